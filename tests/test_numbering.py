"""Numbering of scanned and shuffled lines, merges of dense parts, look-up tables, kept samples, long alleles."""

import random
import time

import pytest
from pyspark.sql import functions as F

from varframe.operators import annotate as an
from varframe.operators import index as ix
from varframe.operators import lines as ln
from varframe.operators import merge as mg
from varframe.operators import vcf
from varframe.plans import jobs
from varframe.sources import text


@pytest.fixture
def scanned(spark, tmp_path):
    path = tmp_path / "in.vcf"
    path.write_text("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n" + "".join(f"c\t{i}\t.\tA\tC\t.\t.\t.\n" for i in range(500)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    yield text.scan_lines(spark, str(path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_shuffled_lines_that_kept_their_columns(spark, scanned):
    _, body = ln.split_header_body(scanned)
    assert body.rdd.getNumPartitions() > 5
    got = ix.split_index(body).orderBy("idx").collect()
    assert [(r.idx, r.value.split("\t")[1]) for r in got] == [(i, str(i)) for i in range(500)]
    shuffled = body.repartition(7)
    with pytest.raises(Exception, match="left their scan partitions"):
        ix.split_index(shuffled).collect()
    assert [r.value for r in ix.dense_index(shuffled, text.LINE_KEY).orderBy("idx").collect()] == [r.value for r in got]
    out = jobs.line_batches(shuffled.unionByName(scanned.where(ln.is_header())), text.LINE_KEY, ["cat"], 40, partitions=3)
    assert [r.value for r in out.orderBy("line_no").collect()][1:] == [r.value for r in got]


def test_dense_index_keeps_nothing_in_memory(spark):
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    assert ix.dense_index(spark.range(100), ["id"]).agg(F.sum("idx")).first()[0] == 4950
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == before


def test_part_files_go_by_number(spark):
    names = ["/a/part-99999-x.txt", "/a/part-100000-x.txt", "/a/part-00002-x.txt", "/b/part-00001.txt", "/a/other.txt", "/a/part-x"]
    df = spark.createDataFrame([(n,) for n in names], "file string")
    got = [r.file for r in df.orderBy(ix.file_order("file")).collect()]
    assert [n for n in got if n.startswith("/a/part-") and n[8].isdigit()] == [names[2], names[0], names[1]]


def parts_of(spark, seed):
    r = random.Random(seed)
    rows = []
    for part in range(6):
        for suffix in ("a.txt", "b.vcf", "c.csv", "d.bin"):
            if r.random() < 0.8:
                n = r.randrange(9)
                lines = ["#h"] * r.randrange(3) * (suffix == "b.vcf") + [r.choice(["#stray", "x"]) if suffix == "b.vcf" else "x" for _ in range(n)]
                rows += [(part, suffix, i, f"{v}{part}-{i}") for i, v in enumerate(lines)]
    return spark.createDataFrame(rows, "part int, suffix string, line_no long, value string").repartition(5)


@pytest.mark.parametrize("seed", range(5))
def test_dense_merge_equals_the_general_one(spark, seed):
    parts = parts_of(spark, seed)
    head = spark.createDataFrame([(0, "##x"), (1, "#CHROM")], "k long, value string")
    want = mg.merge_routed(parts, head, ["k"]).collect()
    assert sorted(mg.merge_routed(parts, head, ["k"], dense=True).collect()) == sorted(want)
    assert len({(r.suffix, r.line_no) for r in want}) == len(want)


def test_dense_merge_refuses_gaps(spark):
    parts = spark.createDataFrame([(0, "a.txt", 0, "x"), (0, "a.txt", 2, "y")], "part int, suffix string, line_no long, value string")
    head = spark.createDataFrame([(0, "#CHROM")], "k long, value string")
    with pytest.raises(Exception, match="without gaps"):
        mg.merge_routed(parts, head, ["k"], dense=True).collect()


def test_merge_plans_read_nothing(spark):
    """Plans of merges are made without running a job."""
    broken = spark.range(3).select(F.lit(0).alias("part"), F.lit("x.vcf").alias("suffix"), "id", F.raise_error(F.lit("ran")).cast("string").alias("value"))
    broken = broken.withColumnRenamed("id", "line_no")
    head = spark.createDataFrame([(0, "#CHROM")], "k long, value string")
    mg._vcf_rows(broken, head, ["k"])


def test_read_parts(spark, tmp_path):
    for name, lines in {"10.a.b.txt": ["x", "y"], "2.vcf": ["#", "r"], "0.a.b.txt": [], "3": ["z"]}.items():
        (tmp_path / name).write_text("".join(v + "\n" for v in lines))
    got = sorted(map(tuple, text.read_parts(spark, [str(p) for p in tmp_path.iterdir()]).collect()), key=str)
    assert got == sorted([(10, "a.b.txt", 0, "x"), (10, "a.b.txt", 1, "y"), (2, "vcf", 0, "#"), (2, "vcf", 1, "r"), (3, None, 0, "z")], key=str)


def test_lookup_tables_serve_many_runs(spark):
    rows = spark.createDataFrame([("c", 1, "A", "C")] * 30 + [("c", 2, "A", "C")], "chrom string, pos long, ref string, alt string")
    table = spark.createDataFrame([("c", 1, "A", "C", 0.1, "i"), ("c", 1, "A", "C", 0.3, "h"), ("c", 1, "A", "G", 0.2, "g")],
                                  "chrom string, pos long, ref string, alt string, af double, id string")
    made = an.lookup(table, ["af", "id"])
    assert "Aggregate" not in made._jdf.queryExecution().toString()
    for prepared, t in ((True, made), (False, table)):
        got = an.annotate_exact(rows, t, ["af", "id"], prepared=prepared).groupBy("pos", "af", "id").count().collect()
        assert sorted(map(tuple, got)) == [(1, "0.3", "h", 30), (2, ".", ".", 1)]
    ids = an.annotate_existing(rows, an.lookup_ids(table), prepared=True)
    assert {(r.pos, r.existing) for r in ids.collect()} == {(1, "g,h,i"), (2, ".")}
    wide = an.lookup_af({"p": table, "q": table.where("af < 0.15")})
    assert {(r.pos, r.p, r.q, r.max_af) for r in an.annotate_max_af(rows, ["p", "q"], table=wide).collect()} == {(1, 0.3, 0.1, 0.3), (2, None, None, None)}


def test_kept_samples_of_short_and_long_lines(spark):
    names = spark.createDataFrame([(i, f"S{i}") for i in range(50)], "sample_idx int, sample string")
    rows = spark.createDataFrame([("c", 1, "A", "C", ["DP", "GT"], [f"{i}:{i}/1" for i in range(50)]), ("c", 2, "A", "C", ["GT"], ["0/1"]), ("c", 3, "A", "C", None, None)],
                                 "chrom string, pos long, ref string, alt string, format array<string>, samples array<string>")
    keep = spark.createDataFrame([("S7",), ("S0",), ("S0",), ("nobody",)], "sample string")
    got = vcf.samples_long(rows, names, keep)
    assert sorted((r.pos, r["sample"], r.gt) for r in got.collect()) == [(1, "S0", "0/1"), (1, "S7", "7/1"), (2, "S0", "0/1")]
    assert vcf.samples_long(rows, names).count() == 51


def test_minimal_form_of_long_alleles(spark):
    r = random.Random(2)
    long = "".join(r.choice("ACGT") for _ in range(40000))
    rows = [(5, long + "A" + long, long + "CC" + long), (1, long, long), (9, "A" + long, long[:100]), (3, "ACGTT", "ACT"), (3, "é", "éé")]
    df = spark.createDataFrame(rows, "pos long, ref string, alt string").coalesce(1)
    t = time.time()
    got = {(x.ref, x.alt): (x.min_pos, x.min_ref, x.min_alt) for x in vcf.minimal(df).collect()}
    assert time.time() - t < 20
    for pos, ref, alt in rows:
        a, b = ref, alt
        n = 0
        while a and b and a[-1] == b[-1] and n < 90000:
            a, b, n = a[:-1], b[:-1], n + 1
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        assert got[ref, alt] == (pos + k, a[k:] or "-", b[k:] or "-")
