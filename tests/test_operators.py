"""Operator tests on tiny inline frames with edge rows."""

import pytest
from pyspark.sql import functions as F

from varframe.operators import annotate as an
from varframe.operators import external as ex
from varframe.operators import index as ix
from varframe.operators import lines as ln
from varframe.operators import merge as mg
from varframe.operators import vcf
from varframe.sources import sinks

# A small VCF of our own with the edge rows of FIXTURES.md: QUAL '.', empty INFO '.',
# flag INFO, duplicate INFO key, fewer sample values than FORMAT keys, symbolic and '*' alleles.
VCF = [
    "##fileformat=VCFv4.2",
    '##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth">',
    '##INFO=<ID=DB,Number=0,Type=Flag,Description="dbSNP">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    "##contig=<ID=chr1,length=1000>",
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2",
    "chr1\t10\t.\tATT\tAT\t45.90\tPASS\tDP=10;DB\tGT:DP\t0/1:3\t1/1:4",
    "chr1\t20\trs1\tG\tA,C\t.\t.\t.\tGT:DP:GQ\t1/2:5\t0/0",
    "chr1\t30\t.\tA\t<DEL>\t12\tq10\tDP=3;DP=4\tGT\t0|1\t1|0",
    "chr1\t40\t.\tC\t*\t7.5\tPASS\tDP=1\tGT\t./.\t0/1",
    "chr1\t50\t.\tCA\tCATA\t100\tPASS\tDB;DP=9\tGT:DP\t0/1:1\t0/1:2",
    "chr1\t60\t.\tTTGG\tT\t1e3\tPASS\tDP=2\tGT\t1/1\t1/1",
]


def _lines(spark):
    rows = [(i, v) for i, v in enumerate(VCF)]
    return spark.createDataFrame(rows, "seq long, value string")


def test_split_halves_add_up(spark):
    df = _lines(spark)
    head, body = ln.split_header_body(df)
    assert head.count() == 6 and body.count() == 6
    assert head.count() + body.count() == df.count()


def test_sample_names(spark):
    head, _ = ln.split_header_body(_lines(spark))
    got = [(r.sample_idx, r.sample) for r in ln.sample_names(head, ["seq"]).orderBy("sample_idx").collect()]
    assert got == [(0, "S1"), (1, "S2")]


def test_vcf_round_trip(spark):
    _, body = ln.split_header_body(_lines(spark))
    back = vcf.format_rows(vcf.parse(body))
    # a repeated INFO key is collapsed to its last value; every other line comes back as it was
    expected = [v.replace("DP=3;DP=4", "DP=4") for v in VCF[6:]]
    assert sorted(r.value for r in back.collect()) == sorted(expected)


def test_vcf_parse_edges(spark):
    _, body = ln.split_header_body(_lines(spark))
    rows = {r.pos: r for r in vcf.parse(body).collect()}
    assert rows[20].qual is None and rows[20].filter is None and rows[20].info == {}
    assert rows[20].alt == ["A", "C"] and rows[20].id == "rs1"
    assert rows[10].info == {"DP": "10", "DB": None} and rows[10].qual == 45.9 and rows[10].qual_raw == "45.90"
    assert rows[30].info == {"DP": "4"}  # last value of a repeated key
    maps = {r.pos: r for r in vcf.sample_maps(vcf.parse(body)).collect()}
    assert maps[20].samples[1] == {"GT": "0/0"}  # fewer values than FORMAT keys


def test_vcf_meta(spark):
    head, _ = ln.split_header_body(_lines(spark))
    m = {r.id: r for r in vcf.meta(head).collect()}
    assert m["DP"].kind == "INFO" and m["DP"].type == "Integer" and m["DB"].number == "0"
    assert m["chr1"].kind == "contig" and m["chr1"].length == 1000


@pytest.mark.parametrize(
    "pos,ref,alt,expected",
    [
        (10, "ATT", "AT", (11, "T", "-")),
        (5, "GCA", "GTA", (6, "C", "T")),
        (7, "A", "C", (7, "A", "C")),
        (3, "TTGG", "T", (4, "TGG", "-")),
        (9, "CA", "CATA", (10, "-", "AT")),
    ],
)
def test_minimal_alleles(spark, pos, ref, alt, expected):
    df = spark.createDataFrame([(pos, ref, alt)], "pos long, ref string, alt string")
    r = vcf.minimal(df).first()
    assert (r.min_pos, r.min_ref, r.min_alt) == expected


def test_variant_class(spark):
    df = spark.createDataFrame(
        [("A", "C"), ("A", "AT"), ("AT", "A"), ("AC", "GT"), ("ACG", "T"), ("A", "<DEL>"), ("C", "*")],
        "ref string, alt string")
    got = [r.variant_class for r in vcf.with_class(df).collect()]
    assert got == ["SNV", "insertion", "deletion", "substitution", "indel", "sequence_alteration",
                   "sequence_alteration"]


def test_explode_alleles(spark):
    df = spark.createDataFrame([("chr1", 20, "G", ["A", "C"])], "chrom string, pos long, ref string, alt array<string>")
    got = [(r.allele_num, r.alt) for r in vcf.explode_alleles(df).collect()]
    assert got == [(1, "A"), (2, "C")]


@pytest.mark.parametrize("parts", [2, 8, 31])
def test_dense_index_and_batches_independent_of_partitions(spark, parts):
    df = spark.range(1003).select((F.col("id") * 7919 % 1003).alias("k")).repartition(parts)
    out = ix.batch(ix.dense_index(df, ["k"], partitions=parts), 100)
    rows = out.orderBy("k").collect()
    assert [r.idx for r in rows] == list(range(1003))
    sizes = {}
    for r in rows:
        sizes[r.batch_id] = sizes.get(r.batch_id, 0) + 1
    assert [sizes[b] for b in sorted(sizes)] == [100] * 10 + [3]


def test_dense_index_grouped(spark):
    df = spark.createDataFrame([(g, i) for g in "abc" for i in range(50)], "g string, i long")
    out = ix.dense_index(df, ["i"], group=["g"], partitions=7).collect()
    assert all(r.idx == r.i for r in out)


def test_batch_partitions_at_least_one():
    assert ix.batch_partitions(99, 20000) == 1
    assert ix.batch_partitions(40001, 20000) == 3


def test_header_for_batches(spark):
    head, body = ln.split_header_body(_lines(spark))
    h = ln.header_for_batches(head, ["seq"], 3)
    assert h.count() == 18
    assert sorted({r.batch_id for r in h.collect()}) == [0, 1, 2]


def test_pipe_identity_and_order(spark):
    df = spark.range(500).select(F.format_string("line%04d", "id").alias("value"), "id")
    out = ex.pipe_partitions(df, ["cat"], order=["id"], partitions=5)
    got = [r.value for r in ix.dense_index(out, ["part", "line_no"]).orderBy("idx").collect()]
    assert got == [f"line{i:04d}" for i in range(500)]


def test_pipe_failure_fails_job(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("value"))
    with pytest.raises(Exception) as err:
        ex.pipe_partitions(df, ["sh", "-c", "cat >/dev/null; echo boom >&2; exit 3"]).collect()
    assert "exited with 3" in str(err.value) or "boom" in str(err.value)


def test_pipe_batches_with_header_drop(spark):
    df = spark.createDataFrame([(0, 0, "#h"), (0, 1, "a"), (1, 0, "b")], "batch_id long, pos_in_batch int, value string")
    out = ln.drop_header_lines(ex.pipe_batches(df, ["tr", "a-z", "A-Z"]))
    assert sorted((r.batch_id, r.value) for r in out.collect()) == [(0, "A"), (1, "B")]


def test_multi_output(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("value"), "id")
    cmd = ["sh", "-c", "tee {out}.a.txt > {out}.b.vcf"]
    out = ex.pipe_multi_output(df, cmd, order=["id"], partitions=3)
    got = out.groupBy("suffix").count().orderBy("suffix").collect()
    assert [(r.suffix, r["count"]) for r in got] == [("a.txt", 20), ("b.vcf", 20)]


@pytest.mark.parametrize("step", ["pipe_partitions", "write_lines"])
def test_ranges_grow_with_the_rows(spark, tmp_path, monkeypatch, step):
    """6000 lines in 8 shuffle partitions, at most about 100 to be sorted by a task: 60 ranges, the lines in order."""
    monkeypatch.setattr(ix, "RANGE_ROWS", 100)
    df = spark.range(6000).select((F.lit(5999) - F.col("id")).alias("id")).withColumn("value", F.format_string("line%04d", "id"))
    if step == "pipe_partitions":
        rows = ex.pipe_partitions(df.repartition(5), ["cat"], order=["id"]).orderBy("part", "line_no").collect()
        held = [[r.value for r in rows if r.part == part] for part in sorted({r.part for r in rows})]
    else:
        path = tmp_path / "out"
        sinks.write_lines(df.repartition(5), str(path), ["id"])
        held = [f.read_text().split() for f in sorted(path.glob("part-*"))]
    assert sum(held, []) == [f"line{i:04d}" for i in range(6000)]
    assert len(held) >= 50 and max(map(len, held)) < 300


def test_few_rows_take_the_sessions_partitions(spark):
    assert ix.ordered(spark.range(50), ["id"]).rdd.getNumPartitions() <= 8
    assert ix.range_count(spark.range(50)) == 8 and ix.range_count(spark.range(8 * ix.RANGE_ROWS + 1)) == 9


def test_multi_output_sorts_small_ranges(spark, monkeypatch):
    """Two processes for 1000 lines, put in order 100 lines at a time: an output is its process's lines in order."""
    asked = []
    monkeypatch.setattr(ex, "RANGE_LINES", 100)
    monkeypatch.setattr(ex, "ordered", lambda df, order, n=None, f=ex.ordered: asked.append(n) or f(df, order, n))
    df = spark.range(1000).select((F.lit(999) - F.col("id")).alias("id")).withColumn("value", F.format_string("line%04d", "id"))
    out = ex.pipe_multi_output(df.repartition(5), ["sh", "-c", "cat > {out}.txt"], order=["id"], partitions=2)
    rows = sorted((r.part, r.line_no, r.value) for r in out.collect())
    assert asked == [10]
    assert [v for _, _, v in rows] == [f"line{i:04d}" for i in range(1000)]
    assert [n for p, n, _ in rows if p == 0] + [n for p, n, _ in rows if p == 1] == [
        *range(sum(p == 0 for p, _, _ in rows)), *range(sum(p == 1 for p, _, _ in rows))]
    assert {p for p, _, _ in rows} == {0, 1} and min(sum(p == i for p, _, _ in rows) for i in (0, 1)) > 200


def test_multi_output_runs_a_process_without_lines(spark, monkeypatch):
    """All lines have one key and fall in few ranges; each of the processes still prints its own line."""
    monkeypatch.setattr(ex, "RANGE_LINES", 10)
    df = spark.range(200).select(F.lit(1).alias("id"), F.lit("x").alias("value"))
    out = ex.pipe_multi_output(df, ["sh", "-c", "{ echo own; cat; } > {out}.txt"], order=["id"], partitions=4).collect()
    assert sorted(r.part for r in out if r.value == "own") == [0, 1, 2, 3] and len(out) == 204


def test_batch_files_share_frames(spark, tmp_path):
    """Output of many small batches is handed on in few frames, and a tool without input starts no thread."""
    import threading

    import pandas as pd

    class Frame:  # takes the task's function
        def mapInPandas(self, run, schema):
            self.run = run
            return self

    with pytest.MonkeyPatch.context() as m:
        m.chdir(tmp_path)
        m.setattr(ex, "_by_batch", lambda *a: Frame())
        m.setattr(threading.Thread, "start", lambda self: pytest.fail("a thread was started"))
        taken = ex.pipe_batches_file(None, ["sh", "-c", "tr a-z A-Z < {in} > {out}.up.txt && wc -l < {in} | tr -d ' '; echo note >&2"])
        rows = pd.DataFrame({"batch_id": [i // 3 for i in range(200)], "value": [f"l{i}" for i in range(200)]})
        frames = list(taken.run(iter([rows.iloc[:100], rows.iloc[100:100], rows.iloc[100:]])))
        failing = ex.pipe_batches_file(None, ["sh", "-c", "echo boom >&2; exit 3"])
        with pytest.raises(ex.ExternalCommandError, match="exited with 3: boom"):
            list(failing.run(iter([rows])))
    assert len(frames) == 1 and not list(tmp_path.iterdir())
    got = sorted(frames[0].itertuples(index=False, name=None))
    want = [(b, "", 0, str(min(3, 200 - 3 * b))) for b in range(67)] + [(i // 3, "up.txt", i % 3, f"L{i}") for i in range(200)]
    assert got == sorted(want)


def test_merge_tables_keeps_first_present_header(spark):
    parts = spark.createDataFrame(
        [(1, "t.txt", 0, "H"), (1, "t.txt", 1, "x"), (3, "t.txt", 0, "H"), (3, "t.txt", 1, "y")],
        "part int, suffix string, line_no long, value string")
    got = [r.value for r in mg.merge_tables(parts).orderBy("line_no").collect()]
    assert got == ["H", "x", "y"]


def test_info_declarations_empty_without_columns(spark):
    cols = spark.createDataFrame([], "col_idx int, name string")
    assert mg.info_declarations(cols).count() == 0


def test_point_overlap_left_and_flank(spark):
    rows = spark.createDataFrame([("c", 5), ("c", 15), ("c", 40), ("d", 1)], "chrom string, pos long")
    genes = spark.createDataFrame([("c", 10, 20, 1), ("c", 30, 35, 2), ("c", 50, 60, 3)],
                                  "chrom string, start long, end long, gene long")
    hit = {r.pos: r.gene for r in an.annotate_overlap(rows, genes, ["gene"], bin_size=8).collect()}
    assert hit == {5: None, 15: 1, 40: None, 1: None}
    fl = {r.pos: (r.up_end, r.down_start) for r in an.annotate_flank(rows, genes, bin_size=8).collect()}
    assert fl == {5: (None, 10), 40: (35, 50), 1: (None, None)}


def test_pick_and_pack(spark):
    df = spark.createDataFrame([("g", 1, 5.0), ("g", 2, 9.0), ("g", 3, 7.0), ("h", 4, 1.0)],
                               "gene string, v long, q double")
    top = an.pick(df, ["gene"], [F.col("q").desc()], k=2, rank="rank").collect()
    assert sorted((r.gene, r.rank, r.v) for r in top) == [("g", 1, 2), ("g", 2, 3), ("h", 1, 4)]
    packed = an.pack(df, ["gene"], ["v", "q"]).orderBy("gene").collect()
    assert packed[0].ANN == "1|5.0,2|9.0,3|7.0"


def test_stream_job(spark, tmp_path):
    from varframe.streaming.pipe_stream import annotate_stream

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.vcf").write_text("\n".join(VCF) + "\n")
    q = annotate_stream(spark, str(src), str(tmp_path / "out"), ["tr", "a-z", "A-Z"],
                        checkpoint=str(tmp_path / "ckpt"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted(r.value for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted(v.upper() for v in VCF[6:])


def test_job_run_and_write(spark, tmp_path):
    from varframe.plans import jobs
    from varframe.sources.text import scan_lines

    src = tmp_path / "in.vcf"
    src.write_text("\n".join(VCF) + "\n")
    out = str(tmp_path / "out")
    for tool in ("snpeff", "vep"):
        job = jobs.Job(tool, ("sh", "-c", "echo '#x'; tr a-z A-Z"), str(src), out + tool, batch_size=4)
        jobs.write(jobs.run(spark, job), job.output)
        got = [r.value for r in ix.split_index(scan_lines(spark, job.output)).orderBy("idx").collect()]
        assert got == VCF[:6] + [v.upper() for v in VCF[6:]]
    with pytest.raises(ValueError):
        jobs.run(spark, jobs.Job("nope", ("cat",), str(src)))


def test_point_overlap_salted_shuffle_path(spark):
    from varframe.operators.overlap import point_overlap

    # one hot position holding most rows, intervals forced onto the shuffle path
    rows = spark.createDataFrame([("c", 15)] * 200 + [("c", 40), ("c", 5)], "chrom string, pos long")
    iv = spark.createDataFrame([("c", 10, 20, 1), ("c", 12, 16, 2), ("c", 38, 41, 3)],
                               "chrom string, start long, end long, gene long")
    for how in ("inner", "left", "left_semi", "left_anti"):
        small = point_overlap(rows, iv, how=how, bin_size=8)
        salted = point_overlap(rows, iv, how=how, bin_size=8, salt=4)
        assert sorted(map(tuple, small.collect())) == sorted(map(tuple, salted.collect())), how
    assert point_overlap(rows, iv, how="inner", bin_size=8).count() == 401
