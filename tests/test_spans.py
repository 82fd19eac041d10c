"""Spans against intervals, variants with length, and headers after a tool that edits them."""

import random

import pytest
from pyspark.sql import functions as F

from varframe.operators import annotate as an
from varframe.operators import overlap as ov
from varframe.operators import vcf
from varframe.plans import jobs

HEAD = ["##fileformat=VCFv4.2", '##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth">',
        '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">', "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1"]
GENES = [("c", 100, 200, 1), ("c", 500, 600, 2)]


def genes(spark, rows=GENES):
    return spark.createDataFrame(rows, "chrom string, start long, end long, gene long")


@pytest.fixture(scope="module")
def drawn():
    """Intervals of all sizes, and the pairs that overlap."""
    r = random.Random(1)

    def span():
        first = r.randrange(400_000_000) if r.random() < 0.5 else r.randrange(200_000)
        return first, first + (int(2 ** r.uniform(0, 29)) if r.random() < 0.7 else r.randrange(1, 5)) - 1

    a = [(i, r.choice("cd"), *span()) for i in range(400)] + [(1000, None, 1, 2), (1001, "c", None, 5), (1002, "c", 9, 3), (1003, "c", 0, 2**61)]
    a += [a[7], a[7]]
    b = [(i, r.choice("cd"), *span()) for i in range(300)] + [(2000, "c", 0, 2**60), (2001, "c", 5, 1), (2002, None, 1, 9)]
    pairs = [(x[0], y[0]) for x in a for y in b if None not in x and x[1] == y[1] and x[2] <= x[3] and y[2] <= y[3] and x[2] <= y[3] and y[2] <= x[3]]
    return a, b, pairs


@pytest.mark.parametrize("threshold", ["10m", "-1"])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_span_overlap_equals_all_pairs(spark, drawn, how, threshold):
    rows, table, pairs = drawn
    a = spark.createDataFrame(rows, "i long, chrom string, pos long, end long")
    b = spark.createDataFrame(table, "k long, chrom string, start long, stop long")
    met = {i for i, _ in pairs}
    ids = [x[0] for x in rows]
    want = {"inner": pairs, "left": pairs + [(i, None) for i in ids if i not in met],
            "left_semi": [(i,) for i in ids if i in met], "left_anti": [(i,) for i in ids if i not in met]}[how]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        out = ov.span_overlap(a, b, how, interval=("start", "stop"))
        got = [tuple(r) for r in out.select(*(["i", "k"] if how in ("inner", "left") else ["i"])).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sorted(got, key=str) == sorted(want, key=str)


def test_long_intervals_become_few_rows(spark):
    one = spark.createDataFrame([(0, 248_956_421), (16_000, 17_000), (5, 5)], "_t_lo long, _t_hi long")
    lo, hi = F.col("_t_lo"), F.col("_t_hi")
    own = ov.level_of(lo, hi)
    slots = F.concat(ov._slots(F.sequence(own, F.lit(len(ov.LEVEL_BITS) - 1)), 0, lo, hi), ov._slots(F.array(own), 1, lo, hi))
    counts = {r["_t_lo"]: r.n for r in one.select("_t_lo", F.size(slots).alias("n")).collect()}
    assert counts[0] <= 8 and counts[5] == len(ov.LEVEL_BITS) + 1 and counts[16_000] <= 2 * (len(ov.LEVEL_BITS) + 1)


def test_a_hot_place_is_matched_once(spark):
    """A place that holds most rows goes through the interval join as one row."""
    rows = spark.range(5000).select(F.lit("c").alias("chrom"), F.lit(150).cast("long").alias("pos"), F.lit(150).cast("long").alias("end"), "id")
    assert an.annotate_overlap(rows, genes(spark), ["gene"], end="end").where("gene = 1").count() == 5000


def test_deletion_that_reaches_a_gene(spark):
    rows = spark.createDataFrame([("c", 90, "A" * 30, ["A"], {"DP": "1"}), ("c", 90, "A", ["T"], {}), ("c", 210, "N", ["<DEL>"], {"END": "505"}),
                                  ("c", 300, "A", ["T"], {"END": "900"}), ("d", 1, "A", ["T"], {})],
                                 "chrom string, pos long, ref string, alt array<string>, info map<string,string>")
    spans = vcf.with_end(rows, "last", info="info")
    assert [r["last"] for r in spans.collect()] == [119, 90, 505, 300, 1]
    hits = {(r.pos, r["last"]): r.gene for r in an.annotate_overlap(spans, genes(spark), ["gene"], end="last").collect()}
    assert hits == {(90, 119): 1, (90, 90): None, (210, 505): 2, (300, 300): None, (1, 1): None}
    flanks = {(r.pos, r["last"]): (r.up_end, r.down_start) for r in an.annotate_flank(spans, genes(spark), end="last", bin_size=64).collect()}
    assert flanks == {(90, 90): (None, 100), (300, 300): (200, 500), (1, 1): (None, None)}
    near = {(r.pos, r["last"], r.gene): (r.relation, r.distance) for r in an.annotate_distance(spans, genes(spark), distance=100, end="last").collect()}
    assert near == {(90, 119, 1): ("within", 0), (90, 90, 1): ("upstream", 10), (210, 505, 1): ("downstream", 10),
                    (210, 505, 2): ("within", 0), (300, 300, 1): ("downstream", 100)}
    wanted = spark.createDataFrame([("c", 119, 119), ("d", None, None), ("c", 450, 460)], "chrom string, start long, end long")
    assert sorted((r.pos, r["last"]) for r in an.restrict(spans, wanted, end="last").collect()) == [(1, 1), (90, 119), (210, 505)]


def test_flank_covered_by_a_long_gene_before_a_short_one(spark):
    rows = spark.createDataFrame([("c", 50), ("c", 150), ("c", 95), (None, 5)], "chrom string, pos long")
    table = genes(spark, [("c", 10, 90, 1), ("c", 20, 30, 2), ("c", 200, 210, 3)])
    got = {r.pos: (r.up_end, r.down_start) for r in an.annotate_flank(rows, table, bin_size=16).collect()}
    assert got == {150: (90, 200), 95: (90, 200), 5: (None, None)}


def lines(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "line_no long, value string")


def body(*infos):
    return [f"c\t{90 + 10 * i}\t.\t{'A' * 20}\tA\t.\tPASS\t{x}\tGT\t0/1" for i, x in enumerate(infos)]


def run_tool(spark, tmp_path, script):
    src = tmp_path / "in.vcf"
    src.write_text("\n".join(HEAD + body("DP=1", "DP=2")) + "\n")
    outs = []
    for tool in ("snpeff", "vep"):
        out = jobs.run(spark, jobs.Job(tool, ("sh", "-c", script), str(src), batch_size=1, partitions=2))
        outs.append([r.value for r in out.orderBy(*jobs.OUTPUT_ORDER).collect()])
    assert outs[0] == outs[1]
    return outs[0]


def test_a_rewritten_declaration_adds_nothing(spark, tmp_path):
    got = run_tool(spark, tmp_path, """echo '##INFO=<ID=DP,Number=1,Type=Integer,Description="Read depth",Source="x">'; cat""")
    assert got == HEAD + body("DP=1", "DP=2")


def test_new_declarations_come_once_each(spark, tmp_path):
    new = ['##FILTER=<ID=q9,Description="Low">', '##FORMAT=<ID=XX,Number=1,Type=String,Description="Added">',
           '##INFO=<ID=GT,Number=1,Type=String,Description="Not the format field">', '##INFO=<ID=ZZ,Number=0,Type=Flag,Description="A">']
    script = "; ".join(f"echo '{x}'" for x in reversed([*new, '##INFO=<ID=ZZ,Number=0,Type=Flag,Description="B">', "##contig=<ID=c>", HEAD[1]])) + "; cat"
    got = run_tool(spark, tmp_path, script)
    assert got == HEAD[:-1] + new + HEAD[-1:] + body("DP=1", "DP=2")


def test_native_annotate_edits_one_entry(spark):
    rows = body("DP=3;DP=4", ".", "ANN=old;DP=1", "DP=1;ANN=old;X", "ANN=old")
    table = spark.createDataFrame([("c", 100, 109, "g", "b")], "chrom string, start long, end long, symbol string, biotype string")
    head = [*HEAD[:2], '##INFO=<ID=ANN,Number=1,Type=String,Description="Old">', *HEAD[2:]]
    out = [(r.line_no, r.value) for r in jobs.native_annotate(lines(spark, head + rows), table).orderBy("line_no").collect()]
    decl = '##INFO=<ID=ANN,Number=.,Type=String,Description="Overlapping genes: symbol|biotype">'
    want = body("DP=3;DP=4;ANN=g|b", "ANN=g|b", "DP=1;ANN=.", "DP=1;X;ANN=.", "ANN=.")
    assert out == list(enumerate(HEAD[:3] + [decl] + HEAD[3:] + want))
    fresh = [(r.line_no, r.value) for r in jobs.native_annotate(lines(spark, HEAD + rows[:2]), table).orderBy("line_no").collect()]
    assert fresh == list(enumerate(HEAD[:3] + [decl] + HEAD[3:] + want[:2]))


@pytest.mark.parametrize("end", [None, "end"])
def test_a_table_that_grows_when_exploded_is_not_broadcast(spark, end):
    """The planner's estimate is that of 20,000 ids; the join would hold some 300,000 rows in the driver."""
    iv = spark.range(20_000).selectExpr("id as gene", "'c' as chrom", "id * 750 as start", "id * 750 + 900 as end")
    rows = spark.range(3000).selectExpr("'c' as chrom", "id * 5000 as pos", "id * 5000 + 10 as end")
    out = an.annotate_overlap(rows, iv, ["gene"], end=end)
    import contextlib
    import io

    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        out.explain()
    assert "BroadcastHashJoin" not in shown.getvalue()
    last = 10 if end else 0
    want = sum(1 for i in range(3000) for g in range(max(0, i * 5000 // 750 - 3), min(20_000, i * 5000 // 750 + 3))
               if g * 750 <= i * 5000 + last and i * 5000 <= g * 750 + 900)
    assert out.where("gene is not null").count() == want


@pytest.mark.parametrize("name", ["annotate_gene", "distance_spans", "job_native_annotate", "overlap_spans", "pack_ann", "pick_canonical"])
def test_queries_never_broadcast_exploded_genes(spark, name):
    """The genes of sf0.1 are a small table, but not when exploded over bins: they meet the variants by a shuffle."""
    import contextlib
    import io

    from varframe.plans import catalog

    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        catalog.QUERIES[name](spark, "/root/testdata/sf0.1").explain()
    joins = [x for x in shown.getvalue().split("\n") if "Join" in x and "_bin#" in x]
    assert joins and all("SortMergeJoin" in x for x in joins)
