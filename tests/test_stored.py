"""Stored output numbered from counts, lines made when they are written, problems judged once, first lines by number."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from varframe.operators import index as ix
from varframe.operators import merge as mg
from varframe.operators import typed
from varframe.plans import fixtures as fx
from varframe.plans import jobs
from varframe.sources import sinks


def plan(df):
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain()
    return shown.getvalue()


def test_stored_index_numbers_what_stays(spark):
    rows = [(p, i, f"{'#' if (p + i) % 3 == 0 else ''}{p}:{i}") for p in (0, 2, 5) for i in range(7)]
    df = spark.createDataFrame(rows, "part int, line_no long, value string").repartition(5)
    got = ix.stored_index(df, "part", keep=~F.col("value").startswith("#"), start=10).select("idx", "value").orderBy("idx").collect()
    assert [tuple(r) for r in got] == [(10 + i, v) for i, v in enumerate(v for _, _, v in rows if not v.startswith("#"))]


def test_stored_index_fails_on_gaps(spark):
    df = spark.createDataFrame([(0, 0, "a"), (0, 2, "b")], "part int, line_no long, value string")
    with pytest.raises(Exception, match="without gaps"):
        ix.stored_index(df, "part").collect()


def test_job_output_is_numbered_without_a_range_shuffle(spark):
    head = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
    lines = spark.createDataFrame(list(enumerate(head + [f"c\t{i}\t.\ta\tg\t.\t.\t." for i in range(50)])), "line_no long, value string")
    out = jobs.line_batches(lines, ["line_no"], ["sh", "-c", "echo '#x'; tr a-z A-Z"], 7)
    assert "rangepartitioning" not in plan(out)
    got = [r["value"] for r in out.orderBy("line_no").collect()]
    assert got == head + [f"C\t{i}\t.\tA\tG\t.\t.\t." for i in range(50)]
    assert [r["line_no"] for r in out.orderBy("line_no").collect()] == list(range(52))


def test_first_lines_sort_no_texts(spark):
    parts = spark.createDataFrame([(p, "x.txt", i, f"{p}-{i}") for p in range(3) for i in range(4, 1, -1)], "part int, suffix string, line_no long, value string")
    out = mg.first_lines(parts)
    assert sorted(r["value"] for r in out.collect()) == ["0-2", "1-2", "2-2"]
    assert "HashAggregate(keys=[part" in plan(out)


def test_value_made_after_the_order(spark, tmp_path):
    df = spark.range(100).select((99 - F.col("id")).alias("k"))
    p = sinks.write_lines(df, str(tmp_path / "x"), ["k"], value=F.concat(F.lit("v"), F.col("k").cast("string")).alias("value"), partitions=3)
    got = [r[0] for f in range(3) for r in spark.read.text(f"{p}/part-0000{f}*").collect()]
    assert got == [f"v{i}" for i in range(100)]


@pytest.mark.parametrize(("mod", "step", "text"), [(7, 1, "{}"), (99, 7, "{}"), (100, 1, "0.{:02d}")])
def test_cyclic_is_the_joined_list(spark, mod, step, text):
    df = spark.range(300).selectExpr("id as k", "cast(id % 5 + 1 as int) as n")
    got = df.select("k", "n", F.expr(fx._cyclic("k", "n", mod, step, text)).alias("v")).collect()
    assert all(r.v == ",".join(text.format((r.k + step * i) % mod) for i in range(r.n)) for r in got)


def test_problems_are_judged_once(spark):
    schema = typed.schema_of(['##INFO=<ID=AC,Number=A,Type=Integer,Description="x">', '##INFO=<ID=AF,Number=A,Type=Float,Description="x">'])
    values = ["1,2", "1,.", "x,2", "1", "99999999999,1", "", "1e3,2", "-1,+2"]
    rows = spark.createDataFrame([(i, ["A", "C"], {"AC": v, "AF": v}) for i, v in enumerate(values)], "i int, alt array<string>, info map<string,string>")
    out = typed.typed_info(rows, schema)
    got = {r["i"]: {(v["id"], v["problem"]) for v in r["violations"]} for r in out.collect()}
    assert got == {0: set(), 1: set(), 2: {("AC", "type"), ("AF", "type")}, 3: {("AC", "number"), ("AF", "number")}, 4: {("AC", "type")},
                   5: {("AC", "type"), ("AF", "type")}, 6: {("AC", "type")}, 7: set()}


def test_one_gzip_file_is_read_by_ranges(spark, tmp_path):
    from varframe.sources import bgzf

    df = spark.range(20000).select("id", F.concat(F.lit("line "), F.xxhash64("id").cast("string")).alias("value"))
    p = sinks.write_file(df, str(tmp_path / "x.gz"), ["id"], compression="gzip", partitions=3)
    assert bgzf.is_bgzf(p)
    back = bgzf.read_lines(spark, p, range_bytes=1 << 15)
    assert back.select("block").distinct().count() > 1
    got = [r["value"] for r in ix.split_index(back).orderBy("idx").collect()]
    assert got == [r["value"] for r in df.orderBy("id").collect()]
