"""Edge cases of single operators, external tools run once, and the launcher."""

import os
import subprocess
import sys

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from varframe.operators import annotate as an
from varframe.operators import external as ex
from varframe.operators import vcf
from varframe.operators.overlap import point_overlap
from varframe.plans import jobs
from varframe.sources import sinks, text

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HEAD = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\tS3"]
BODY = [f"chr1\t{10 * i}\t.\tA\tC\t.\tPASS\tDP={i}\tGT\t0/1\t0/0\t1/1" for i in range(1, 11)]


def batches(spark, n, size=2):
    return spark.range(n * size).select(
        F.expr(f"id div {size}").alias("batch_id"), F.expr(f"cast(id % {size} as int)").alias("pos_in_batch"),
        F.concat(F.lit("v"), F.col("id")).alias("value"))


def logged(folder):
    """A tool that leaves one file per call, and copies its input."""
    return ["sh", "-c", f"mktemp {folder}/call-XXXXXXXX > /dev/null; cat"]


def test_one_call_per_batch_on_the_asked_tasks(spark, tmp_path):
    out = ex.pipe_batches(batches(spark, 100), logged(tmp_path), partitions=25)
    rows = out.withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in rows}) == 25 and len(os.listdir(tmp_path)) == 100
    assert sorted((r.batch_id, r.line_no, r.value) for r in rows) == [(i // 2, i % 2, f"v{i}") for i in range(200)]


@pytest.mark.parametrize("kind", ["line_batches", "stream"])
def test_jobs_run_the_tool_once(spark, tmp_path, kind):
    lines = spark.createDataFrame(list(enumerate(HEAD + BODY)), "line_no long, value string")
    if kind == "stream":
        out, calls = jobs.stream(lines, ["line_no"], logged(tmp_path), partitions=3), 3
    else:
        out, calls = jobs.line_batches(lines, ["line_no"], logged(tmp_path), 4, partitions=3), 3
    assert [r.value for r in out.orderBy("line_no").collect()] == HEAD + BODY
    assert len(os.listdir(tmp_path)) == calls


def test_batches_larger_than_an_arrow_batch_and_tools_that_stop_early(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        out = ex.pipe_batches(batches(spark, 4, 10), ["cat"], partitions=2, prefix=["h"])
        assert sorted((r.batch_id, r.line_no, r.value) for r in out.collect()) == sorted(
            [(b, 0, "h") for b in range(4)] + [(b, 1 + i, f"v{10 * b + i}") for b in range(4) for i in range(10)])
        few = ex.pipe_batches(batches(spark, 4, 10), ["head", "-n", "1"], partitions=1).collect()
        assert sorted(r.value for r in few) == ["v0", "v10", "v20", "v30"]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_batch_files(spark):
    tool = ["sh", "-c", "sort -r {in} > {out}.a.txt; head -n 1 {in} > {out}.b; echo done"]
    got = ex.pipe_batches_file(batches(spark, 3), tool, partitions=2).collect()
    assert sorted((r.batch_id, r.suffix, r.line_no, r.value) for r in got) == sorted(
        x for b in range(3) for x in [(b, "", 0, "done"), (b, "a.txt", 0, f"v{2 * b + 1}"), (b, "a.txt", 1, f"v{2 * b}"), (b, "b", 0, f"v{2 * b}")])
    with pytest.raises(PySparkException, match="exited with 3"):
        ex.pipe_batches_file(batches(spark, 1), ["sh", "-c", "exit 3"]).collect()


def test_undecodable_output_fails(spark):
    with pytest.raises(PySparkException, match="not UTF-8"):
        ex.pipe_batches(batches(spark, 1), ["printf", r"caf\351\n"]).collect()


def test_whole_contigs_restrict(spark):
    lines = spark.createDataFrame([("chr1",), ("chr2:5-7",), ("chr2:9",)], "value string")
    rows = spark.createDataFrame([("chr1", 1), ("chr1", 10**8), ("chr2", 5), ("chr2", 8), ("chr2", 9), ("chr3", 5), (None, 1)], "chrom string, pos long")
    got = an.restrict(rows, text.parse_intervals(lines))
    assert sorted(map(tuple, got.collect())) == [("chr1", 1), ("chr1", 10**8), ("chr2", 5), ("chr2", 9)]
    with pytest.raises(PySparkException, match="not an interval"):
        text.parse_intervals(spark.createDataFrame([("chr1:x-y",)], "value string")).collect()


def test_lookup_keeps_records_whole(spark):
    key = "chrom string, pos long, ref string, alt string"
    rows = spark.createDataFrame([("c", 1, "A", "C"), ("c", 2, "A", "C")], key)
    found = spark.createDataFrame([("c", 1, "A", "C", 0.9, "aaa"), ("c", 1, "A", "C", 0.1, "zzz")], key + ", af double, name string")
    got = {r.pos: (r.af, r.name) for r in an.annotate_exact(rows, found, ["af", "name"]).collect()}
    assert got == {1: ("0.9", "aaa"), 2: (".", ".")}


def test_lines_without_columns(spark):
    body = spark.createDataFrame([(BODY[0],), ("",), ("  ",)], "value string")
    rows = vcf.parse(body)
    assert rows.count() == 1
    with pytest.raises(PySparkException, match="fewer than 8"):
        vcf.parse(spark.createDataFrame([("chr1\t5",)], "value string")).collect()
    with pytest.raises(PySparkException, match="without pos"):
        vcf.format_rows(vcf.parse(spark.createDataFrame([(BODY[0].replace("\t10\t", "\tx10\t"),)], "value string"))).collect()


@pytest.mark.parametrize("alt", ["G[17:198982[", "]13:123456]G", "<DEL>", "*"])
def test_symbolic_alleles_stay(spark, alt):
    rows = spark.createDataFrame([("c", 7, "G", alt)], "chrom string, pos long, ref string, alt string")
    r = vcf.minimal(rows).first()
    assert (r.min_pos, r.min_ref, r.min_alt) == (7, "G", alt)


def test_flank_keeps_rows_without_a_place(spark):
    rows = spark.createDataFrame([("c", 50, 1), (None, 50, 2), ("c", None, 3)], "chrom string, pos long, n int")
    genes = spark.createDataFrame([("c", 10, 20), ("c", 80, 90)], 'chrom string, start long, end long')
    got = {r.n: (r.up_end, r.down_start) for r in an.annotate_flank(rows, genes).collect()}
    assert got == {1: (20, 80), 2: (None, None), 3: (None, None)}


def test_overlap_needs_no_single_task(spark):
    rows = spark.range(100).select(F.lit("c").alias("chrom"), F.col("id").alias("pos"))
    iv = spark.createDataFrame([("c", 5, 9)], "chrom string, start long, end long")
    out = point_overlap(rows, iv)
    assert out.count() == 5 and "GlobalLimit" not in out._jdf.queryExecution().toString()


def test_joining_parts_is_done_or_fails(spark, tmp_path):
    df = spark.range(50).select("id", F.col("id").cast("string").alias("value"))
    with pytest.raises(OSError, match="join files"):
        sinks.write_lines(df, str(tmp_path / "many"), ["id"], single=True, partitions=4)
    one = sinks.write_lines(df, str(tmp_path / "one"), ["id"], single=True, partitions=1)
    assert [r.value for r in spark.read.text(one).collect()] == [str(i) for i in range(50)]


@pytest.mark.parametrize("tool, cmd", [("vep", "cat"), ("snpeff", "cat"), ("pypgx", "cat"), ("gatk", "sh -c 'cat {in} > {out}.txt'"),
                                       ("annovar", "sh -c 'cat > {out}.avinput'")])
def test_launcher_runs_as_a_script(tmp_path, tool, cmd):
    source = tmp_path / "in.txt"
    source.write_text("\n".join(["chr1:1-5", "chr1:7-9", "chr2", "chr3:4"] if tool == "gatk" else HEAD + BODY) + "\n")
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2 pyspark-shell"}
    run = subprocess.run([sys.executable, os.path.join(ROOT, "run_job.py"), "--annotation_tool", tool, "--tool_cmd", cmd, "-i", str(source),
                          "-o", str(tmp_path / "out"), "--partitions", "2"], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-3000:]
    lines = [x for folder, _, names in os.walk(tmp_path / "out") for n in sorted(names) if n.startswith("part-")
             for x in open(os.path.join(folder, n)).read().splitlines()]
    want = {"gatk": ["chr1:1-5", "chr1:7-9", "chr2", "chr3:4"], "pypgx": ["S1", "S2", "S3"]}.get(tool, BODY)
    assert set(want) <= set(lines)
