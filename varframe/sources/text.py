"""Line-oriented sources: text files, interval lists, tool output parts, CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Order key of scanned lines: file, split start inside the file, then the id
# Spark gives rows inside a split (increasing in file order).
LINE_KEY = ["file", "block", "seq"]


def scan_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of one or many text files (plain or compressed by suffix) with their order key.

    Returns ``file string, block bigint, seq bigint, value string``; sorting on
    ``LINE_KEY`` gives the lines in file order, files in path order.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.text(paths)
    extra = [c for c in df.columns if c != "value"]  # partition columns of a partitioned folder
    return df.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
        *extra,
    )


def parse_intervals(lines: DataFrame, value: str = "value") -> DataFrame:
    """``chrom[:start[-end]]`` lines to ``chrom, start, end`` (A3); a bare chrom is the whole contig
    (no start and end). A line of another form fails the query.
    """
    pat = r"^([^:\s]+)(?::([0-9,]+)(?:-([0-9,]+))?)?\s*$"
    start = F.regexp_replace(F.regexp_extract(value, pat, 2), ",", "")
    end = F.regexp_replace(F.regexp_extract(value, pat, 3), ",", "")
    start_col = F.when(start != "", start).try_cast("bigint")
    end_col = F.coalesce(F.when(end != "", end).try_cast("bigint"), start_col)
    chrom = F.regexp_extract(value, pat, 1)
    bad = F.raise_error(F.concat(F.lit("not an interval: "), F.col(value)))
    return (
        lines.withColumn("chrom", F.when(F.col(value).isNotNull() & (chrom == ""), bad.cast("string")).otherwise(chrom))
        .withColumn("start", start_col)
        .withColumn("end", end_col)
    )


def read_intervals(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Interval list read on the executors (D11: not a driver-local file read)."""
    lines = scan_lines(spark, paths)
    lines = lines.where((F.trim("value") != "") & ~F.col("value").startswith("@") & ~F.col("value").startswith("#"))
    return parse_intervals(lines)


def part_name(name_col: str = "name") -> tuple:
    """Tool output file name ``<part>.<suffix>`` split on the first dot."""
    pieces = F.split(F.col(name_col), r"[.]", 2)
    return (
        F.element_at(pieces, 1).try_cast("int").alias("part"),
        F.when(F.size(pieces) > 1, F.element_at(pieces, 2)).alias("suffix"),
    )


def read_parts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Part files named ``<part>.<suffix>`` to rows ``part, suffix, line_no, value``.

    ``line_no`` is the 0-based line inside its file, counted where the file is scanned (no shuffle).
    """
    from ..operators.index import split_index

    lines = split_index(scan_lines(spark, paths), name="line_no", split=["block"], group=["file"])
    lines = lines.withColumn("name", F.element_at(F.split("file", "/"), -1))
    return lines.select(*part_name("name"), "line_no", "value")


BENCH_SCHEMA = T.StructType(
    [
        T.StructField("CPU_cores", T.StringType()),
        T.StructField("Tools", T.StringType()),
        T.StructField("Running_time_minutes", T.DoubleType()),
        T.StructField("CPU_percentage_pct", T.DoubleType()),
        T.StructField("Maximum_memory_used_pct", T.DoubleType()),
    ]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = BENCH_SCHEMA) -> DataFrame:
    """CSV with a header row, read with a fixed schema (A5; no inference pass)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
