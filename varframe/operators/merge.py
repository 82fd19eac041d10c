"""Merging tool output parts under one header.

Parts are rows ``part int, suffix string, line_no bigint, value string``: the
output of one tool process per input partition, kept as rows instead of files on
one host. The merges are unions with an explicit order key ``(part, line_no)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .index import bounded_index, dense_index
from .lines import as_array, drop_header_lines, is_header

# Coordinate columns of a tool's table output, and the INFO lines
# that open and close the block of added declarations.
COORDINATE_COLUMNS = ["Chr", "Start", "End", "Ref", "Alt"]
OTHERINFO = "Otherinfo"
TOOL = "ANNOVAR"


def open_tag(tool: str = TOOL) -> str:
    return (f'##INFO=<ID={tool}_DATE,Number=1,Type=String,'
            f'Description="Flag the start of {tool} annotation for one alternative allele">')


def close_tag(tool: str = TOOL) -> str:
    return (f'##INFO=<ID=ALLELE_END,Number=0,Type=Flag,'
            f'Description="Flag the end of {tool} annotation for one alternative allele">')


def info_line(col, tool: str = TOOL):
    return F.concat(F.lit("##INFO=<ID="), col, F.lit(',Number=.,Type=String,Description="'), col,
                    F.lit(f' annotation provided by {tool}">'))


def kind_of(suffix: str = "suffix"):
    """Merge kind by the last three characters of the suffix."""
    s3 = F.substring(F.col(suffix), -3, 3)
    return F.when(s3.isin("txt", "csv"), F.lit("table")).when(s3 == "vcf", F.lit("vcf")).otherwise(F.lit("plain"))


def part_suffixes(parts: DataFrame) -> DataFrame:
    """Distinct suffixes (A28); the reference's first-seen order is replaced by sorting."""
    return parts.select("suffix").distinct()


def present_parts(expected: DataFrame, parts: DataFrame, col: str = "part") -> DataFrame:
    """Expected part ids that actually have output (A9): a semi join."""
    return expected.join(parts.select(col).distinct(), col, "left_semi")


def first_lines(parts: DataFrame) -> DataFrame:
    """First line of every part.

    The least line number of each part comes first, a hash aggregate of numbers: ``min_by`` of a text sorts its input, so it
    gets the first lines alone.
    """
    least = parts.groupBy("part", "suffix").agg(F.min("line_no").alias("_least"))
    parts = parts.join(least, ["part", "suffix"]).where(F.col("line_no") == F.col("_least"))
    return parts.groupBy("part", "suffix").agg(F.min_by("value", "line_no").alias("value"))


def table_header(parts: DataFrame) -> DataFrame:
    """First line of the first part whose suffix ends in ``.txt``."""
    txt = first_lines(parts.where(F.col("suffix").endswith(".txt")))
    return txt.agg(F.min_by("value", F.struct("part", "suffix")).alias("value")).where(F.col("value").isNotNull())


def annotation_columns(header_row: DataFrame) -> DataFrame:
    """Column names of a table header row that are annotations (A8): ``col_idx, name``."""
    names = header_row.select(F.posexplode(F.split("value", "\t")).alias("col_idx", "name"))
    keep = ~F.col("name").contains(OTHERINFO) & ~F.col("name").isin(*COORDINATE_COLUMNS)
    return names.where(keep).select(F.col("col_idx").cast("int").alias("col_idx"), "name")


def info_declarations(columns: DataFrame, tool: str = TOOL) -> DataFrame:
    """INFO lines for added columns, wrapped in open/close lines when any (A13): ``decl_idx, value``."""
    body = columns.select((F.col("col_idx") + 1).alias("_k"), info_line(F.col("name"), tool).alias("value"))
    # the bracketing lines exist only when there is at least one column
    present = columns.agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 0)
    tags = present.select(
        F.explode(F.array(
            F.struct(F.lit(0).alias("_k"), F.lit(open_tag(tool)).alias("value")),
            F.struct(F.lit(1 << 30).alias("_k"), F.lit(close_tag(tool)).alias("value")),
        )).alias("t")
    ).select("t._k", "t.value")
    both = body.unionByName(tags)
    return bounded_index(both, ["_k"], name="decl_idx").select(F.col("decl_idx"), "value")


def patch_header(header: DataFrame, order: list[str], inserted: DataFrame, inserted_order: list[str]) -> DataFrame:
    """Insert rows before the last header line, the ``#CHROM`` line (A35): ``line_no, value``.

    Sections: 0 = ``##`` meta lines, 1 = inserted rows, 2 = the column line.
    """
    h = bounded_index(header, order, name="_k").select(
        F.when(F.col("value").startswith("##"), F.lit(0)).otherwise(F.lit(2)).alias("_section"), "_k", "value"
    )
    ins = bounded_index(inserted, inserted_order, name="_k").select(F.lit(1).alias("_section"), "_k", "value")
    return bounded_index(h.unionByName(ins), ["_section", "_k"], name="line_no").select("line_no", "value")


def _table_rows(parts: DataFrame) -> DataFrame:
    """Table parts without the first line of every part but the first present one."""
    # one row per suffix: bounded by the kinds of output a tool writes
    first = F.broadcast(parts.groupBy("suffix").agg(F.min("part").alias("_first")))
    kept = parts.join(first, "suffix").where((F.col("part") == F.col("_first")) | (F.col("line_no") != 0))
    return kept.drop("_first")


def _keyed(df: DataFrame, section: int) -> DataFrame:
    return df.select("suffix", F.lit(section).alias("_s"), F.col("part").cast("bigint").alias("_a"),
                     F.col("line_no").alias("_b"), "value")


def _vcf_rows(parts: DataFrame, header: DataFrame, header_order: list[str]) -> DataFrame:
    """VCF parts stripped of ``#`` lines (D10) behind the header, repeated once per VCF suffix."""
    body = _keyed(drop_header_lines(parts), 1)
    h = parts.select("suffix").distinct().select("suffix", F.posexplode(as_array(header, header_order)).alias("_i", "value")).select(
        "suffix", F.lit(0).alias("_s"), F.lit(0).cast("bigint").alias("_a"), F.col("_i").cast("bigint").alias("_b"), "value")
    return h.unionByName(body)


def _number(rows: DataFrame) -> DataFrame:
    return dense_index(rows, ["_s", "_a", "_b"], name="line_no", group=["suffix"], few_groups=True)


def merge_tables(parts: DataFrame) -> DataFrame:
    """Table parts (txt/csv) per suffix, one header row: ``suffix, line_no, value``."""
    return _number(_keyed(_table_rows(parts), 1)).select("suffix", "line_no", "value")


def merge_plain(parts: DataFrame) -> DataFrame:
    """Parts concatenated per suffix in part order, no header work."""
    return _number(_keyed(parts, 1)).select("suffix", "line_no", "value")


def merge_vcf(parts: DataFrame, header: DataFrame, header_order: list[str]) -> DataFrame:
    """VCF parts under one header (A34): header rows first, then every part's
    non-``#`` lines in part order. ``suffix, line_no, value``."""
    return _number(_vcf_rows(parts, header, header_order)).select("suffix", "line_no", "value")


def merge_routed(parts: DataFrame, header: DataFrame, header_order: list[str], dense: bool = False) -> DataFrame:
    """Route every suffix to its merge by kind (A36): ``suffix, kind, line_no, value``.

    The three kinds are prepared separately and numbered in one pass (one range
    shuffle for all output files). ``dense`` says that every part numbers its lines from 0
    without gaps, as a tool's stored output does (else the query fails): then nothing is shuffled or copied.
    """
    if dense:
        return _merge_dense(parts, header, header_order)
    k = parts.withColumn("kind", kind_of())
    pick = lambda kind: k.where(F.col("kind") == kind).drop("kind")
    rows = (
        _keyed(_table_rows(pick("table")), 1)
        .unionByName(_vcf_rows(pick("vcf"), header, header_order))
        .unionByName(_keyed(pick("plain"), 1))
    )
    return _number(rows).withColumn("kind", kind_of()).select("suffix", "kind", "line_no", "value")


def _merge_dense(parts: DataFrame, header: DataFrame, header_order: list[str]) -> DataFrame:
    """One aggregate per part tells how many lines it keeps; a running sum over a suffix's parts tells where they go.

    A line moves by its part's place and by the dropped lines before it: the first line of a
    later table part, or the ``#`` lines of a VCF part (those above its first row, and stray ones further down).
    """
    lines = as_array(header, header_order)
    k = parts.withColumn("kind", kind_of()).withColumn("_hash", (F.col("kind") == "vcf") & is_header())
    stats = k.groupBy("suffix", "part", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.max("line_no").alias("last"), F.min(F.when(~F.col("_hash"), F.col("line_no"))).alias("top"),
        F.array_sort(F.collect_list(F.when(F.col("_hash"), F.col("line_no")))).alias("hashes"))
    by_part = Window.partitionBy("suffix").orderBy("part")
    kind = F.col("kind")
    stats = stats.withColumn("cut", F.when(kind == "vcf", F.coalesce("top", F.col("n"))).when(
        (kind == "table") & (F.row_number().over(by_part) > 1), F.lit(1)).otherwise(F.lit(0)))
    stray = F.expr("slice(hashes, cast(cut as int) + 1, greatest(size(hashes) - cast(cut as int), 0))")
    gaps = F.raise_error(F.lit("merge: a part's lines aren't numbered from 0 without gaps")).cast("bigint")
    stats = stats.withColumn("stray", stray).withColumn(
        "kept", F.when(F.col("last") + 1 == F.col("n"), F.col("n") - F.col("cut") - F.size("stray")).otherwise(gaps))
    before = F.coalesce(F.sum("kept").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = stats.select("suffix", "part", "cut", "stray", (before + F.when(kind == "vcf", F.size(lines)).otherwise(F.lit(0))).alias("start"))
    rows = k.where((F.col("kind") != "vcf") | ~F.col("_hash")).join(places, ["suffix", "part"]).where(F.col("line_no") >= F.col("cut"))
    skipped = F.when(F.size("stray") == 0, 0).otherwise(F.size(F.filter("stray", lambda x: x < F.col("line_no"))))
    body = rows.select("suffix", "kind", (F.col("start") + F.col("line_no") - F.col("cut") - skipped).alias("line_no"), "value")
    heads = k.where(kind == "vcf").select("suffix", "kind").distinct().select("suffix", "kind", F.posexplode(lines).alias("_i", "value"))
    return heads.select("suffix", "kind", F.col("_i").cast("bigint").alias("line_no"), "value").unionByName(body)
