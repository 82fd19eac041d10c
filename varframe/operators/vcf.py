"""VCF lines to typed rows and back.

Whole-file jobs: every function maps a DataFrame of lines or rows to another
DataFrame with built-in expressions; there is no per-row Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vcf as fv

ROW_COLUMNS = ["chrom", "pos", "id", "ref", "alt", "qual", "qual_raw", "filter", "info", "format", "samples"]


def parse(body: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Body lines to typed rows (B1).

    ``chrom string, pos bigint, id string, ref string, alt array<string>,
    qual double, qual_raw string, filter string, info map<string,string>,
    format array<string>, samples array<string>``; ``.`` is NULL. Blank lines and lines
    that start with ``#`` are dropped; another line of fewer than eight columns fails the query.

    Sample columns stay text until a field is asked for (``sample_field``,
    ``sample_maps``, ``samples_long``): a line can carry many thousands of
    samples and most queries read one key of a few of them.
    """
    a_row = (F.trim(F.col(value)) != "") & ~F.col(value).startswith("#")
    body = body.where(a_row)
    cut = F.split(F.col(value), "\t")
    short = F.raise_error(F.concat(F.lit("a VCF line has fewer than 8 columns: "), F.substring(value, 1, 80)))
    # the row test is repeated because the planner may evaluate this before the filter
    rows = body.select(*keep, F.when(a_row & (F.size(cut) < 8), short.cast("array<string>")).otherwise(cut).alias("_f"))
    f = F.col("_f")
    rows = rows.withColumn("_fmt", F.when(F.size(f) >= 9, F.split(F.get(f, F.lit(8)), ":")))
    samples = F.when(F.size(f) > 9, F.slice(f, 10, F.size(f) - 9))
    return rows.select(
        *keep,
        F.get(f, F.lit(0)).alias("chrom"),
        F.get(f, F.lit(1)).try_cast("bigint").alias("pos"),
        fv.missing_to_null(F.get(f, F.lit(2))).alias("id"),
        F.get(f, F.lit(3)).alias("ref"),
        F.when(F.get(f, F.lit(4)) != fv.MISSING, F.split(F.get(f, F.lit(4)), ",")).alias("alt"),
        F.get(f, F.lit(5)).try_cast("double").alias("qual"),
        F.get(f, F.lit(5)).alias("qual_raw"),
        fv.missing_to_null(F.get(f, F.lit(6))).alias("filter"),
        fv.info_map(F.get(f, F.lit(7))).alias("info"),
        F.col("_fmt").alias("format"),
        samples.alias("samples"),
    )


def format_rows(rows: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed rows back to VCF lines (B3); ``qual_raw`` keeps the original QUAL text.

    A row without chrom, pos or ref fails the query: a line without them would be shifted.
    """
    na = lambda c: F.coalesce(c, F.lit(fv.MISSING))
    qual = F.coalesce(F.col("qual_raw"), F.col("qual").cast("string"), F.lit(fv.MISSING))
    samples = F.col("samples")
    needed = lambda c: F.coalesce(F.col(c).cast("string"), F.raise_error(F.lit(f"a row without {c} has no VCF line")).cast("string"))
    fields = [
        needed("chrom"), needed("pos"), na(F.col("id")), needed("ref"),
        na(F.array_join(F.col("alt"), ",")), qual, na(F.col("filter")), fv.info_text(F.col("info")),
    ]
    line = F.concat_ws("\t", *fields)
    with_fmt = F.concat_ws("\t", line, F.array_join(F.col("format"), ":"), F.array_join(samples, "\t"))
    return rows.select(*keep, F.when(F.col("format").isNull(), line).otherwise(with_fmt).alias(value))


META_PATTERN = r"^##([A-Za-z_]+)=<(.*)>$"


def meta(header: DataFrame, value: str = "value") -> DataFrame:
    """Structured ``##KEY=<...>`` header lines to ``kind, id, number, type, description, length`` (B2)."""
    v = F.col(value)

    def field(pat):
        x = F.regexp_extract(v, pat, 1)
        return F.when(x != "", x)

    structured = header.where(v.rlike(META_PATTERN))
    return structured.select(
        F.regexp_extract(v, META_PATTERN, 1).alias("kind"),
        field(r"[<,]ID=([^,>]+)").alias("id"),
        field(r"[<,]Number=([^,>]+)").alias("number"),
        field(r"[<,]Type=([^,>]+)").alias("type"),
        field(r'[<,]Description="([^"]*)"').alias("description"),
        field(r"[<,]length=([0-9]+)").try_cast("bigint").alias("length"),
    )


DECLARED = ("INFO", "FORMAT", "FILTER")


def declarations(lines: DataFrame, value: str = "value", kinds: tuple[str, ...] = DECLARED) -> DataFrame:
    """Header lines that declare a field: ``kind, id, value``."""
    v = F.col(value)
    found = lines.where(v.startswith("##")).select(
        F.regexp_extract(v, META_PATTERN, 1).alias("kind"), F.regexp_extract(v, r"[<,]ID=([^,>]+)", 1).alias("id"), v.alias("value"))
    return found.where(F.col("kind").isin(*kinds) & (F.col("id") != ""))


def sample_maps(rows: DataFrame) -> DataFrame:
    """Replace the sample texts by ``map<string,string>`` keyed by FORMAT (all fields of all samples)."""
    return rows.withColumn("samples", F.transform("samples", lambda s: fv.sample_map(F.col("format"), s)))


def explode_alleles(rows: DataFrame, alt: str = "alt") -> DataFrame:
    """One row per alternative allele with its 1-based number."""
    others = [c for c in rows.columns if c != alt]
    return rows.select(*others, F.posexplode(alt).alias("_i", "_alt")).select(
        *others, (F.col("_i") + 1).cast("int").alias("allele_num"), F.col("_alt").alias(alt)
    )


def with_end(rows: DataFrame, name: str = "end", pos: str = "pos", ref: str = "ref", alt: str = "alt", info: str | None = None) -> DataFrame:
    """Add ``name``, the last base a row covers: that of its reference allele.

    With ``info`` (the INFO map), a row with a symbolic allele ends at its ``END`` if that is later.
    """
    last = F.col(pos) + F.length(F.col(ref)) - 1
    if info is not None:
        several = rows.schema[alt].dataType.typeName() == "array"
        symbolic = F.exists(F.col(alt), fv.is_symbolic) if several else fv.is_symbolic(F.col(alt))
        last = F.greatest(last, F.when(F.coalesce(symbolic, F.lit(False)), F.try_element_at(info, F.lit("END")).try_cast("bigint")))
    return rows.withColumn(name, last)


def minimal(rows: DataFrame, pos: str = "pos", ref: str = "ref", alt: str = "alt") -> DataFrame:
    """Add ``min_pos, min_ref, min_alt``: shared suffix then prefix trimmed."""
    return fv.trim_common(rows, ref, alt, pos)


def with_class(rows: DataFrame, ref: str = "ref", alt: str = "alt") -> DataFrame:
    """Add ``variant_class`` (B6) from the minimal alleles."""
    keep = rows.columns
    t = fv.trim_common(rows, ref, alt, pos="_no_pos_")
    t = t.withColumn("variant_class", fv.class_of(F.col(ref), F.col(alt), F.col("min_ref"), F.col("min_alt")))
    return t.select(*keep, "variant_class")


def samples_long(rows: DataFrame, names: DataFrame, keep: DataFrame | None = None,
                 key: tuple[str, ...] = ("chrom", "pos", "ref", "alt")) -> DataFrame:
    """Wide samples to long rows ``key…, sample, gt`` (B17), optionally kept to a sample list.

    ``names`` is ``sample_idx int, sample string`` from the column line; it and ``keep`` have
    one row per sample of the file. The places of the kept samples are found once; a row reads
    and multiplies by those alone, whatever the number of its columns.
    """
    if keep is not None:
        names = names.join(keep.select("sample").distinct(), "sample", "left_semi")
    kept = names.agg(F.array_sort(F.collect_list(F.struct("sample_idx", "sample"))).alias("_kept")).scalar()
    one = rows.select(*key, "format", "samples", F.explode(kept).alias("_s"))
    # a line with fewer columns has no row for the missing samples
    one = one.withColumn("_text", F.get("samples", F.col("_s.sample_idx"))).where(F.col("_text").isNotNull())
    return one.select(*key, F.col("_s.sample").alias("sample"), fv.sample_field(F.col("format"), F.col("_text"), "GT").alias("gt"))
