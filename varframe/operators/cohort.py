"""Coordinate order by the header's contigs, and several VCF files as one.

Contigs are ordered as the header lists them (chr2 before chr10 in the usual files); contigs it
doesn't list come after, by name. The dictionary is bounded by the header, so it is a map that a query
reads once, not a join.

Files become one file by concatenation: their meta lines are united by kind and ID, their sample
columns by name. A declaration belongs to the first file that has it, in the files' order;
``header_conflicts`` reports IDs whose Number or Type differ between files. A sample that a file
doesn't have is ``.`` in its rows, and rows of a file whose samples already are the
united ones stay as they are, byte by byte.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vcf as fv
from .index import file_order
from .lines import N_FIXED_VCF_COLUMNS, is_header
from .vcf import META_PATTERN

UNLISTED = (1 << 31) - 1
COORDINATES = ["contig_rank", "chrom", "pos", "ref", "alt"]


def contig_ranks(head: DataFrame, order: Sequence[str], value: str = "value") -> Column:
    """Contig names to their place among the header's ``##contig`` lines, as a map read when the query runs."""
    name = F.regexp_extract(F.col(value), r"^##contig=<(?:.*,)?ID=([^,>]+)", 1)
    listed = head.select(*order, name.alias("_name")).where(F.col("_name") != "")
    # of a name listed twice the first place counts
    places = listed.groupBy("_name").agg(F.min(F.struct(*order)).alias("_at"))
    sorted_ = F.array_sort(F.collect_list(F.struct("_at", "_name")))
    return places.agg(F.map_from_arrays(F.transform(sorted_, lambda x: x["_name"]), F.transform(sorted_, lambda x, i: i)).alias("_m")).scalar()


def with_contig_rank(rows: DataFrame, ranks: Column, chrom: str = "chrom") -> DataFrame:
    """Add ``contig_rank``; rows in the order of ``COORDINATES`` are in coordinate order."""
    rows = rows.withColumn("_ranks", ranks)
    return rows.withColumn("contig_rank", F.coalesce(F.try_element_at("_ranks", F.col(chrom)), F.lit(UNLISTED)).cast("int")).drop("_ranks")


def _meta(heads: DataFrame) -> DataFrame:
    """Meta lines with their kind and ID; an unstructured line is its own ID."""
    v = F.col("value")
    kind = F.regexp_extract(v, META_PATTERN, 1)
    key = F.when(kind == "", F.regexp_extract(v, r"^##([^=]+)", 1)).otherwise(kind)
    id_ = F.regexp_extract(v, r"[<,]ID=([^,>]+)", 1)
    own = F.when((kind != "") & (id_ != ""), id_).when(key == "fileformat", F.lit("")).otherwise(v)
    field = lambda name: F.regexp_extract(v, rf"[<,]{name}=([^,>]+)", 1)
    return heads.where(v.startswith("##")).select(
        "file_order", "block", "seq", "value", key.alias("kind"), own.alias("id"), field("Number").alias("number"), field("Type").alias("type"))


def _heads(lines: DataFrame) -> DataFrame:
    return lines.where(is_header()).withColumn("file_order", file_order("file"))


def header_conflicts(lines: DataFrame) -> DataFrame:
    """``kind, id, declared``: IDs that files declare with different Number or Type, and their declarations."""
    both = F.struct("number", "type")
    found = _meta(_heads(lines)).where(F.col("kind").isin("INFO", "FORMAT")).groupBy("kind", "id").agg(F.array_sort(F.collect_set(both)).alias("d"))
    return found.where(F.size("d") > 1).select("kind", "id", F.array_join(F.transform("d", lambda x: F.concat_ws("/", x["number"], x["type"])), ", ").alias("declared"))


def _sample_columns(heads: DataFrame) -> DataFrame:
    """``file, file_order, names``: the sample names of every file's column line."""
    cut = F.split("value", "\t")
    return heads.where(F.col("value").startswith("#") & ~F.col("value").startswith("##")).select(
        "file", "file_order", F.slice(cut, N_FIXED_VCF_COLUMNS + 1, F.greatest(F.size(cut) - N_FIXED_VCF_COLUMNS, F.lit(0))).alias("names"))


FIXED = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"
MERGED_ORDER = ["section", "contig_rank", "chrom", "pos", "ref", "alt", "file_order", "block", "seq"]


def merge_files(lines: DataFrame) -> DataFrame:
    """Lines of several VCF files (``file, block, seq, value``) as the lines of one, in the order of ``MERGED_ORDER``.

    Body rows are in coordinate order; rows of one place stay in the order of their files. Rows with
    fewer columns than their file's header keep ``.`` for the missing samples.
    """
    heads = _heads(lines)
    meta = _meta(heads)
    first = F.min(F.struct("file_order", "block", "seq", "value"))
    # kinds keep the place of their first line, ``fileformat`` being first in every file
    kinds = meta.groupBy("kind").agg(F.min(F.struct("file_order", "block", "seq")).alias("kind_at"))
    united = meta.groupBy("kind", "id").agg(first.alias("own")).join(kinds, "kind")
    ranked = F.array_sort(F.collect_list(F.struct("kind_at", "own.file_order", "own.block", "own.seq", "own.value")))
    meta_lines = united.agg(ranked.alias("r")).select(F.posexplode("r").alias("seq", "x")).select(
        F.lit(0).alias("section"), F.col("seq").cast("bigint").alias("seq"), "x.value")

    columns = _sample_columns(heads)
    names = columns.select("file_order", F.posexplode("names").alias("at", "name")).groupBy("name").agg(F.min(F.struct("file_order", "at")).alias("own"))
    every = names.agg(F.transform(F.array_sort(F.collect_list(F.struct("own", "name"))), lambda x: x["name"]).alias("n"))
    column_line = every.select(F.lit(1).alias("section"), F.lit(0).cast("bigint").alias("seq"), F.when(F.size("n") == 0, F.lit(FIXED)).otherwise(
        F.concat_ws("\t", F.lit(FIXED), F.lit("FORMAT"), F.array_join("n", "\t"))).alias("value"))

    # per file: where each united sample stands among its own, 0 if nowhere
    places = columns.withColumn("_all", every.scalar()).select(F.col("file").alias("_file"), F.col("names").alias("_names"), F.when(
        F.col("names") != F.col("_all"), F.transform("_all", lambda n: F.array_position("names", n).cast("int"))).alias("_to"))
    contigs = meta_lines.where(F.col("value").startswith("##contig="))
    body = lines.where(~is_header() & (F.trim("value") != "")).join(places, F.col("file") == F.col("_file"), "left").withColumn("_cut", F.split("value", "\t"))
    put = F.transform("_to", lambda p: F.when(p > 0, F.coalesce(F.get("_cut", p + N_FIXED_VCF_COLUMNS - 1), F.lit(fv.MISSING))).otherwise(F.lit(fv.MISSING)))
    fixed = F.concat(F.slice("_cut", 1, 8), F.array(F.coalesce(F.get("_cut", F.lit(8)), F.lit(fv.MISSING))))
    text = F.when(F.col("_to").isNull(), F.col("value")).otherwise(F.array_join(F.concat(fixed, put), "\t"))
    field = lambda i: F.get("_cut", F.lit(i))
    rows = body.select(F.lit(2).alias("section"), field(0).alias("chrom"), field(1).try_cast("bigint").alias("pos"), field(3).alias("ref"), field(4).alias("alt"),
                       file_order("file").alias("file_order"), "block", "seq", text.alias("value"))
    rows = with_contig_rank(rows, contig_ranks(contigs, ["seq"]))
    return meta_lines.unionByName(column_line).unionByName(rows, allowMissingColumns=True).select(*MERGED_ORDER, "value")
