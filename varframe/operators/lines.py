"""Header/body split and header-line operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .index import bounded_index, dense_index, split_index

N_FIXED_VCF_COLUMNS = 9
HEADER_BYTES = 64 << 20


def is_header(value: str = "value") -> Column:
    """Null-safe ``value`` starts with ``#``."""
    return F.coalesce(F.col(value).startswith("#"), F.lit(False))


def split_by(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows passing and failing ``predicate`` (null counts as failing), one scan plan each."""
    p = F.coalesce(predicate, F.lit(False))
    return df.where(p), df.where(~p)


def split_header_body(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    return split_by(lines, is_header(value))


def drop_header_lines(df: DataFrame, value: str = "value") -> DataFrame:
    """Drop lines a tool emits starting with ``#``."""
    return df.where(~is_header(value))


def last_line(df: DataFrame, order: Sequence[str], value: str = "value") -> DataFrame:
    """The last line in ``order`` as a one-row frame (A30), an aggregate, no sort."""
    return df.agg(F.max_by(F.col(value), F.struct(*order)).alias(value))


def header_lines(head: DataFrame, order, max_bytes: int = HEADER_BYTES) -> list[str]:
    """The header in order, in the driver; its size is checked before it leaves the cluster."""
    size = head.agg(F.sum(F.octet_length("value") + 1)).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"a header of {size} bytes is over the limit of {max_bytes}")
    # put in order here: a sort would read the whole file twice
    lines = head.select("value", F.struct(*order).alias("_at")).collect()
    return [r["value"] for r in sorted(lines, key=lambda r: [(x is not None, x) for x in r["_at"]])]


def sample_names(header: DataFrame, order: Sequence[str], value: str = "value") -> DataFrame:
    """Sample names of the ``#CHROM`` line (last header line): fields 10.. with 0-based index."""
    cols = F.split(F.col(value), "\t")
    return last_line(header, order, value).select(
        F.posexplode(F.slice(cols, N_FIXED_VCF_COLUMNS + 1, F.greatest(F.size(cols) - N_FIXED_VCF_COLUMNS, F.lit(0))))
    ).select(F.col("pos").cast("int").alias("sample_idx"), F.col("col").alias("sample"))


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    """Global row count as a frame (A27); partial counts per task, one final row."""
    return df.agg(F.count(F.lit(1)).alias(name))


def union_sections(header: DataFrame, body: DataFrame, order: Sequence[str], value: str = "value", scanned: bool = False) -> DataFrame:
    """Header lines, then body lines, each in ``order`` (A31, D15), with a dense ``line_no``.

    ``scanned`` says that ``body`` is still in its scan partitions: it is numbered there, without a shuffle.
    """
    if scanned:
        h = bounded_index(header, order, name="_n").select(F.col("_n").alias("line_no"), value)
        n = header.agg(F.count(F.lit(1))).scalar()
        return h.unionByName(split_index(body, name="_n").select((F.col("_n") + n).alias("line_no"), value))
    cols = list(dict.fromkeys([*order, value]))
    both = header.select(F.lit(0).alias("_section"), *cols).unionByName(body.select(F.lit(1).alias("_section"), *cols))
    return dense_index(both, ["_section", *order], name="line_no").select("line_no", value)


def as_array(rows: DataFrame, order: Sequence[str], value: str = "value") -> Column:
    """The values of a small frame in ``order`` as one array, read when the query runs (a scalar subquery)."""
    pairs = F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.col(value).alias("_v"))))
    return rows.agg(F.transform(pairs, lambda x: x["_v"]).alias("_a")).scalar()


def header_for_batches(header: DataFrame, order: Sequence[str], n_batches: int, value: str = "value") -> DataFrame:
    """The header lines once per batch: ``batch_id, line_in_batch, value``.

    The batch ids are a range that many tasks share; each repeats the header, read once, for its own.
    """
    ids = header.sparkSession.range(max(n_batches, 1)).withColumnRenamed("id", "batch_id")
    return ids.select("batch_id", F.posexplode(as_array(header, order, value)).alias("_i", value)).select(
        "batch_id", F.col("_i").cast("bigint").alias("line_in_batch"), value)
