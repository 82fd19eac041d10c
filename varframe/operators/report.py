"""Benchmark report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .index import dense_index


def pivot_mean(df: DataFrame, index: str, columns: str, value: str, values: Sequence[str] | None = None,
               digits: int | None = 0) -> DataFrame:
    """Pivot table with the mean (A38); ``digits`` rounds half to even like numpy.

    Give ``values`` to skip the extra job Spark runs to find the pivot columns.
    """
    g = df.groupBy(index)
    g = g.pivot(columns, list(values)) if values is not None else g.pivot(columns)
    out = g.agg(F.avg(value))
    if digits is not None:
        for c in out.columns:
            if c != index:
                out = out.withColumn(c, F.bround(F.col(c), digits))
    return out


def ranked_means(df: DataFrame, index: str, columns: str, value: str, digits: int = 2) -> DataFrame:
    """Means per (index, column) ranked by value descending (A39, D12: sorted before the pivot)."""
    m = df.groupBy(index, columns).agg(F.bround(F.avg(value), digits).alias("mean"))
    return dense_index(m, [F.col("mean").desc(), F.col(index), F.col(columns)], name="rank")
