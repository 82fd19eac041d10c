"""Global order, dense row index and fixed-size batches.

A dense 0-based index in a total order is computed without a global window
(which would pull every row into one task):

1. range-partition on the order key and sort inside each partition;
2. tag rows with ``spark_partition_id()`` and the position inside the partition
   (low 33 bits of ``monotonically_increasing_id()``);
3. write that frame to the shared folder, so the counts and the rows are the same
   partitions (two separate range exchanges sample different bounds) and a lost
   executor costs no recomputation;
4. count rows per partition (one row per partition), turn the counts into
   offsets with a running sum over at most ``k`` rows, and join them back.

Lines that are still in their scan partitions need none of this: ``split_index``.
Which of the two applies is the caller's to say; ``split_index`` fails on a frame
that has been shuffled.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import default_partitions, scratch_path

_LOW33 = (1 << 33) - 1
# rows that one task sorts, about
RANGE_ROWS = 200_000


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of a row's columns that can be hashed: the same in every attempt of a task."""
    plain = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*plain) if plain else F.lit(0).cast("bigint")


def range_count(df: DataFrame) -> int:
    """Ranges of about ``RANGE_ROWS`` rows for ``df``, at least the session's partitions: they grow in number, not in length."""
    return max(default_partitions(df.sparkSession), -(-df.count() // RANGE_ROWS))


def ordered(df: DataFrame, order: Sequence[str | Column], partitions: int | None = None) -> DataFrame:
    """Range-partition on ``order`` and sort inside partitions (order survives fan-out, A23).

    Without ``partitions`` the rows are counted first, so that no task sorts much more than ``RANGE_ROWS`` of them.
    Rows with equal keys are told apart by a hash of all their columns, so the range
    partitioner can split a key that holds a large share of the rows, and a retried
    task deals its rows out as before. (Maps can't be hashed; they don't take part.)
    """
    k = partitions or range_count(df)
    o = _cols(order) + [F.col("_tie")]
    tagged = df.withColumn("_tie", row_hash(df))
    return tagged.repartitionByRange(k, *o).sortWithinPartitions(*o).drop("_tie")


def dense_index(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "idx",
    group: Sequence[str] | None = None,
    partitions: int | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """Add ``name``: the 0-based rank of each row in ``order`` (per ``group`` if given).

    ``order`` must be total (ties only between identical rows) for a repeatable
    result; with ``group`` the group columns are put in front of the order.
    ``few_groups`` says the group count is bounded by the caller (e.g. the kinds
    of output of one tool), so the offsets table - one row per partition and
    group - is broadcast; otherwise the planner decides by its size.
    """
    group = list(group or [])
    full = _cols(group) + _cols(order)
    tagged = (
        ordered(df, full, partitions)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33)))
    )
    path = scratch_path(df.sparkSession, "index")
    tagged.write.parquet(path)
    keyed = df.sparkSession.read.schema(tagged.schema).parquet(path)
    # per partition (and group inside it): row count and first local position
    counts = keyed.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first"))
    w = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid", *group, (F.coalesce(F.sum("_n").over(w), F.lit(0)) - F.col("_first")).alias("_off"))
    if not group or few_groups:
        # one row per partition (and group): bounded by partitions (+ groups)
        offsets = F.broadcast(offsets)
    out = keyed.join(offsets, ["_pid", *group]).withColumn(name, F.col("_off") + F.col("_local"))
    return out.drop("_pid", "_local", "_off")


def file_order(file: str) -> Column:
    """File names in order, part files of a folder by their number (``part-99999`` before ``part-100000``)."""
    name = F.element_at(F.split(F.col(file), "/"), -1)
    number = F.regexp_extract(name, "^part-([0-9]+)", 1)
    folder = F.substring_index(F.col(file), "/", -1)
    padded = F.concat(F.expr(f"substring({file}, 1, length({file}) - length(substring_index({file}, '/', -1)))"),
                      F.lpad(number, 18, "0"), folder)
    return F.when(number != "", padded).otherwise(F.col(file))


def split_index(
    df: DataFrame,
    name: str = "idx",
    split: Sequence[str] = ("file", "block"),
    group: Sequence[str] | None = None,
) -> DataFrame:
    """Dense index in file order for scanned lines, without a shuffle.

    ``df`` must still be in its scan partitions (only narrow operations, e.g.
    filters, since ``scan_lines``): every file split is then a contiguous run of
    a partition, so ``monotonically_increasing_id()`` taken here counts the
    surviving rows of a split consecutively. One small aggregate gives rows and
    first id per split; a running sum over the splits (one row per split, a
    bounded table) gives each split's offset, broadcast back. A recomputed task
    scans the same split the same way, so ids and offsets agree. Part files go by
    their number. A frame whose splits no longer stand together fails.
    """
    group = list(group or [])
    split = list(split)
    m = df.withColumn("_m", F.monotonically_increasing_id())
    counts = m.groupBy(*group, *split).agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_first"), F.max("_m").alias("_last"))
    by = [file_order(c) if c == "file" else F.col(c) for c in split]
    w = Window.partitionBy(*group).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    moved = F.raise_error(F.lit("split_index: the rows have left their scan partitions; use dense_index")).cast("bigint")
    first = F.when(F.col("_last") - F.col("_first") + 1 == F.col("_n"), F.col("_first")).otherwise(moved)
    offsets = counts.select(*group, *split, (F.coalesce(F.sum("_n").over(w), F.lit(0)) - first).alias("_off"))
    out = m.join(F.broadcast(offsets), [*group, *split]).withColumn(name, F.col("_off") + F.col("_m"))
    return out.drop("_m", "_off")


def stored_index(
    df: DataFrame,
    part: str,
    line: str = "line_no",
    keep: Column | None = None,
    name: str = "idx",
    start: Column | int = 0,
) -> DataFrame:
    """Dense index of stored rows whose ``line`` already numbers each ``part`` from 0 without gaps, as a tool's output does.

    ``keep`` tells which rows stay (others, few in a part, are dropped and leave no gap); counting begins at ``start``. One
    aggregate per part gives its place: nothing is range-shuffled or copied. ``df`` must be stored, as it is read twice.
    """
    kept = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))
    marked = df.withColumn("_kept", kept)
    stats = marked.groupBy(part).agg(
        F.count(F.lit(1)).alias("_n"), F.max(line).alias("_last"),
        F.array_sort(F.collect_list(F.when(~F.col("_kept"), F.col(line)))).alias("_gone"))
    gaps = F.raise_error(F.lit("stored_index: a part's lines aren't numbered from 0 without gaps")).cast("bigint")
    stats = stats.withColumn("_stay", F.when(F.col("_last") + 1 == F.col("_n"), F.col("_n") - F.size("_gone")).otherwise(gaps))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    places = stats.select(part, "_gone", (F.coalesce(F.sum("_stay").over(before), F.lit(0)) + start).alias("_off"))
    skipped = F.when(F.size("_gone") == 0, 0).otherwise(F.size(F.filter("_gone", lambda x: x < F.col(line))))
    out = marked.where("_kept").join(places, part)
    return out.withColumn(name, F.col("_off") + F.col(line) - skipped).drop("_kept", "_gone", "_off")


def bounded_index(df: DataFrame, order: Sequence[str], name: str = "idx") -> DataFrame:
    """The 0-based rank of each row of a frame that is small by its nature (a file's header, a tool's columns).

    One aggregate puts the rows in one sorted array; no range shuffle, count or copy. Not for data rows.
    """
    rows = F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                                                F.struct(*df.columns).alias("_row"))))
    return df.agg(rows.alias("_rows")).select(F.posexplode("_rows").alias("_at", "_x")).select(
        "_x._row.*", F.col("_at").cast("bigint").alias(name))


def batch(df: DataFrame, size: int, idx: str = "idx") -> DataFrame:
    """Fixed-size batches in index order, the last one short, ids from 0."""
    if size <= 0:
        raise ValueError("batch size must be positive")
    return df.withColumn("batch_id", F.expr(f"{idx} div {int(size)}")).withColumn(
        "pos_in_batch", F.expr(f"cast({idx} % {int(size)} as int)")
    )


def balanced_batches(
    df: DataFrame,
    order: Sequence[str | Column],
    weight: Column,
    target: int,
    group: Sequence[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Batches of nearly equal weight in a total order (A19, A22): ``batch_id``, ``pos_in_batch``, ``weight``.

    The total weight is cut into ``ceil(total / target)`` equal stretches and a row belongs to the
    stretch its weight begins in, so no batch outweighs a stretch by more than one row. With ``group`` (e.g. the contig)
    every group is cut by itself and no batch spans two. Weights must not be negative; a null counts as 0, and
    rows that weigh nothing go with what stands before them. ``pos_in_batch`` rises in order, with gaps.

    As in ``dense_index`` a first pass writes the rows in ranges and sums each range up; the running sums of
    rows stay within a range, those of ranges and groups are small tables.
    """
    if target <= 0:
        raise ValueError("the target weight must be positive")
    group = list(group or [])
    tagged = ordered(df.withColumn("weight", F.coalesce(weight.cast("bigint"), F.lit(0))), _cols(group) + _cols(order), partitions).withColumn(
        "_pid", F.spark_partition_id()).withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33)))
    path = scratch_path(df.sparkSession, "balanced")
    tagged.write.parquet(path)
    keyed = df.sparkSession.read.schema(tagged.schema).parquet(path).withColumn("_all", F.lit(0))
    own = ["_all", *group]
    ranges = keyed.groupBy(*own, "_pid").agg(F.sum("weight").alias("_w"))
    before = Window.partitionBy(*own).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*own)
    ranges = ranges.withColumn("_start", F.coalesce(F.sum("_w").over(before), F.lit(0))).withColumn("_total", F.sum("_w").over(whole))
    ranges = ranges.withColumn("_cuts", F.greatest(F.lit(1), F.expr(f"(_total + {int(target) - 1}) div {int(target)}")))
    # one row per group: the batches of the groups before it
    groups = ranges.groupBy(*own).agg(F.max("_cuts").alias("_cuts"))
    first = Window.partitionBy("_all").orderBy(*own).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("_first", F.coalesce(F.sum("_cuts").over(first), F.lit(0))).drop("_cuts")

    def beside(left: DataFrame, right: DataFrame, cols: list[str]) -> DataFrame:
        """``left`` with the other columns of ``right``, matched by ``cols``; null matches null."""
        right = right.withColumnsRenamed({c: f"_of_{c}" for c in cols})
        on = functools.reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in cols])
        return left.join(right, on).drop(*[f"_of_{c}" for c in cols])

    placed = beside(ranges.drop("_w"), groups, own)
    local = Window.partitionBy("_pid", *own).orderBy("_local").rowsBetween(Window.unboundedPreceding, -1)
    out = beside(keyed.withColumn("_before", F.coalesce(F.sum("weight").over(local), F.lit(0))), placed, [*own, "_pid"])
    # a row at the very end, without weight, would begin beyond the last stretch
    stretch = F.when(F.col("_total") > 0, F.least(F.expr("cast((_start + _before) as decimal(38,0)) * _cuts div _total"), F.col("_cuts") - 1)).otherwise(F.lit(0))
    return out.select(*df.columns, "weight", (F.col("_first") + stretch).cast("bigint").alias("batch_id"),
                      (F.col("_pid").cast("bigint") * (1 << 33) + F.col("_local")).alias("pos_in_batch"))


def batch_partitions(n_rows: int, size: int) -> int:
    """Partition count for ``n_rows`` cut in batches of ``size``: ceil, at least 1."""
    return max(1, math.ceil(n_rows / size))


def batch_plan_frame(counts: DataFrame, size_col: str = "batch_size", n_col: str = "n_items") -> DataFrame:
    """Add ``n_batches`` and ``n_partitions`` columns to a frame of (n_items, batch_size)."""
    n, b = F.col(n_col), F.col(size_col)
    nb = F.expr(f"({n_col} + {size_col} - 1) div {size_col}")
    return counts.withColumn("n_batches", nb).withColumn("n_partitions", F.greatest(F.lit(1).cast("bigint"), nb))


def count_batches(df: DataFrame, size: int) -> int:
    """Number of batches of ``size`` over ``df`` (one scalar to the driver)."""
    return batch_partitions(df.count(), size)
