"""Interval overlap joins as equi-joins on genome bins.

Spans against intervals (``span_overlap``): bins are nested, from 16 kb growing eightfold up
to one bin for a whole contig. An interval's own level is the first whose bins are at least as
long as it, so it touches at most two bins there and at any coarser level. Two intervals
meet at the coarser of their two levels, where the coarser one stands as its own and the
finer one visits; level and role are part of the join key, so intervals that only share a
coarse bin never meet. A span becomes one or two rows for its own level and for every
coarser level that occurs in the table; an interval of the table one or two for its own level
and each coarser one, so a chromosome-long one makes three or four rows. A pair that meets in two
bins counts in the bin of the later start, so it appears once.

Whether a span has partners depends on its place alone: left, semi and anti joins match
the distinct places and then join the rows to them, so a hot place goes through the interval
join once, and both sides of the last join are plain exchanges that adaptive execution can split.

Points against short intervals (``point_overlap``): Spark would plan ``a.chrom = b.chrom and b.start <= a.pos <= b.end`` as a join on
the chromosome alone (about 25 keys, badly skewed). Instead each interval is
exploded over the fixed-width bins it touches and points get their single bin,
so the join key is ``(chrom, bin)`` and the range test is a residual filter.
A point has exactly one bin, so a point can never meet the same interval twice:
left, semi and anti joins keep their meaning without a second pass.

The exploded intervals are counted first, as the planner's estimate is that of the table they come from, not of
the rows it becomes: up to ``BROADCAST_ROWS`` of them Spark may broadcast (by
``spark.sql.autoBroadcastJoinThreshold``); more are always joined by a shuffle, so the driver never holds a table that grows.
Then both sides shuffle on ``(chrom, bin, salt)``: every point row takes
one of ``salt`` sub-keys, by a hash of the row, and the intervals are copied to
all of them, so a hot bin (or one hot position) is spread over ``salt`` tasks;
AQE's skew join splits what is left. Any salt a row gets finds all of its
intervals, so the result does not depend on the salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .index import row_hash

BIN = 10_000
SALT = 8
# exploded rows up to which an interval table may be broadcast
BROADCAST_ROWS = 100_000


def _unless_small(exploded: DataFrame, intervals: DataFrame, copies: Column) -> DataFrame:
    """``exploded``, to be joined by a shuffle unless its rows, ``copies`` for each of ``intervals``, are few."""
    n = intervals.agg(F.sum(copies.cast("double"))).first()[0] or 0
    return exploded if n <= BROADCAST_ROWS else exploded.hint("merge")


def binned(intervals: DataFrame, start: str = "start", end: str = "end", distance: int = 0,
           bin_size: int = BIN) -> DataFrame:
    """Intervals widened by ``distance`` and exploded over their bins: adds ``_lo, _hi, _bin``."""
    lo = F.greatest(F.col(start) - F.lit(distance), F.lit(0).cast("bigint"))
    hi = F.col(end) + F.lit(distance)
    return (
        intervals.withColumn("_lo", lo).withColumn("_hi", hi)
        .withColumn("_bin", F.explode(F.sequence(F.expr(f"_lo div {bin_size}"), F.expr(f"_hi div {bin_size}"))))
    )


def point_overlap(
    points: DataFrame,
    intervals: DataFrame,
    how: str = "inner",
    pos: str = "pos",
    chrom: str = "chrom",
    start: str = "start",
    end: str = "end",
    distance: int = 0,
    bin_size: int = BIN,
    prefix: str = "",
    salt: int = SALT,
) -> DataFrame:
    """Join points to the intervals that contain them (widened by ``distance``).

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``. Interval
    columns other than ``chrom`` are renamed with ``prefix`` to avoid clashes.
    """
    iv = intervals.withColumnRenamed(chrom, "_chrom")
    if prefix:
        for c in iv.columns:
            if c not in ("_chrom",):
                iv = iv.withColumnRenamed(c, prefix + c)
        start, end = prefix + start, prefix + end
    whole, iv = iv, binned(iv, start, end, distance, bin_size)
    p = points.withColumn("_pbin", F.expr(f"{pos} div {bin_size}"))
    cond = (
        (p[chrom] == iv["_chrom"]) & (p["_pbin"] == iv["_bin"])
        & (iv["_lo"] <= p[pos]) & (p[pos] <= iv["_hi"])
    )
    drop = ["_pbin", "_psalt"] if how in ("left_semi", "left_anti") else \
        ["_pbin", "_psalt", "_chrom", "_bin", "_lo", "_hi", "_salt"]
    p = p.withColumn("_psalt", F.pmod(row_hash(points), F.lit(salt)).cast("int"))
    iv = iv.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    touched = (F.col(end) - F.col(start) + 2 * distance) / bin_size + 2
    out = p.join(_unless_small(iv, whole, touched * salt), cond & (p["_psalt"] == iv["_salt"]), how)
    return out.drop(*drop)


# bin widths as powers of two; the last holds any contig
LEVEL_BITS = (14, 17, 20, 23, 26, 29, 62)


def level_of(lo: Column, hi: Column) -> Column:
    """The first level whose bins are at least as long as the interval."""
    level = F.lit(len(LEVEL_BITS) - 1)
    for i in range(len(LEVEL_BITS) - 2, -1, -1):
        level = F.when(hi - lo < (1 << LEVEL_BITS[i]), F.lit(i)).otherwise(level)
    return level


def _bin(place: Column, level: Column) -> Column:
    bits = F.element_at(F.array(*[F.lit(b) for b in LEVEL_BITS]), level + 1)
    return F.call_function("shiftright", place, bits)


def _slots(levels: Column, table_own: int, lo: Column, hi: Column) -> Column:
    """``(slot, bin)`` of an interval's bins at each of ``levels``; a slot is a level and who stands there as its own."""
    return F.flatten(F.transform(levels, lambda level: F.transform(
        F.sequence(_bin(lo, level), _bin(hi, level)),
        lambda b: F.struct((level * 2 + table_own).alias("slot"), b.alias("bin")))))


def _spread(df: DataFrame, slots: Column) -> DataFrame:
    """One row per slot and bin."""
    return df.withColumn("_at", F.explode(slots)).withColumn("_slot", F.col("_at.slot")).withColumn(
        "_bin", F.col("_at.bin")).drop("_at")


def _meet(spans: DataFrame, table: DataFrame) -> DataFrame:
    """Pairs of overlapping ``spans`` (_chrom, _lo, _hi and more) and ``table`` (_t_chrom, _t_lo, _t_hi and more)."""
    lo, hi, t_lo, t_hi = (F.col(c) for c in ("_lo", "_hi", "_t_lo", "_t_hi"))
    spans, table = spans.where(lo <= hi), table.where(t_lo <= t_hi)
    present = table.agg(F.collect_set(level_of(t_lo, t_hi)).alias("levels")).scalar()
    a = spans.withColumn("_own", level_of(lo, hi)).withColumn("_all", present)
    a = a.withColumn("_visits", F.filter("_all", lambda m: m > F.col("_own")))
    a = _spread(a, F.concat(_slots(F.array("_own"), 0, lo, hi), _slots(F.col("_visits"), 1, lo, hi))).drop("_own", "_all", "_visits")
    b = table.withColumn("_own", level_of(t_lo, t_hi))
    b = _spread(b, F.concat(_slots(F.sequence(F.col("_own"), F.lit(len(LEVEL_BITS) - 1)), 0, t_lo, t_hi),
                            _slots(F.array("_own"), 1, t_lo, t_hi))).drop("_own")
    b = b.withColumnRenamed("_slot", "_t_slot").withColumnRenamed("_bin", "_t_bin")
    once = F.col("_bin") == _bin(F.greatest("_lo", "_t_lo"), F.floor(F.col("_slot") / 2).cast("int"))
    # an interval stands once or twice at its own level, twice over, and at each coarser one
    most = (F.lit(len(LEVEL_BITS) + 1) - level_of(t_lo, t_hi)) * 2
    pairs = a.join(_unless_small(b, table, most), (F.col("_chrom") == F.col("_t_chrom")) & (F.col("_slot") == F.col("_t_slot")) & (F.col("_bin") == F.col("_t_bin"))
                   & (lo <= t_hi) & (t_lo <= hi) & once)
    return pairs.drop("_slot", "_bin", "_t_slot", "_t_bin")


def span_overlap(
    rows: DataFrame,
    table: DataFrame,
    how: str = "inner",
    span: tuple[str, str] = ("pos", "end"),
    interval: tuple[str, str] = ("start", "end"),
    chrom: str = "chrom",
    distance: int = 0,
    prefix: str = "",
) -> DataFrame:
    """Join rows that cover ``span`` (first and last base) to the intervals they overlap, each pair once.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``. Intervals are widened by
    ``distance``; their columns other than ``chrom`` get ``prefix``, they must not clash with the rows'. A row, or an
    interval, without a chromosome or place, or that ends before it starts, overlaps nothing.
    """
    t = table.select(F.col(chrom).alias("_t_chrom"),
                     F.greatest(F.col(interval[0]).cast("bigint") - distance, F.lit(0)).alias("_t_lo"),
                     (F.col(interval[1]).cast("bigint") + distance).alias("_t_hi"),
                     *[F.col(c).alias(prefix + c) for c in table.columns if c != chrom])
    place = [F.col(chrom).alias("_chrom"), F.col(span[0]).cast("bigint").alias("_lo"), F.col(span[1]).cast("bigint").alias("_hi")]
    placed = rows.select("*", *place)
    if how == "inner":
        return _meet(placed, t).drop("_chrom", "_lo", "_hi", "_t_chrom", "_t_lo", "_t_hi")
    met = _meet(rows.select(*place).distinct(), t).drop("_t_chrom", "_t_lo", "_t_hi")
    if how != "left":
        met = met.select("_chrom", "_lo", "_hi").distinct()
    return placed.join(met, ["_chrom", "_lo", "_hi"], how).drop("_chrom", "_lo", "_hi")
