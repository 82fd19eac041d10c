"""Annotation as Spark joins.

The annotation tables are caller-supplied DataFrames. The interval operators take a row as
its one base ``pos``, or, with ``end`` (see ``vcf.with_end``), as all bases it covers. Lookup tables are reduced
to one row per key before the join so a match never multiplies rows; several
frequency sources are merged into one keyed table so the variants shuffle once.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .overlap import BIN, point_overlap, span_overlap

VARIANT_KEY = ["chrom", "pos", "ref", "alt"]
NA = "."


def lookup(table: DataFrame, cols: Sequence[str], keys: Sequence[str] = VARIANT_KEY, name: str = "lookup") -> DataFrame:
    """A look-up table with one whole record per key (of several the largest, compared column by
    column), written once to the shared folder.

    Prepared this way it serves many annotation runs, its size is known to the planner, and beside a plain
    scan, not an aggregate, adaptive execution can split a hot key of the rows.
    """
    one = table.groupBy(*keys).agg(F.max(F.struct(*cols)).alias("_one")).select(*keys, *[F.col(f"_one.{c}").alias(c) for c in cols])
    return _written(one, name)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def annotate_exact(rows: DataFrame, table: DataFrame, cols: Sequence[str], keys: Sequence[str] = VARIANT_KEY,
                   na: str = NA, prepared: bool = False) -> DataFrame:
    """Filter-based annotation (B7): exact key lookup, ``na`` where missing (values as text).

    ``prepared`` says that ``table`` comes from ``lookup``; else it is made into one here.
    """
    out = rows.join(table if prepared else lookup(table, cols, keys), list(keys), "left")
    return out.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(na)) for c in cols})


def lookup_ids(known: DataFrame, id_col: str = "id", keys: Sequence[str] = ("chrom", "pos"), name: str = "existing") -> DataFrame:
    """A look-up table of all distinct ids per key, sorted and comma-joined; written once, as ``lookup``."""
    return _written(known.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_set(id_col)), ",").alias(name)), "lookup-ids")


def annotate_existing(rows: DataFrame, known: DataFrame, id_col: str = "id", keys: Sequence[str] = ("chrom", "pos"),
                      name: str = "existing", na: str = NA, prepared: bool = False) -> DataFrame:
    """Known variants at the same position (B8): their ids, sorted and distinct, comma-joined.

    The id list per position is bounded by the distinct alleles seen there. ``prepared``: ``known`` comes from ``lookup_ids``.
    """
    ids = known if prepared else lookup_ids(known, id_col, keys, name)
    return rows.join(ids, list(keys), "left").withColumn(name, F.coalesce(F.col(name), F.lit(na)))


def lookup_af(sources: Mapping[str, DataFrame], af: str = "af", keys: Sequence[str] = VARIANT_KEY) -> DataFrame:
    """A look-up table of frequencies, one column per source; written once, as ``lookup``."""
    parts = [df.select(*keys, F.lit(src).alias("_src"), F.col(af).cast("double").alias("_af")) for src, df in sources.items()]
    stacked = functools.reduce(DataFrame.unionByName, parts)
    return _written(stacked.groupBy(*keys).agg(*[F.max(F.when(F.col("_src") == src, F.col("_af"))).alias(src) for src in sources]), "lookup-af")


def annotate_max_af(rows: DataFrame, sources: Mapping[str, DataFrame] | Sequence[str], af: str = "af",
                    keys: Sequence[str] = VARIANT_KEY, name: str = "max_af", table: DataFrame | None = None) -> DataFrame:
    """Frequencies from several sources and their maximum.

    The sources are one look-up table with one row per key and one column per source, joined once; ``table`` is
    such a table made before by ``lookup_af`` (``sources`` are then its columns).
    """
    cols = list(sources)
    out = rows.join(lookup_af(sources, af, keys) if table is None else table, list(keys), "left")
    return out.withColumn(name, F.greatest(*cols) if len(cols) > 1 else F.col(cols[0]))


def _overlap(rows: DataFrame, table: DataFrame, how: str, end: str | None, distance: int = 0, bin_size: int = BIN,
             prefix: str = "") -> DataFrame:
    if end is None:
        return point_overlap(rows, table, how=how, distance=distance, bin_size=bin_size, prefix=prefix)
    return span_overlap(rows, table, how=how, span=("pos", end), distance=distance, prefix=prefix)


def annotate_overlap(rows: DataFrame, table: DataFrame, cols: Sequence[str], how: str = "left",
                     distance: int = 0, bin_size: int = BIN, end: str | None = None) -> DataFrame:
    """Region / gene annotation (B10, B11): interval columns ``cols`` for every overlapping interval."""
    iv = table.select("chrom", "start", "end", *cols)
    out = _overlap(rows, iv, how, end, distance, bin_size, "_a_")
    for c in cols:
        out = out.withColumnRenamed("_a_" + c, c)
    return out.drop("_a_start", "_a_end")


def annotate_distance(rows: DataFrame, genes: DataFrame, cols: Sequence[str] = ("gene",), distance: int = 5000,
                      bin_size: int = BIN, end: str | None = None) -> DataFrame:
    """Genes within ``distance`` bases (B12): ``relation`` upstream / within / downstream and ``distance``."""
    iv = genes.select("chrom", "start", "end", *cols)
    out = _overlap(rows, iv, "inner", end, distance, bin_size, "_g_")
    for c in cols:
        out = out.withColumnRenamed("_g_" + c, c)
    pos, last, gs, ge = F.col("pos"), F.col(end or "pos"), F.col("_g_start"), F.col("_g_end")
    return (
        out.withColumn("relation", F.when(last < gs, "upstream").when(pos > ge, "downstream").otherwise("within"))
        .withColumn("distance", F.when(last < gs, gs - last).when(pos > ge, pos - ge).otherwise(F.lit(0).cast("bigint")))
        .drop("_g_start", "_g_end")
    )


def _flanks(places: DataFrame, genes: DataFrame, bin_size: int) -> DataFrame:
    """For distinct ``(_chrom, _last)``: the largest end of the genes that start there or before, and the next start.

    Places and gene starts are one event table, exchanged once by ``(chrom, bin)``: a bin holds at
    most two events per base. The largest end and first start of each bin carry the answer
    across bins by running aggregates over the occupied bins of a chromosome (bounded by
    its length / bin width).
    """
    starts = genes.where(F.col("start") <= F.col("end")).groupBy(F.col("chrom").alias("_chrom"), F.col("start").alias("key")).agg(
        F.max("end").alias("reach"))
    ev = starts.select("_chrom", "key", F.lit(0).alias("kind"), "reach").unionByName(
        places.select("_chrom", F.col("_last").alias("key"), F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("reach"))
    ).withColumn("_bin", F.expr(f"key div {bin_size}"))
    start = F.when(F.col("kind") == 0, F.col("key"))
    # a gene that starts at a place counts as before it; backwards, as after the places it is before
    before = Window.partitionBy("_chrom", "_bin").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("_chrom", "_bin").orderBy(F.desc("key"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    local = ev.withColumn("_reach", F.max("reach").over(before)).withColumn("_next", F.min(start).over(after)).where("kind = 1")
    bins = ev.groupBy("_chrom", "_bin").agg(F.max("reach").alias("_r"), F.min(start).alias("_s"))
    forward = Window.partitionBy("_chrom").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy("_chrom").orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, -1)
    carry = bins.select("_chrom", "_bin", F.max("_r").over(forward).alias("_fr"), F.min("_s").over(back).alias("_fs"))
    return local.join(carry, ["_chrom", "_bin"]).select(
        "_chrom", F.col("key").alias("_last"), F.greatest("_reach", "_fr").alias("up_end"), F.least("_next", "_fs").alias("down_start"))


def annotate_flank(rows: DataFrame, genes: DataFrame, bin_size: int = BIN, end: str | None = None) -> DataFrame:
    """Nearest gene end upstream and gene start downstream for rows no gene overlaps.

    Adds ``up_end`` (largest gene end before the row) and ``down_start`` (smallest gene start
    after it) on the same chromosome; NULL when there is none. A row is free of genes if and
    only if every gene that starts at or before its last base ends before its first, so
    the largest such end tells both whether the row is free and what lies upstream: one look-up
    per distinct last base, then one join back.
    """
    place = [F.col("chrom").alias("_chrom"), F.col(end or "pos").cast("bigint").alias("_last")]
    found = _flanks(rows.select(*place).where("_chrom is not null and _last is not null").distinct(), genes, bin_size)
    joined = rows.select("*", *place).join(found, ["_chrom", "_last"], "left").drop("_chrom", "_last")
    return joined.where(F.coalesce(F.col("up_end") < F.col("pos"), F.lit(True)))


def pick(rows: DataFrame, by: Sequence[str], order: Sequence[Column | str], k: int = 1,
         rank: str | None = None) -> DataFrame:
    """Keep the first ``k`` rows per ``by`` in ``order``.

    ``row_number() <= k`` lets Spark insert a partial per-task limit before the
    shuffle (WindowGroupLimit), so a hot group sends at most k rows per task.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    out = rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    return out.withColumnRenamed("_rn", rank) if rank else out.drop("_rn")


def pack(rows: DataFrame, key: Sequence[str], fields: Sequence[str], name: str = "ANN") -> DataFrame:
    """All annotations of a variant in one INFO-style field (B15): distinct ``a|b|c`` entries, sorted."""
    entry = F.concat_ws("|", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields])
    return rows.groupBy(*key).agg(F.array_join(F.sort_array(F.collect_set(entry)), ",").alias(name))


def restrict(rows: DataFrame, intervals: DataFrame, bin_size: int = BIN, end: str | None = None) -> DataFrame:
    """Rows inside any interval of a list (B16), with ``end``: rows that share a base with one.

    An interval without a start is its whole contig: those need no bins, only the name; with ``end``
    they are intervals of the coarsest bin.
    """
    if end is not None:
        whole = intervals.select("chrom", F.coalesce("start", F.lit(0)).alias("start"), F.when(
            F.col("start").isNull(), F.lit(1 << 61)).otherwise(F.col("end")).alias("end"))
        return span_overlap(rows, whole, "left_semi", span=("pos", end))
    bounded = intervals.where(F.col("start").isNotNull()).select("chrom", "start", "end")
    whole = intervals.where(F.col("start").isNull()).select(F.col("chrom").alias("_whole")).distinct()
    marked = rows.join(whole, F.col("chrom") == F.col("_whole"), "left")
    rest = point_overlap(marked.where(F.col("_whole").isNull()).drop("_whole"), bounded, how="left_semi", bin_size=bin_size)
    return marked.where(F.col("_whole").isNotNull()).drop("_whole").unionByName(rest)
