"""Column expressions for VCF fields (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "."


def missing_to_null(c: Column) -> Column:
    return F.when(c != MISSING, c)


def info_map(info: Column) -> Column:
    """INFO text to ``map<string,string>``; a flag maps to NULL, ``.`` to an empty map.

    A repeated key keeps its last value (``spark.sql.mapKeyDedupPolicy=LAST_WIN``).
    """
    return F.when((info == MISSING) | (info == ""), F.create_map().cast("map<string,string>")).otherwise(
        F.str_to_map(info, F.lit(";"), F.lit("="))
    )


def info_text(m: Column) -> Column:
    """``map<string,string>`` back to INFO text in key order of the map; NULL value = flag."""
    parts = F.zip_with(F.map_keys(m), F.map_values(m), lambda k, v: F.coalesce(F.concat(k, F.lit("="), v), k))
    return F.when(F.size(m) == 0, F.lit(MISSING)).otherwise(F.array_join(parts, ";"))


def sample_map(fmt_keys: Column, sample: Column) -> Column:
    """One sample column to a map keyed by FORMAT; trailing keys without values are dropped."""
    pairs = F.arrays_zip(fmt_keys.alias("k"), F.split(sample, ":").alias("v"))
    kept = F.filter(pairs, lambda e: e["k"].isNotNull() & e["v"].isNotNull())
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["k"].alias("key"), e["v"].alias("value"))))


def sample_field(fmt_keys: Column, sample: Column, key: str) -> Column:
    """One FORMAT field of one sample text, NULL when absent."""
    i = F.array_position(fmt_keys, F.lit(key))
    return F.when(i > 0, F.try_element_at(F.split(sample, ":"), i.cast("int")))


def _common_run(a: Column, b: Column, from_end: bool) -> Column:
    """Length of the run of equal characters at the start (or end) of ``a`` and ``b``.

    Alleles of one base (most variants) are answered by one comparison; longer ones are cut
    into characters once and compared side by side, in time proportional to their length.
    """
    m = F.least(F.length(a), F.length(b))
    chars = lambda x: F.split(F.reverse(x) if from_end else x, "")
    same = F.transform(F.arrays_zip(F.slice(chars(a), 1, m).alias("x"), F.slice(chars(b), 1, m).alias("y")), lambda p: p["x"] == p["y"])
    first_diff = F.array_position(same, False)
    run = F.when(first_diff == 0, m).otherwise(first_diff - 1)
    at = F.lit(-1 if from_end else 1)
    one = F.when(F.substring(a, at, 1) == F.substring(b, at, 1), F.lit(1)).otherwise(F.lit(0))
    return F.when(m == 0, F.lit(0)).when(m == 1, one).otherwise(run).cast("int")


def is_symbolic(allele: Column) -> Column:
    """``<...>``, ``*`` or a breakend: no bases to trim."""
    return F.coalesce(allele.startswith("<") | (allele == "*") | allele.contains("[") | allele.contains("]"), F.lit(False))


def trim_common(df, ref: str = "ref", alt: str = "alt", pos: str = "pos"):
    """Minimal representation (B5): drop the shared suffix, then the shared prefix.

    Adds ``min_pos`` (pos + bases removed in front), ``min_ref``, ``min_alt``; an
    empty allele is written ``-``. Symbolic alleles and breakends stay as they are. Built in steps so no expression is repeated.
    """
    dash = lambda x: F.when(F.length(x) == 0, F.lit("-")).otherwise(x)
    r, a = F.col(ref), F.col(alt)
    symbolic = is_symbolic(r) | is_symbolic(a)
    t = df.withColumn("_sym", symbolic).withColumn("_s", F.when(F.col("_sym"), 0).otherwise(_common_run(r, a, True)))
    t = t.withColumn("_r1", F.expr(f"substring({ref}, 1, length({ref}) - _s)")).withColumn(
        "_a1", F.expr(f"substring({alt}, 1, length({alt}) - _s)"))
    t = t.withColumn("_p", F.when(F.col("_sym"), 0).otherwise(_common_run(F.col("_r1"), F.col("_a1"), False)))
    t = t.withColumn("min_pos", F.col(pos) + F.col("_p")) if pos in df.columns else t
    t = t.withColumn("min_ref", dash(F.expr("substring(_r1, _p + 1)"))).withColumn(
        "min_alt", dash(F.expr("substring(_a1, _p + 1)")))
    return t.drop("_sym", "_s", "_r1", "_a1", "_p")


def class_of(ref: Column, alt: Column, min_ref: Column, min_alt: Column) -> Column:
    """SNV, insertion, deletion, substitution, indel, or sequence_alteration (B6),
    judged on the minimal alleles."""
    return (
        F.when(is_symbolic(alt), F.lit("sequence_alteration"))
        .when(min_ref == "-", F.lit("insertion"))
        .when(min_alt == "-", F.lit("deletion"))
        .when((F.length(min_ref) == 1) & (F.length(min_alt) == 1), F.lit("SNV"))
        .when(F.length(min_ref) == F.length(min_alt), F.lit("substitution"))
        .otherwise(F.lit("indel"))
    )
