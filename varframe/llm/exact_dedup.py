"""Exact deduplication by composable polynomial fingerprints, confirmed chunk by chunk.

A text is cut into chunks of ``chunk_bytes`` UTF-8 bytes. Each chunk has a polynomial hash
under two primes and the shift ``r**length``; two neighbouring pieces combine as
``(a * shift_b + b, shift_a * shift_b)``, so the chunks of a huge document are hashed by
many tasks and combined afterwards. Documents of one chunk are hashed where they are read.
Documents with equal fingerprint and length are then compared with their group's
representative, one chunk row against one chunk row, so no task holds a whole group or
two whole documents; a group may hold any share of all rows.

Defined results: a null text counts as empty; rows that repeat the same (id, text) are one
document and give one row, or with ``every_row``, as in the query, a row each, counted in
``group_size``; the query's ``kept`` is null for a null id; ids may be null (smallest) or shared by different texts; of
equal texts the largest id stays; a text that only shares the fingerprint is taken out of
the group and grouped by its own digest; an empty table gives an empty result; other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import every_copy, ready, staged, table, text_or_empty

CHUNK_BYTES = 1 << 16
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1672897913)


def reversed_powers(base: int, prime: int, n: int) -> np.ndarray:
    """``base**(n-1) ... base**0`` modulo ``prime``, by doubling."""
    out = np.ones(1, dtype=np.int64)
    while len(out) < n:
        out = np.concatenate([out, out * pow(base, len(out), prime) % prime])
    return out[:n][::-1].copy()


_POWERS: dict[tuple[int, int, int], np.ndarray] = {}


def chunk_hash(data: bytes, base: int, prime: int, size: int) -> int:
    """Polynomial hash of at most ``size`` (<= 64 KiB) bytes; bytes count from 1."""
    key = (base, prime, size)
    if key not in _POWERS:
        _POWERS[key] = reversed_powers(base, prime, size)
    if not data:
        return 0
    digits = np.frombuffer(data, dtype=np.uint8).astype(np.int64) + 1
    return int(np.dot(digits, _POWERS[key][size - len(data):]) % prime)


def _hasher(chunk_bytes: int, bases: tuple[int, int], primes: tuple[int, int]):
    if not 0 < chunk_bytes <= CHUNK_BYTES:
        raise ValueError(f"chunk_bytes must be 1..{CHUNK_BYTES}")

    @pandas_udf("struct<h1: bigint, h2: bigint, s1: bigint, s2: bigint>")
    def fingerprint(part: pd.Series) -> pd.DataFrame:
        out = np.empty((len(part), 4), dtype=np.int64)
        for i, data in enumerate(part):
            for j in (0, 1):
                out[i, j] = chunk_hash(data, bases[j], primes[j], chunk_bytes)
                out[i, 2 + j] = pow(bases[j], len(data), primes[j])
        return pd.DataFrame(out, columns=["h1", "h2", "s1", "s2"])

    return fingerprint


def _chunks(df: DataFrame, chunk_bytes: int) -> DataFrame:
    """One row per chunk of column ``bin``; an empty text has one empty chunk."""
    last = F.greatest(F.lit(0), F.expr(f"(n_bytes - 1) div {chunk_bytes}"))
    return df.withColumn("chunk_no", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long")))).withColumn(
        "part", F.expr(f"substring(bin, cast(chunk_no * {chunk_bytes} + 1 as int), {chunk_bytes})")).drop("bin")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    t = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return t.select("id", F.sha2("text", 256).alias("sha"), F.octet_length("text").cast("long").alias("n_bytes"),
                    F.col("text").cast("binary").alias("bin"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES,
                 bases: tuple[int, int] = BASES, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """(id, sha, n_bytes, h1, h2, copies): the fingerprint of every document; a row may stand for several copies."""
    texts = _texts(docs, id_col, text_col)
    hashed = _hasher(chunk_bytes, bases, primes)
    small = texts.filter(F.col("n_bytes") <= chunk_bytes).withColumn("f", hashed("bin")).select(
        "id", "sha", "n_bytes", "f.h1", "f.h2", F.lit(1).cast("long").alias("copies"))
    # chunks of huge documents go to different tasks and come back as four numbers each
    parts = _chunks(texts.filter(F.col("n_bytes") > chunk_bytes), chunk_bytes).repartition("id", "sha", "chunk_no")
    p1, p2 = primes
    huge = parts.withColumn("f", hashed("part")).groupBy("id", "sha", "n_bytes").agg(
        F.array_sort(F.collect_set(F.struct("chunk_no", "f.h1", "f.h2", "f.s1", "f.s2"))).alias("fs"),
        F.count("*").alias("chunks")).select(
        "id", "sha", "n_bytes", F.expr("chunks div size(fs)").alias("copies"),
        F.expr(f"""aggregate(fs, named_struct('h1', 0L, 'h2', 0L), (a, x) -> named_struct(
            'h1', (a.h1 * x.s1 + x.h1) % {p1}, 'h2', (a.h2 * x.s2 + x.h2) % {p2}))""").alias("f")).select(
        "id", "sha", "n_bytes", "f.h1", "f.h2", "copies")
    return small.unionByName(huge)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES,
                 bases: tuple[int, int] = BASES, primes: tuple[int, int] = PRIMES, every_row: bool = False) -> DataFrame:
    """One row per document, or per row: id, sha, keep_id, group_size, kept (see the module's text)."""
    spark = ready(docs.sparkSession)
    fp = ["h1", "h2", "n_bytes"]
    prints = staged(spark, fingerprints(docs, id_col, text_col, chunk_bytes, bases, primes).groupBy("id", "sha", *fp).agg(
        F.sum("copies").alias("copies") if every_row else F.lit(1).cast("long").alias("copies")), "exact-prints")
    # partial aggregation: a hot fingerprint sends one row per task
    multi = staged(spark, prints.groupBy(*fp).agg(F.max(F.struct("id", "sha")).alias("rep"), F.count("*").alias("n"))
                   .filter("n > 1").select(*fp, F.col("rep.id").alias("rep_id"), F.col("rep.sha").alias("rep_sha")),
                   "exact-multi")
    joined = staged(spark, prints.join(multi, fp, "left"), "exact-joined")
    single = joined.filter("rep_sha is null").select(
        "id", "sha", F.col("id").alias("keep_id"), F.col("copies").alias("group_size"), "copies")
    members = joined.filter("rep_sha is not null")

    same_row = lambda a, b: a["id"].eqNullSafe(b["id"]) & (a["sha"] == b["sha"])
    texts = _texts(docs, id_col, text_col).drop("n_bytes")
    mine = texts.join(members, same_row(texts, members)).select(
        members["id"], members["sha"], "n_bytes", "rep_id", "rep_sha", "bin")
    is_rep = F.col("id").eqNullSafe(F.col("rep_id")) & (F.col("sha") == F.col("rep_sha"))
    theirs = _chunks(mine.filter(is_rep).dropDuplicates(["rep_id", "rep_sha"]), chunk_bytes).select(
        F.col("rep_id").alias("r_id"), F.col("rep_sha").alias("r_sha"), F.col("chunk_no").alias("r_no"),
        F.col("part").alias("r_part"))
    compared = _chunks(mine.filter(~is_rep), chunk_bytes).join(
        theirs, F.col("rep_id").eqNullSafe(F.col("r_id")) & (F.col("rep_sha") == F.col("r_sha"))
        & (F.col("chunk_no") == F.col("r_no")))
    differs = compared.groupBy("id", "sha").agg(F.max(F.col("part") != F.col("r_part")).alias("differs")).filter(
        "differs").select(F.col("id").alias("d_id"), F.col("sha").alias("d_sha"))
    checked = staged(spark, members.join(
        differs, members["id"].eqNullSafe(differs["d_id"]) & (members["sha"] == differs["d_sha"]), "left").select(
        "id", "sha", "copies", *fp, F.when(F.col("d_sha").isNull(), F.col("rep_sha")).otherwise(F.col("sha")).alias("cls")),
        "exact-checked")
    sizes = staged(spark, checked.groupBy(*fp, "cls").agg(F.max("id").alias("keep_id"), F.sum("copies").alias("group_size")),
                   "exact-sizes")
    grouped = checked.join(sizes, [*fp, "cls"]).select("id", "sha", "keep_id", "group_size", "copies")
    out = single.unionByName(grouped)
    if prints.filter("copies > 1").limit(1).count():
        out = every_copy(staged(spark, out, "exact-groups"))
    else:
        out = out.drop("copies")
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one row of every set of equal texts, all columns kept."""
    gone = exact_groups(docs, id_col, text_col)
    keep = gone.filter("kept").select(F.col("id").alias("_keep_id"), F.col("sha").alias("_keep_sha"))
    rows = docs.withColumn("_sha", F.sha2(text_or_empty(text_col), 256))
    once = rows.join(keep, rows[id_col].eqNullSafe(keep["_keep_id"]) & (rows["_sha"] == keep["_keep_sha"]), "left_semi")
    return once.dropDuplicates([id_col, "_sha"]).drop("_sha")


def op1_exact_dedup(spark, sf_dir):
    """Every document with its class of identical texts; the largest doc_id of a class stays."""
    ready(spark)
    return exact_groups(table(spark, sf_dir, "documents"), every_row=True).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("id") == F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))


OP1_SQL = """
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = max(doc_id) over g as kept, sha256(coalesce(text, '')) as text_sha256
from documents window g as (partition by coalesce(text, ''))"""
