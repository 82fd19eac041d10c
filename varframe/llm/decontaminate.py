"""Benchmark decontamination as a prefix-filtered containment join over item-sized windows.

A window is ``WINDOW`` consecutive words of a benchmark item (a shorter item is one window).
The words of a window are ordered by how often they occur in the whole corpus. A text that
contains the window contains its two rarest words at their distance, so the join needs only
that prefix: places of a text with such a pair are candidates, sent with the words around them
(at most ``WINDOW`` - 1 on either side, which bounds length and position), joined to the windows
by the pair, and compared word by word there.

The corpus is read three times, whatever the size of the benchmark: to count words, to find
candidates, and to put the results beside its rows. The tasks know the benchmark's words and pairs by bitmaps of
``FILTER_BITS`` bits, whose size doesn't depend on the benchmark; a false positive costs a row and
changes nothing. Windows, counts, candidates and items stay in Spark, in written tables whose
joins adaptive execution can split where many documents share a passage; the items of a window
meet the documents by window numbers, once for each set of windows that documents have.

Results depend on the text alone: they are kept by the text's md5, so copies are joined once and rows
need no ids. Defined results: a null text has no words; items without words have no windows; repeated
items count once by id; an item without an id marks words but isn't listed; an empty corpus
gives an empty result, an empty benchmark marks nothing. All columns of the documents are
kept in ``doc``, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .common import ascii_lower, map_docs, ready, staged, table, text_or_empty, text_slices

WINDOW = 13
FILTER_BITS = 1 << 26
WORD_PATTERN = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"


def windows(bench: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """(key, item): the distinct windows of every item as blank-joined words."""
    items = bench.select(F.col(id_col).cast("string").alias("item"),
                         F.regexp_extract_all(ascii_lower(text_or_empty(text_col)), F.lit(WORD_PATTERN), F.lit(1)).alias("w"))
    return items.filter(F.size("w") > 0).select("item", F.explode(F.expr(
        f"transform(sequence(0, greatest(size(w) - {size}, 0)), i -> array_join(slice(w, i + 1, {size}), ' '))")).alias("key")).distinct()


# ---------------------------------------------------------------- bitmaps of 64-bit numbers

def bitmap(numbers: DataFrame, col: str, bits: int) -> np.ndarray:
    """A Bloom filter of two hashes, ``bits`` (a power of two) long, of the numbers in ``col``."""
    low = F.col(col).bitwiseAND(F.lit(bits - 1))
    high = F.shiftrightunsigned(col, 32).bitwiseAND(F.lit(bits - 1))
    places = numbers.select(F.explode(F.array(low, high)).alias("at"))
    found = places.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("mask")).toArrow()  # at most bits / 64 rows
    out = np.zeros(max(bits // 64, 1), dtype=np.uint64)
    out[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return out


def contains(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    mask, one = np.uint64(len(bits) * 64 - 1), np.uint64(1)
    test = lambda at: (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & one
    first = test(numbers & mask).astype(bool)
    some = np.flatnonzero(first)
    first[some] = test((numbers[some] >> np.uint64(32)) & mask).astype(bool)
    return first


def pair(one: np.ndarray, other: np.ndarray, distance: int) -> np.ndarray:
    """A number for two words ``distance`` words apart."""
    step = np.uint64((distance * 0x165667B19E3779F9) % (1 << 64))
    return words.mix(one * np.uint64(0x9E3779B97F4A7C15) ^ words.mix(other + step))


# ---------------------------------------------------------------- benchmark side

def window_words(wins: DataFrame) -> DataFrame:
    """(wid, pos, h) of the words of (wid, key)."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            h, offsets = words.word_hashes(batch.column(1).to_pylist())
            size = np.diff(offsets)
            pos = np.arange(len(h)) - np.repeat(offsets[:-1], size)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), size)), pa.array(pos.astype(np.int32)),
                                              pa.array(h.view(np.int64))], ["wid", "pos", "h"])

    return wins.select("wid", "key").mapInArrow(run, "wid long, pos int, h long")


def corpus_counts(docs: DataFrame, text_col: str, vocabulary: np.ndarray) -> DataFrame:
    """(h, n): how often the words that the bitmap ``vocabulary`` lets through occur in all texts."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        import pyarrow as pa

        held: dict[int, int] = {}
        for batch in batches:
            for text in _sliced(batch.column(0)):
                h, _ = words.word_hashes(text)
                word, n = np.unique(h[contains(sent.value, h)], return_counts=True)
                for w, c in zip(word.tolist(), n.tolist(), strict=True):
                    held[w] = held.get(w, 0) + c
            if len(held) > 1 << 20:
                yield counted(pa, held)
                held = {}
        yield counted(pa, held)

    def counted(pa, held):
        return pa.RecordBatch.from_arrays([pa.array(np.array(list(held), dtype=np.uint64).view(np.int64)),
                                           pa.array(list(held.values()), pa.int64())], ["h", "n"])

    return docs.select(text_or_empty(text_col).alias("text")).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def prefixes(wins: DataFrame, each: DataFrame, counts: DataFrame) -> DataFrame:
    """(wid, key, n, at, h, p): each window's rarest word, its place and hash, and its pair with the next rarest.

    A window with a word that the corpus doesn't have can't occur and has no row.
    """
    ranked = each.join(counts, "h", "left").groupBy("wid").agg(F.array_sort(F.collect_list(F.struct(
        F.coalesce("n", F.lit(0)).alias("seen"), "pos", "h"))).alias("r")).filter(F.col("r")[0]["seen"] > 0)
    second = F.coalesce(F.get("r", F.lit(1)), F.col("r")[0])
    picked = ranked.select("wid", F.size("r").alias("n"), F.col("r")[0]["pos"].alias("at"), F.col("r")[0]["h"].alias("h"),
                           (second["pos"] - F.col("r")[0]["pos"]).alias("d"), second["h"].alias("h2"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            h, d, h2 = (batch.column(i).to_numpy() for i in (3, 4, 5))
            p = np.zeros(len(h), dtype=np.uint64)
            for x in np.unique(d).tolist():
                p[d == x] = pair(h[d == x].view(np.uint64), h2[d == x].view(np.uint64), x)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(p.view(np.int64))], ["wid", "n", "at", "h", "p"])

    return picked.mapInArrow(run, "wid long, n int, at int, h long, p long").join(wins, "wid")


# ---------------------------------------------------------------- corpus side

def _sliced(texts):
    for lo, hi in text_slices(texts):
        yield texts.slice(lo, hi - lo).to_pylist()


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def candidates(docs: DataFrame, text_col: str, first: np.ndarray, both: np.ndarray, size: int) -> DataFrame:
    """(p, tkey, pos, at, around): places with a rarest word and its partner, and the words around them.

    ``pos`` is the word's number in its text, ``at`` its place in ``around``.
    """
    sent = docs.sparkSession.sparkContext.broadcast((first, both))

    def run(batches):
        import pyarrow as pa

        first, both = sent.value
        for batch in batches:
            for lo, hi in text_slices(batch.column(1)):
                texts = batch.column(1).slice(lo, hi - lo).to_pylist()
                h, offsets = words.word_hashes(texts)
                pos = np.flatnonzero(contains(first, h))
                doc = np.searchsorted(offsets, pos, side="right") - 1
                places, found = [], []
                for d in range(1 - size, size):
                    ok = (pos + d >= offsets[doc]) & (pos + d < offsets[doc + 1])
                    p = pair(h[pos[ok]], h[pos[ok] + d], d)
                    some = contains(both, p)
                    places.append(np.flatnonzero(ok)[some])
                    found.append(p[some])
                place, p = np.concatenate(places), np.concatenate(found)
                at, doc = pos[place], doc[place]
                begin, end = np.maximum(at - size + 1, offsets[doc]), np.minimum(at + size, offsets[doc + 1])
                own = {i: words.split(texts[i]) for i in np.unique(doc).tolist()}
                around = [[w.decode("utf-8", "surrogatepass") for w in own[i][b:e]] for i, b, e in
                          zip(doc.tolist(), (begin - offsets[doc]).tolist(), (end - offsets[doc]).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p.view(np.int64)), batch.column(0).slice(lo, hi - lo).take(pa.array(doc)), pa.array(at - offsets[doc]),
                     pa.array((at - begin).astype(np.int32)), pa.array(around, pa.list_(pa.string()))], ["p", "tkey", "pos", "at", "around"])

    rows = docs.select(text_or_empty(text_col).alias("text")).select(_text_key(F.col("text")).alias("tkey"), "text")
    return rows.mapInArrow(run, "p long, tkey binary, pos long, at int, around array<string>")


def window_hits(docs: DataFrame, wins: DataFrame, text_col: str, size: int, filter_bits: int) -> DataFrame:
    """(tkey, start, end, wid): every occurrence of a window (wid, key) in a text, in words."""
    spark = docs.sparkSession
    each = staged(spark, window_words(wins), "window-words")
    counts = staged(spark, corpus_counts(docs, text_col, bitmap(each, "h", filter_bits)), "window-counts")
    prefix = staged(spark, prefixes(wins, each, counts), "window-prefixes")
    found = staged(spark, candidates(docs, text_col, bitmap(prefix, "h", filter_bits), bitmap(prefix, "p", filter_bits), size), "window-candidates")
    own = prefix.select("p", "wid", "key", "n", F.col("at").alias("o"))
    begin = F.col("at") - F.col("o")
    fits = (begin >= 0) & (begin + F.col("n") <= F.size("around"))
    words_there = F.array_join(F.slice("around", F.greatest(begin, F.lit(0)) + 1, F.col("n")), " ")
    return found.join(own, "p").filter(fits & (words_there == F.col("key"))).select(
        "tkey", (F.col("pos") - F.col("o")).alias("start"), (F.col("pos") - F.col("o") + F.col("n")).alias("end"), "wid").distinct()


def findings(hits: DataFrame, items: DataFrame) -> DataFrame:
    """(tkey, spans, items, n_hit) of the texts with hits; ``items``: wid, item."""
    spark = hits.sparkSession
    by_text = staged(spark, hits.groupBy("tkey").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("s"), F.array_sort(F.collect_set("wid")).alias("wids"))
        .withColumn("set", F.unhex(F.md5(F.array_join("wids", ",")))), "window-texts")
    sets = by_text.groupBy("set").agg(F.first("wids").alias("wids")).select("set", F.explode("wids").alias("wid"))
    named = sets.join(items.filter("item is not null"), "wid").groupBy("set").agg(F.array_sort(F.collect_set("item")).alias("items"))
    # sorted spans, joined where they touch or overlap
    empty = F.array().cast("array<struct<start: bigint, end: bigint>>")
    last = lambda a: F.element_at(a, -1)
    grown = lambda a, x: F.when((F.size(a) > 0) & (x["start"] <= F.try_element_at(a, F.lit(-1))["end"]), F.concat(
        F.slice(a, 1, F.size(a) - 1), F.array(F.struct(last(a)["start"].alias("start"), F.greatest(last(a)["end"], x["end"]).alias("end"))))
    ).otherwise(F.concat(a, F.array(x)))
    return by_text.join(named, "set", "left").select("tkey", F.aggregate("s", empty, grown).alias("spans"), F.coalesce(
        "items", F.array().cast("array<string>")).alias("items"))


def contamination(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", size: int = WINDOW, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``doc`` (all columns), n_words, spans of hit words, items (ids of the items found), n_hit, contaminated.

    A document is contaminated if at least a twentieth of its words, and not none, are hit.
    """
    spark = ready(docs.sparkSession)
    owned = staged(spark, windows(bench, item_col, item_text, size), "windows")
    wins = staged(spark, owned.select("key").distinct().withColumn("wid", F.monotonically_increasing_id()), "window-keys")
    hits = staged(spark, window_hits(docs, wins, text_col, size, filter_bits), "window-hits")
    found = staged(spark, findings(hits, owned.join(wins, "key").select("wid", "item")), "window-findings")

    def count():
        return lambda texts: [np.diff(words.word_hashes(texts)[1]).tolist()]

    base = map_docs(docs, text_col, "n_words long", count).withColumn(
        "tkey", _text_key(F.coalesce(F.col(f"doc.`{text_col}`").cast("string"), F.lit(""))))
    out = base.join(found, "tkey", "left").drop("tkey")
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])
    return out.withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start: bigint, end: bigint>>"))).withColumn(
        "items", F.coalesce("items", F.array().cast("array<string>"))).withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op8_decontaminate(spark, sf_dir):
    """Every document with its words that occur in benchmark windows."""
    ready(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(docs, table(spark, sf_dir, "benchmark")).select(
        "doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""
OP8_SQL = f"""
with d as (select doc_id, {_WORDS} as w from documents),
b as (select item_id, {_WORDS} as w from benchmark),
win as (
  select distinct item_id, least(len(w), 13) as n,
         array_to_string(w[i : i + least(len(w), 13) - 1], ' ') as key
  from (select item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) as i from b where len(w) > 0)),
sizes as (select distinct n from win),
places as (
  select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as key
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)),
hits as (select distinct doc_id, i, n, item_id from places join win using (n, key)),
covered as (
  select doc_id, count(*) as n_hit
  from (select distinct doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id),
found as (
  select doc_id, count(*) as n_items, string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
  from (select distinct doc_id, item_id from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * n_hit >= len(w) as contaminated
from d left join covered using (doc_id) left join found using (doc_id)"""
