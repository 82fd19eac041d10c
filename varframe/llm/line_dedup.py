"""Line deduplication by range-partitioned line hashes; the result is a keep bitmap per document.

Every line's key (white space stripped at both ends, A-Z lower-cased) of at least
``min_chars`` code points is hashed to 128 bits. The hashes are range-partitioned by
(hash, document) and sorted by (hash, document, position): first occurrences are streamed
off the sorted runs, and a key that fills many partitions is summed up in each of them
before the small totals meet. A key found in at least ``min_docs`` documents loses all its
lines except those of the largest document id holding it. Decisions come back as sparse
bitmaps of 64 lines a word; words in which every line stays are left out.

Only DataFrame functions run here. Defined results: null or empty text is one empty line,
which has no key; equal ids count as one document; a null id is smaller than any other;
repeated rows give repeated rows; an empty table gives an empty result; input columns other
than the two named may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, ready, staged, table, text_or_empty

MIN_CHARS = 40
MIN_DOCS = 5
BLANK = " \t\n\x0b\x0c\r"


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, tkey, pos, h1, h2) of every line whose key is long enough; tkey tells texts of one id apart."""
    t = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    lines = t.select("id", F.xxhash64("text").alias("tkey"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.filter(F.length("line") >= min_chars).withColumn("line", F.trim(F.col("line"), F.lit(BLANK)))
    lines = lines.filter(F.length("line") >= min_chars).withColumn("line", ascii_lower(F.col("line")))
    return lines.select("id", "tkey", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"))


def repeated_keys(hashes: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, keep): keys in at least ``min_docs`` documents, and the document that keeps its lines."""
    ranged = hashes.repartitionByRange("h1", "h2", "id").sortWithinPartitions("h1", "h2", "id", "pos")
    run = Window.partitionBy("h1", "h2", "id").orderBy("pos", "tkey")
    firsts = ranged.withColumn("nth", F.row_number().over(run)).filter("nth = 1")
    return firsts.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("id").alias("keep")).filter(
        F.col("n_docs") >= min_docs).select("h1", "h2", "keep")


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, tkey, n_dropped, words): documents that lose lines, with their sparse keep bitmaps.

    ``words`` is a sorted array of (word, keep): bit ``pos % 64`` of word ``pos div 64`` tells
    whether the line at ``pos`` stays; a word that isn't listed is all ones.
    """
    spark = ready(docs.sparkSession)
    hashes = staged(spark, line_hashes(docs, id_col, text_col, min_chars), "line-hashes")
    keys = staged(spark, repeated_keys(hashes, min_docs), "line-keys")
    gone = hashes.join(keys, ["h1", "h2"]).filter(~F.col("id").eqNullSafe(F.col("keep")))
    words = gone.groupBy("id", "tkey", F.expr("pos div 64").cast("int").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, pos % 64))").alias("bits"))
    return words.groupBy("id", "tkey").agg(
        F.sum(F.expr("bit_count(bits)")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.expr("~bits").alias("keep")))).alias("words"))


# the sparse words filled up to one word per 64 lines, in one pass over them
DENSE = """concat(array_repeat(-1L, words[0].word), flatten(transform(words, (x, i) -> concat(array(x.keep),
    array_repeat(-1L, coalesce(get(words, i + 1).word, cast((size(lines) - 1) div 64 as int) + 1) - x.word - 1)))))"""


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_dropped, kept_text) of every row of ``docs``."""
    t = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).withColumn(
        "tkey", F.xxhash64("text"))
    b = bitmaps.select(F.col("id").alias("b_id"), F.col("tkey").alias("b_tkey"), "n_dropped", "words")
    j = t.join(b, t["id"].eqNullSafe(b["b_id"]) & (t["tkey"] == b["b_tkey"]), "left").withColumn(
        "lines", F.split("text", "\n"))
    hit = j.withColumn("dense", F.when(F.col("words").isNotNull(), F.expr(DENSE)))
    kept = F.expr("""array_join(filter(lines, (x, i) -> getbit(dense[cast(i div 64 as int)], i % 64) = 1), '\n')""")
    return hit.select("id", F.size("lines").cast("long").alias("n_lines"),
                      F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
                      F.when(F.col("words").isNull(), F.col("text")).otherwise(kept).alias("kept_text"))


def op10_line_dedup(spark, sf_dir):
    """Every document after its repeated lines are dropped."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    return apply_bitmaps(docs, keep_bitmaps(docs)).select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP10_SQL = """
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (
  select doc_id, pos, line, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from lines),
hot as (
  select k, max(doc_id) as keep from keyed where length(k) >= 40 group by k having count(distinct doc_id) >= 5),
marked as (
  select doc_id, pos, line, hot.k is not null and doc_id <> keep as gone from keyed left join hot using (k))
select doc_id, count(*) as n_lines, cast(count(*) filter (where gone) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id"""
