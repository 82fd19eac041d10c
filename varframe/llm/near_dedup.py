"""Near-duplicate classes: banded join of DartMinHash signatures, exact check, components.

Two documents are linked if the weighted Jaccard similarity of their multisets of five-word
shingles is ``SIMILARITY`` or more; a class is a connected component of links. Candidates
share at least one of ``BANDS`` bands of ``ROWS`` signature values: a pair at 0.8 is missed
with probability (1 - 0.8**5)**24 = 7e-5, a closer one less often.

No task sees all pairs of a bucket, and no link between candidates is lost:

1. Documents with one multiset (a 128-bit fingerprint) are one node.
2. In each bucket every node is compared with one pivot, the node that shares the most
   buckets with others (the centre of its family). Links found so far give components.
3. Nodes that were compared with one pivot and are in its component are settled among
   themselves. The others are compared with all nodes of that pivot but those of their own
   component, without making rows of these pairs: step 2 left for each node a bitmap of the
   pivot's elements it has, so two nodes share at most the bits they have in common and the
   fewer of their elements that aren't the pivot's. Elements that no other node has are left
   out first, and a node with too few left can have no partner at all. Blocks of
   at most ``BLOCK`` by ``BLOCK`` nodes, of ``BLOCK_BYTES`` a side, are compared in a task each; only pairs that may be similar
   enough become rows.

Every link is confirmed exactly (on 64-bit hashes of the shingles). Step 3 emits little, but
its comparisons grow with the product of a pivot's unsettled and possible nodes.

Defined results: documents without words (null, empty, only signs) are alone; a text of
fewer than five words is one shingle; rows that repeat an (id, text) are one document and
give one row, or with ``every_row``, as in the query, a row each, counted in ``class_size``
if the text has words; the class id is the largest id of the class (null ids are smallest); an empty
table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import dartminhash as dart
from .common import every_copy, map_docs, ready, staged, table, text_or_empty, text_slices

BANDS, ROWS = 24, 5
BLOCK = 1024
BLOCK_BYTES = 64 << 20
SIMILARITY = 0.8
BUCKET = ["band", "key"]


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tkey"), text.alias("text"))


def _sketcher(bands: int, rows: int):
    def make():
        def run(texts: list):
            doc, element, count = dart.shingles(texts)
            keys = dart.band_keys(dart.signatures(doc, element, count, len(texts), bands * rows), bands)
            n = np.bincount(doc, weights=count, minlength=len(texts)).astype(np.int64)
            sums = [np.zeros(len(texts), dtype=np.uint64) for _ in (0, 1)]
            with np.errstate(over="ignore"):
                for s, salt in zip(sums, (1, 2), strict=True):  # order-free sums over the multiset
                    np.add.at(s, doc, dart.mix(dart.mix(element + np.uint64(salt)) + count.astype(np.uint64)))
            node = [a.tobytes() + b.tobytes() for a, b in zip(*sums, strict=True)]
            return [n, node, list(keys.view(np.int64))]

        return run

    return make


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, tkey, n, node, keys): size and fingerprint of the shingle multiset, and band keys, of every row."""
    return map_docs(_identified(docs, id_col, text_col), "text", "n long, node binary, keys array<long>",
                    _sketcher(bands, rows)).select("doc.id", "doc.tkey", "n", "node", "keys")


MEASURED = "a binary, b binary, both long, n_a long, n_b long, bits binary"


def measured(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sizes of their overlap and multisets, and b's elements that a has, as bits."""
    ta = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    tb = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def compare(batches):
        import pyarrow as pa

        held: dict[str, np.ndarray] = {}

        def elements(text):
            if text not in held:
                if len(held) >= 8:
                    held.clear()
                held[text] = dart.elements(text)
            return held[text]

        for batch in batches:
            rows = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = elements(x), elements(y)
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                found = x[at] == y
                rows.append((int(found.sum()), len(x), len(y), np.packbits(found).tobytes()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array([r[i] for r in rows], type=k) for i, k in enumerate(kinds)]],
                ["a", "b", "both", "n_a", "n_b", "bits"])

    return pairs.join(tb, "b").join(ta, "a").select("a", "b", "text_a", "text_b").mapInArrow(compare, MEASURED)


def similar(similarity: float):
    """Overlap and sizes as a condition: both / (n + n' - both) >= similarity."""
    return F.col("both") * (1 + similarity) >= similarity * (F.col("n_a") + F.col("n_b")) - 1e-9


def components(spark, edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of ``edges`` (a, b): the largest node it is connected to.

    Alternating stars: each node points its smaller neighbours, then its larger ones, to the
    largest node it knows of, until nothing changes.
    """
    now = staged(spark, edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
                 "near-edges")
    while True:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        top = staged(spark, both.groupBy("u").agg(F.max("v").alias("m")).select("u", F.greatest("u", "m").alias("m")), "near-tops")
        wide = staged(spark, both.filter("v < u").join(top, "u").select(F.col("m").alias("hi"), F.col("v").alias("lo"))
                      .filter("hi <> lo").distinct(), "near-wide")
        top = staged(spark, wide.groupBy("lo").agg(F.max("hi").alias("m")), "near-tops")
        step = wide.join(top, "lo")
        after = staged(spark, step.select(F.col("m").alias("hi"), F.col("hi").alias("lo")).unionByName(
            step.select(F.col("m").alias("hi"), "lo")).filter("hi <> lo").distinct(), "near-edges")
        # settled when every node has one larger neighbour only, which has none itself
        ups = after.groupBy("lo").agg(F.count("*").alias("n"))
        open_ = ups.filter("n > 1").limit(1).count() or after.join(ups.select(F.col("lo").alias("hi")), "hi", "left_semi").limit(1).count()
        now = after
        if not open_:
            break
    tops = now.select(F.col("hi").alias("node"), F.col("hi").alias("comp")).distinct()
    return staged(spark, now.select(F.col("lo").alias("node"), F.col("hi").alias("comp")).unionByName(tops), "near-components")


def _unique_weights(texts: DataFrame) -> DataFrame:
    """(node, unique): the weight of a node's shingles that no other node of ``texts`` has."""
    def explode(batches):
        import pyarrow as pa

        for batch in batches:
            for lo, hi in text_slices(batch.column(1)):
                doc, element, count = dart.shingles(batch.column(1).slice(lo, hi - lo).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(element.view(np.int64)), batch.column(0).slice(lo, hi - lo).take(pa.array(doc)), pa.array(count)],
                    ["shingle", "node", "weight"])

    each = texts.select("node", "text").mapInArrow(explode, "shingle long, node binary, weight long")
    return each.groupBy("shingle").agg(F.count("*").alias("n"), F.max("node").alias("node"), F.max("weight").alias("weight")).filter(
        "n = 1").groupBy("node").agg(F.sum("weight").alias("unique"))


def links(docs: DataFrame, nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): links between nodes that connect all nodes of a class (``nodes``: node, n, rep, keys)."""
    spark = docs.sparkSession
    buckets = nodes.select("node", F.posexplode("keys").alias("band", "key"))
    shared = buckets.groupBy(*BUCKET).agg(F.count("*").alias("m")).filter("m > 1")
    members = staged(spark, buckets.join(shared, BUCKET), "near-members")

    reach = members.groupBy("node").agg(F.sum("m").alias("reach"))
    pivots = staged(spark, members.join(reach, "node").groupBy(*BUCKET).agg(F.max(F.struct("reach", "node")).alias("p"))
                    .select(*BUCKET, F.col("p.node").alias("pivot")), "near-pivots")
    pairs = members.join(pivots, BUCKET).filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    involved = nodes.join(members.select("node").distinct(), "node", "left_semi").select(
        "node", F.col("rep.id").alias("r_id"), F.col("rep.tkey").alias("r_tkey"))
    texts = staged(spark, docs.join(involved, docs["id"].eqNullSafe(involved["r_id"]) & (docs["tkey"] == involved["r_tkey"]))
                   .select("node", "text"), "near-texts")
    tried = staged(spark, measured(staged(spark, pairs, "near-pairs"), texts), "near-tried")
    found = tried.filter(similar(similarity)).select("a", "b")

    comp = components(spark, found)
    more = unsettled_pairs(spark, tried, comp, texts, similarity)
    rest = measured(staged(spark, more, "near-more"), texts).filter(similar(similarity)).select("a", "b")
    return found.unionByName(staged(spark, rest, "near-rest"))


def unsettled_pairs(spark, tried: DataFrame, comp: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs of nodes tried with one pivot that may be similar and are not connected yet (step 3)."""
    of = lambda col, name: comp.select(F.col("node").alias(col), F.col("comp").alias(name))
    placed = staged(spark, tried.join(of("a", "comp_a"), "a", "left").join(of("b", "comp_b"), "b", "left").select(
        F.col("b").alias("pivot"), F.col("a").alias("node"), "n_a", "both", "bits", F.coalesce("comp_a", "a").alias("comp"),
        (F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")).alias("open")), "near-placed")
    # written first: beside an aggregate a hot pivot's rows couldn't be split
    groups = staged(spark, placed.groupBy("pivot").agg(F.count("*").alias("members"), F.count_if("open").alias("open_members"))
                    .filter("members > 1 and open_members > 0").select("pivot"), "near-groups")
    group = staged(spark, placed.join(groups, "pivot"), "near-unsettled")
    own = texts.join(group.select("node").union(group.select("pivot")).distinct(), "node", "left_semi")
    # s: elements that some other node has; a node needs a share of ``similarity`` of them to have a partner
    possible = staged(spark, group.join(_unique_weights(own), "node", "left").withColumn(
        "s", F.col("n_a") - F.coalesce("unique", F.lit(0))).filter(F.col("s") >= similarity * F.col("n_a")).select(
        "pivot", "node", F.col("n_a").alias("n"), (F.col("s") - F.col("both")).alias("extra"), "bits", "comp", "open"), "near-possible")
    # a block's bitmaps are as wide as the pivot: fewer rows of a wide one make a block
    rows = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_BYTES) / F.greatest(F.max(F.octet_length("bits")), F.lit(1)))))
    blocks = staged(spark, possible.groupBy("pivot").agg(
        F.ceil(F.count_if("open") / rows).cast("int").alias("n_left"), F.ceil(F.count("*") / rows).cast("int").alias("n_right"))
        .filter("n_left > 0"), "near-blocks")
    dealt = possible.join(blocks, "pivot")
    span = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    cols = ["node", "n", "extra", "bits", "comp"]
    left = dealt.filter("open").withColumn("i", mine("n_left")).withColumn("j", span("n_right"))
    right = dealt.withColumn("j", mine("n_right")).withColumn("i", span("n_left"))
    both = left.select("pivot", "i", "j", F.lit(True).alias("left"), *cols).unionByName(
        right.select("pivot", "i", "j", F.lit(False).alias("left"), *cols))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        one, two = rows[rows["left"]], rows[~rows["left"]]
        out = []
        if len(one) and len(two):
            bits = lambda x: np.frombuffer(b"".join(x["bits"]), dtype=np.uint8).reshape(len(x), -1)
            mine, theirs = bits(one), bits(two)
            n, extra, comp, node = (two[c].to_numpy() for c in ("n", "extra", "comp", "node"))
            for k, (own, size, more, part) in enumerate(zip(one["node"], one["n"], one["extra"], one["comp"], strict=True)):
                most = np.bitwise_count(theirs & mine[k]).sum(axis=1, dtype=np.int64) + np.minimum(extra, more)
                fits = np.flatnonzero(most * (1 + similarity) >= similarity * (n + size) - 1e-9)
                out += [(max(own, node[m]), min(own, node[m])) for m in fits if comp[m] != part]
        return pd.DataFrame(out, columns=["a", "b"])

    return both.groupBy("pivot", "i", "j").applyInPandas(compare, "a binary, b binary").distinct()


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                 bands: int = BANDS, rows: int = ROWS, every_row: bool = False) -> DataFrame:
    """One row per document, or per row: id, tkey, class_id, class_size, kept (the row that stays of its class)."""
    spark = ready(docs.sparkSession)
    made = staged(spark, sketches(docs, id_col, text_col, bands, rows), "near-sketches")
    nodes = staged(spark, made.filter("n > 0").groupBy("node").agg(F.max(F.struct("id", "tkey", "n", "keys")).alias("r")).select(
        "node", F.struct("r.id", "r.tkey").alias("rep"), "r.n", "r.keys"), "near-nodes")
    edges = links(_identified(docs, id_col, text_col), nodes, similarity)
    comp = components(spark, edges)
    rows_ = made.groupBy("id", "tkey", "n", "node").agg((F.count("*") if every_row else F.lit(1).cast("long")).alias("copies"))
    placed = staged(spark, rows_.join(comp, "node", "left").select(
        "id", "tkey", "n", "copies", F.when(F.col("n") > 0, F.coalesce("comp", "node")).alias("comp")), "near-placed")
    classes = staged(spark, placed.filter("n > 0").groupBy("comp").agg(F.max(F.struct("id", "tkey")).alias("top"), F.sum("copies").alias("class_size"))
                     .filter("class_size > 1"), "near-classes")
    out = placed.join(classes, "comp", "left").select(
        "id", "tkey", "copies", F.when(F.col("top").isNull(), F.col("id")).otherwise(F.col("top.id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
        F.coalesce(F.struct("id", "tkey") == F.col("top"), F.col("top").isNull()).alias("kept"))
    if placed.filter("copies > 1").limit(1).count():
        return every_copy(staged(spark, out, "near-rows"))
    return out.drop("copies")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay: one row of every class, all columns kept; of a document's repeated rows one."""
    spark = ready(docs.sparkSession)
    gone = near_classes(docs, id_col, text_col, similarity).filter("not kept").select(
        F.col("id").alias("_gone_id"), F.col("tkey").alias("_gone_tkey"))
    rows = docs.withColumn("_tkey", F.xxhash64(text_or_empty(text_col)))
    of = lambda found: rows[id_col].eqNullSafe(found["_gone_id"]) & (rows["_tkey"] == found["_gone_tkey"])
    rows = rows.join(gone, of(gone), "left_anti")
    twice = staged(spark, rows.groupBy(F.col(id_col).alias("_gone_id"), F.col("_tkey").alias("_gone_tkey")).agg(
        F.count("*").alias("n")).filter("n > 1").drop("n"), "near-repeated")
    # only repeated documents are brought together, the others' texts stay where they are
    once = rows.join(twice, of(twice), "left_semi").dropDuplicates([id_col, "_tkey"])
    return rows.join(twice, of(twice), "left_anti").unionByName(once).drop("_tkey")


def op2_near_dedup(spark, sf_dir):
    """Every document with its class of near-duplicates."""
    ready(spark)
    return near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"), every_row=True).select(
        F.col("id").alias("doc_id"), "class_id", "class_size", "kept")
