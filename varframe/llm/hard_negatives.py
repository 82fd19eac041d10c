"""Hard-negative mining over Hilbert-ordered Parquet blocks with zone maps.

Components are scaled and floored to whole numbers. Candidates are sorted by label and by their
place on a Hilbert curve through the ``CURVE_DIMS`` components that vary most, then cut into
blocks of at most ``BLOCK_ROWS`` rows of one label; a block is one row of a Parquet table with
its packed ids and vectors and, as zone map, the least and largest value of every component.

A search asks, for every anchor, for the best ``k`` candidates of its own label (or of other
labels) in windows [lo, hi] of scores. Interval arithmetic over a zone map bounds the
scores that a block can hold for an anchor. Each window first reads its most promising block, which
gives a floor for its k-th score; then it reads every block whose bounds meet the window above that
floor. So positives are one window without limits, and each positive's negatives are one more
window, [low% of its score, high% of it]. Results are exact; bounds only save reading.

Bounds and blocks are computed in cells of a grid: about ``GROUP_ROWS`` candidates (a group of
blocks) by about ``CHUNK_ROWS`` anchors, both dealt by hashes of row numbers, so every cell is
bounded whatever the labels, ties or copies. Blocks that no anchor of a chunk must read aren't
sent there. Only counts and one row per component go to the driver.

Defined results: rows with a null id or label, a null vector, or a null or non-finite component
take no part; a component that leaves 32 bits when scaled, or a score that leaves 64, fails the
query; a shorter vector counts as filled up with zeros; rows with the anchor's id are never its
partners; repeated rows are partners, and anchors, of their own; ties go to the smaller id; an
anchor without positives, or with negative scores only, has no rows; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ready, staged, table

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW_PERCENT = 80
HIGH_PERCENT = 100
BLOCK_ROWS = 512
GROUP_ROWS = 8192
CHUNK_ROWS = 8192
CURVE_DIMS = 15
CURVE_BITS = 4
LEAST, LARGEST = -(1 << 63), (1 << 63) - 1


def scaled_vectors(rows: DataFrame, id_col: str, label_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(id, label, q) of the rows that take part; q holds floor(scale * x) of every component."""
    src = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                      F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    wide = F.raise_error(F.lit("a scaled component leaves 32 bits")).cast("int")
    whole = lambda x: F.when(F.abs(x * scale) >= float(1 << 31), wide).otherwise(F.floor(x * scale).cast("int"))
    kept = src.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.col("v").isNotNull() & finite, F.lit(False)))
    return kept.select("id", "label", F.transform("v", whole).alias("q"))


def matrix(lists, dim: int) -> np.ndarray:
    """The rows of an Arrow list array as an integer matrix; shorter rows are filled up with zeros."""
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(lists.offsets.to_numpy())
    if (sizes == dim).all():
        return values.reshape(len(lists), dim)
    out = np.zeros((len(lists), dim), dtype=np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def component_stats(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of every component; tasks send one row per component."""
    def moments(batches):
        import pyarrow as pa

        total = np.zeros((3, 0))
        for batch in batches:
            q = batch.column(0)
            dim = int(np.diff(q.offsets.to_numpy()).max(initial=0))
            x = matrix(q, dim).astype(float)
            part = np.stack([np.full(dim, len(x)), x.sum(0), (x * x).sum(0)])
            wide = max(dim, total.shape[1])
            total = sum(np.pad(p, ((0, 0), (0, wide - p.shape[1]))) for p in (total, part))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.shape[1])), *map(pa.array, total)], ["c", "n", "s", "ss"])

    found = vectors.select("q").mapInArrow(moments, "c long, n double, s double, ss double").groupBy("c").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).orderBy("c").collect()
    n, s, ss = (np.array([r[x] for r in found], dtype=float) for x in ("n", "s", "ss"))
    mean = s / np.maximum(n, 1)
    return mean, np.sqrt(np.maximum(ss / np.maximum(n, 1) - mean * mean, 0))


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with ``bits`` bits a coordinate (at most 63 bits in all)."""
    x = [c.copy() for c in cells.astype(np.int64).T]
    if not x:
        return np.zeros(len(cells), dtype=np.int64)
    for b in range(bits - 1, 0, -1):
        high, low = 1 << b, (1 << b) - 1
        for i in range(len(x)):
            turned = (x[i] & high) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0]) ^ swap
            if i:
                x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & (1 << b), (1 << b) - 1, 0)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = (key << 1) | (((c ^ flip) >> b) & 1)
    return key


def with_curve(vectors: DataFrame, mean: np.ndarray, spread: np.ndarray, dims: int = CURVE_DIMS, bits: int = CURVE_BITS) -> DataFrame:
    """Adds ``place`` on the curve through the components that vary most, and fills vectors up to the common length."""
    dim = len(mean)
    chosen = np.sort(np.argsort(-spread, kind="stable")[:dims])
    at, width = mean[chosen] - 2 * spread[chosen], np.maximum(4 * spread[chosen], 1e-9) / (1 << bits)

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            q = matrix(batch.column(2), dim)
            cells = np.clip((q[:, chosen] - at) / width, 0, (1 << bits) - 1).astype(np.int64)
            full = pa.FixedSizeListArray.from_arrays(pa.array(q.reshape(-1).astype(np.int32)), dim) if dim else batch.column(2)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), full.cast(pa.list_(pa.int32())),
                                              pa.array(hilbert_keys(cells, bits))], ["id", "label", "q", "place"])

    return vectors.select("id", "label", "q").mapInArrow(place, "id long, label long, q array<int>, place long")


BLOCK = "label long, n int, least array<int>, largest array<int>, ids binary, vectors binary"


def candidate_blocks(placed: DataFrame, dim: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The Parquet table of blocks: BLOCK's columns and a block number."""
    order = ["label", "place", "id", "row"]
    rows = placed.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)

    def pack(batches):
        import pyarrow as pa

        def block(label, ids, q):
            by_id = np.argsort(ids, kind="stable")
            ids, q = ids[by_id], q[by_id]
            return pa.RecordBatch.from_pylist([{
                "label": int(label), "n": len(ids), "least": q.min(0), "largest": q.max(0),
                "ids": ids.astype(np.int64).tobytes(), "vectors": q.astype(np.int32).tobytes()}],
                schema=pa.schema([("label", pa.int64()), ("n", pa.int32()), ("least", pa.list_(pa.int32())),
                                  ("largest", pa.list_(pa.int32())), ("ids", pa.binary()), ("vectors", pa.binary())]))

        held: list = []  # (ids, q) of one label, fewer rows than a block
        label, size = None, 0
        for batch in batches:
            labels, ids = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            q = matrix(batch.column(2), dim)
            cuts = [0, *(np.nonzero(np.diff(labels))[0] + 1), len(labels)]
            for lo, hi in zip(cuts, cuts[1:]):
                if held and labels[lo] != label:
                    yield block(label, *map(np.concatenate, zip(*held)))
                    held, size = [], 0
                label = labels[lo]
                while lo < hi:
                    take = min(hi - lo, block_rows - size)
                    held.append((ids[lo:lo + take], q[lo:lo + take]))
                    lo, size = lo + take, size + take
                    if size == block_rows:
                        yield block(label, *map(np.concatenate, zip(*held)))
                        held, size = [], 0
        if held:
            yield block(label, *map(np.concatenate, zip(*held)))

    packed = rows.select("id", "label", "q").mapInArrow(pack, BLOCK)
    return staged(placed.sparkSession, packed.withColumn("block", F.monotonically_increasing_id()), "negatives-blocks")


def exact_products(a: np.ndarray, b: np.ndarray, clip: bool = False) -> np.ndarray:
    """a @ b.T of integer matrices, exactly; what leaves 64 bits is an error, or cut to them (``clip``)."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 1 << 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    if most <= LARGEST:
        return a @ b.T
    wide = a.astype(object) @ b.T.astype(object)
    if clip:
        wide = np.clip(wide, LEAST, LARGEST)
    if wide.size and (wide.max() > LARGEST or wide.min() < LEAST):
        raise OverflowError("a score leaves 64 bits")
    return wide.astype(np.int64)


def score_bounds(anchors: np.ndarray, least: np.ndarray, largest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that any vector within the zone maps can have, per anchor and block."""
    signed = np.hstack([np.maximum(anchors, 0), np.minimum(anchors, 0)])
    return (exact_products(signed, np.hstack([least, largest]), clip=True),
            exact_products(signed, np.hstack([largest, least]), clip=True))


def _anchor_side(anchors, dim: int):
    """Anchors of a cell in the order of their numbers: number, id, label, matrix, windows."""
    anchors = anchors.combine_chunks().sort_by("aid")
    chunk = lambda c: anchors.column(c).combine_chunks()
    windows = int(anchors.column("los").combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max(initial=0))

    def window_matrix(c, missing):
        lists = chunk(c)
        out = np.full((len(lists), windows), missing, dtype=np.int64)
        sizes = np.diff(lists.offsets.to_numpy())
        values = lists.flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(lists)), sizes)
        out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
        return out

    # a window that an anchor doesn't have is empty
    return (chunk("aid").to_numpy(), chunk("id").to_numpy(), chunk("label").to_numpy(), matrix(chunk("q"), dim),
            window_matrix("los", LARGEST), window_matrix("his", LEAST))


class Grid:
    """Cells of block groups and anchor chunks for one search."""

    def __init__(self, blocks: DataFrame, dim: int, k: int, same_label: bool, group_rows: int, chunk_rows: int):
        self.spark, self.blocks, self.dim, self.k, self.same = blocks.sparkSession, blocks, dim, k, same_label
        self.chunk_rows = chunk_rows
        rows = blocks.agg(F.sum("n")).first()[0] or 0
        self.groups = max(1, -(-rows // group_rows))
        self.grouped = blocks.withColumn("grp", F.pmod(F.xxhash64("block"), F.lit(self.groups)).cast("int"))

    def search(self, anchors: DataFrame) -> DataFrame:
        """(aid, win, rank, id, score) of the best k of each window; ``anchors``: aid, id, label, q, los, his."""
        chunks = max(1, -(-anchors.count() // self.chunk_rows))
        anchors = staged(self.spark, anchors.withColumn("chunk", F.pmod(F.xxhash64("aid"), F.lit(chunks)).cast("int")),
                         "negatives-anchors")
        best = Window.partitionBy("aid", "win").orderBy(F.desc("bound"), "block")
        first = self.bounded(anchors, chunks, seed=True).withColumn("rn", F.row_number().over(best)).filter("rn = 1")
        seeds = self.read(anchors, staged(self.spark, first.groupBy("grp", "chunk", "block").agg(F.collect_set("aid").alias("aids")),
                                          "negatives-seeds"))
        floors = self.top(seeds).groupBy("aid").agg(F.collect_list(F.when(
            F.col("rank") == self.k, F.struct("win", "score"))).alias("floors"))
        # the k-th score of a window's first block is the least that its results can have
        raised = anchors.join(floors, "aid", "left").withColumn("los", F.when(F.col("floors").isNull(), F.col("los")).otherwise(
            F.transform("los", lambda lo, i: F.greatest(lo, F.array_max(F.transform(
                F.filter("floors", lambda f: f["win"] == i), lambda f: f["score"])))))).drop("floors")
        raised = staged(self.spark, raised, "negatives-raised")
        return self.top(self.read(raised, staged(self.spark, self.bounded(raised, chunks, seed=False), "negatives-wanted")))

    def top(self, found: DataFrame) -> DataFrame:
        order = Window.partitionBy("aid", "win").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= self.k)

    def bounded(self, anchors: DataFrame, chunks: int, seed: bool) -> DataFrame:
        """By zone maps alone: each window's most promising block (``seed``), or all blocks a chunk must read.

        ``aids`` lists the anchors that read the block; null means all of the chunk.
        """
        dim, same = self.dim, self.same
        zones = self.grouped.select("grp", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "block", "label",
                                    "least", "largest")
        sent = anchors.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(self.groups - 1))))

        def bound(zones, anchors):
            import pyarrow as pa

            out: dict = {}
            if zones.num_rows and anchors.num_rows:
                aid, _, label, q, lo, hi = _anchor_side(anchors, dim)
                zones = zones.combine_chunks().sort_by("block")
                column = lambda c: zones.column(c).combine_chunks()
                block = column("block").to_numpy()
                low, high = score_bounds(q, matrix(column("least"), dim), matrix(column("largest"), dim))
                fits = (label[:, None] == column("label").to_numpy()) == same
                grp, chunk = zones.column("grp")[0].as_py(), zones.column("chunk")[0].as_py()
                meets = lambda w: fits & (high >= lo[:, w, None]) & (low <= hi[:, w, None]) & (lo <= hi)[:, w, None]
                if seed:
                    for w in range(lo.shape[1]):
                        reach = np.where(meets(w), np.minimum(high, hi[:, w, None]), LEAST)
                        at = reach.argmax(1)
                        some = meets(w)[np.arange(len(aid)), at]
                        for c, v in (("aid", aid[some]), ("win", np.full(some.sum(), w)), ("bound", reach.max(1)[some]), ("block", block[at[some]])):
                            out.setdefault(c, []).append(v)
                    out = {c: np.concatenate(v) for c, v in out.items()}
                    out |= {"grp": np.full(len(out.get("aid", ())), grp), "chunk": np.full(len(out.get("aid", ())), chunk)}
                else:
                    want = np.zeros_like(fits)
                    for w in range(lo.shape[1]):
                        want |= meets(w)
                    wanted = np.nonzero(want.any(0))[0]
                    out = {"grp": np.full(len(wanted), grp), "chunk": np.full(len(wanted), chunk), "block": block[wanted],
                           "aids": [None if want[:, j].all() else aid[want[:, j]] for j in wanted]}
            return pa.table({c: pa.array(out.get(c, []), type=t) for c, t in types(pa).items()})

        def types(pa):
            if seed:
                return {"grp": pa.int32(), "chunk": pa.int32(), "block": pa.int64(), "aid": pa.int64(), "win": pa.int32(), "bound": pa.int64()}
            return {"grp": pa.int32(), "chunk": pa.int32(), "block": pa.int64(), "aids": pa.list_(pa.int64())}

        schema = "grp int, chunk int, block long, " + ("aid long, win int, bound long" if seed else "aids array<long>")
        return zones.groupBy("grp", "chunk").cogroup(sent.groupBy("grp", "chunk")).applyInArrow(bound, schema)

    def read(self, anchors: DataFrame, wanted: DataFrame) -> DataFrame:
        """(aid, win, id, score): each cell's best k of every window over the wanted blocks."""
        dim, k = self.dim, self.k
        blocks = self.blocks.select("block", "n", "ids", "vectors").join(wanted, "block")
        cells = wanted.select(F.col("grp").alias("to_grp"), F.col("chunk").alias("to_chunk")).distinct()
        sent = anchors.join(cells, F.col("chunk") == F.col("to_chunk"))

        def score(blocks, anchors):
            import pyarrow as pa

            best: list = [np.zeros(0, dtype=np.int64)] * 4  # anchor, window, score, candidate
            if blocks.num_rows and anchors.num_rows:
                aid, own, _, q, lo, hi = _anchor_side(anchors, dim)
                lo = lo.copy()
                for b in blocks.to_pylist():
                    who = np.arange(len(aid)) if b["aids"] is None else np.searchsorted(aid, np.sort(b["aids"]))
                    ids = np.frombuffer(b["ids"], dtype=np.int64)
                    vectors = np.frombuffer(b["vectors"], dtype=np.int32).reshape(b["n"], dim).astype(np.int64)
                    scores = exact_products(q[who], vectors)
                    partner = own[who][:, None] != ids
                    for w in range(lo.shape[1]):
                        ok = partner & (scores >= lo[who, w][:, None]) & (scores <= hi[who, w][:, None])
                        if b["n"] > k:
                            floor = np.partition(np.where(ok, scores, LEAST), b["n"] - k, axis=1)[:, b["n"] - k]
                            lo[who, w] = np.maximum(lo[who, w], floor)
                            ok &= scores >= lo[who, w][:, None]
                        row, col = np.nonzero(ok)
                        for i, v in enumerate((who[row], np.full(len(row), w), scores[row, col], ids[col])):
                            best[i] = np.concatenate([best[i], v])
                    best = _best(best, k)
                best[0] = aid[best[0]]
            return pa.table({"aid": pa.array(best[0], pa.int64()), "win": pa.array(best[1], pa.int32()),
                             "id": pa.array(best[3], pa.int64()), "score": pa.array(best[2], pa.int64())})

        return blocks.groupBy("grp", "chunk").cogroup(sent.groupBy("to_grp", "to_chunk")).applyInArrow(
            score, "aid long, win int, id long, score long")


def _best(found: list, k: int) -> list:
    """The best k of every (anchor, window): higher scores first, then smaller ids."""
    anchor, window, score, cand = found
    order = np.lexsort((cand, ~score, window, anchor))  # ~score falls as the score rises, without overflow
    anchor, window = anchor[order], window[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1])
    start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    kept = order[np.arange(len(order)) - start < k]
    return [x[kept] for x in found]


def hard_negatives(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
                   scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, low_percent: int = LOW_PERCENT,
                   high_percent: int = HIGH_PERCENT, block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS,
                   chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores; ``is_anchor`` tells anchors by their ``id``."""
    spark = ready(rows.sparkSession)
    vectors = staged(spark, scaled_vectors(rows, id_col, label_col, vec_col, scale), "negatives-vectors")
    mean, spread = component_stats(vectors)
    dim = len(mean)
    placed = staged(spark, with_curve(vectors, mean, spread), "negatives-placed")
    blocks = candidate_blocks(placed, dim, block_rows)
    anchors = staged(spark, placed.filter(is_anchor).select("id", "label", "q").withColumn("aid", F.monotonically_increasing_id()),
                     "negatives-anchors")
    everything = anchors.select("*", F.array(F.lit(LEAST)).alias("los"), F.array(F.lit(LARGEST)).alias("his"))
    found = staged(spark, Grid(blocks, dim, positives, True, group_rows, chunk_rows).search(everything), "negatives-positives")
    low, high = F.lit(low_percent), F.lit(high_percent)
    # the least and largest whole scores n with low * p <= 100 * n <= high * p
    windows = found.select("aid", "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
                           F.ceil(low * F.col("score").cast("decimal(38,0)") / 100).cast("long").alias("lo"),
                           F.floor(high * F.col("score").cast("decimal(38,0)") / 100).cast("long").alias("hi"))
    asked = windows.filter("lo <= hi").groupBy("aid").agg(F.sort_array(F.collect_list(F.struct("rank", "lo", "hi"))).alias("w")).select(
        "aid", F.col("w.rank").alias("ranks"), F.col("w.lo").alias("los"), F.col("w.hi").alias("his"))
    asked = staged(spark, anchors.join(asked, "aid"), "negatives-windows")
    mined = Grid(blocks, dim, negatives, False, group_rows, chunk_rows).search(asked.drop("ranks"))
    of = asked.select("aid", F.col("id").alias("anchor_id"), F.posexplode("ranks").alias("win", "p_rank"))
    return mined.withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score").join(of, ["aid", "win"]).join(
        windows.select("aid", F.col("rank").alias("p_rank"), "positive_id", "positive_score"), ["aid", "p_rank"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark, sf_dir):
    """Negatives near each anchor's positives, for anchors with an id divisible by 100."""
    ready(spark)
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long")))
    return hard_negatives(rows, F.col("id") % 100 == 0)


OP11_SQL = f"""
with vectors as (
  select row_number() over () as rid, vec_id, case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor({SCALE} * cast(x as double))) as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.rid, a.vec_id as anchor_id, v.vec_id, a.label = v.label as same, cast(list_dot_product(a.q, v.q) as bigint) as score
  from vectors a join vectors v on a.vec_id <> v.vec_id where a.vec_id % 100 = 0),
positive as (
  select rid, anchor_id, vec_id as positive_id, score as positive_score, row_number() over (
    partition by rid order by score desc, vec_id) as nth from pairs where same qualify nth <= {POSITIVES}),
mined as (
  select p.anchor_id, p.positive_id, row_number() over (partition by p.rid, p.nth order by n.score desc, n.vec_id) as rank,
         n.vec_id as negative_id, p.positive_score, n.score as negative_score
  from positive p join pairs n on n.rid = p.rid and not n.same
    and {LOW_PERCENT} * p.positive_score <= 100 * n.score and 100 * n.score <= {HIGH_PERCENT} * p.positive_score)
select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score
from mined where rank <= {NEGATIVES}"""
