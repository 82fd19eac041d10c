"""Hard negatives, sharding and fill-in-the-middle: edge cases, and results on small tables against SQL or by hand."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from varframe.llm import fim, hard_negatives, sharding
from varframe.llm.registry import QUERIES, SQL


def sql_on(name, folder, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    rel = con.sql(SQL[name])
    return [dict(zip(rel.columns, r)) for r in rel.fetchall()]


def same(df, want):
    key = lambda r: tuple(sorted((k, str(v)) for k, v in r.items()))
    return sorted(map(key, (r.asDict() for r in df.collect()))) == sorted(map(key, want))


# ---------------------------------------------------------------- hard negatives

@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (5, 2)])
def test_hilbert_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = hard_negatives.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_bounds_hold_and_products_are_exact():
    r = np.random.default_rng(3)
    block, a = r.integers(-300, 300, (40, 6)), r.integers(-300, 300, (9, 6))
    low, high = hard_negatives.score_bounds(a, block.min(0)[None], block.max(0)[None])
    scores = hard_negatives.exact_products(a, block)
    assert (scores == [[sum(map(int.__mul__, x, y)) for y in block.tolist()] for x in a.tolist()]).all()
    assert (low <= scores).all() and (scores <= high).all()
    big, signs = np.array([[(1 << 31) - 1] * 3]), np.array([1, 1, -1])
    assert hard_negatives.exact_products(big[:, :1], big[:, :1])[0, 0] == ((1 << 31) - 1) ** 2
    assert hard_negatives.exact_products(big, big * signs)[0, 0] == ((1 << 31) - 1) ** 2
    wide = np.array([[-(1 << 31)] * 3])
    assert hard_negatives.score_bounds(wide, wide, wide)[0][0, 0] == (1 << 63) - 1
    with pytest.raises(OverflowError):
        hard_negatives.exact_products(wide, wide)


def embeddings(spark, folder, rows):
    schema = "vec_id long, embedding array<float>, label int, place string, n string"
    spark.createDataFrame([(*r, "x", "y") for r in rows], schema).write.parquet(f"{folder}/embeddings.parquet")


def test_op11_on_odd_rows(spark, tmp_path):
    r = random.Random(5)
    vec = lambda d=4: [r.uniform(-1, 1) for _ in range(d)]
    hot = vec()
    rows = [(i, vec(), r.randrange(3)) for i in range(0, 900, 3)] + [(1000 + i, hot, r.randrange(3)) for i in range(150)]
    rows += [(100, vec(), 1), (1, None, 1), (2, vec(), None), (4, [1.0, None, 0.0, 0.0], 1), (5, [float("nan")] * 4, 1),
             (7, [float("inf")] * 4, 0), (None, None, None), (2000, [0.0] * 4, 9), (2100, vec(), 77)]
    rows += [(1001, hot, 0)] * 3
    embeddings(spark, tmp_path, rows)
    got = QUERIES["op11_hard_negatives"](spark, str(tmp_path))
    want = sql_on("op11_hard_negatives", tmp_path, ["embeddings"])
    assert want and same(got, want)


def test_op11_cells_blocks_and_lengths(spark, tmp_path):
    """Many small blocks, groups and chunks give what one of each gives; shorter vectors end in zeros."""
    r = random.Random(8)
    rows = [(i, [r.uniform(-1, 1) for _ in range(r.randrange(6))], r.randrange(4)) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    is_anchor = F.col("id") % 10 == 0
    one = hard_negatives.hard_negatives(df, is_anchor).collect()
    cut = hard_negatives.hard_negatives(df, is_anchor, block_rows=7, group_rows=60, chunk_rows=9).collect()
    assert one and sorted(one) == sorted(cut)
    q = {i: [int(np.floor(256 * x)) for x in v] + [0] * (6 - len(v)) for i, v, _ in rows}
    label = {i: y for i, _, y in rows}
    want = []
    for a in range(0, 400, 10):
        score = {i: sum(map(int.__mul__, q[a], q[i])) for i in q if i != a}
        best = sorted((i for i in score if label[i] == label[a]), key=lambda i: (-score[i], i))[:5]
        for p in best:
            fit = sorted((i for i in score if label[i] != label[a] and 80 * score[p] <= 100 * score[i] <= 100 * score[p]),
                         key=lambda i: (-score[i], i))[:5]
            want += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(fit)]
    assert sorted(map(tuple, one)) == sorted(want)


def test_op11_bounds_save_reading(spark):
    """On clustered vectors, the zone maps keep most blocks from being read."""
    r = np.random.default_rng(1)
    centers = r.normal(size=(8, 6)) * 2
    rows = [(i, (centers[i % 8] + r.normal(size=6) * 0.02).tolist(), int(i % 2)) for i in range(1600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    vectors = hard_negatives.scaled_vectors(df, "vec_id", "label", "embedding").cache()
    mean, spread = hard_negatives.component_stats(vectors)
    placed = hard_negatives.with_curve(vectors, mean, spread)
    blocks = hard_negatives.candidate_blocks(placed, len(mean), 20)
    grid = hard_negatives.Grid(blocks, len(mean), 5, True, 8192, 8192)
    sums = placed.filter("id % 100 = 0").select("id", "label", "q", F.monotonically_increasing_id().alias("aid"))
    norm = F.aggregate("q", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x)
    asked = sums.select("*", F.lit(0).alias("chunk"), F.array((norm * 0.9).cast("long")).alias("los"),
                        F.array(F.lit(hard_negatives.LARGEST)).alias("his"))
    wanted = grid.bounded(asked, 1, seed=False).collect()
    reads = sum(len(w.aids) if w.aids is not None else asked.count() for w in wanted)
    assert 0 < reads < 0.4 * asked.count() * blocks.count()


def test_op11_empty_and_refused(spark, tmp_path):
    embeddings(spark, tmp_path, [])
    assert QUERIES["op11_hard_negatives"](spark, str(tmp_path)).count() == 0
    far = spark.createDataFrame([(100, [1e30], 1)], "vec_id long, embedding array<double>, label long")
    with pytest.raises(Exception, match="32 bits"):
        hard_negatives.hard_negatives(far, F.col("id") % 100 == 0).collect()


# ---------------------------------------------------------------- sharding

def documents(spark, folder, rows):
    spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, shard string, slot int").write.parquet(
        f"{folder}/documents.parquet")


ODD = [(1, "a"), (2, None), (3, ""), (None, "no id"), (None, "no id"), (5, "é" * 70000), (6, "a\0b\n"), (7, "😀 x"), (7, "😀 x"),
       (8, "<P>"), (9, "x<M"), (10, ">y <S"), (-4, "minus")]


@pytest.mark.parametrize("name", ["op12_sharding", "op13_fill_in_middle"])
def test_odd_documents(spark, tmp_path, name):
    rows = ODD + [(11, "same row")] * 500 + [(i, f"text {i} " * (i % 9)) for i in range(100, 400)]
    documents(spark, tmp_path, rows)
    got = QUERIES[name](spark, str(tmp_path))
    want = sql_on(name, tmp_path, ["documents"])
    assert len(want) == len(rows) and same(got, want)
    documents(spark, tmp_path / "none", [])
    assert QUERIES[name](spark, str(tmp_path / "none")).count() == 0


def test_shards_by_weight_and_movement(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    tree = [("a", "r", 0, 1.0), ("a", "r", 1, 3.0), ("a", "s", 2, 2.0), ("b", "t", 3, 2.0)]
    heavier = [*tree[:2], ("a", "s", 2, 6.0), tree[3]]
    rows = sharding.place(docs, tree, next_tree=heavier).collect()
    counts = np.bincount([r.shard for r in rows])
    assert np.allclose(counts / len(rows), np.array([1, 3, 2, 2]) / 8, atol=0.01)
    moves = {(r.shard, r.grown_shard) for r in rows if r.shard != r.grown_shard}
    # region a gained weight by its rack s: rows come from b into a, and within a into s
    assert moves and all(new == 2 or old == 3 for old, new in moves) and not any(new == 3 for _, new in moves)
    more = sharding.place(docs, tree).collect()
    assert {r.grown_shard for r in more if r.shard != r.grown_shard} == {4}
    with pytest.raises(ValueError):
        sharding.place(docs, [("a", "r", 0, 0.0)])


def test_equal_texts_share_a_shard_if_they_are_the_key(spark):
    docs = spark.createDataFrame([(i, f"text {i % 7}") for i in range(200)], "doc_id long, text string")
    rows = sharding.place(docs, key=F.col("text")).groupBy("text_crc32").agg(F.countDistinct("shard").alias("n")).collect()
    assert len(rows) == 7 and {r.n for r in rows} == {1}


def test_slots_do_not_depend_on_partitions(spark):
    docs = spark.createDataFrame([(i % 300, f"t{i % 450}") for i in range(900)], "doc_id long, text string")
    one = sorted(map(tuple, sharding.with_slots(sharding.place(docs.coalesce(1))).collect()))
    many = sorted(map(tuple, sharding.with_slots(sharding.place(docs.repartition(13))).collect()))
    assert one == many


# ---------------------------------------------------------------- fill in the middle

def test_skip_list_finds_every_rank():
    r = np.random.default_rng(2)
    for n in (0, 1, 3, 4, 5, 16, 17, 63, 64, 65, 300):
        widths = r.integers(1, 5, n)
        at = np.concatenate([[0], np.cumsum(widths)])
        lanes = fim.SkipList(widths, 4)
        for a in range(n + 1):
            b = int(r.integers(a, n + 1))
            assert lanes.seek(a, b) == [at[a], at[b]]


def test_units_of_a_pattern(spark):
    assert fim.unit_widths("ab, c", re.compile(r"\w+")).tolist() == [2, 1, 1, 1]
    assert fim.unit_widths("ab", re.compile("x*")).tolist() == [1, 1]
    rows = [(i, "der Hund läuft 😀 weiter, " * (i % 5)) for i in range(60)]
    df = spark.createDataFrame([(*r, "o") for r in rows], "doc_id long, text string, output string")
    got = fim.fill_in_middle(df, unit=r"\S+\s*", fim_percent=100).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    for g in got:
        text = g.doc.text
        assert g.back == text and g.n == len(re.findall(r"\S+\s*", text))
        if g.form != "plain":
            ends = [0, *(m.end() for m in re.finditer(r"\S+\s*", text))]
            assert g.prefix_chars in ends and g.prefix_chars + g.middle_chars in ends
    assert {g.form for g in got} == {"plain", "psm", "spm"}


def test_marks_that_parts_could_form(spark):
    """Cuts beside pieces of marks are still undone exactly."""
    rows = [(i, "<<P<S<M>"[: i % 8].replace("<M>", "") + ">S>M>P>" * (i % 3) + "<S<M<P") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = fim.fill_in_middle(df, fim_percent=100).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert all(g.back == g.doc.text for g in got) and sum(g.form == "spm" for g in got) > 20
