"""Sharding by a hierarchical weighted hash tree: regions hold racks, racks hold shards.

A row descends the tree by its key. At each level every child draws a number, the exponential
-ln(u) / weight with u from the md5 of child and key, and the smallest draw wins, so a child
is chosen with its share of the weight. A child's draw depends on the child, its weight and the
key alone: when weights change, rows move only into subtrees that gained weight or out of those
that lost it, at every level. A shard that comes as a region of its own (``grown``) therefore
takes rows only into itself; one added to an old rack moves rows within, and into, that
rack's region only. A node's weight is the sum of its shards' weights.

The law is ``key``: the id and the shards decide, nothing else. Equal texts share a shard only if
they are given as the key (``key`` may be any column). Slots number the rows of a shard
without gaps in the order of (id, crc, size): the rows without their texts are range-partitioned by
shard and that order, written to the shared folder, and each run of a shard in a partition
starts at the rows counted before it, one small table of runs. A shard with a third of all
rows is dealt over many partitions, as are repeated rows.

Only DataFrame functions run here; the tree itself is a literal in the plan, as long as the
list of shards. Defined results: a null key draws as an empty one; a null text has no bytes
(size 1, crc 0); repeated rows share a shard and get slots of their own; weights must be
positive; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ready, staged, table

SHARDS = 8
SHARDS_A_RACK = 2
RACKS_A_REGION = 2
DIGITS = 13  # hex digits of the md5 that make up a draw: 52 bits

Leaf = tuple[str, str, int, float]  # region, rack, shard, weight


def even_tree(shards: int = SHARDS, shards_a_rack: int = SHARDS_A_RACK, racks_a_region: int = RACKS_A_REGION) -> list[Leaf]:
    """A tree of shards 0, 1, ... of weight 1, racks and regions filled one after the other."""
    rack = lambda s: s // shards_a_rack
    return [(f"g{rack(s) // racks_a_region}", f"k{rack(s)}", s, 1.0) for s in range(shards)]


def grown(tree: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, in a rack and region of its own."""
    new = max(s for _, _, s, _ in tree) + 1
    return [*tree, (f"+g{new}", f"+k{new}", new, weight)]


def _levels(tree: Sequence[Leaf]) -> list[dict[str, dict[str, float]]]:
    """Per level: parent path to the weights of its children's paths."""
    levels: list[dict[str, dict[str, float]]] = [{}, {}, {}]
    for region, rack, shard, weight in tree:
        if not weight > 0:
            raise ValueError(f"the weight of shard {shard} is not positive")
        paths = ["", region, f"{region}/{rack}", f"{region}/{rack}/{shard}"]
        for level, (parent, child) in enumerate(zip(paths, paths[1:])):
            children = levels[level].setdefault(parent, {})
            children[child] = children.get(child, 0.0) + weight
    return levels


def draw(path: Column, weight: Column, key: Column) -> Column:
    """The draw of a child for a key; the smallest wins."""
    digits = F.conv(F.substring(F.md5(F.concat(path, F.lit(":"), key)), 1, DIGITS), 16, 10).cast("double")
    return -F.log((digits + 0.5) / float(16 ** DIGITS)) / weight


def descend(tree: Sequence[Leaf], key: Column) -> Column:
    """The shard of a key: an array of the nodes on the way and the shard's number."""
    at = F.lit("")
    for level in _levels(tree):
        children = F.create_map(*[x for parent, kids in level.items() for x in (F.lit(parent), F.array(*[
            F.struct(F.lit(path).alias("path"), F.lit(weight).alias("weight")) for path, weight in kids.items()]))])
        drawn = F.transform(F.element_at(children, at), lambda c: F.struct(
            draw(c["path"], c["weight"], key).alias("draw"), c["path"].alias("path")))
        at = F.array_min(drawn)["path"]
    return F.element_at(F.split(at, "/"), -1).cast("int")


def place(docs: DataFrame, tree: Sequence[Leaf] | None = None, id_col: str = "doc_id", text_col: str = "text",
          key: Column | None = None, next_tree: Sequence[Leaf] | None = None) -> DataFrame:
    """(id, size, text_crc32, shard, grown_shard) of every row; ``next_tree`` is ``grown(tree)`` unless given."""
    tree = even_tree() if tree is None else tree
    id_ = docs[f"`{id_col}`"]
    text = F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit(""))
    key = F.coalesce((id_ if key is None else key).cast("string"), F.lit(""))
    return docs.select(
        id_.alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        descend(tree, key).alias("shard"), descend(grown(tree) if next_tree is None else next_tree, key).alias("grown_shard"))


def with_slots(placed: DataFrame) -> DataFrame:
    """Adds ``slot``, the gapless number of a row within its shard from 0, in the order of id, crc and size."""
    spark = ready(placed.sparkSession)
    rows = staged(spark, placed, "shard-rows").withColumn("row", F.monotonically_increasing_id())  # tells equal rows apart
    order = ["shard", "id", "text_crc32", "size", "row"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    runs = staged(spark, ranged.withColumn("at", F.monotonically_increasing_id()).withColumn("run", F.spark_partition_id()),
                  "shard-runs")
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.groupBy("shard", "run").agg(F.count("*").alias("n"), F.min("at").alias("first")).select(
        "shard", "run", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("start"))
    # a run is a partition's share of a shard: at most the partitions and the shards together
    return runs.join(F.broadcast(starts), ["shard", "run"]).withColumn("slot", F.col("start") + F.col("at")).drop(
        "start", "at", "run")


def op12_sharding(spark, sf_dir):
    """Shard, slot and next shard of every document by the law ``key``."""
    ready(spark)
    return with_slots(place(table(spark, sf_dir, "documents"))).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _sql() -> str:
    """The same descents as one join per level against the list of children."""
    def children(tree):
        return ", ".join(f"({level}, '{parent}', '{path}', {weight!r})" for level, kids in enumerate(_levels(tree))
                         for parent, under in kids.items() for path, weight in under.items())

    drawn = f"-ln((cast('0x' || substr(md5(concat(c.path, ':', d.key)), 1, {DIGITS}) as bigint) + 0.5) / {16 ** DIGITS}) / c.weight"
    steps = []
    for name, tree in (("now", even_tree()), ("next", grown(even_tree()))):
        steps.append(f"{name}(level, parent, path, weight) as (values {children(tree)})")
        for level in range(3):
            source = "(select key, '' as path from keys)" if level == 0 else f"{name}{level - 1}"
            steps.append(f"""{name}{level} as (
  select d.key, arg_min(c.path, {{'draw': {drawn}, 'path': c.path}}) as path
  from {source} d join {name} c on c.level = {level} and c.parent = d.path group by d.key)""")
    return f"""
with docs as (select doc_id, coalesce(cast(doc_id as varchar), '') as key, coalesce(text, '') as text from documents),
keys as (select distinct key from docs),
{", ".join(steps)},
step as (select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) as step),
bytes as (select *, list_transform(regexp_extract_all(hex(text), '..'), lambda h: cast('0x' || h as bigint)) as bytes from docs),
placed as (
  select doc_id, len(bytes) + 1 as size,
         xor(list_reduce(list_prepend(cast(4294967295 as bigint), bytes), lambda x, y: xor(x >> 8, step[xor(x & 255, y) + 1])),
             4294967295) as text_crc32,
         cast(split_part(now2.path, '/', 3) as int) as shard, cast(split_part(next2.path, '/', 3) as int) as grown_shard
  from bytes, step, now2, next2 where now2.key = bytes.key and next2.key = bytes.key)
select doc_id, size, text_crc32, 'key' as law, shard, grown_shard,
       row_number() over (partition by shard order by doc_id nulls first, text_crc32, size) - 1 as slot
from placed"""


OP12_SQL = _sql()
