"""Batches of equal weight."""

import random

import pytest
from pyspark.sql import functions as F

from varframe.operators import index as ix
from varframe.plans import jobs


@pytest.mark.parametrize("parts", [1, 7])
def test_batches_outweigh_the_mean_by_at_most_one_row(spark, parts):
    r = random.Random(3)
    rows = [(r.choice("abc"), i, r.choice([0, 1, 5, 5000, r.randrange(100)])) for i in range(800)] + [(None, i, 3) for i in range(5)] + [("z", 1, None), ("y", 1, 0)]
    df = spark.createDataFrame(rows, "g string, k long, w long").repartition(9)
    for group, target in ((None, 2000), (["g"], 2000), (["g"], 10**9), (None, 1)):
        out = ix.balanced_batches(df, ["g", "k"] if group is None else ["k"], F.col("w"), target, group=group, partitions=parts).collect()
        assert len(out) == len(rows)
        order = sorted(out, key=lambda x: (x.g is not None, x.g or "", x.k))
        ids = [x.batch_id for x in order]
        assert ids == sorted(ids) and ids[0] == 0
        by = {}
        for x in order:
            by.setdefault(x.batch_id, []).append(x)
        for found in by.values():
            assert [x.pos_in_batch for x in found] == sorted({x.pos_in_batch for x in found})
            if group:
                assert len({x.g for x in found}) == 1
        for g in {x.g for x in out} if group else [...]:
            own = [f for f in by.values() if g is ... or f[0].g == g]
            total = sum(x.weight for f in own for x in f)
            cuts = max(1, -(-total // target))
            assert all(sum(x.weight for x in f) <= total / cuts + max(x.weight for x in f) for f in own)


def test_equal_rows_and_no_rows(spark):
    df = spark.createDataFrame([("a", 1)] * 100, "g string, w long")
    sizes = ix.balanced_batches(df, ["g"], F.col("w"), 10).groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in sizes) == [10] * 10
    assert ix.balanced_batches(df.limit(0), ["g"], F.col("w"), 10).count() == 0
    with pytest.raises(ValueError):
        ix.balanced_batches(df, ["g"], F.col("w"), 0)


def test_interval_job_by_bases(spark):
    rows = [("c1", 1, 1000), ("c1", 1001, 1010), ("c1", 1020, 1030), ("c2", 5, 5), ("c2", None, None), ("c1", 2000, 2989)]
    df = spark.createDataFrame([(i, c, s, e, f"{c}:{s}-{e}") for i, (c, s, e) in enumerate(rows)], "k long, chrom string, start long, end long, value string")
    out = jobs.interval_batches(df, ["k"], ["cat"], bases=1005, partitions=2).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.batch_id, r.line_no)):
        got.setdefault(r.batch_id, []).append(r.value)
    assert list(got.values()) == [["c1:1-1000"], ["c1:1001-1010", "c1:1020-1030", "c1:2000-2989"], ["c2:5-5", "c2:None-None"]]
