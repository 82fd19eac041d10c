"""One long-lived process per task: starts, time limit, restarts, large batches."""

import os
import time

import pytest
from pyspark.sql import functions as F

from varframe.operators import external as ex

WAIT = "while IFS= read -r line; do printf '%s\\n' \"$line\"; done"


def batches(spark, n, size=2):
    return spark.range(n * size).select(F.expr(f"id div {size}").alias("batch_id"), F.expr(f"cast(id % {size} as int)").alias("pos_in_batch"),
                                        F.concat(F.lit("v"), F.col("id")).alias("value"))


def started(folder, then):
    return ["sh", "-c", f"mktemp {folder}/start-XXXXXXXX > /dev/null; {then}"]


def rows(out):
    return sorted((r.batch_id, r.line_no, r.value) for r in out.collect())


def test_one_start_per_task(spark, tmp_path):
    out = ex.pipe_batches_lived(batches(spark, 100), started(tmp_path, WAIT), partitions=4, prefix=["#h"])
    want = sorted([(b, 0, "#h") for b in range(100)] + [(i // 2, 1 + i % 2, f"v{i}") for i in range(200)])
    assert rows(out) == want and len(os.listdir(tmp_path)) == 4


def test_a_hung_tool_fails_in_time(spark, tmp_path):
    t = time.time()
    with pytest.raises(Exception, match="took more than 1.5 s"):
        ex.pipe_batches_lived(batches(spark, 2), started(tmp_path, "sleep 60"), partitions=1, seconds=1.5, tries=2).collect()
    assert time.time() - t < 30


def test_a_tool_that_dies_is_started_anew(spark, tmp_path):
    """It ends in the middle of every third batch it sees, with half of the output printed."""
    dying = ("n=0; while IFS= read -r line; do printf '%s\\n' \"$line\"; case \"$line\" in '#END'*) n=$((n+1));; esac; "
             "if [ $n = 3 ]; then read -r line; printf '%s\\n' \"$line\"; exit 7; fi; done")
    out = ex.pipe_batches_lived(batches(spark, 10), started(tmp_path, dying), partitions=1)
    assert rows(out) == [(i // 2, i % 2, f"v{i}") for i in range(20)] and len(os.listdir(tmp_path)) == 4
    with pytest.raises(Exception, match="ended with 9"):
        ex.pipe_batches_lived(batches(spark, 2), ["sh", "-c", "read -r x; exit 9"], partitions=1).collect()


def test_large_batches_and_bad_ends(spark):
    out = ex.pipe_batches_lived(batches(spark, 2, 60000), ["cat"], partitions=1).groupBy("batch_id").agg(F.count("*").alias("n"), F.max("line_no").alias("m"))
    assert sorted(map(tuple, out.collect())) == [(0, 60000, 59999), (1, 60000, 59999)]
    with pytest.raises(Exception, match="after its last batch|exited with 4"):
        ex.pipe_batches_lived(batches(spark, 2), ["sh", "-c", WAIT + "; exit 4"], partitions=1).collect()
    assert ex.pipe_batches_lived(batches(spark, 0), ["cat"], partitions=2).count() == 0
