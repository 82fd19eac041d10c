"""Resumable batches: what a killed run has done isn't done again."""

import os
import signal
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from varframe.operators.ledger import Ledger, PoisonedBatches

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def batches(spark, n=20, size=3, word="v"):
    return spark.range(n * size).select(F.expr(f"id div {size}").alias("batch_id"), F.expr(f"cast(id % {size} as int)").alias("pos_in_batch"),
                                        F.concat(F.lit(word), F.col("id")).alias("value"))


def counting(folder, then="cat"):
    return ["sh", "-c", f"mktemp {folder}/call-XXXXXXXX > /dev/null; {then}"]


def rows(out):
    return sorted((r.batch_id, r.line_no, r.value) for r in out.collect())


WANT = [(i // 3, i % 3, f"v{i}") for i in range(60)]


def test_a_second_run_calls_nothing(spark, tmp_path):
    calls, book = tmp_path / "calls", Ledger(spark, str(tmp_path / "book"))
    calls.mkdir()
    assert rows(book.run(batches(spark), counting(calls), partitions=4)) == WANT and len(os.listdir(calls)) == 20
    assert rows(book.run(batches(spark), counting(calls), partitions=3)) == WANT and len(os.listdir(calls)) == 20
    r = book.records().orderBy("batch_id").collect()
    assert [(x.batch_id, x.status, x.rows_in, x.rows_out) for x in r] == [(i, "done", 3, 3) for i in range(20)]
    # one changed line: its batch alone runs again, and the old output is no longer part of the result
    changed = batches(spark).withColumn("value", F.when(F.col("value") == "v31", "new").otherwise(F.col("value")))
    assert rows(book.run(changed, counting(calls))) == [(b, n, "new" if v == "v31" else v) for b, n, v in WANT] and len(os.listdir(calls)) == 21


def test_poisoned_batches_are_set_aside(spark, tmp_path):
    calls, book = tmp_path / "calls", Ledger(spark, str(tmp_path / "book"))
    calls.mkdir()
    bad = "x=$(cat); case \"$x\" in *v7*) echo broken >&2; exit 3;; esac; printf '%s\\n' \"$x\""
    with pytest.raises(PoisonedBatches, match="batch 2: .*broken"):
        book.run(batches(spark, 6), counting(calls, bad), tries=4)
    assert len(os.listdir(calls)) == 5 + 4
    good = [w for w in WANT if w[0] < 6 and w[0] != 2]
    assert rows(book.run(batches(spark, 6), counting(calls, bad), strict=False)) == good and len(os.listdir(calls)) == 9
    assert rows(book.run(batches(spark, 6), counting(calls), retry_poisoned=True)) == WANT[:18] and len(os.listdir(calls)) == 10


def test_prefix_empty_output_and_no_batches(spark, tmp_path):
    book = Ledger(spark, str(tmp_path / "book"))
    assert rows(book.run(batches(spark, 2, 1), ["cat"], prefix=["#h"])) == [(0, 0, "#h"), (0, 1, "v0"), (1, 0, "#h"), (1, 1, "v1")]
    other = Ledger(spark, str(tmp_path / "other"))
    assert rows(other.run(batches(spark, 3), ["true"])) == [] and {r.rows_out for r in other.records().collect()} == {0}
    assert rows(Ledger(spark, str(tmp_path / "none")).run(batches(spark, 0), ["cat"])) == []


def test_a_killed_run_goes_on(spark, tmp_path):
    calls, book = tmp_path / "calls", tmp_path / "book"
    calls.mkdir()
    script = tmp_path / "run.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {ROOT!r}); sys.path.insert(0, {ROOT!r} + "/tests")
from varframe.session import local_session
import test_ledger as t
spark = local_session(cores=2, partitions=2)
t.Ledger(spark, {str(book)!r}).run(t.batches(spark), t.counting({str(calls)!r}, "sleep 0.7; cat"), partitions=2)
""")
    proc = subprocess.Popen([sys.executable, str(script)], start_new_session=True, cwd=tmp_path, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    try:
        end = time.time() + 120
        while len(os.listdir(calls)) < 8 and proc.poll() is None and time.time() < end:
            time.sleep(0.1)
        assert proc.poll() is None
    finally:
        os.killpg(proc.pid, signal.SIGKILL)
        proc.wait()
    time.sleep(1)
    called, done = len(os.listdir(calls)), len([n for n in os.listdir(book / "records") if n.endswith(".json") and not n.startswith(("_", "."))])
    assert 4 <= done < 20
    assert rows(Ledger(spark, str(book)).run(batches(spark), counting(calls), partitions=4)) == WANT
    assert len(os.listdir(calls)) == called + 20 - done
