"""Batches through an external tool with a ledger: a restarted run goes on where the last one stopped.

The ledger is a folder that driver and tasks share. A task that has run the tool over a batch
writes the output as one Parquet file under a name of its own, renames it, and then writes the
batch's record: id, input hash, rows in and out. A batch without a record hasn't happened,
whatever died when; one with a record of the same input isn't run again, neither by a
retried task nor by a later run. A changed input has another hash, so it runs anew.

A batch that fails is tried again, ``tries`` times in all, from a task-private copy; then it is set
aside with a ``poisoned`` record and the others go on. Later runs leave it aside unless told to retry.

The hash of a batch is the exclusive or of hashes of its (place, line) pairs, from one aggregate.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import default_partitions
from ..sources.bgzf import open_store
from .external import ExternalCommandError, _batches, run_lines

TRIES = 3
RECORD = "batch_id long, input_hash long, status string, rows_in long, rows_out long, error string"
OUTPUT = "batch_id long, input_hash long, line_no long, value string"


class PoisonedBatches(RuntimeError):
    pass


class Ledger:
    """Records and outputs of one tool's batches under ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        store, inner = open_store(self.folder)
        for sub in ("records", "out"):
            store.create_dir(f"{inner}/{sub}", recursive=True)

    def records(self) -> DataFrame:
        """Every record (``RECORD``); one of a batch's inputs that changed since is still listed."""
        return self.spark.read.schema(RECORD).json(f"{self.folder}/records")

    def inputs(self, batches: DataFrame, batch_col: str = "batch_id", pos_col: str = "pos_in_batch", value: str = "value") -> DataFrame:
        """``batch_id, input_hash, rows_in`` of the batches at hand."""
        return batches.groupBy(F.col(batch_col).cast("bigint").alias("batch_id")).agg(
            F.bit_xor(F.xxhash64(F.col(pos_col).cast("bigint"), value)).alias("input_hash"), F.count(F.lit(1)).alias("rows_in"))

    def run(self, batches: DataFrame, cmd: Sequence[str], tries: int = TRIES, prefix: Sequence[str] = (), partitions: int | None = None,
            batch_col: str = "batch_id", pos_col: str = "pos_in_batch", value: str = "value", retry_poisoned: bool = False,
            strict: bool = True) -> DataFrame:
        """Run the batches that have no record, then return all outputs: ``batch_id, line_no, value``.

        With ``strict`` a poisoned batch among them is an error at the end, when all others are done.
        """
        inputs = self.inputs(batches, batch_col, pos_col, value)
        past = self.records().where(F.lit(True) if not retry_poisoned else F.col("status") == "done")
        pending = inputs.join(past.select("batch_id", "input_hash").distinct(), ["batch_id", "input_hash"], "left_anti")
        rows = batches.select(F.col(batch_col).cast("bigint").alias("batch_id"), F.col(pos_col).alias("pos"), F.col(value).alias("value"))
        k = partitions or default_partitions(self.spark)
        dealt = rows.join(pending.select("batch_id", "input_hash"), "batch_id").repartitionById(
            k, F.pmod("batch_id", F.lit(k)).cast("int")).sortWithinPartitions("batch_id", "pos").select("batch_id", "value", "input_hash")
        dealt.mapInPandas(_runner(self.folder, list(cmd), list(prefix), tries, retry_poisoned), "batch_id long, status string").write.format(
            "noop").mode("overwrite").save()
        now = self.records().join(inputs.select("batch_id", "input_hash"), ["batch_id", "input_hash"], "left_semi")
        if strict:
            done = now.where("status = 'done'").select("batch_id", "input_hash")
            bad = now.where("status = 'poisoned'").join(done, ["batch_id", "input_hash"], "left_anti").orderBy("batch_id").limit(5).collect()
            if bad:
                raise PoisonedBatches("; ".join(f"batch {r['batch_id']}: {r['error']}" for r in bad))
        return self.outputs(inputs)

    def outputs(self, inputs: DataFrame) -> DataFrame:
        """The outputs of ``inputs`` (see above) that are done."""
        out = self.spark.read.schema(OUTPUT).parquet(f"{self.folder}/out")
        return out.join(inputs.select("batch_id", "input_hash"), ["batch_id", "input_hash"], "left_semi").drop("input_hash")


def _exists(store, path: str) -> bool:
    from pyarrow import fs

    return store.get_file_info(path).type == fs.FileType.File


def _runner(folder: str, cmd: list[str], prefix: list[str], tries: int, retry_poisoned: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa
        import pyarrow.parquet as pq

        store, inner = open_store(folder)
        hashes: dict[int, int] = {}

        def noted(frames):
            for f in frames:
                hashes.update(zip(f["batch_id"].tolist(), f["input_hash"].tolist(), strict=True))
                yield f

        def record(name: str, **fields) -> None:
            tmp = f"{inner}/records/_{uuid.uuid4().hex}"
            with store.open_output_stream(tmp) as out:
                out.write((json.dumps(fields) + "\n").encode())
            store.move(tmp, f"{inner}/records/{name}.json")

        def attempt(bid: int, spool: str, to: str) -> int:
            n = 0
            with store.open_output_stream(to) as sink, open(spool, encoding="utf-8", newline="") as src:
                schema = pa.schema([("batch_id", pa.int64()), ("input_hash", pa.int64()), ("line_no", pa.int64()), ("value", pa.string())])
                with pq.ParquetWriter(sink, schema) as writer:
                    for lines in run_lines(cmd, iter(lambda: src.read(1 << 20), "")):
                        writer.write_table(pa.table([[bid] * len(lines), [hashes[bid]] * len(lines), list(range(n, n + len(lines))), lines], schema=schema))
                        n += len(lines)
            return n

        for bid, text in _batches(noted(frames), prefix):
            name = f"{bid}-{hashes[bid] & 0xFFFFFFFFFFFFFFFF:016x}"
            if _exists(store, f"{inner}/records/{name}.json") and not retry_poisoned:
                continue  # an earlier attempt of this task has done it
            with tempfile.TemporaryDirectory(prefix=f"vf-batch{bid}-", dir=os.getcwd()) as work:
                spool, rows = os.path.join(work, "batch"), 0
                with open(spool, "w", encoding="utf-8", newline="") as fh:
                    for chunk in text:
                        fh.write(chunk)
                        rows += chunk.count("\n")
                error = None
                for _ in range(max(tries, 1)):
                    tmp = f"{inner}/out/_{uuid.uuid4().hex}"
                    try:
                        n = attempt(bid, spool, tmp)
                    except (ExternalCommandError, OSError) as exc:
                        error = str(exc)[-2000:]
                        if _exists(store, tmp):
                            store.delete_file(tmp)
                        continue
                    store.move(tmp, f"{inner}/out/{name}.parquet")
                    record(name, batch_id=bid, input_hash=hashes[bid], status="done", rows_in=rows - len(prefix), rows_out=n, error=None)
                    yield pd.DataFrame({"batch_id": [bid], "status": ["done"]})
                    break
                else:
                    record(name, batch_id=bid, input_hash=hashes[bid], status="poisoned", rows_in=rows - len(prefix), rows_out=0, error=error)
                    yield pd.DataFrame({"batch_id": [bid], "status": ["poisoned"]})
            hashes.pop(bid, None)

    return run
