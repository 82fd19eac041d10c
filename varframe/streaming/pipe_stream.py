"""The stream job (J2) over VCF chunk files arriving in a folder, with Structured Streaming.

Not a new operator: the same per-partition pipe and ``#``-line drop as
``plans.jobs.stream``, run on every micro-batch of new files. The header of each
chunk is dropped before the tool; output rows carry ``(part, line_no)``, their
order inside the epoch. The
checkpoint location is the caller's, in a shared folder: a query restarted with it goes
on with the next epoch and writes a replayed epoch over itself. Each checkpoint location
has a folder of its own in the output, so a query started anew never touches what an
earlier one has written.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.external import pipe_partitions
from ..operators.index import split_index
from ..operators.lines import is_header


def stream_lines(spark: SparkSession, folder: str, max_files: int = 1) -> DataFrame:
    """New text files in ``folder`` as a stream of ``file, value`` rows."""
    return (
        spark.readStream.option("maxFilesPerTrigger", max_files).text(folder)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                "value")
    )


def annotate_stream(
    spark: SparkSession,
    folder: str,
    output: str,
    cmd: Sequence[str],
    checkpoint: str,
    query_name: str | None = None,
    max_files: int = 1,
) -> StreamingQuery:
    """Start the streaming J2: body lines of each new file through ``cmd``, header lines dropped."""
    cmd = list(cmd)
    run = f"{output}/run={zlib.crc32(checkpoint.encode()):08x}"

    def per_batch(batch: DataFrame, epoch: int) -> None:
        # a micro-batch is a plain file scan: number its lines in file order without a shuffle
        body = split_index(batch, name="line_no").where(~is_header("value"))
        out = pipe_partitions(body, cmd, order=["line_no"])
        # one folder per epoch, overwritten on a retry: a replayed batch does not duplicate rows
        out.where(~is_header("value")).write.mode("overwrite").parquet(f"{run}/epoch={epoch}")

    w = stream_lines(spark, folder, max_files).writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return w.start()
