"""Text sinks.

Every writer is parallel: rows are range-partitioned on their order key and
sorted inside each partition, so part files ``part-00000…`` concatenated in order of
their numbers are the ordered file. ``single=True`` then joins the parts into one file
with the file system's metadata-only ``concat`` (HDFS), or fails; no bytes go through
the driver or a single task. Output is overwritten (D14).

``write_file`` and ``write_files`` make real single files, also on file systems without
``concat`` if tasks can write to them as to a local or shared folder: the parts' sizes give every
part its place in the file, and many tasks copy their pieces there at the same time. A
retried task writes the same bytes to the same place; the file gets its name when all are in.
Parts of a plain file are gzipped until they are copied, so its lines are stored as they are only once.
Compressed parts are gzip members, and members one after the other are one gzip file; ``write_file`` makes
them block gzip, which ``bgzf.read_lines`` reads by ranges.
"""

from __future__ import annotations

import gzip
import os
import re
import shutil
import uuid
from collections.abc import Sequence

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame

from ..operators.index import ordered
from ..session import default_partitions

PIECE_BYTES = 64 << 20


def write_lines(
    df: DataFrame,
    path: str,
    order: Sequence[str | Column],
    value: str | Column = "value",
    compression: str | None = None,
    single: bool = False,
    partitions: int | None = None,
    fast: bool = False,
) -> str:
    """Write ``value`` in ``order`` as text under ``path``; returns the path written.

    ``value`` may be an expression: it is computed on the rows in order, not before they are sampled and shuffled.
    ``fast`` gzips in less than half the time, to half as many bytes again.
    """
    w = ordered(df, order, partitions).select(value).write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    if fast:
        w = w.option("zlib.compress.level", "BEST_SPEED")
    w.text(path)
    if single:
        return concat_parts(df.sparkSession, path)
    return path


def write_batches(
    df: DataFrame, path: str, order: Sequence[str], batch_col: str = "batch_id", value: str = "value",
    compression: str | None = None,
) -> str:
    """One file per batch: ``path/batch_id=<i>/part-…`` (A47). A batch is one bounded task."""
    w = (
        df.repartition(batch_col)
        .sortWithinPartitions(batch_col, *order)
        .select(batch_col, value)
        .write.mode("overwrite")
        .partitionBy(batch_col)
    )
    if compression:
        w = w.option("compression", compression)
    w.text(path)
    return path


def write_by_key(df: DataFrame, path: str, key: str, order: Sequence[str], value: str = "value", compression: str | None = None) -> str:
    """One directory per key value, e.g. per tool output suffix."""
    w = (
        df.repartitionByRange(key, *order)
        .sortWithinPartitions(key, *order)
        .select(key, value)
        .write.mode("overwrite")
        .partitionBy(key)
    )
    if compression:
        w = w.option("compression", compression)
    w.text(path)
    return path


def concat_parts(spark, path: str) -> str:
    """Join ``path/part-*`` into its first part by ``FileSystem.concat`` (HDFS: metadata only); returns that file.

    Empty parts are dropped first (``concat`` may refuse them) and parts are joined by
    their number. A file system without ``concat`` is an error: ask for parts there.
    """
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    parts = sorted((int(m[1]), s.getLen(), s.getPath()) for s in fs.listStatus(p)
                   if (m := re.match(r"part-(\d+)", s.getPath().getName())))
    full = [f for _, size, f in parts if size] or [f for _, _, f in parts[:1]]
    for _, _, f in parts:
        if f not in full:
            fs.delete(f, False)
    if len(full) > 1:
        rest = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(full) - 1)
        for i, f in enumerate(full[1:]):
            rest[i] = f
        try:
            fs.concat(full[0], rest)
        except UnsupportedOperationException as exc:
            raise OSError(f"{path}: this file system can't join files; write parts (single=False)") from exc
    return full[0].toString() if full else path


def _local(path: str) -> str | None:
    """The path as tasks open it, or None where they can't."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return None if "://" in path else os.path.abspath(path)


def _folder_parts(folder: str) -> list[tuple[str, int]]:
    """Part files of a folder with their sizes, in order of their numbers."""
    found = [(int(m[1]), n) for n in os.listdir(folder) if (m := re.match(r"part-(\d+)", n))]
    return [(os.path.join(folder, n), os.path.getsize(os.path.join(folder, n))) for _, n in sorted(found)]


def _pieces(source: str, at: int, size: int, packed: bool):
    """``size`` bytes of a part from ``at`` on, unpacked if it is ``packed``, in buffers."""
    with (gzip.open if packed else open)(source, "rb") as src:
        src.seek(at)
        while size and (buf := src.read(min(size, 1 << 20))):
            yield buf
            size -= len(buf)


def _copy_pieces(frames):
    import pandas as pd

    for pdf in frames:
        done = 0
        for source, at, target, to, size, packed in pdf.itertuples(index=False):
            with open(target, "r+b") as dst:
                dst.seek(to)
                for buf in _pieces(source, at, size, packed):
                    done += dst.write(buf)
                dst.flush()
                os.fsync(dst.fileno())
        yield pd.DataFrame({"copied": [done]})


def _unpacked_sizes(spark, sources: Sequence[str]) -> dict[str, int]:
    """Bytes of text in each gzipped part, read through by many tasks."""
    import pandas as pd

    def sizes(frames):
        for pdf in frames:
            yield pd.DataFrame({"source": pdf["source"], "size": [sum(map(len, _pieces(f, 0, 1 << 62, True))) for f in pdf["source"]]})

    table = spark.createDataFrame([(f,) for f in sources], "source string")
    tasks = min(len(sources), 4 * default_partitions(spark))
    return {r["source"]: r["size"] for r in table.repartition(tasks).mapInPandas(sizes, "source string, size long").collect()}


def _join_folders(spark, folders: dict[str, str], packed: bool = False) -> None:
    """Make one file of the parts of each folder: ``{file: folder}``; all are copied by one job.

    ``packed``: the parts are gzipped, the file is to be plain. A part is then one piece.
    """
    pieces, waiting, total = [], {}, 0
    parts = {target: _folder_parts(folder) for target, folder in folders.items()}
    sources = [source for found in parts.values() for source, _ in found]
    sizes = _unpacked_sizes(spark, sources) if packed and sources else {}
    for target, found in parts.items():
        waiting[target] = f"{target}.{uuid.uuid4().hex}.tmp"
        to = 0
        for source, size in found:
            size = sizes.get(source, size)
            a_piece = max(size, 1) if packed else PIECE_BYTES
            for at in range(0, size, a_piece):
                n = min(a_piece, size - at)
                pieces.append((source, at, waiting[target], to + at, n, packed))
            to += size
        total += to
        with open(waiting[target], "wb") as f:
            f.truncate(to)
    if pieces:
        table = spark.createDataFrame(pieces, "source string, at long, target string, to long, size long, packed boolean")
        tasks = min(len(pieces), 4 * default_partitions(spark))
        copied = table.repartition(tasks).mapInPandas(_copy_pieces, "copied long").agg({"copied": "sum"}).first()[0]
        if copied != total:
            raise OSError(f"copied {copied} of {total} bytes")
    for target, tmp in waiting.items():
        crc = os.path.join(os.path.dirname(target), f".{os.path.basename(target)}.crc")
        if os.path.exists(crc):  # of an earlier file under this name
            os.remove(crc)
        os.replace(tmp, target)


def write_file(
    df: DataFrame,
    file: str,
    order: Sequence[str | Column],
    value: str | Column = "value",
    compression: str | None = None,
    partitions: int | None = None,
) -> str:
    """Write ``value`` in ``order`` as the one file ``file`` (A45), gzipped if asked (A46); returns it.

    On HDFS the parts are joined by ``concat``; in a local or shared folder by copying at known
    offsets; another file system is an error before anything is written there.
    """
    spark, local = df.sparkSession, _local(file)
    parts = f"{file if local is None else local}.parts-{uuid.uuid4().hex}"
    if local is None:
        jvm, target = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(file)
        fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.getScheme() != "hdfs":
            raise OSError(f"{file}: this file system can't join files; write parts (write_lines)")
        joined = write_lines(df, parts, order, value, compression, single=True, partitions=partitions)
        fs.delete(target, False)
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(joined), target):
            raise OSError(f"{file}: could not rename {joined}")
        fs.delete(jvm.org.apache.hadoop.fs.Path(parts), True)
        return file
    os.makedirs(os.path.dirname(local), exist_ok=True)
    try:
        if compression == "gzip":  # in blocks, so that many tasks can read the one file again
            from .bgzf import write_bgzf

            write_bgzf(df, f"file:{parts}", order, value, partitions=partitions)
        else:
            write_lines(df, f"file:{parts}", order, value, compression or "gzip", partitions=partitions)
        _join_folders(spark, {local: parts}, packed=compression is None)
    finally:
        shutil.rmtree(parts, ignore_errors=True)
    return file


def write_files(df: DataFrame, folder: str, key: str, order: Sequence[str], value: str = "value", compression: str | None = None) -> str:
    """One file per value of ``key`` under ``folder``, named by it (A48: a tool's few kinds of output).

    A null key, or one that can't be a file's name, is an error.
    """
    local = _local(folder)
    if local is None:
        raise OSError(f"{folder}: not a folder that tasks can write to; use write_by_key")
    names = [r[0] for r in df.select(key).distinct().collect()]
    bad = [n for n in names if n is None or n in ("", ".", "..") or "/" in str(n)]
    if bad:
        raise ValueError(f"not a file name: {bad[0]!r}")
    parts = f"{local}.parts-{uuid.uuid4().hex}"
    number = {n: i for i, n in enumerate(sorted(names))}
    os.makedirs(local, exist_ok=True)
    try:
        from pyspark.sql import functions as F

        numbered = F.create_map(*[F.lit(x) for kv in number.items() for x in kv])
        if number:
            write_by_key(df.withColumn("_file", numbered[F.col(key)]), f"file:{parts}", "_file", order, value, compression or "gzip")
            _join_folders(df.sparkSession, {os.path.join(local, str(n)): os.path.join(parts, f"_file={i}") for n, i in number.items()},
                          packed=compression is None)
    finally:
        shutil.rmtree(parts, ignore_errors=True)
    return folder
