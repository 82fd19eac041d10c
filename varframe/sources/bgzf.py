"""Block-gzip files (the usual ``.vcf.gz``) read by many tasks, and written.

A block-gzip file is a gzip file of many small members, each of which says how long it is, so
reading can start at any member. The data source ``bgzf`` cuts a file into ranges of compressed bytes,
one partition each. A reader looks for the first member that starts in its range (a header whose
length leads to another header, or the end, and whose content passes its checksum), unpacks the members that
start there, and deals with lines as split readers do: all but the first range drop everything up
to the first line end, and every range reads on past its end up to the next line end. So every line
is read by exactly one task, in members of 64 KB, whatever the file's length.

Plain gzip has no such members and stays one task of the text scan (``read_lines`` looks at the
first header and picks). Files are opened by ``pyarrow.fs``: local and shared folders, and the
stores it knows; a path that only Spark can open goes to the text scan too.

Lines end with ``\\n`` or ``\\r\\n``. Ranges are planned from file sizes alone.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from . import text

MAGIC = b"\x1f\x8b\x08\x04"
HEADER = 18  # gzip header with the one extra field that block gzip uses
MEMBER = 65280  # bytes of text a written member holds
RANGE_BYTES = 32 << 20
READ_BYTES = 1 << 20
ROWS_A_BATCH = 8192
END_OF_FILE = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


class BadBlock(ValueError):
    pass


def open_store(path: str):
    """The file system of a path, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if "://" not in path else fs.FileSystem.from_uri(path)


def member_size(buf: bytes, at: int = 0) -> int | None:
    """Length in bytes of the member whose header stands at ``at``, or None if none does."""
    if buf[at:at + 4] != MAGIC or len(buf) < at + HEADER:
        return None
    extra = struct.unpack_from("<H", buf, at + 10)[0]
    i, end = at + 12, min(at + 12 + extra, len(buf))
    while i + 4 <= end:
        kind, size = buf[i:i + 2], struct.unpack_from("<H", buf, i + 2)[0]
        if kind == b"BC" and size == 2 and i + 6 <= end:
            return struct.unpack_from("<H", buf, i + 4)[0] + 1
        i += 4 + size
    return None


def unpack(member: bytes) -> bytes:
    """The text of one member, checked."""
    extra = struct.unpack_from("<H", member, 10)[0]
    try:
        out = zlib.decompress(member[12 + extra:-8], wbits=-15)
    except zlib.error as exc:
        raise BadBlock(str(exc)) from exc
    if (zlib.crc32(out), len(out)) != struct.unpack("<II", member[-8:]):
        raise BadBlock("checksum of a block-gzip member")
    return out


def pack(raw: bytes) -> bytes:
    """One member with ``raw`` (at most ``MEMBER`` bytes)."""
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(raw) + c.flush()
    head = MAGIC + b"\0\0\0\0\0\xff" + struct.pack("<H2sHH", 6, b"BC", 2, HEADER + len(body) + 7)
    return head + body + struct.pack("<II", zlib.crc32(raw), len(raw))


def is_bgzf(path: str) -> bool:
    """Whether a file that this process can open begins with a block-gzip member."""
    try:
        store, inner = open_store(path)
        with store.open_input_file(inner) as f:
            return member_size(f.read(HEADER)) is not None
    except (OSError, ValueError, NotImplementedError):
        return False


class Members:
    """The members of an open file from a byte on: ``(start, text)``."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def first(self, lo: int, hi: int) -> int | None:
        """Start of the first member in [lo, hi)."""
        at = lo
        while at < hi:
            buf = self.file.read_at(min(READ_BYTES, self.size - at), at)
            i = buf.find(MAGIC)
            while i >= 0 and at + i < hi:
                if self._is_member(at + i):
                    return at + i
                i = buf.find(MAGIC, i + 1)
            if i >= 0 or at + len(buf) >= self.size:
                return None
            at += len(buf) - len(MAGIC) + 1
        return None

    def _is_member(self, at: int) -> bool:
        """A header that leads to another one, or the end, and content that passes its checksum."""
        buf = self.file.read_at(min(1 << 17, self.size - at), at)
        n = member_size(buf)
        if n is None or n > len(buf) or (at + n < self.size and member_size(buf, n) is None and len(buf) >= n + HEADER):
            return False
        try:
            unpack(buf[:n])
        except BadBlock:
            return False
        return True

    def read(self, at: int) -> Iterator[tuple[int, bytes]]:
        buf, base = b"", at
        while at < self.size:
            i = at - base
            n = member_size(buf, i)
            if n is None or i + n > len(buf):
                base, i = at, 0
                buf = self.file.read_at(min(READ_BYTES, self.size - at), at)
                n = member_size(buf)
                if n is None or n > len(buf):
                    raise BadBlock(f"no block-gzip member at byte {at}")
            yield at, unpack(buf[i:i + n])
            at += n


@dataclass
class Range(InputPartition):
    path: str
    lo: int
    hi: int


class BgzfReader(DataSourceReader):
    def __init__(self, options):
        self.paths = options["files"].split("\n")
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))

    def partitions(self) -> Sequence[Range]:
        out = []
        for path in self.paths:
            store, inner = open_store(path)
            size = store.get_file_info(inner).size
            if size is None:
                raise FileNotFoundError(path)
            out += [Range(path, lo, min(lo + self.range_bytes, size)) for lo in range(0, max(size, 1), self.range_bytes)]
        return out

    def read(self, partition: Range):
        import pyarrow as pa

        names, seq = ["file", "block", "seq", "value"], 0
        for lines in range_lines(partition):
            n = len(lines)
            yield pa.RecordBatch.from_arrays([pa.array([partition.path] * n), pa.array([partition.lo] * n, pa.int64()),
                                              pa.array(range(seq, seq + n), pa.int64()), pa.array(lines, pa.string())], names)
            seq += n


def range_lines(part: Range) -> Iterator[list[str]]:
    """The lines that belong to a range, in lists."""
    store, inner = open_store(part.path)
    size = store.get_file_info(inner).size
    with store.open_input_file(inner) as f:
        members = Members(f, size)
        start = 0 if part.lo == 0 else members.first(part.lo, part.hi)
        if start is None:
            return
        held, skipping, out = [], part.lo > 0, []  # held: pieces of a line without an end so far
        for at, raw in members.read(start):
            past = at >= part.hi
            if past and skipping:
                return  # the range lies within one line, which an earlier one reads
            if skipping:
                cut = raw.find(b"\n")
                if cut < 0:
                    continue
                raw, skipping = raw[cut + 1:], False
            if past:  # the line that crosses the end, or starts there
                cut = raw.find(b"\n")
                held.append(raw if cut < 0 else raw[:cut])
                if cut < 0:
                    continue
                yield out + [_line(held)]
                return
            first, *rest = raw.split(b"\n")
            held.append(first)
            if rest:
                out.append(_line(held))
                out += [_line([x]) for x in rest[:-1]]
                held = [rest[-1]]
            if len(out) >= ROWS_A_BATCH:
                yield out
                out = []
        if not skipping and any(held):  # the file's last line has no end
            out.append(_line(held))
        if out:
            yield out


def _line(pieces: list[bytes]) -> str:
    raw = b"".join(pieces)
    return (raw[:-1] if raw.endswith(b"\r") else raw).decode("utf-8")


@dataclass
class Written(WriterCommitMessage):
    part: int
    path: str


class BgzfWriter(DataSourceArrowWriter):
    """One file per partition, ``part-00000.gz`` on, in the order of partitions; a task writes under a name of
    its own, and the committed attempts are renamed."""

    def __init__(self, options, overwrite):
        self.path, self.overwrite = options["path"], overwrite

    def write(self, batches) -> Written:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        store, folder = open_store(self.path)
        store.create_dir(folder, recursive=True)
        path = f"{folder}/_attempt-{uuid.uuid4().hex}"
        with store.open_output_stream(path) as f:
            held = b""
            for batch in batches:
                lines = batch.column(batch.schema.get_field_index("value")).to_pylist()
                held += "".join(f"{x or ''}\n" for x in lines).encode("utf-8")
                full = len(held) // MEMBER * MEMBER
                f.write(b"".join(pack(held[i:i + MEMBER]) for i in range(0, full, MEMBER)))
                held = held[full:]
            if held:
                f.write(pack(held))
            f.write(END_OF_FILE)
        return Written(part, path)

    def commit(self, messages) -> None:
        store, folder = open_store(self.path)
        for m in sorted((m for m in messages if m), key=lambda m: m.part):
            store.move(m.path, f"{folder}/part-{m.part:05d}.gz")
        with store.open_output_stream(f"{folder}/_SUCCESS"):
            pass

    def abort(self, messages) -> None:
        for m in messages:
            if m:
                store, _ = open_store(m.path)
                store.delete_file(m.path)


class BgzfSource(DataSource):
    @classmethod
    def name(cls):
        return "bgzf"

    def schema(self):
        return "file string, block bigint, seq bigint, value string"

    def reader(self, schema):
        return BgzfReader(self.options)

    def writer(self, schema, overwrite):
        return BgzfWriter(self.options, overwrite)


def files_of(path: str) -> list[str]:
    """The data files of a path: the file itself, or a folder's, by name."""
    from pyarrow import fs

    store, inner = open_store(path)
    if store.get_file_info(inner).type != fs.FileType.Directory:
        return [path]
    names = sorted(os.path.basename(i.path) for i in store.get_file_info(fs.FileSelector(inner)) if i.type == fs.FileType.File)
    return [f"{path.rstrip('/')}/{n}" for n in names if not n.startswith(("_", "."))]


def scan_bgzf(spark: SparkSession, paths: str | Sequence[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Lines of block-gzip files (or folders of them) with their order key, as ``text.scan_lines`` returns them."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    spark.dataSource.register(BgzfSource)
    files = [f for p in paths for f in files_of(p)]
    return spark.read.format("bgzf").option("files", "\n".join(files)).option("range_bytes", range_bytes).load()


def write_bgzf(df: DataFrame, path: str, order: Sequence[str | Column], value: str | Column = "value", partitions: int | None = None) -> str:
    """``value`` in ``order`` as block-gzip parts under a new folder ``path``; parts in order of their names are the file."""
    from ..operators.index import ordered

    df.sparkSession.dataSource.register(BgzfSource)
    text_ = F.col(value) if isinstance(value, str) else value
    ordered(df, order, partitions).select(text_.cast("string").alias("value")).write.format("bgzf").mode("append").save(path)
    return path


def read_lines(spark: SparkSession, paths: str | Sequence[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Lines of text files: block-gzip ones by ranges, if every path is one, else the plain scan (gzip is one task a file)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if all(p.endswith((".gz", ".bgz")) and is_bgzf(p) for p in paths):
        return scan_bgzf(spark, paths, range_bytes)
    return text.scan_lines(spark, paths)
