"""Block-gzip files: every line is read once whatever the ranges, members and line ends."""

import gzip
import random

import pytest

from varframe.operators import index as ix
from varframe.sources import bgzf, text


def file_of(path, raw, member=100):
    with open(path, "wb") as f:
        for i in range(0, len(raw), member):
            f.write(bgzf.pack(raw[i:i + member]))
        f.write(bgzf.END_OF_FILE)
    assert gzip.open(path).read() == raw
    return str(path)


CASES = {
    "short lines": "".join(f"line {i}\n" for i in range(400)).encode(),
    "no end at the end": b"a\nb\nlast",
    "lines of many members": b"\n".join([b"x" * 950, b"", b"y" * 2000, b"", b"", b"z"]) + b"\n",
    "one long line": b"q" * 3000,
    "windows ends": b"".join(b"row\t%d\r\n" % i for i in range(200)),
    "utf-8 over members": ("é😀ß" * 300 + "\n" + "ü" * 100).encode(),
    "empty": b"",
    "only ends": b"\n" * 500,
}


@pytest.mark.parametrize("name", CASES)
def test_ranges_of_any_size_give_every_line_once(tmp_path, name):
    raw = CASES[name]
    r = random.Random(1)
    want = raw.decode().replace("\r\n", "\n").split("\n")
    want = want[:-1] if want[-1] == "" else want
    for member in (100, 7, 33):
        path = file_of(tmp_path / f"{member}.gz", raw, member)
        size = (tmp_path / f"{member}.gz").stat().st_size
        for step in (1 << 20, 1000, 211, 64, 29):
            step = min(step, max(size, 1)) if step > 29 else step + r.randrange(5)
            parts = [bgzf.Range(path, lo, min(lo + step, size)) for lo in range(0, size, step)]
            got = [line for p in parts for lines in bgzf.range_lines(p) for line in lines]
            assert got == want, (member, step)


def test_a_header_within_data_is_no_member(tmp_path):
    """Stored (uncompressed) members carry a whole member as their content."""
    import struct
    import zlib

    inner = bgzf.pack(b"not a\nline\n" * 3)
    raw = b"head\n" + inner.hex().encode() + b"\ntail\n"
    c = zlib.compressobj(0, zlib.DEFLATED, -15)
    body = c.compress(inner + b"\n") + c.flush()
    stored = bgzf.MAGIC + b"\0\0\0\0\0\xff" + struct.pack("<H2sHH", 6, b"BC", 2, bgzf.HEADER + len(body) + 7) + body + struct.pack(
        "<II", zlib.crc32(inner + b"\n"), len(inner) + 1)
    path = tmp_path / "x.gz"
    path.write_bytes(bgzf.pack(raw) + stored + bgzf.pack(raw) + bgzf.END_OF_FILE)
    with open(path, "rb") as f:
        at = f.read().find(inner)
    store, inside = bgzf.open_store(str(path))
    with store.open_input_file(inside) as f:
        members = bgzf.Members(f, path.stat().st_size)
        assert members.first(at - 3, at + 1) is None and members.first(at - 3, path.stat().st_size) == len(bgzf.pack(raw)) + len(stored)


def test_scan_runs_in_many_tasks_and_equals_the_plain_scan(spark, tmp_path):
    from pyspark.sql import functions as F

    raw = "".join(f"chr1\t{i}\t{random.Random(i).random()}\n" for i in range(20000)).encode()
    path = file_of(tmp_path / "a.vcf.gz", raw, 5000)
    scanned = bgzf.read_lines(spark, path, range_bytes=20_000)
    assert scanned.rdd.getNumPartitions() > 8
    assert scanned.select(F.spark_partition_id().alias("p")).distinct().count() > 8
    plain = [r.value for r in text.scan_lines(spark, path).orderBy(*text.LINE_KEY).collect()]
    got = ix.split_index(scanned, name="n").orderBy("n").collect()
    assert [r.value for r in got] == plain and [r.n for r in got] == list(range(20000))


def test_plain_gzip_stays_with_the_text_scan(spark, tmp_path):
    path = tmp_path / "p.vcf.gz"
    path.write_bytes(gzip.compress(b"a\nb\n"))
    assert not bgzf.is_bgzf(str(path)) and [r.value for r in bgzf.read_lines(spark, str(path)).collect()] == ["a", "b"]


def test_written_parts_read_back_in_order(spark, tmp_path):
    df = spark.range(30000).selectExpr("id", "concat('line ', id * 7919 % 30011, repeat('x', id % 50)) as value")
    out = bgzf.write_bgzf(df, str(tmp_path / "out"), ["id"], partitions=5)
    back = ix.split_index(bgzf.scan_bgzf(spark, out, range_bytes=50_000), name="n").orderBy("n").collect()
    assert [r.value for r in back] == [r.value for r in df.orderBy("id").collect()]
    assert len([f for f in (tmp_path / "out").iterdir() if f.name.startswith("part-")]) == 5


def test_damaged_file_fails(spark, tmp_path):
    raw = bytearray(bgzf.pack(b"abc\n" * 50) + bgzf.pack(b"def\n" * 50))
    raw[22] ^= 255
    path = tmp_path / "bad.gz"
    path.write_bytes(bytes(raw))
    with pytest.raises(Exception, match="(?i)checksum|BadBlock|invalid"):
        bgzf.scan_bgzf(spark, str(path)).collect()
