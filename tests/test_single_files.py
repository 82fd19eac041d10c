"""Single files put together by many tasks."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from varframe.plans import jobs
from varframe.sources import sinks


def numbered(spark, n):
    return spark.range(n).select("id", F.concat(F.lit("row "), F.col("id"), F.repeat(F.lit("x"), F.col("id").cast("int") % 90)).alias("value"))


@pytest.mark.parametrize("compression, opener", [(None, open), ("gzip", gzip.open)])
def test_one_file_in_order(spark, tmp_path, monkeypatch, compression, opener):
    monkeypatch.setattr(sinks, "PIECE_BYTES", 1000)
    df = numbered(spark, 3000)
    path = tmp_path / "a" / "out.txt"
    for _ in range(2):  # an existing file is replaced
        assert sinks.write_file(df, str(path), ["id"], compression=compression, partitions=7) == str(path)
        with opener(path, "rt") as f:
            assert f.read() == "".join(r.value + "\n" for r in df.orderBy("id").collect())
        assert os.listdir(path.parent) == ["out.txt"]
    assert spark.read.text(str(path)).count() == 3000 or compression  # by its name, a compressed one needs .gz


def test_empty_file_and_file_urls(spark, tmp_path):
    path = tmp_path / "none.txt"
    sinks.write_file(numbered(spark, 0), f"file://{path}", ["id"])
    assert path.read_bytes() == b""
    with pytest.raises(Exception):
        sinks.write_file(numbered(spark, 3), "s3a://bucket/x.txt", ["id"])


def test_one_file_for_each_key(spark, tmp_path):
    df = numbered(spark, 2000).withColumn("kind", F.element_at(F.array(F.lit("a.txt"), F.lit("b c=1.vcf"), F.lit("d")), F.col("id").cast("int") % 3 + 1))
    out = sinks.write_files(df, str(tmp_path / "out"), "kind", ["id"])
    assert sorted(os.listdir(out)) == ["a.txt", "b c=1.vcf", "d"]
    for i, name in enumerate(["a.txt", "b c=1.vcf", "d"]):
        assert (tmp_path / "out" / name).read_text() == "".join(r.value + "\n" for r in df.where(F.col("id") % 3 == i).orderBy("id").collect())
    for bad in (None, "x/y", ".."):
        with pytest.raises(ValueError):
            sinks.write_files(df.withColumn("kind", F.lit(bad).cast("string")), str(tmp_path / "bad"), "kind", ["id"])


def test_job_writes_single_files(spark, tmp_path):
    src = tmp_path / "in.vcf"
    rows = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"] + [f"c\t{i}\t.\tA\tC\t.\t.\t." for i in range(1, 40)]
    src.write_text("\n".join(rows) + "\n")
    job = jobs.Job("snpeff", ("cat",), str(src), str(tmp_path / "one.vcf"), partitions=4)
    jobs.write(jobs.run(spark, job), job.output, single=True)
    assert (tmp_path / "one.vcf").read_text().splitlines() == rows
    many = jobs.Job("annovar", ("sh", "-c", "cat > {out}.avinput"), str(src), str(tmp_path / "kinds"), partitions=4)
    jobs.write(jobs.run(spark, many), many.output, single=True)
    assert os.listdir(many.output) == ["avinput"] and (tmp_path / "kinds" / "avinput").read_text().splitlines() == rows[2:]


@pytest.mark.parametrize("keyed", [False, True])
def test_parts_of_a_plain_file_are_packed(spark, tmp_path, monkeypatch, keyed):
    """The lines stand as they are in the one file alone, not in its parts too."""
    held = []

    def join(spark, folders, *a, f=sinks._join_folders, **b):
        held.extend(size for folder in folders.values() for _, size in sinks._folder_parts(folder))
        return f(spark, folders, *a, **b)

    monkeypatch.setattr(sinks, "_join_folders", join)
    df = spark.range(5000).select("id", F.concat(F.lpad(F.col("id").cast("string"), 6, "0"), F.lit("\t0/0\t0/1" * 20), F.lit(" é")).alias("value"),
                                  F.lit("all.txt").alias("kind"))
    if keyed:
        sinks.write_files(df, str(tmp_path / "out"), "kind", ["id"])
    else:
        sinks.write_file(df, str(tmp_path / "out" / "all.txt"), ["id"], partitions=7)
    raw = (tmp_path / "out" / "all.txt").read_bytes()
    assert raw.decode().split("\n") == [f"{i:06d}" + "\t0/0\t0/1" * 20 + " é" for i in range(5000)] + [""]
    assert sum(held) * 3 < len(raw)
