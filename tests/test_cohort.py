"""Contig order, and several files with different headers and samples as one."""

from pyspark.sql import functions as F

from varframe.operators import cohort
from varframe.operators import index as ix
from varframe.sources import sinks, text

A = ["##fileformat=VCFv4.2", '##INFO=<ID=DP,Number=1,Type=Integer,Description="d">', "##contig=<ID=chr1>", "##contig=<ID=chr2>", "##contig=<ID=chr10,length=5>",
     "##source=one", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2",
     "chr10\t5\t.\tA\tC\t.\t.\tDP=1\tGT\t0/1\t1/1", "chr2\t9\t.\tA\tC\t.\t.\tDP=2\tGT\t0/0\t0/1", "chr2\t9\t.\tA\tC\t.\t.\tDP=3\tGT\t0/0"]
B = ["##fileformat=VCFv4.2", '##FORMAT=<ID=GT,Number=1,Type=String,Description="g">', '##INFO=<ID=DP,Number=.,Type=Integer,Description="d">', "##contig=<ID=chr10>",
     "##contig=<ID=extra>", "##source=two", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS3\tS2",
     "chr2\t1\t.\tA\tC\t.\t.\t.\tGT:AD\t1/1:3\t0/0:4", "zz\t1\t.\tA\tC\t.\t.\t.\tGT\t.\t.", "extra\t7\t.\tA\tC\t.\t.\t.\tGT\t1\t0"]
C = ["##fileformat=VCFv4.3", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO", "chr1\t1\t.\tA\tC\t.\t.\tX"]


def scan(spark, tmp_path, **files):
    paths = []
    for name, lines in files.items():
        (tmp_path / f"{name}.vcf").write_text("\n".join(lines) + "\n")
        paths.append(str(tmp_path / f"{name}.vcf"))
    return text.scan_lines(spark, paths)


def merged(lines):
    return [r.value for r in cohort.merge_files(lines).orderBy(*cohort.MERGED_ORDER).collect()]


def test_contigs_in_header_order(spark):
    head = spark.createDataFrame(list(enumerate(["##contig=<ID=b>", "##contig=<length=4,ID=a>", "##contig=<ID=b,length=9>", "##x"])), "k long, value string")
    rows = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "chrom string")
    got = {r.chrom: r.contig_rank for r in cohort.with_contig_rank(rows, cohort.contig_ranks(head, ["k"])).collect()}
    assert got == {"b": 0, "a": 1, "c": cohort.UNLISTED, None: cohort.UNLISTED}


def test_files_with_different_samples_become_one(spark, tmp_path):
    got = merged(scan(spark, tmp_path, a=A, b=B, c=C))
    assert got[:10] == [A[0], A[1], A[2], A[3], A[4], B[4], A[5], B[5], B[1], A[6] + "\tS3"]
    assert got[10:] == ["chr1\t1\t.\tA\tC\t.\t.\tX\t.\t.\t.\t.", "chr2\t1\t.\tA\tC\t.\t.\t.\tGT:AD\t.\t0/0:4\t1/1:3",
                        A[8] + "\t.", A[9] + "\t.\t.", A[7] + "\t.", "extra\t7\t.\tA\tC\t.\t.\t.\tGT\t.\t0\t1", "zz\t1\t.\tA\tC\t.\t.\t.\tGT\t.\t.\t."]
    conflicts = cohort.header_conflicts(scan(spark, tmp_path, a=A, b=B)).collect()
    assert [tuple(r) for r in conflicts] == [("INFO", "DP", "./Integer, 1/Integer")]


def test_same_samples_stay_byte_by_byte(spark, tmp_path):
    b = [*A[:7], "chr1\t3\t.\tA\tC\t.\t.\tDP=9;odd  text\tGT\t0/1\t1|1\textra column"]
    got = merged(scan(spark, tmp_path, a=A, b=b))
    assert got == [*A[:7], b[7], A[8], A[9], A[7]]


def test_merged_files_are_written_in_order(spark, tmp_path):
    both = cohort.merge_files(scan(spark, tmp_path, a=A, b=B))
    path = sinks.write_file(both, str(tmp_path / "out.vcf"), cohort.MERGED_ORDER, partitions=3)
    lines = open(path).read().splitlines()
    assert sorted(lines) == sorted(r.value for r in both.collect()) and lines[0] == A[0]
    assert [x.split("\t")[0] for x in lines if not x.startswith("#")] == ["chr2", "chr2", "chr2", "chr10", "extra", "zz"]


def test_coordinate_index(spark):
    head = spark.createDataFrame([(i, f"##contig=<ID=chr{i}>") for i in range(1, 12)], "k long, value string")
    rows = spark.range(200).select(F.concat(F.lit("chr"), F.col("id") % 11 + 1).alias("chrom"), (F.col("id") * 37 % 200).alias("pos"), F.lit("A").alias("ref"), F.lit("C").alias("alt"))
    got = ix.dense_index(cohort.with_contig_rank(rows, cohort.contig_ranks(head, ["k"])), cohort.COORDINATES).orderBy("idx").collect()
    assert [(r.chrom, r.pos) for r in got] == sorted(((r.chrom, r.pos) for r in got), key=lambda x: (int(x[0][3:]), x[1]))
