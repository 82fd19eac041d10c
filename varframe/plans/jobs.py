"""The five whole jobs (J1-J5) as Spark plans, with tool profiles as data.

A job reads a VCF (or an interval list), cuts it as the tool wants, runs the
external command over partitions or batches and returns the merged output as an
ordered DataFrame; ``write`` puts it in a text sink. Header lines the tool
prints are always dropped and the input header is put back in front (D15).
"""

from __future__ import annotations

import argparse
import shlex
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import annotate as an
from ..operators import external as ex
from ..operators import index as ix
from ..operators import ledger as lg
from ..operators import lines as ln
from ..operators import merge as mg
from ..operators import vcf
from ..session import scratch_path
from ..sources import bgzf, sinks, text


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back (cuts lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


@dataclass(frozen=True)
class Job:
    tool: str
    tool_cmd: tuple[str, ...]
    input: str = ""
    output: str = ""
    batch_size: int | None = None
    partitions: int | None = None
    extra: dict = field(default_factory=dict)
    ledger: str | None = None
    bases: int | None = None


# Tool profiles: how each kind of tool is fed (fixed values of the reference's jobs)
PROFILES = {
    "vep": {"mode": "line_batches", "batch_size": 20000},
    "snpeff": {"mode": "stream"},
    "annovar": {"mode": "outputs"},
    "pypgx": {"mode": "sample_batches", "batch_size": 10},
    "gatk": {"mode": "interval_batches", "batch_size": 3},
}


OUTPUT_ORDER = ["_s", "_a", "_b"]


def declared_header(head: DataFrame, order, out: DataFrame) -> DataFrame:
    """The header with the INFO, FORMAT and FILTER fields that a tool declares and the input doesn't,
    before the column line (D4): ``line_no, value``.

    A field is its kind and ID. A tool that prints a declaration of the input again, changed or
    not, adds nothing: the input's stands, as its values were written under it. Of several
    declarations of a new field the smallest text is taken.
    """
    new = vcf.declarations(out).groupBy("kind", "id").agg(F.min("value").alias("value"))
    new = new.join(vcf.declarations(head).select("kind", "id"), ["kind", "id"], "left_anti")
    return mg.patch_header(head, order, new, ["kind", "id"])


def _ordered_output(head: DataFrame, head_order, out: DataFrame, out_order, numbered: bool = True,
                    declared: bool = False) -> DataFrame:
    """Input header, then the tool's non-header output in its order.

    ``out`` is stored, its lines numbered from 0 in each batch or partition: ``numbered`` gives ``line_no, value``
    from counts of these, without a shuffle of the lines; without it the frame keeps the order key ``_s, _a, _b`` for the sink, which sorts on it anyway.
    ``declared`` adds the fields that only the tool declares to the header.
    """
    body = ln.drop_header_lines(out)
    if declared:
        head, head_order = declared_header(head, head_order, out), ["line_no"]
    h = ix.bounded_index(head, head_order, name="_a").select(
        F.lit(0).alias("_s"), "_a", F.lit(0).cast("bigint").alias("_b"), "value")
    if numbered:
        n = head.agg(F.count(F.lit(1))).scalar()
        b = ix.stored_index(out.select(F.col(out_order[0]).alias("_a"), F.col(out_order[1]).alias("_b"), "value"), "_a", "_b",
                            ~ln.is_header(), name="line_no", start=n)
        return h.select(F.col("_a").alias("line_no"), "value").unionByName(b.select("line_no", "value"))
    b = body.select(F.lit(1).alias("_s"), F.col(out_order[0]).cast("bigint").alias("_a"),
                    F.col(out_order[1]).cast("bigint").alias("_b"), "value")
    return h.unionByName(b)


def line_batches(lines: DataFrame, order, cmd, batch_size: int = 20000, numbered: bool = True,
                 partitions: int | None = None, declared: bool = False, scanned: bool = False, ledger: str | None = None) -> DataFrame:
    """Batches of ``batch_size`` body lines, each with the header, one process per batch.

    ``scanned`` says that the lines are still in their scan partitions, so that they are numbered without a shuffle.
    With ``ledger``, a shared folder, a run that was stopped goes on with the batches it hasn't done.
    """
    head, body = ln.split_header_body(lines)
    b = ix.batch(ix.split_index(body) if scanned else ix.dense_index(body, order), batch_size)
    prefix = ln.header_lines(head, order)
    if ledger:
        out = lg.Ledger(lines.sparkSession, ledger).run(b, cmd, prefix=prefix, partitions=partitions)
    else:
        # written once: ordering the output reads it more than once, and each read would run the tool
        out = materialize(ex.pipe_batches(b, cmd, partitions=partitions, prefix=prefix), "tool_output")
    return _ordered_output(head, order, out, ["batch_id", "line_no"], numbered, declared)


def stream(lines: DataFrame, order, cmd, partitions: int | None = None, numbered: bool = True, declared: bool = False) -> DataFrame:
    """Headerless body lines through one process per range partition, order kept."""
    head, body = ln.split_header_body(lines)
    out = materialize(ex.pipe_partitions(body, cmd, order=order, partitions=partitions), "tool_output")
    return _ordered_output(head, order, out, ["part", "line_no"], numbered, declared)


def outputs(lines: DataFrame, order, cmd, partitions: int | None = None) -> DataFrame:
    """One process per partition writing several files, merged by kind under an
    extended header: ``suffix, kind, line_no, value``."""
    head, body = ln.split_header_body(lines)
    # the tool's files, kept once as a table in the shared folder (several merges read them)
    parts = materialize(ex.pipe_multi_output(body, cmd, order=order, partitions=partitions), "tool_outputs")
    decls = mg.info_declarations(mg.annotation_columns(mg.table_header(parts)))
    header = mg.patch_header(head, order, decls, ["decl_idx"])
    return mg.merge_routed(parts, header, ["line_no"], dense=True)


def _batch_outputs(b: DataFrame, cmd, partitions: int | None, ledger: str | None = None) -> DataFrame:
    """Batches through the tool, by files if its command names them, else by its standard input and output."""
    if ledger:
        return lg.Ledger(b.sparkSession, ledger).run(b, cmd, partitions=partitions)
    by_file = any("{in}" in a or "{out}" in a for a in cmd)
    return (ex.pipe_batches_file if by_file else ex.pipe_batches)(b, cmd, partitions=partitions)


def sample_batches(lines: DataFrame, order, cmd, batch_size: int = 10, partitions: int | None = None,
                   ledger: str | None = None) -> DataFrame:
    """Sample names of the column line in batches, one process per batch."""
    head, _ = ln.split_header_body(lines)
    names = ln.sample_names(head, order)
    b = ix.batch(ix.dense_index(names, ["sample_idx"]), batch_size)
    return _batch_outputs(b.select("batch_id", "pos_in_batch", F.col("sample").alias("value")), cmd, partitions, ledger)


def interval_batches(intervals: DataFrame, order, cmd, batch_size: int = 3, partitions: int | None = None,
                     scanned: bool = False, ledger: str | None = None, bases: int | None = None) -> DataFrame:
    """Interval-list lines in batches, one process per batch (``scanned``: see ``line_batches``).

    With ``bases`` batches are of nearly that many bases instead, and stay within a contig; an interval without an end counts as one.
    """
    if bases:
        length = F.greatest(F.coalesce(F.col("end") - F.col("start") + 1, F.lit(1)), F.lit(1))
        b = ix.balanced_batches(intervals, order, length, bases, group=["chrom"])
        return _batch_outputs(b.select("batch_id", "pos_in_batch", "value"), cmd, partitions, ledger)
    b = ix.batch(ix.split_index(intervals) if scanned else ix.dense_index(intervals, order), batch_size)
    return _batch_outputs(b.select("batch_id", "pos_in_batch", "value"), cmd, partitions, ledger)


ANN = '##INFO=<ID={name},Number=.,Type=String,Description="Overlapping genes: {fields}">'


def native_annotate(lines: DataFrame, genes: DataFrame, fields=("symbol", "biotype"), na: str = ".", name: str = "ANN") -> DataFrame:
    """VCF lines to VCF lines with the genes that overlap a variant's bases in INFO, declared in the header.

    ``lines`` has ``line_no, value``; the result has the same columns, in file order. Only
    places and genes are joined; the line itself meets its packed genes by ``line_no``, and
    everything in it but the INFO entry ``name`` stays as it was, byte by byte. An input that has
    the entry already gets new values under the new declaration.
    """
    head, body = ln.split_header_body(lines)
    spark = lines.sparkSession
    decl = spark.range(1).select(F.lit(ANN.format(name=name, fields="|".join(fields))).alias("value"))
    own = F.col("value").startswith(f"##INFO=<ID={name},")
    patched = mg.patch_header(head.where(~own), ["line_no"], decl, ["value"])
    shift = head.agg(F.lit(1) - F.count(F.when(own, 1))).scalar()
    rows = vcf.with_end(vcf.parse(body, keep=("line_no",)), "_last", info="info")
    hits = an.annotate_overlap(rows.select("line_no", "chrom", "pos", "_last"), genes, list(fields), how="inner", end="_last")
    packed = an.pack(hits, ["line_no"], list(fields), "_ann")
    cut = F.split("value", "\t")
    kept = F.trim(F.regexp_replace(F.get(cut, F.lit(7)), f"(^|;){name}=[^;]*", ""), F.lit(";"))
    entry = F.concat(F.lit(f"{name}="), F.coalesce("_ann", F.lit(na)))
    info = F.when(kept.isin("", "."), entry).otherwise(F.concat_ws(";", kept, entry))
    line = F.concat_ws("\t", F.slice(cut, 1, 7), info, F.slice(cut, 9, F.greatest(F.size(cut) - 8, F.lit(0))))
    full = body.where(F.trim("value") != "").join(packed, "line_no", "left")
    return patched.unionByName(full.select((F.col("line_no") + shift).alias("line_no"), line.alias("value")))


def run(spark: SparkSession, job: Job) -> DataFrame:
    """Run ``job`` on its input path; returns the ordered output frame."""
    prof = PROFILES.get(job.tool)
    if prof is None:
        raise ValueError(f"unknown tool {job.tool!r}; known: {sorted(PROFILES)}")  # D11
    size = job.batch_size or prof.get("batch_size")
    if prof["mode"] == "interval_batches":
        iv = text.read_intervals(spark, job.input)
        return interval_batches(iv, text.LINE_KEY, job.tool_cmd, size, job.partitions, scanned=True, ledger=job.ledger,
                                bases=job.bases)
    lines = ix.split_index(bgzf.read_lines(spark, job.input), name="line_no")
    mode = prof["mode"]
    if mode == "line_batches":
        return line_batches(lines, ["line_no"], job.tool_cmd, size, numbered=False, partitions=job.partitions, declared=True,
                            scanned=True, ledger=job.ledger)
    if mode == "stream":
        return stream(lines, ["line_no"], job.tool_cmd, job.partitions, numbered=False, declared=True)
    if mode == "outputs":
        return outputs(lines, ["line_no"], job.tool_cmd, job.partitions)
    return sample_batches(lines, ["line_no"], job.tool_cmd, size, job.partitions, ledger=job.ledger)


def write(result: DataFrame, path: str, single: bool = False) -> None:
    """Write a job result: one ordered text per output kind, or one ordered text; with ``single`` real files (see ``sinks``)."""
    if "suffix" in result.columns and "batch_id" in result.columns:
        result = materialize(result, "tool_output")
        for r in result.select("suffix").distinct().collect():  # the kinds of file one tool writes
            sinks.write_batches(result.where(F.col("suffix") == r["suffix"]), f"{path}/{r['suffix'] or 'stdout'}", ["line_no"])
    elif "suffix" in result.columns and single:
        sinks.write_files(result, path, "suffix", ["line_no"])
    elif "suffix" in result.columns:
        sinks.write_by_key(result, path, "suffix", ["line_no"])
    elif "batch_id" in result.columns:
        sinks.write_batches(materialize(result, "tool_output"), path, ["line_no"])
    elif "_s" in result.columns:
        (sinks.write_file if single else sinks.write_lines)(result, path, OUTPUT_ORDER)
    else:
        (sinks.write_file if single else sinks.write_lines)(result, path, ["line_no"])


def main(argv=None) -> None:
    """``spark-submit run_job.py --annotation_tool vep --tool_cmd '...' -i in.vcf -o out``."""
    ap = argparse.ArgumentParser(prog="varframe")
    ap.add_argument("--annotation_tool", required=True, choices=sorted(PROFILES))
    ap.add_argument("--tool_cmd", required=True, help="command line of the tool, as one quoted string")
    ap.add_argument("-i", "--input_file", required=True)
    ap.add_argument("-o", "--output_file", required=True)
    ap.add_argument("--batch_size", type=int)
    ap.add_argument("--partitions", type=int, help="tasks that run the tool")
    ap.add_argument("--single", action="store_true", help="one output file, or one for each kind of output")
    ap.add_argument("--ledger", help="shared folder with the records of done batches; a restarted run goes on from them")
    ap.add_argument("--bases", type=int, help="intervals in batches of about this many bases instead of a number of intervals")
    a = ap.parse_args(argv)
    from ..session import configure

    spark = configure(SparkSession.builder.appName("varframe").getOrCreate())
    job = Job(a.annotation_tool, tuple(shlex.split(a.tool_cmd)), a.input_file, a.output_file, a.batch_size,
              a.partitions, ledger=a.ledger, bases=a.bases)
    write(run(spark, job), job.output, a.single)

