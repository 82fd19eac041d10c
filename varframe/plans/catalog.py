"""Registered queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and their SQL twins ``SQL[name]``.

Each query runs an operator of the library over the whole fixture views of
``fixtures.py`` (derived from the test tables); each SQL text computes the same
result in DuckDB from the same tables, with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import index as ix
from ..operators import lines as ln
from ..operators import merge as mg
from ..session import configure, scratch_path
from ..sources import sinks, text
from . import fixtures as fx
from .oracle import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            SQL[name] = sql(oracle)
        return run

    return deco


ORDER = ["line_no"]


def _header_body(spark, d):
    """Header and body lines of the VCF file (one scan, two filters; file order in ``line_no``)."""
    return ln.split_header_body(fx.vcf_lines(spark, d))


# ---------------------------------------------------------------- scans, splits

@query("scan_lines", """
select line_no, value from ranked_lines""")
def scan_lines(spark, d):
    """Write the VCF as two files (header, body), scan both paths, index lines in file order (A1, A2)."""
    head, body = _header_body(spark, d)
    root = scratch_path(spark, "scan_lines")
    p0 = sinks.write_lines(head, f"{root}/0_header", ORDER)
    p1 = sinks.write_lines(body, f"{root}/1_body", ORDER)
    scanned = text.scan_lines(spark, [p0, p1])
    return ix.split_index(scanned, name="line_no").select("line_no", "value")


@query("interval_scan", """
select chrom, "start", "end" from genes""")
def interval_scan(spark, d):
    """Genes written as an interval list ``chrom:start-end``, read back on the executors (A3)."""
    g = fx.genes(spark, d)
    p = sinks.write_lines(
        g.select("gene", F.concat_ws("", "chrom", F.lit(":"), F.col("start").cast("string"), F.lit("-"),
                                     F.col("end").cast("string")).alias("value")),
        scratch_path(spark, "intervals"), ["gene"])
    return text.read_intervals(spark, p).select("chrom", "start", "end")


@query("split_header", """
select value from lines where value like '#%'""")
def split_header(spark, d):
    return _header_body(spark, d)[0].select("value")


@query("split_body", """
select value from lines where value not like '#%'""")
def split_body(spark, d):
    return _header_body(spark, d)[1].select("value")


@query("sample_list", """
select cast(row_number() over (order by n_nationkey) - 1 as int) as sample_idx, n_name as sample from nation""")
def sample_list(spark, d):
    """Sample names from the last header line."""
    head, _ = _header_body(spark, d)
    return ln.sample_names(head, ORDER)


@query("count_variants", """
select count(*) as n_variants from lines where value not like '#%'""")
def count_variants(spark, d):
    return ln.count_rows(_header_body(spark, d)[1], "n_variants")


@query("union_header_body", """
select line_no, value from ranked_lines""")
def union_header_body(spark, d):
    """Header then body in order, with a dense line number."""
    head, body = _header_body(spark, d)
    return ln.union_sections(head, body, ORDER, scanned=True)


# ---------------------------------------------------------------- batching

_BATCH_ROWS_SQL = """
select cast(rn // {b} as bigint) as batch_id, count(*) as n_rows,
       arg_min(pos, rn) as first_pos, arg_max(pos, rn) as last_pos,
       arg_min(chrom, rn) as first_chrom, arg_max(chrom, rn) as last_chrom,
       cast(sum(pos) as bigint) as sum_pos
from (select *, row_number() over (order by chrom, pos, ref, alt, qual, rf, tax, dp) - 1 as rn from variants)
group by 1"""


@query("batch_rows", _BATCH_ROWS_SQL.format(b=1000))
def batch_rows(spark, d):
    """Variants in genome order cut in batches of 1000 (A19, A20): count and bounds per batch."""
    v = ix.batch(ix.dense_index(fx.variants(spark, d), fx.VARIANT_ORDER), 1000)
    return v.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min_by("pos", "idx").alias("first_pos"), F.max_by("pos", "idx").alias("last_pos"),
        F.min_by("chrom", "idx").alias("first_chrom"), F.max_by("chrom", "idx").alias("last_chrom"),
        F.sum("pos").alias("sum_pos"),
    )


@query("batch_intervals", """
select cast(rn // 3 as bigint) as batch_id, count(*) as n_intervals, min(gene) as first_gene, max(gene) as last_gene
from (select *, row_number() over (order by gene) - 1 as rn from genes) group by 1""")
def batch_intervals(spark, d):
    """Intervals in batches of 3."""
    g = ix.batch(ix.dense_index(fx.genes(spark, d), ["gene"]), 3)
    return g.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_intervals"), F.min("gene").alias("first_gene"),
                                     F.max("gene").alias("last_gene"))


@query("batch_samples", """
select cast(rn // 10 as bigint) as batch_id, count(*) as n_samples,
       arg_min(sample, rn) as first_sample, arg_max(sample, rn) as last_sample
from (select *, row_number() over (order by sample_idx) - 1 as rn from samples) group by 1""")
def batch_samples(spark, d):
    """Samples in batches of 10."""
    s = ix.batch(ix.dense_index(fx.samples(spark, d), ["sample_idx"]), 10)
    return s.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_samples"),
                                     F.min_by("sample", "idx").alias("first_sample"),
                                     F.max_by("sample", "idx").alias("last_sample"))


@query("batch_plan", """
select kind, n_items, batch_size, (n_items + batch_size - 1) // batch_size as n_batches,
       greatest(1, (n_items + batch_size - 1) // batch_size) as n_partitions
from (select 'lines' as kind, count(*) as n_items, cast(20000 as bigint) as batch_size from variants
      union all select 'intervals', count(*), cast(3 as bigint) from genes
      union all select 'samples', count(*), cast(10 as bigint) from samples)""")
def batch_plan(spark, d):
    """Batch and partition counts for the three batch kinds."""
    def one(kind, df, size):
        return df.agg(F.count(F.lit(1)).alias("n_items")).select(
            F.lit(kind).alias("kind"), "n_items", F.lit(size).cast("bigint").alias("batch_size"))

    counts = one("lines", fx.variants(spark, d), 20000).unionByName(one("intervals", fx.genes(spark, d), 3)) \
        .unionByName(one("samples", fx.samples(spark, d), 10))
    return ix.batch_plan_frame(counts)


@query("batch_text", """
select cast(rn // 10 as bigint) as batch_id, string_agg(sample, chr(10) order by rn) as text
from (select *, row_number() over (order by sample_idx) - 1 as rn from samples) group by 1""")
def batch_text(spark, d):
    """One text per batch, lines joined by newline in order (A14); groups are at most 10 rows."""
    s = ix.batch(ix.dense_index(fx.samples(spark, d), ["sample_idx"]), 10)
    return s.groupBy("batch_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos_in_batch", "sample"))),
                                 lambda x: x["sample"]), "\n").alias("text"))


@query("batch_with_header", """
with h as (select value, row_number() over (order by section, seq, value) - 1 as k from lines where value like '#%'),
     b as (select value, row_number() over (order by section, seq, value) - 1 as rn from lines where value not like '#%'),
     nh as (select count(*) as n from h),
     ids as (select distinct rn // 20000 as batch_id from b)
select cast(ids.batch_id as bigint) as batch_id, cast(h.k as bigint) as line_in_batch, h.value from ids, h
union all
select cast(rn // 20000 as bigint), cast(rn % 20000 + (select n from nh) as bigint), value from b""")
def batch_with_header(spark, d):
    """Header lines in front of every batch of 20000 body lines."""
    head, body = _header_body(spark, d)
    return _with_header(head, body, 20000)


def _with_header(head, body, size):
    b = ix.batch(ix.split_index(body), size)
    n_head = head.count()
    n_batches = ix.count_batches(body, size)
    h = ln.header_for_batches(head, ORDER, n_batches)
    return h.unionByName(
        b.select("batch_id", (F.col("pos_in_batch") + F.lit(n_head)).cast("bigint").alias("line_in_batch"), "value"))


# ---------------------------------------------------------------- tool output parts and merges

_TXT_HEADER = "(select arg_min(value, part) as v from all_parts where suffix like '%.txt' and line_no = 0)"
_ANN_COLS = f"""
ann_cols as (
  select cast(i as int) as col_idx, name from (
    select unnest(range(len(string_split(v, chr(9))))) as i, unnest(string_split(v, chr(9))) as name
    from {_TXT_HEADER})
  where name not like '%Otherinfo%' and name not in ('Chr', 'Start', 'End', 'Ref', 'Alt'))"""
_DECLS = """
decls as (
  select cast(0 as bigint) as decl_idx,
         '##INFO=<ID=ANNOVAR_DATE,Number=1,Type=String,Description="Flag the start of ANNOVAR annotation for one alternative allele">' as value
  union all
  select row_number() over (order by col_idx),
         concat('##INFO=<ID=', name, ',Number=.,Type=String,Description="', name, ' annotation provided by ANNOVAR">')
  from ann_cols
  union all
  select (select count(*) from ann_cols) + 1,
         '##INFO=<ID=ALLELE_END,Number=0,Type=Flag,Description="Flag the end of ANNOVAR annotation for one alternative allele">')"""
_PATCHED = """
patched as (
  select row_number() over (order by s, k) - 1 as line_no, value from (
    select case when value like '##%' then 0 else 2 end as s, line_no as k, value
    from ranked_lines where value like '#%'
    union all select 1, decl_idx, value from decls))"""


def _parts(spark, d):
    return fx.parts(spark, d)


@query("part_suffix", """
select distinct concat(cast(part as varchar), '.', suffix) as name, part, suffix from all_parts""")
def part_suffix(spark, d):
    """Part file name to (part, suffix) on the first dot."""
    names = _parts(spark, d).select(F.concat_ws(".", F.col("part").cast("string"), "suffix").alias("name")).distinct()
    return names.select("name", *text.part_name("name"))


@query("distinct_suffix", "select distinct suffix from all_parts")
def distinct_suffix(spark, d):
    return mg.part_suffixes(_parts(spark, d))


@query("present_parts", """
select cast(range as int) as part from range(10) where range in (select part from all_parts)""")
def present_parts(spark, d):
    """Expected part ids 0..9 kept when the tool wrote output for them."""
    expected = spark.range(10).select(F.col("id").cast("int").alias("part"))
    return mg.present_parts(expected, _parts(spark, d))


@query("first_line", "select part, suffix, arg_min(value, line_no) as value from all_parts group by part, suffix")
def first_line(spark, d):
    return mg.first_lines(_parts(spark, d))


@query("annotation_columns", f"with {_ANN_COLS} select col_idx, name from ann_cols")
def annotation_columns(spark, d):
    """Annotation column names of the first table part's header row."""
    return mg.annotation_columns(mg.table_header(_parts(spark, d)))


@query("info_decls", f"with {_ANN_COLS}, {_DECLS} select decl_idx, value from decls")
def info_decls(spark, d):
    """INFO declarations for the added columns between open and close lines."""
    return mg.info_declarations(mg.annotation_columns(mg.table_header(_parts(spark, d))))


def _patched_header(spark, d):
    head, _ = _header_body(spark, d)
    decls = mg.info_declarations(mg.annotation_columns(mg.table_header(_parts(spark, d))))
    return mg.patch_header(head, ORDER, decls, ["decl_idx"])


@query("header_patch", f"with {_ANN_COLS}, {_DECLS}, {_PATCHED} select line_no, value from patched")
def header_patch(spark, d):
    """Declarations inserted before the column line."""
    return _patched_header(spark, d)


_TABLE_MERGE = """
select suffix, row_number() over (partition by suffix order by part, line_no) - 1 as line_no, value
from all_parts p
where (suffix like '%txt' or suffix like '%csv')
  and (line_no <> 0 or part = (select min(part) from all_parts q where q.suffix = p.suffix))"""
_PLAIN_MERGE = """
select suffix, row_number() over (partition by suffix order by part, line_no) - 1 as line_no, value
from all_parts where not (suffix like '%txt' or suffix like '%csv' or suffix like '%vcf')"""
_VCF_MERGE = f"""
select suffix, row_number() over (partition by suffix order by s, a, b) - 1 as line_no, value from (
  select suffix, 0 as s, cast(0 as bigint) as a, h.line_no as b, h.value
  from patched h, (select distinct suffix from all_parts where suffix like '%vcf') x
  union all
  select suffix, 1, part, line_no, value from all_parts where suffix like '%vcf' and value not like '#%')"""


@query("merge_tables", _TABLE_MERGE)
def merge_tables(spark, d):
    """Table parts merged, one header row."""
    p = _parts(spark, d)
    return mg.merge_tables(p.where(mg.kind_of() == "table"))


@query("merge_parts", _PLAIN_MERGE)
def merge_parts(spark, d):
    """Other parts concatenated in part order."""
    p = _parts(spark, d)
    return mg.merge_plain(p.where(mg.kind_of() == "plain"))


@query("merge_vcf", f"with {_ANN_COLS}, {_DECLS}, {_PATCHED} {_VCF_MERGE}")
def merge_vcf(spark, d):
    """VCF parts stripped of '#' lines under the extended header."""
    p = _parts(spark, d)
    return mg.merge_vcf(p.where(mg.kind_of() == "vcf"), _patched_header(spark, d), ["line_no"])


@query("merge_route", f"""
with {_ANN_COLS}, {_DECLS}, {_PATCHED}
select suffix, 'table' as kind, line_no, value from ({_TABLE_MERGE})
union all select suffix, 'vcf', line_no, value from ({_VCF_MERGE})
union all select suffix, 'plain', line_no, value from ({_PLAIN_MERGE})""")
def merge_route(spark, d):
    """Every suffix routed to its merge by the last three characters."""
    return mg.merge_routed(_parts(spark, d), _patched_header(spark, d), ["line_no"])


# ---------------------------------------------------------------- external programs and jobs

from ..operators import external as ex  # noqa: E402
from ..operators import report as rp  # noqa: E402
from . import jobs  # noqa: E402

UPPER = ["tr", "a-z", "A-Z"]
# prints a header line of its own, then upper-cases: the header must be dropped
UPPER_WITH_HEADER = ["sh", "-c", "echo '#tool output'; tr a-z A-Z"]
# writes three outputs like a table annotator: a table with a header row, a VCF, a plain file
MULTI_OUTPUT = ["sh", "-c", (
    "cat > {out}.in && "
    "{ printf 'Chr\\tStart\\tEnd\\tRef\\tAlt\\tGene.refGene\\tOtherinfo1\\n'; tr a-z A-Z < {out}.in; }"
    " > {out}.hg38_multianno.txt && "
    "{ echo '#tool vcf'; cat {out}.in; } > {out}.hg38_multianno.vcf && "
    "cut -f1-2 {out}.in > {out}.avinput && rm {out}.in")]

_BODY_RANKED = "(select row_number() over (order by section, seq, value) - 1 as rn, value from lines where value not like '#%')"
_JOB_LINES = """
select line_no, case when value like '#%' then value else upper(value) end as value from ranked_lines"""


@query("pipe_drop_header", "select upper(value) as value from lines where value not like '#%'")
def pipe_drop_header(spark, d):
    """Body lines through a process per partition; '#' lines it prints are dropped."""
    _, body = _header_body(spark, d)
    out = ex.pipe_partitions(body, UPPER_WITH_HEADER, order=ORDER)
    return ln.drop_header_lines(out).select("value")


@query("pipe_partitions", f"select rn as line_no, upper(value) as value from {_BODY_RANKED}")
def pipe_partitions(spark, d):
    """Output of one process per range partition keeps the input order."""
    _, body = _header_body(spark, d)
    # written once: its counts and its rows are two reads, and each would run the tool
    out = jobs.materialize(ex.pipe_partitions(body, UPPER, order=ORDER), "tool_output")
    return ix.stored_index(out, "part", name="line_no_out").select(F.col("line_no_out").alias("line_no"), "value")


@query("pipe_exit_codes", "select 0 as exit_code, count(*) as n_lines from lines where value not like '#%'")
def pipe_exit_codes(spark, d):
    """Only the exit code of every partition's process, with the lines it was fed."""
    _, body = _header_body(spark, d)
    codes = ex.pipe_exit_codes(body, ["cat"])
    return codes.groupBy("exit_code").agg(F.sum("n_lines").alias("n_lines"))


@query("pipe_multi_output", """
select 'hg38_multianno.txt' as suffix, upper(value) as value from lines where value not like '#%'
union all select 'hg38_multianno.txt', concat_ws(chr(9), 'Chr', 'Start', 'End', 'Ref', 'Alt', 'Gene.refGene', 'Otherinfo1')
  from range(8)
union all select 'hg38_multianno.vcf', value from lines where value not like '#%'
union all select 'hg38_multianno.vcf', '#tool vcf' from range(8)
union all select 'avinput', concat(split_part(value, chr(9), 1), chr(9), split_part(value, chr(9), 2))
  from lines where value not like '#%'""")
def pipe_multi_output(spark, d):
    """One process per partition writing three files; the files come back as rows."""
    _, body = _header_body(spark, d)
    out = ex.pipe_multi_output(body, MULTI_OUTPUT, order=ORDER, partitions=8)
    return out.select("suffix", "value")


@query("pipe_batches", """
select cast(rn // 10 as bigint) as batch_id, cast(rn % 10 as bigint) as line_no, upper(sample) as value
from (select *, row_number() over (order by sample_idx) - 1 as rn from samples)""")
def pipe_batches(spark, d):
    """One process call per batch of 10 samples."""
    s = ix.batch(ix.dense_index(fx.samples(spark, d), ["sample_idx"]), 10)
    return ex.pipe_batches(s.select("batch_id", "pos_in_batch", F.col("sample").alias("value")), UPPER)


UPPER_FILES = ["sh", "-c", "tr a-z A-Z < {in} > {out}.up.txt && wc -l < {in} | tr -d ' '"]


@query("pipe_batches_file", """
with s as (select *, row_number() over (order by sample_idx) - 1 as rn from samples)
select cast(rn // 10 as bigint) as batch_id, 'up.txt' as suffix, cast(rn % 10 as bigint) as line_no, upper(sample) as value from s
union all select cast(rn // 10 as bigint), '', 0, cast(count(*) as varchar) from s group by 1""")
def pipe_batches_file(spark, d):
    """One process call per batch of 10 samples, batch and result as files."""
    s = ix.batch(ix.dense_index(fx.samples(spark, d), ["sample_idx"]), 10)
    return ex.pipe_batches_file(s.select("batch_id", "pos_in_batch", F.col("sample").alias("value")), UPPER_FILES)


@query("job_line_batches", _JOB_LINES)
def job_line_batches(spark, d):
    """Batches of 20000 lines each with the header, one process per batch, merged in order."""
    return jobs.line_batches(fx.vcf_lines(spark, d), ORDER, UPPER_WITH_HEADER, 20000, scanned=True)


@query("job_stream", _JOB_LINES)
def job_stream(spark, d):
    """Headerless lines through one process per partition, header put back."""
    return jobs.stream(fx.vcf_lines(spark, d), ORDER, UPPER_WITH_HEADER)


# declares one INFO field of its own and one that the input has
DECLARING = ["sh", "-c", """echo '##INFO=<ID=EXT,Number=1,Type=String,Description="Added">'
echo '##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth">'; tr a-z A-Z"""]


@query("job_stream_declared", """
with n as (select max(line_no) as cut from ranked_lines where value like '#%')
select line_no + case when line_no >= n.cut then 1 else 0 end as line_no,
       case when value like '#%' then value else upper(value) end as value from ranked_lines, n
union all select cut, '##INFO=<ID=EXT,Number=1,Type=String,Description="Added">' from n""")
def job_stream_declared(spark, d):
    """J2 with a tool that declares INFO fields: the new one is kept before the column line."""
    return jobs.stream(fx.vcf_lines(spark, d), ORDER, DECLARING, declared=True)


@query("job_native_annotate", """
with n as (select max(line_no) as cut from ranked_lines where value like '#%'),
b as (select line_no, string_split(value, chr(9)) as f from ranked_lines where value not like '#%'),
ann as (
  select line_no, string_agg(x, ',' order by x) as ann from (
    select distinct line_no, concat(symbol, '|', biotype) as x
    from b join genes g on b.f[1] = g.chrom and cast(b.f[2] as bigint) <= g."end"
      and cast(b.f[2] as bigint) + length(b.f[4]) - 1 >= g."start") group by line_no)
select line_no + case when line_no >= n.cut then 1 else 0 end as line_no, value from ranked_lines, n where value like '#%'
union all select cut, '##INFO=<ID=ANN,Number=.,Type=String,Description="Overlapping genes: symbol|biotype">' from n
union all select line_no + 1, array_to_string(list_concat(f[1:7], [f[8] || ';ANN=' || coalesce(ann, '.')], f[9:]), chr(9))
from b left join ann using (line_no)""")
def job_native_annotate(spark, d):
    """VCF text to annotated VCF text: scan, parse, join, pack, declare, format."""
    return jobs.native_annotate(fx.vcf_lines(spark, d), fx.genes(spark, d))


_JOB_OUTPUTS_SQL = """
with ann_cols as (select 0 as col_idx, 'Gene.refGene' as name),
{decls}, {patched},
jbody as (select rn, value from {body})
select 'hg38_multianno.txt' as suffix, 'table' as kind, cast(0 as bigint) as line_no,
       concat_ws(chr(9), 'Chr', 'Start', 'End', 'Ref', 'Alt', 'Gene.refGene', 'Otherinfo1') as value
union all select 'hg38_multianno.txt', 'table', rn + 1, upper(value) from jbody
union all select 'hg38_multianno.vcf', 'vcf', line_no, value from patched
union all select 'hg38_multianno.vcf', 'vcf', rn + (select count(*) from patched), value from jbody
union all select 'avinput', 'plain', rn, concat(split_part(value, chr(9), 1), chr(9), split_part(value, chr(9), 2))
  from jbody"""


@query("job_outputs", _JOB_OUTPUTS_SQL.format(decls=_DECLS.strip(), patched=_PATCHED.strip(), body=_BODY_RANKED))
def job_outputs(spark, d):
    """One process per partition with three outputs, merged by kind under an extended header."""
    return jobs.outputs(fx.vcf_lines(spark, d), ORDER, MULTI_OUTPUT)


@query("job_sample_batches", """
select cast(rn // 10 as bigint) as batch_id, cast(rn % 10 as bigint) as line_no, upper(n_name) as value
from (select *, row_number() over (order by n_nationkey) - 1 as rn from nation)""")
def job_sample_batches(spark, d):
    """The file's samples in batches of 10, one process per batch."""
    return jobs.sample_batches(fx.vcf_lines(spark, d), ORDER, UPPER, 10)


@query("job_interval_batches", """
select cast(rn // 3 as bigint) as batch_id, cast(rn % 3 as bigint) as line_no,
       upper(concat(chrom, ':', cast("start" as varchar), '-', cast("end" as varchar))) as value
from (select *, row_number() over (order by gene) - 1 as rn from genes)""")
def job_interval_batches(spark, d):
    """An interval list file read on the executors, batches of 3, one process per batch."""
    return jobs.interval_batches(_interval_file(spark, d), ORDER, UPPER, 3, scanned=True)


def _interval_file(spark, d):
    """The genes as an interval list file, read back on the executors."""
    g = fx.genes(spark, d)
    p = sinks.write_lines(
        g.select("gene", F.concat_ws("", "chrom", F.lit(":"), F.col("start").cast("string"), F.lit("-"),
                                     F.col("end").cast("string")).alias("value")),
        scratch_path(spark, "intervals"), ["gene"])
    return text.read_intervals(spark, p)


@query("job_interval_batches_file", """
with g as (select concat(chrom, ':', cast("start" as varchar), '-', cast("end" as varchar)) as v,
                  row_number() over (order by gene) - 1 as rn from genes)
select cast(rn // 3 as bigint) as batch_id, 'up.txt' as suffix, cast(rn % 3 as bigint) as line_no, upper(v) as value from g
union all select cast(rn // 3 as bigint), '', 0, cast(count(*) as varchar) from g group by 1""")
def job_interval_batches_file(spark, d):
    """J5 with a tool that takes the batch as a file and writes files."""
    return jobs.interval_batches(_interval_file(spark, d), text.LINE_KEY, UPPER_FILES, 3, scanned=True)


# ---------------------------------------------------------------- sinks (written, then read back)

def _write_read(spark, d, compression=None):
    lines = fx.vcf_lines(spark, d)
    p = sinks.write_lines(lines, scratch_path(spark, "single"), ORDER, compression=compression)
    return ix.split_index(text.scan_lines(spark, p), name="line_no").select("line_no", "value")


@query("write_single", "select line_no, value from ranked_lines")
def write_single(spark, d):
    """One ordered text output, written in parallel, read back in order."""
    return _write_read(spark, d)


@query("write_single_gz", "select line_no, value from ranked_lines")
def write_single_gz(spark, d):
    """Same, gzip-compressed."""
    return _write_read(spark, d, "gzip")


@query("write_batches", f"""
select cast(rn // 20000 as bigint) as batch_id, cast(rn % 20000 as bigint) as line_no, value from {_BODY_RANKED}""")
def write_batches(spark, d):
    """One file per batch of 20000 body lines, read back per batch."""
    _, body = _header_body(spark, d)
    b = ix.batch(ix.split_index(body), 20000)
    p = sinks.write_batches(b, scratch_path(spark, "batches"), ["pos_in_batch"])
    back = text.scan_lines(spark, p).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return ix.split_index(back, name="line_no", group=["batch_id"]).select(
        "batch_id", "line_no", "value")


# ---------------------------------------------------------------- benchmark report

_BENCH_CSV_COLS = ["CPU_cores", "Tools", "Running_time_minutes", "CPU_percentage_pct", "Maximum_memory_used_pct"]


def _bench_csv(spark, d):
    """The bench rows written as CSV with a header row, then read with the fixed schema (A5)."""
    b = fx.bench(spark, d).toDF(*_BENCH_CSV_COLS)
    p = scratch_path(spark, "bench_csv")
    b.write.mode("overwrite").option("header", True).csv(p)
    return text.read_csv(spark, p)


def _pivot_sql(metric):
    cols = ", ".join(f"round_even(avg(case when tool = '{t}' then {metric} end), 0) as {t}" for t in "FOP")
    return f"select idx as CPU_cores, {cols} from bench group by idx"


@query("bench_pivot_time", _pivot_sql("time"))
def bench_pivot_time(spark, d):
    """Mean running time per CPU_cores x Tools, rounded half to even."""
    return rp.pivot_mean(_bench_csv(spark, d), "CPU_cores", "Tools", "Running_time_minutes", ["F", "O", "P"])


@query("bench_pivot_cpu", _pivot_sql("cpu"))
def bench_pivot_cpu(spark, d):
    """Mean CPU percentage per CPU_cores x Tools."""
    return rp.pivot_mean(_bench_csv(spark, d), "CPU_cores", "Tools", "CPU_percentage_pct", ["F", "O", "P"])


@query("bench_pivot_mem", _pivot_sql("mem"))
def bench_pivot_mem(spark, d):
    return rp.pivot_mean(_bench_csv(spark, d), "CPU_cores", "Tools", "Maximum_memory_used_pct", ["F", "O", "P"])


@query("bench_sorted", """
select row_number() over (order by mean desc, CPU_cores, Tools) - 1 as rank, CPU_cores, Tools, mean
from (select idx as CPU_cores, tool as Tools, round_even(avg(mem), 2) as mean from bench group by idx, tool)""")
def bench_sorted(spark, d):
    """Means ranked by value before any pivot."""
    return rp.ranked_means(_bench_csv(spark, d), "CPU_cores", "Tools", "Maximum_memory_used_pct")


# ---------------------------------------------------------------- VCF rows

from ..operators import annotate as an  # noqa: E402
from ..functions import vcf as fv  # noqa: E402
from ..operators import vcf  # noqa: E402

_GT = "(['0/0', '0/1', '1/1'])[cast((pos // 7 + {j}) % 3 as int) + 1]"


def _rows(spark, d):
    return vcf.parse(_header_body(spark, d)[1])


@query("vcf_rows", f"""
select chrom, pos, ref, alt, cast(floor(qual) as double) as qual, 'PASS' as filter, rf, dp,
       tax = 0 as notax, 25 as n_samples, {_GT.format(j=0)} as gt0
from variants""")
def vcf_rows(spark, d):
    """Body lines parsed to typed rows (B1), shown flat."""
    r = _rows(spark, d)
    return r.select(
        "chrom", "pos", "ref", F.array_join("alt", ",").alias("alt"), "qual", "filter",
        F.col("info")["RF"].alias("rf"), F.col("info")["DP"].try_cast("int").alias("dp"),
        F.map_contains_key("info", "NOTAX").alias("notax"), F.size("samples").alias("n_samples"),
        fv.sample_field(F.col("format"), F.element_at("samples", 1), "GT").alias("gt0"),
    )


@query("vcf_format", "select value from lines where value not like '#%'")
def vcf_format(spark, d):
    """Typed rows written back as VCF lines: the text round trip."""
    return vcf.format_rows(_rows(spark, d))


_META = r"'^##([A-Za-z_]+)=<(.*)>$'"


@query("vcf_meta", f"""
select regexp_extract(value, {_META}, 1) as kind,
       nullif(regexp_extract(value, '[<,]ID=([^,>]+)', 1), '') as id,
       nullif(regexp_extract(value, '[<,]Number=([^,>]+)', 1), '') as number,
       nullif(regexp_extract(value, '[<,]Type=([^,>]+)', 1), '') as type,
       nullif(regexp_extract(value, '[<,]Description="([^"]*)"', 1), '') as description,
       try_cast(nullif(regexp_extract(value, '[<,]length=([0-9]+)', 1), '') as bigint) as length
from lines where regexp_matches(value, {_META})""")
def vcf_meta(spark, d):
    """Structured header lines as a table (B2)."""
    return vcf.meta(_header_body(spark, d)[0])


def _multi(spark, d):
    """Alleles of the same (chrom, pos, ref) gathered into one multi-allelic row."""
    v = fx.variants(spark, d)
    return v.groupBy("chrom", "pos", "ref").agg(F.array_sort(F.collect_set("alt")).alias("alt"))


_ALLELES = """
alleles as (
  select chrom, pos, ref, cast(unnest(range(1, len(alts) + 1)) as int) as allele_num, unnest(alts) as alt
  from (select chrom, pos, ref, list_sort(list_distinct(list(alt))) as alts from variants group by chrom, pos, ref))"""


def _trim_sql(src: str, cols: str) -> str:
    """Shared suffix then prefix trimmed, in SQL (same rule as functions.vcf.trim_common)."""
    return f"""
t1 as (select {cols}, least(length(ref), length(alt)) as m from {src}),
t2 as (select *, coalesce(nullif(list_position(list_transform(range(1, m + 1),
          lambda i: substr(ref, -i, 1) = substr(alt, -i, 1)), false), 0) - 1, m) as s from t1),
t3 as (select *, substr(ref, 1, length(ref) - s) as r1, substr(alt, 1, length(alt) - s) as a1 from t2),
t4 as (select *, least(length(r1), length(a1)) as m2 from t3),
t5 as (select *, coalesce(nullif(list_position(list_transform(range(1, m2 + 1),
          lambda i: substr(r1, i, 1) = substr(a1, i, 1)), false), 0) - 1, m2) as p from t4),
trimmed as (select *, pos + p as min_pos,
       case when length(r1) = p then '-' else substr(r1, p + 1) end as min_ref,
       case when length(a1) = p then '-' else substr(a1, p + 1) end as min_alt from t5)"""


@query("allele_explode", f"with {_ALLELES} select chrom, pos, ref, allele_num, alt from alleles")
def allele_explode(spark, d):
    """One row per alternative allele with its number."""
    return vcf.explode_alleles(_multi(spark, d))


@query("allele_minimal", f"""
with {_ALLELES}, {_trim_sql('alleles', 'chrom, pos, ref, alt, allele_num')}
select chrom, pos, ref, alt, allele_num, min_pos, min_ref, min_alt from trimmed""")
def allele_minimal(spark, d):
    """Minimal allele representation of every allele."""
    return vcf.minimal(vcf.explode_alleles(_multi(spark, d)))


@query("variant_class", f"""
with {_trim_sql('variants', 'chrom, pos, ref, alt')}
select chrom, pos, ref, alt,
       case when alt like '<%' or alt = '*' then 'sequence_alteration'
            when min_ref = '-' then 'insertion' when min_alt = '-' then 'deletion'
            when length(min_ref) = 1 and length(min_alt) = 1 then 'SNV'
            when length(min_ref) = length(min_alt) then 'substitution' else 'indel' end as variant_class
from trimmed""")
def variant_class(spark, d):
    """SNV / insertion / deletion / substitution class per variant."""
    return vcf.with_class(fx.variants(spark, d).select("chrom", "pos", "ref", "alt")).select(
        "chrom", "pos", "ref", "alt", "variant_class")


@query("sample_subset", f"""
select v.chrom, v.pos, v.ref, v.alt, n.n_name as sample, {_GT.format(j='n.j')} as gt
from variants v, (select n_name, n_regionkey, row_number() over (order by n_nationkey) - 1 as j from nation) n,
     region r
where n.n_regionkey = r.r_regionkey and r.r_name = 'ASIA'""")
def sample_subset(spark, d):
    """Wide genotype columns to long rows, kept to the samples of one region."""
    head, body = _header_body(spark, d)
    names = ln.sample_names(head, ORDER)
    asia = fx.table(spark, d, "nation").join(
        fx.table(spark, d, "region").where(F.col("r_name") == "ASIA"), F.col("n_regionkey") == F.col("r_regionkey"),
        "left_semi").select(F.col("n_name").alias("sample"))
    rows = vcf.parse(body).withColumn("alt", F.array_join("alt", ","))
    return vcf.samples_long(rows, names, keep=asia)


# ---------------------------------------------------------------- annotation joins

_V = "select chrom, pos, ref, alt, qual from variants"


def _v(spark, d):
    return fx.variants(spark, d).select("chrom", "pos", "ref", "alt", "qual")


def _freq(spark, d, flag):
    return fx.variants(spark, d).where(F.col("rf") == flag).select("chrom", "pos", "ref", "alt",
                                                                  F.col("tax").alias("af"))


@query("annotate_exact", f"""
select v.chrom, v.pos, v.ref, v.alt, v.qual, coalesce(cast(k.af as varchar), '.') as af
from ({_V}) v left join known k using (chrom, pos, ref, alt)""")
def annotate_exact(spark, d):
    """Exact (chrom, pos, ref, alt) lookup, '.' when missing."""
    return an.annotate_exact(_v(spark, d), _freq(spark, d, "R"), ["af"])


@query("annotate_existing", f"""
select v.chrom, v.pos, v.ref, v.alt, v.qual, coalesce(e.existing, '.') as existing
from ({_V}) v left join (select chrom, pos, string_agg(distinct id, ',' order by id) as existing
                         from known group by chrom, pos) e using (chrom, pos)""")
def annotate_existing(spark, d):
    """Ids of known variants at the same position."""
    return an.annotate_existing(_v(spark, d), fx.known(spark, d))


@query("annotate_max_af", f"""
select v.chrom, v.pos, v.ref, v.alt, v.qual, r.af as af_r, a.af as af_a, greatest(r.af, a.af) as max_af
from ({_V}) v left join known r using (chrom, pos, ref, alt) left join known_a a using (chrom, pos, ref, alt)""")
def annotate_max_af(spark, d):
    """Two frequency sources and their maximum."""
    return an.annotate_max_af(_v(spark, d), {"af_r": _freq(spark, d, "R"), "af_a": _freq(spark, d, "A")})


@query("annotate_region", f"""
select v.chrom, v.pos, v.ref, v.alt, v.qual, b.band
from ({_V}) v left join bands b on v.chrom = b.chrom and v.pos between b."start" and b."end" """)
def annotate_region(spark, d):
    """Region (band) annotation by interval overlap."""
    return an.annotate_overlap(_v(spark, d), fx.bands(spark, d), ["band"])


@query("annotate_gene", f"""
select v.chrom, v.pos, v.ref, v.alt, v.qual, g.gene, g.symbol, g.biotype
from ({_V}) v left join genes g on v.chrom = g.chrom and v.pos between g."start" and g."end" """)
def annotate_gene(spark, d):
    """Gene symbol and biotype of overlapping genes."""
    return an.annotate_overlap(_v(spark, d), fx.genes(spark, d), ["gene", "symbol", "biotype"])


_DIST_SQL = f"""
select v.chrom, v.pos, v.ref, v.alt, v.qual, g.gene,
       case when v.pos < g."start" then 'upstream' when v.pos > g."end" then 'downstream' else 'within' end
         as relation,
       case when v.pos < g."start" then g."start" - v.pos when v.pos > g."end" then v.pos - g."end" else 0 end
         as distance
from ({_V}) v join genes g on v.chrom = g.chrom
  and v.pos between greatest(g."start" - 5000, 0) and g."end" + 5000"""


@query("annotate_distance", _DIST_SQL)
def annotate_distance(spark, d):
    """Genes within 5000 bases: upstream / within / downstream and distance."""
    return an.annotate_distance(_v(spark, d), fx.genes(spark, d), distance=5000)


@query("annotate_flank", f"""
select v.chrom, v.pos, v.ref, v.alt, v.qual,
       (select max(g."end") from genes g where g.chrom = v.chrom and g."end" < v.pos) as up_end,
       (select min(g."start") from genes g where g.chrom = v.chrom and g."start" > v.pos) as down_start
from ({_V}) v
where not exists (select 1 from genes g where g.chrom = v.chrom and v.pos between g."start" and g."end")""")
def annotate_flank(spark, d):
    """Nearest gene on each side for variants outside every gene."""
    return an.annotate_flank(_v(spark, d), fx.genes(spark, d))


@query("pick_canonical", """
select chrom, pos, ref, alt, qual, gene, transcript from (
  select v.*, t.gene, t.transcript, row_number() over (
      partition by v.chrom, v.pos, v.ref, v.alt, v.qual, v.rf, v.tax, v.dp, t.gene
      order by t.canonical desc, t.transcript) as rn
  from variants v join transcripts t on v.chrom = t.chrom and v.pos between t."start" and t."end")
where rn = 1""")
def pick_canonical(spark, d):
    """One transcript per (variant, gene), canonical first then lowest id."""
    hits = an.annotate_overlap(fx.variants(spark, d), fx.transcripts(spark, d), ["gene", "transcript", "canonical"],
                               how="inner")
    best = an.pick(hits, [*fx.VARIANT_ORDER, "gene"], [F.col("canonical").desc(), F.col("transcript")])
    return best.select("chrom", "pos", "ref", "alt", "qual", "gene", "transcript")


@query("pack_ann", f"""
select chrom, pos, ref, alt,
       string_agg(distinct concat_ws('|', cast(gene as varchar), relation, cast(distance as varchar)), ','
                  order by concat_ws('|', cast(gene as varchar), relation, cast(distance as varchar))) as ANN
from ({_DIST_SQL}) group by chrom, pos, ref, alt""")
def pack_ann(spark, d):
    """All gene annotations of a variant packed in one INFO field."""
    hits = an.annotate_distance(_v(spark, d), fx.genes(spark, d), distance=5000)
    return an.pack(hits, ["chrom", "pos", "ref", "alt"], ["gene", "relation", "distance"])


@query("restrict_intervals", f"""
select chrom, pos, ref, alt, qual from ({_V}) v
where exists (select 1 from bands b where b.chrom = v.chrom and v.pos between b."start" and b."end")""")
def restrict_intervals(spark, d):
    """Variants inside an interval list."""
    return an.restrict(_v(spark, d), fx.bands(spark, d))


@query("prioritise_topk", """
select gene, rank, chrom, pos, ref, alt, qual from (
  select g.gene, v.chrom, v.pos, v.ref, v.alt, v.qual,
         row_number() over (partition by g.gene order by v.qual desc, v.pos, v.ref, v.alt) as rank
  from variants v join genes g on v.chrom = g.chrom and v.pos between g."start" and g."end")
where rank <= 3""")
def prioritise_topk(spark, d):
    """Top 3 variants per gene by quality."""
    hits = an.annotate_overlap(_v(spark, d), fx.genes(spark, d), ["gene"], how="inner")
    top = an.pick(hits, ["gene"], [F.col("qual").desc(), "pos", "ref", "alt"], k=3, rank="rank")
    return top.select("gene", F.col("rank").cast("bigint").alias("rank"), "chrom", "pos", "ref", "alt", "qual")


# ---------------------------------------------------------------- variants with length

_S = 'select chrom, pos, "last", ref, alt, qual from spans'
_OVER = 's.chrom = {t}.chrom and s.pos <= {t}."end" and {t}."start" <= s."last"'


def _s(spark, d):
    return fx.spans(spark, d).select("chrom", "pos", "last", "ref", "alt", "qual")


@query("overlap_spans", f"""
select s.chrom, s.pos, s."last", s.ref, s.alt, s.qual, g.gene
from ({_S}) s left join genes g on {_OVER.format(t='g')}""")
def overlap_spans(spark, d):
    """Genes that share a base with a variant, from one base to whole regions."""
    return an.annotate_overlap(_s(spark, d), fx.genes(spark, d), ["gene"], end="last")


@query("overlap_bands_spans", f"""
select b.band, count(*) as n_variants, min(s.pos) as first_pos, max(s."last") as last_base
from ({_S}) s join bands b on {_OVER.format(t='b')} group by b.band""")
def overlap_bands_spans(spark, d):
    """Variants that reach into each band, intervals of several bin levels on both sides."""
    hits = an.annotate_overlap(_s(spark, d), fx.bands(spark, d), ["band"], how="inner", end="last")
    return hits.groupBy("band").agg(F.count(F.lit(1)).alias("n_variants"), F.min("pos").alias("first_pos"), F.max("last").alias("last_base"))


@query("distance_spans", f"""
select s.chrom, s.pos, s."last", s.ref, s.alt, s.qual, g.gene,
       case when s."last" < g."start" then 'upstream' when s.pos > g."end" then 'downstream' else 'within' end as relation,
       case when s."last" < g."start" then g."start" - s."last" when s.pos > g."end" then s.pos - g."end" else 0 end as distance
from ({_S}) s join genes g on s.chrom = g.chrom and s.pos <= g."end" + 5000 and greatest(g."start" - 5000, 0) <= s."last" """)
def distance_spans(spark, d):
    """Genes within 5000 bases of any base of a variant."""
    return an.annotate_distance(_s(spark, d), fx.genes(spark, d), distance=5000, end="last")


@query("flank_spans", f"""
select s.chrom, s.pos, s."last", s.ref, s.alt, s.qual,
       (select max(g."end") from genes g where g.chrom = s.chrom and g."end" < s.pos) as up_end,
       (select min(g."start") from genes g where g.chrom = s.chrom and g."start" > s."last") as down_start
from ({_S}) s where not exists (select 1 from genes g where {_OVER.format(t='g')})""")
def flank_spans(spark, d):
    """Nearest gene on each side of variants that share no base with a gene."""
    return an.annotate_flank(_s(spark, d), fx.genes(spark, d), end="last")


@query("restrict_spans", f"""
select * from ({_S}) s where exists (select 1 from bands b where {_OVER.format(t='b')})""")
def restrict_spans(spark, d):
    """Variants that share a base with an interval list."""
    return an.restrict(_s(spark, d), fx.bands(spark, d), end="last")


# ---------------------------------------------------------------- fields typed by the header, alleles split

from ..operators import typed  # noqa: E402


def _multi_rows(spark, d):
    """Rows of the multi-allelic VCF file, with its schema read from the file's own header."""
    head, body = ln.split_header_body(text.scan_lines(spark, fx.multi_path(spark, d)))
    rows = vcf.parse(body).withColumn("k", F.col("id").cast("bigint"))
    return rows, typed.header_schema(head, text.LINE_KEY)


def _ints(count, value):
    """A comma-joined list of ``value`` of i, as SQL."""
    return f"array_to_string(list_transform(range(cast({count} as bigint)), lambda i: cast({value} as varchar)), ',')"


@query("vcf_typed_info", f"""
select k, {_ints('case when k % 13 = 0 and n > 1 then n - 1 else n end', '(k + i) % 7')} as ac,
       list_sum(list_transform(range(n), lambda i: cast((k + i) % 100 as double) / 100)) as af_sum,
       cast(list_sum(list_transform(range(n + 1), lambda i: (k * 3 + i) % 50)) as bigint) as ad_sum,
       case when k % 11 <> 0 then cast(k % 200 as int) end as dp, {_ints('(n + 1) * (n + 2) // 2', '(k + 7 * i) % 99')} as pli,
       k % 3 = 0 as db, case when k % 4 = 0 then cast(k % 5 as varchar) end as und
from multi""")
def vcf_typed_info(spark, d):
    """INFO typed by the header's declarations, undeclared keys as text (B1, B2)."""
    rows, schema = _multi_rows(spark, d)
    t = typed.typed_info(rows, schema)
    i = "info_typed."
    total = lambda c, kind: F.aggregate(c, F.lit(0).cast(kind), lambda a, x: a + x)
    return t.select("k", F.array_join(F.transform(i + "AC", lambda x: x.cast("string")), ",").alias("ac"),
                    total(i + "AF", "double").alias("af_sum"), total(i + "AD", "bigint").alias("ad_sum"), F.col(i + "DP").alias("dp"),
                    F.array_join(F.transform(i + "PLI", lambda x: x.cast("string")), ",").alias("pli"), F.col(i + "DB").alias("db"),
                    F.try_element_at("info_rest", F.lit("UND")).alias("und"))


@query("vcf_typed_samples", f"""
select k, cast(j as int) as sample_idx,
       replace(array_to_string(list_transform(range(p), lambda t: cast((k + j + t) % (n + 1) as varchar)), '/'), '/', case when k % 2 = 0 then '|' else '/' end) as gt,
       case when not (j = 2 and k % 6 = 0) then {_ints('n + 1', '(k + j + i) % 60')} end as ad,
       case when not (j = 2 and k % 6 = 0) then cast(list_sum(list_transform(range(cast(g as bigint)), lambda i: (k + j + i) % 90)) as bigint) end as pl_sum
from copies""")
def vcf_typed_samples(spark, d):
    """Samples typed by the header's declarations, one row per sample for comparison (B1)."""
    rows, schema = _multi_rows(spark, d)
    t = typed.typed_samples(rows, schema, keep=["k"])
    s = "sample_typed."
    return t.select("k", "sample_idx", F.col(s + "GT").alias("gt"), F.array_join(F.transform(s + "AD", lambda x: x.cast("string")), ",").alias("ad"),
                    F.aggregate(s + "PL", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("pl_sum"))


@query("vcf_violations", """
select 'INFO' as kind, 'DP' as id, 'type' as problem, count(*) as n from multi where k % 11 = 0 having count(*) > 0
union all select 'INFO', 'AC', 'number', count(*) from multi where k % 13 = 0 and n > 1 having count(*) > 0
union all select 'INFO', 'UND', 'undeclared', count(*) from multi where k % 4 = 0 having count(*) > 0
union all select 'FORMAT', 'XX', 'undeclared', count(*) from copies where not (j = 2 and k % 6 = 0) having count(*) > 0""")
def vcf_violations(spark, d):
    """Values that don't fit their declaration, counted (B2)."""
    rows, schema = _multi_rows(spark, d)
    found = typed.typed_info(rows, schema).select("violations").unionByName(
        typed.typed_samples(rows, schema, keep=[]).select("violations"))
    return typed.violation_counts(found)


# places of the genotypes of alleles 0 and a, by the number of chromosome copies
_PLACES = """case p when 1 then [0, a] when 2 then [0, a * (a + 1) // 2, a + a * (a + 1) // 2]
  else [0, a * (a + 1) * (a + 2) // 6, a * (a + 1) // 2 + a * (a + 1) * (a + 2) // 6,
        a + a * (a + 1) // 2 + a * (a + 1) * (a + 2) // 6] end"""


@query("allele_split", f"""
with s as (
  select *, ['C', 'G', 'T', 'AT'][a] as alt, {_PLACES} as places from (select *, unnest(range(1, n + 1)) as a from copies)),
w as (
  select *, [0, a * (a + 1) // 2, a + a * (a + 1) // 2] as two, concat_ws(':', replace(array_to_string(list_transform(range(p), lambda t: case
      when (k + j + t) % (n + 1) = 0 then '0' when n = 1 or (k + j + t) % (n + 1) = a then '1' else '.' end), '/'), '/', case when k % 2 = 0 then '|' else '/' end),
    case when not (j = 2 and k % 6 = 0) then concat_ws(':', concat((k + j) % 60, ',', (k + j + a) % 60),
      array_to_string(list_transform(places, lambda i: cast((k + j + i) % 90 as varchar)), ','), concat('u', j)) end) as sample
  from s)
select k, cast(a as int) as allele_num, any_value(alt) as alt, string_agg(sample, ' ' order by j) as samples,
       any_value(concat('AC=', case when k % 13 = 0 and n > 1 then {_ints('n - 1', '(k + i) % 7')} else cast((k + a - 1) % 7 as varchar) end,
         ';AF=0.', lpad(cast((k + a - 1) % 100 as varchar), 2, '0'), ';AD=', (k * 3) % 50, ',', (k * 3 + a) % 50,
         ';DP=', case when k % 11 = 0 then 'x' else cast(k % 200 as varchar) end,
         ';PLI=', array_to_string(list_transform(two, lambda i: cast((k + 7 * i) % 99 as varchar)), ','),
         case when k % 3 = 0 then ';DB' else '' end, case when k % 4 = 0 then concat(';UND=', k % 5) else '' end)) as info
from w group by rid, k, n, a""")
def allele_split(spark, d):
    """One row per alternative allele with its own A, R and G values and genotypes."""
    rows, schema = _multi_rows(spark, d)
    return typed.split_alleles(rows, schema).select("k", "allele_num", F.array_join("alt", ",").alias("alt"),
                                                    fv.info_text(F.col("info")).alias("info"), F.array_join("samples", " ").alias("samples"))


# ---------------------------------------------------------------- compressed scan, single files

from ..sources import bgzf  # noqa: E402


@query("scan_bgzf", "select line_no, value from ranked_lines")
def scan_bgzf(spark, d):
    """The VCF as block-gzip files, read by ranges of compressed bytes (A1)."""
    p = bgzf.write_bgzf(fx.vcf_lines(spark, d), scratch_path(spark, "bgzf"), ORDER)
    return ix.split_index(bgzf.scan_bgzf(spark, p, range_bytes=1 << 18), name="line_no").select("line_no", "value")


def _one_file(spark, d, name, compression=None):
    p = sinks.write_file(fx.vcf_lines(spark, d), f"{scratch_path(spark, 'one')}/{name}", ORDER, compression=compression)
    return ix.split_index(bgzf.read_lines(spark, p), name="line_no").select("line_no", "value")


@query("write_one_file", "select line_no, value from ranked_lines")
def write_one_file(spark, d):
    """One ordered file, put together by many tasks, read back."""
    return _one_file(spark, d, "out.vcf")


@query("write_one_file_gz", "select line_no, value from ranked_lines")
def write_one_file_gz(spark, d):
    """One ordered gzip file, read back."""
    return _one_file(spark, d, "out.vcf.gz", "gzip")


@query("write_by_suffix", f"""
with {_ANN_COLS}, {_DECLS}, {_PATCHED}
select suffix, line_no, value from ({_TABLE_MERGE})
union all select suffix, line_no, value from ({_VCF_MERGE})
union all select suffix, line_no, value from ({_PLAIN_MERGE})""")
def write_by_suffix(spark, d):
    """The routed merge written as one file per suffix, each read back by its name."""
    merged = mg.merge_routed(_parts(spark, d), _patched_header(spark, d), ["line_no"])
    p = sinks.write_files(merged, scratch_path(spark, "suffixes"), "suffix", ["line_no"])
    back = text.scan_lines(spark, p).withColumn("suffix", F.element_at(F.split("file", "/"), -1))
    return ix.split_index(back, name="line_no", group=["suffix"]).select("suffix", "line_no", "value")


@query("read_parts", """
select part, suffix, row_number() over (partition by part, suffix order by line_no) - 1 as line_no, value from all_parts""")
def read_parts(spark, d):
    """Part files ``<part>.<suffix>`` written and read back, lines numbered per file."""
    named = _parts(spark, d).withColumn("name", F.concat_ws(".", F.col("part").cast("string"), "suffix"))
    p = sinks.write_files(named, scratch_path(spark, "parts"), "name", ["line_no"])
    return text.read_parts(spark, p)


# ---------------------------------------------------------------- coordinate order, several files as one

from ..operators import cohort  # noqa: E402


@query("coordinate_order", """
select row_number() over (order by cast(substr(chrom, 4) as int), pos, ref, alt, qual, rf, tax, dp) - 1 as idx, chrom, pos, ref, alt from variants""")
def coordinate_order(spark, d):
    """Variants numbered in coordinate order: contigs as the header lists them, chr2 before chr10."""
    ranks = cohort.contig_ranks(_header_body(spark, d)[0], ORDER)
    rows = cohort.with_contig_rank(fx.variants(spark, d), ranks)
    return ix.dense_index(rows, [*cohort.COORDINATES, "qual", "rf", "tax", "dp"]).select("idx", "chrom", "pos", "ref", "alt")


def _two_files(spark, d):
    """The VCF as two files: odd positions with samples 0 to 14, even ones with samples 24 down to 10 and an own header."""
    head, body = _header_body(spark, d)
    cut = F.split("value", "\t")
    root = scratch_path(spark, "cohort")

    def part(name, rows, samples, declared):
        # cut once: named in a lambda, where each F.get of the expression itself would cut the line again
        kept = F.transform(F.array(cut), lambda c: F.array_join(F.concat(F.slice(c, 1, 9), F.array(*[F.get(c, F.lit(9 + i)) for i in samples])), "\t"))[0]
        line = F.when(F.col("value").startswith("##"), declared).otherwise(kept)
        both = head.unionByName(rows).select("line_no", "value")
        # the line is cut once, when it is written
        return sinks.write_file(both, f"{root}/{name}", ORDER, value=line.alias("value"), partitions=fx.file_parts(spark, d))

    pos = F.get(F.split("value", "\t", 3), F.lit(1)).try_cast("bigint")
    one = part("a.vcf", body.where(pos % 2 == 1), range(15), F.col("value"))
    two = part("b.vcf", body.where(pos % 2 == 0), range(24, 9, -1), F.regexp_replace(
        F.regexp_replace("value", "ID=DP,Number=1,Type=Integer", "ID=DP,Number=1,Type=Float"), "ID=RF,", "ID=RF2,"))
    return text.scan_lines(spark, [one, two])


@query("merge_cohort", """
with m as (
  select chrom, pos, ref, alt, row_number() over () as tie, string_split(value, chr(9)) as f from body),
b as (
  select *, concat_ws(chr(9), array_to_string(f[1:9], chr(9)), array_to_string(list_transform(range(25), lambda i:
    case when pos % 2 = 1 then case when (case when i < 15 then i else 39 - i end) < 15 then f[10 + i] else '.' end
         else case when i >= 15 then f[10 + 39 - i] when i >= 10 then f[10 + i] else '.' end end), chr(9))) as value from m),
n as (select list(n_name order by n_nationkey) as names from nation),
h as (
  select line_no, value from ranked_lines where value like '##%'
  union all select 1.5, replace(value, 'ID=RF,', 'ID=RF2,') from ranked_lines where value like '##INFO=<ID=RF,%')
select chrom, pos, value from b
union all select null, null, value from h
union all select null, null, concat(array_to_string(['#CHROM', 'POS', 'ID', 'REF', 'ALT', 'QUAL', 'FILTER', 'INFO', 'FORMAT'], chr(9)), chr(9),
  array_to_string(list_transform(range(25), lambda i: names[1 + case when i < 15 then i else 39 - i end]), chr(9))) from n""")
def merge_cohort(spark, d):
    """Two files with different headers and samples as one file's lines."""
    return cohort.merge_files(_two_files(spark, d)).select("chrom", "pos", "value")


@query("header_conflicts", "select 'INFO' as kind, 'DP' as id, '1/Float, 1/Integer' as declared from region limit 1")
def header_conflicts(spark, d):
    """Fields that the two files declare differently."""
    return cohort.header_conflicts(_two_files(spark, d))


# ---------------------------------------------------------------- resumable batches

@query("job_ledger", _JOB_LINES)
def job_ledger(spark, d):
    """J1 with a ledger, run twice: the second run finds every batch done and returns the same output."""
    folder = scratch_path(spark, "ledger")
    jobs.line_batches(fx.vcf_lines(spark, d), ORDER, UPPER_WITH_HEADER, 20000, scanned=True, ledger=folder)
    return jobs.line_batches(fx.vcf_lines(spark, d), ORDER, ["false"], 20000, scanned=True, ledger=folder)


@query("pipe_batches_lived", """
select cast(rn // 10 as bigint) as batch_id, cast(rn % 10 as bigint) as line_no, upper(sample) as value
from (select *, row_number() over (order by sample_idx) - 1 as rn from samples)""")
def pipe_batches_lived(spark, d):
    """Batches of 10 samples through one process per task."""
    s = ix.batch(ix.dense_index(fx.samples(spark, d), ["sample_idx"]), 10)
    return ex.pipe_batches_lived(s.select("batch_id", "pos_in_batch", F.col("sample").alias("value")), ["sed", "-u", "s/.*/\\U&/"])


# ---------------------------------------------------------------- batches of equal weight

_BALANCED = """
with w as (
  select chrom, gene, "end" - "start" + 1 as len, coalesce(sum("end" - "start" + 1) over (partition by chrom order by "start", gene
           rows between unbounded preceding and 1 preceding), 0) as before, sum("end" - "start" + 1) over (partition by chrom) as total from genes),
g as (
  select chrom, coalesce(sum(cuts) over (order by chrom rows between unbounded preceding and 1 preceding), 0) as first, cuts
  from (select chrom, greatest(1, max((total + 19999) // 20000)) as cuts from w group by chrom))
select cast(first + least(before * cuts // total, cuts - 1) as bigint) as batch_id, any_value(chrom) as chrom, count(*) as n_intervals,
       cast(sum(len) as bigint) as bases, min(gene) as first_gene, max(gene) as last_gene
from w join g using (chrom) group by 1"""


@query("batch_balanced", _BALANCED)
def batch_balanced(spark, d):
    """Intervals in batches of nearly 20000 bases, none over two contigs."""
    b = ix.balanced_batches(fx.genes(spark, d), ["start", "gene"], F.col("end") - F.col("start") + 1, 20000, group=["chrom"])
    return b.groupBy("batch_id").agg(F.first("chrom").alias("chrom"), F.count(F.lit(1)).alias("n_intervals"), F.sum("weight").alias("bases"),
                                     F.min("gene").alias("first_gene"), F.max("gene").alias("last_gene"))
