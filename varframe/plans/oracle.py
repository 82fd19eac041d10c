"""The fixture views of ``fixtures.py`` as DuckDB SQL, and a helper to prefix them.

Only the checking side uses this module: every query in ``__spark_entry__`` has an
SQL twin built from these views over the same parquet tables.
"""

from __future__ import annotations

_BASE = "substr('ACGT', cast(l_linenumber % 4 + 1 as int), 1)"
_ALT = "substr('ACGT', cast((l_linenumber + 1 + l_suppkey % 3) % 4 + 1 as int), 1)"

VIEWS: dict[str, str] = {
    "variants": f"""
select concat('chr', cast(l_partkey % 22 + 1 as varchar)) as chrom,
       l_orderkey * 100 + l_linenumber * 7 as pos,
       case when l_quantity <= 5 then concat({_BASE}, 'GG') else {_BASE} end as ref,
       case when l_quantity >= 40 then concat({_BASE}, 'TT')
            when l_quantity <= 5 then {_BASE}
            else {_ALT} end as alt,
       l_extendedprice as qual, l_returnflag as rf, l_tax as tax,
       cast(floor(l_quantity) as int) as dp
from lineitem""",
    "spans": """
select *, pos + length(ref) - 1 + case when dp <= 4 then cast(floor(qual) as bigint) * dp * dp * dp * dp else 0 end as "last"
from variants""",
    "multi": """
select row_number() over () as rid, l_orderkey * 1000000 + l_linenumber * 100000 + l_partkey as k, cast(1 + (l_orderkey + l_linenumber) % 4 as int) as n,
       concat('chr', cast(l_partkey % 22 + 1 as varchar)) as chrom, l_orderkey * 100 + l_linenumber * 7 as pos
from lineitem""",
    "copies": """
select *, cast((k + j) % 3 + 1 as int) as p, case (k + j) % 3 when 0 then n + 1 when 1 then (n + 1) * (n + 2) // 2
       else (n + 1) * (n + 2) * (n + 3) // 6 end as g
from multi, (select unnest(range(3)) as j)""",
    "genes": """
select p_partkey as gene, concat('chr', cast(p_partkey % 22 + 1 as varchar)) as chrom,
       p_partkey * 750 as "start", p_partkey * 750 + p_size * 100 as "end",
       p_name as symbol, p_type as biotype
from part""",
    "transcripts": """
select p_partkey as gene, p_partkey * 10 + t as transcript,
       concat('chr', cast(p_partkey % 22 + 1 as varchar)) as chrom,
       p_partkey * 750 + t * 10 as "start", p_partkey * 750 + p_size * 100 as "end",
       (p_partkey + t) % 3 = 0 as canonical
from (select p_partkey, p_size, unnest(range(0, p_size % 3 + 1)) as t from part)""",
    "bands": """
select s_suppkey as band, concat('chr', cast(s_nationkey % 22 + 1 as varchar)) as chrom,
       s_suppkey * 15000 as "start", s_suppkey * 15000 + 14999 as "end"
from supplier""",
    "known": """
select chrom, pos, ref, alt, max(tax) as af, concat('rs', cast(pos as varchar), '_', alt) as id
from variants where rf = 'R' group by chrom, pos, ref, alt""",
    "known_a": """
select chrom, pos, ref, alt, max(tax) as af
from variants where rf = 'A' group by chrom, pos, ref, alt""",
    "samples": "select c_custkey as sample_idx, c_name as sample from customer",
    "body": """
select chrom, pos, ref, alt, qual, rf, tax, dp,
  concat_ws(chr(9), chrom, cast(pos as varchar), '.', ref, alt,
    cast(cast(floor(qual) as bigint) as varchar), 'PASS',
    concat('RF=', rf, ';DP=', cast(dp as varchar), case when tax = 0 then ';NOTAX' else '' end),
    'GT',
    array_to_string(list_transform(range(0, 25),
        lambda j: (['0/0', '0/1', '1/1'])[cast((pos // 7 + j) % 3 as int) + 1]), chr(9))) as value
from variants""",
    "lines": """
select 0 as section, cast(seq as bigint) as seq, value from (values
  (0, '##fileformat=VCFv4.2'),
  (10, '##INFO=<ID=RF,Number=1,Type=String,Description="Return flag">'),
  (11, '##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth">'),
  (12, '##INFO=<ID=NOTAX,Number=0,Type=Flag,Description="No tax">'),
  (50, '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">')) t(seq, value)
union all
select 0, cast(r_regionkey + 20 as bigint),
       concat('##INFO=<ID=REGION_', r_name, ',Number=0,Type=Flag,Description="Region ', r_name, '">')
from region
union all
select 0, cast(substr(chrom, 4, 3) as bigint) + 100,
       concat('##contig=<ID=', chrom, ',length=', cast(max(pos) + 1 as varchar), '>')
from variants group by chrom
union all
select 1, cast(0 as bigint),
       concat('#CHROM', chr(9), 'POS', chr(9), 'ID', chr(9), 'REF', chr(9), 'ALT', chr(9), 'QUAL', chr(9),
              'FILTER', chr(9), 'INFO', chr(9), 'FORMAT', chr(9),
              string_agg(n_name, chr(9) order by n_nationkey))
from nation
union all
select 2, pos, value from body""",
    "ranked_lines": """
select section, seq, value, row_number() over (order by section, seq, value) - 1 as line_no
from lines""",
    "parts": """
select * from (
  select cast(o_orderkey % 8 as int) as part,
         coalesce(case o_orderpriority when '1-URGENT' then 'hg38_multianno.txt'
                  when '2-HIGH' then 'hg38_multianno.csv'
                  when '3-MEDIUM' then 'hg38_multianno.vcf' end, 'avinput') as suffix,
         o_orderkey // 8 + 1 as line_no,
         o_orderkey, o_orderstatus, o_custkey
  from orders) o, lateral (
  select case when suffix like '%csv' then concat_ws(',', concat('chr', cast(o_custkey % 22 + 1 as varchar)),
                   cast(o_orderkey * 10 as varchar), cast(o_orderkey * 10 + 1 as varchar), 'A', 'G',
                   o_orderstatus, cast(o_custkey as varchar))
              else concat_ws(chr(9), concat('chr', cast(o_custkey % 22 + 1 as varchar)),
                   cast(o_orderkey * 10 as varchar), cast(o_orderkey * 10 + 1 as varchar), 'A', 'G',
                   o_orderstatus, cast(o_custkey as varchar)) end as value)""",
    "all_parts": """
select part, suffix, line_no, value from parts
union all
select distinct part, suffix, cast(0 as bigint) as line_no,
  case when suffix like '%csv' then 'Chr,Start,End,Ref,Alt,Func.refGene,Gene.refGene,cytoBand,Otherinfo1,Otherinfo2'
       when suffix like '%vcf' then concat('#CHROM', chr(9), 'POS', chr(9), 'ID', chr(9), 'REF', chr(9), 'ALT',
                                           chr(9), 'QUAL', chr(9), 'FILTER', chr(9), 'INFO')
       else concat_ws(chr(9), 'Chr', 'Start', 'End', 'Ref', 'Alt', 'Func.refGene', 'Gene.refGene', 'cytoBand',
                      'Otherinfo1', 'Otherinfo2') end
from parts where suffix not like '%avinput'""",
    "bench": """
select o_orderpriority as idx, o_orderstatus as tool, o_totalprice as time,
       cast(o_custkey as double) as cpu, cast(o_orderkey as double) as mem
from orders""",
}


def sql(body: str) -> str:
    """Prefix ``body`` with every fixture view as a CTE (DuckDB skips unused ones)."""
    ctes = ",\n".join(f"{name} as ({text})" for name, text in VIEWS.items())
    b = body.strip()
    if b[:5].lower() == "with ":
        return f"with {ctes},\n{b[5:]}"
    return f"with {ctes}\n{b}"
