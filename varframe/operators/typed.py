"""INFO and FORMAT fields typed by the header's declarations, and values realigned when alleles are split.

A declaration gives a field its type (Integer: int, Float: double, Flag: boolean, String and
Character: string) and its ``Number``: 1 is a plain value, everything else an array (n values,
A one per alternative allele, R one per allele, G one per genotype, ``.`` any). ``.`` is NULL, as
a whole value or as an element. Values that don't fit their declaration become NULL where
they can't be read, and are reported, never dropped silently: ``violations`` lists them per row.

Genotypes are ordered as VCF orders them, for any ploidy p: a genotype with sorted alleles
k1 <= ... <= kp stands at sum over m of C(k_m + m - 1, m), so there are C(alleles + p - 1, p).

Everything is column expressions over the parsed rows, but for the values of split alleles, which ``alleles`` cuts from
whole batches; the header, bounded by its nature, is read when the schema is made.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vcf as fv
from . import alleles
from .lines import header_lines

SQL_TYPES = {"Integer": "int", "Float": "double", "Flag": "boolean"}
INTEGER = r"^[-+]?[0-9]+$"
FLOAT = r"^(?i)[-+]?([0-9]+[.]?[0-9]*|[.][0-9]+)(e[-+]?[0-9]+)?$|^(?i)[-+]?(inf|infinity|nan)$"
# a list of numbers that both types can read
PLAIN_LIST = r"^(?:[.]|[-+]?[0-9]{1,9})(?:,(?:[.]|[-+]?[0-9]{1,9}))*$"
STRUCTURED = re.compile(r"^##(INFO|FORMAT)=<(.*)>$")


@dataclass(frozen=True)
class Field:
    kind: str
    id: str
    number: str
    type: str

    @property
    def is_flag(self) -> bool:
        return self.type == "Flag" or self.number == "0"

    @property
    def is_array(self) -> bool:
        return not self.is_flag and self.number != "1"

    @property
    def sql_type(self) -> str:
        one = "boolean" if self.is_flag else SQL_TYPES.get(self.type, "string")
        return f"array<{one}>" if self.is_array else one


@dataclass(frozen=True)
class HeaderSchema:
    """The declared INFO and FORMAT fields of a header, in its order; the first declaration of an ID counts."""

    info: dict[str, Field] = field(default_factory=dict)
    format: dict[str, Field] = field(default_factory=dict)


def schema_of(lines: Iterable[str]) -> HeaderSchema:
    """The schema that header lines declare; a declaration without ID, Number or Type is no declaration."""
    out = HeaderSchema()
    for line in lines:
        if m := STRUCTURED.match(line):
            at = {k: re.search(rf"(?:^|,){k}=([^,>]+)", m[2]) for k in ("ID", "Number", "Type")}
            if all(at.values()):
                f = Field(m[1], *(at[k][1] for k in ("ID", "Number", "Type")))
                (out.info if m[1] == "INFO" else out.format).setdefault(f.id, f)
    return out


def header_schema(head: DataFrame, order: Sequence[str]) -> HeaderSchema:
    return schema_of(header_lines(head, order))


# ---------------------------------------------------------------- values

def _one(text: Column, f: Field) -> Column:
    if f.type == "Integer":
        return F.when(text.rlike(INTEGER), text.try_cast("int"))
    if f.type == "Float":
        return F.when(text.rlike(FLOAT), text.try_cast("double"))
    return fv.missing_to_null(text)


def typed_value(text: Column, f: Field) -> Column:
    """A field's text as its declared type; flags aren't texts."""
    if f.is_array:
        return F.when(text != fv.MISSING, F.transform(F.split(text, ","), lambda x: _one(x, f)))
    return _one(text, f)


def genotypes(alleles: Column, ploidy: Column) -> Column:
    """Number of genotypes of ``alleles`` alleles (the reference counts): C(alleles + ploidy - 1, ploidy)."""
    a = alleles.cast("bigint")
    return F.when(ploidy == 1, a).when(ploidy == 2, F.call_function("shiftright", a * (a + 1), F.lit(1))).otherwise(choose(alleles + ploidy - 1, ploidy))


def choose(n: Column, k: Column) -> Column:
    """Binomial coefficient for 0 <= k <= n, by k whole steps."""
    steps = F.when(k > 0, F.sequence(F.lit(1), k.cast("int"))).otherwise(F.array().cast("array<int>"))
    # n - k + i is the i-th factor, and every partial product is a binomial coefficient, so the division is exact
    return F.aggregate(steps, F.lit(1).cast("bigint"), lambda acc, i: F.floor(acc * (n - k + i) / i).cast("bigint"))


def expected_count(f: Field, n_alt: Column, n_genotypes: Column) -> Column | None:
    if f.number == "A":
        return n_alt
    if f.number == "R":
        return n_alt + 1
    if f.number == "G":
        return n_genotypes
    return F.lit(int(f.number)) if f.number.isdigit() else None


def problem_of(text: Column, present: Column, f: Field, n_alt: Column, n_genotypes: Column) -> Column:
    """What is wrong with a field: ``value`` (a flag has one, another field has none), ``type``, ``number``, or NULL."""
    if f.is_flag:
        return F.when(present & text.isNotNull(), F.lit("value"))
    parts = F.split(text, ",")
    given = present & text.isNotNull() & (text != fv.MISSING)
    wrong = F.when(present & text.isNull(), F.lit("value"))
    if f.type in ("Integer", "Float"):
        # most lists are judged as one text; elements are looked at when that doesn't settle it
        bad = ~text.rlike(PLAIN_LIST) & F.exists(parts, lambda x: (x != fv.MISSING) & _one(x, f).isNull()) if f.is_array else _one(text, f).isNull()
        wrong = wrong.when(given & bad, F.lit("type"))
    if f.is_array and (count := expected_count(f, n_alt, n_genotypes)) is not None:
        wrong = wrong.when(given & (F.size(parts) != count), F.lit("number"))
    return wrong


VIOLATION = "struct<kind: string, id: string, problem: string, value: string>"


def _violation(kind: str, id_: Column, problem: Column, value: Column) -> Column:
    return F.when(problem.isNotNull(), F.struct(F.lit(kind).alias("kind"), id_.alias("id"), problem.alias("problem"), value.alias("value")))


def _violations(found: Sequence[Column]) -> Column:
    return F.array_compact(F.array(*found)) if found else F.array().cast(f"array<{VIOLATION}>")


def _judged(rows: DataFrame, kind: str, fields: Sequence[Field], text, there, n_alt: Column, n_genotypes: Column) -> tuple[DataFrame, Column]:
    """``rows`` with a column ``_b<i>`` for what is wrong with each field, and the violations as a column of those.

    The problems are columns of their own, computed once; the array is only made of rows that have one.
    """
    marked = rows.withColumns({f"_b{i}": problem_of(text(f), there(f), f, n_alt, n_genotypes) for i, f in enumerate(fields)})
    found = [F.col(f"_b{i}") for i in range(len(fields))]
    if not found:
        return marked, _violations([])
    listed = _violations([_violation(kind, F.lit(f.id), b, text(f)) for b, f in zip(found, fields, strict=True)])
    return marked, F.when(F.coalesce(*found, F.lit(None).cast("string")).isNull(), F.array().cast(f"array<{VIOLATION}>")).otherwise(listed)


def _n_alt() -> Column:
    return F.coalesce(F.size("alt"), F.lit(0))


def typed_info(rows: DataFrame, schema: HeaderSchema, fields: Sequence[str] | None = None) -> DataFrame:
    """Parsed rows with ``info_typed`` (a struct of the declared fields, or of ``fields``), ``info_rest``
    (undeclared keys as text) and ``violations``, an array of (kind, id, problem, value).

    An absent field is NULL, an absent flag false. G counts of INFO fields are those of two chromosome copies.
    """
    info = F.col("info")
    at = {f.id: i for i, f in enumerate(schema.info.values())}
    text = lambda f: F.col(f"_t{at[f.id]}")
    there = lambda f: F.col(f"_h{at[f.id]}")
    chosen = [schema.info[x] for x in (schema.info if fields is None else fields)]
    values = [(there(f) if f.is_flag else typed_value(text(f), f)).alias(f.id) for f in chosen]
    rest = F.map_filter(info, lambda k, v: ~k.isin(*schema.info)) if schema.info else info
    counted = rows.withColumn("_n", _n_alt()).withColumn("_g", genotypes(F.col("_n") + 1, F.lit(2))).withColumn("info_rest", rest)
    # every field is looked up once
    counted = counted.withColumns({f"_t{i}": F.try_element_at(info, F.lit(x)) for x, i in at.items()}
                                  | {f"_h{i}": F.map_contains_key(info, F.lit(x)) for x, i in at.items()})
    counted, known = _judged(counted, "INFO", list(schema.info.values()), text, there, F.col("_n"), F.col("_g"))
    unknown = F.transform(F.map_entries("info_rest"), lambda e: _violation("INFO", e["key"], F.lit("undeclared"), e["value"]))
    return counted.withColumn("info_typed", F.struct(*values) if values else F.lit(None)).withColumn(
        "violations", F.concat(known, unknown)).drop("_n", "_g", *[f"_{x}{i}" for x in "thb" for i in at.values()])


def _gt_place() -> Column:
    return F.array_position(F.coalesce("format", F.array().cast("array<string>")), F.lit("GT")).cast("int")


def ploidy_of(values: Column, gt_at: Column) -> Column:
    """Chromosome copies of a sample by its genotype; NULL where it has none."""
    gt = F.get(values, gt_at - 1)
    return F.when((gt_at > 0) & (gt != fv.MISSING), F.size(F.split(gt, "[/|]")))


def typed_samples(rows: DataFrame, schema: HeaderSchema, keep: Sequence[str], fields: Sequence[str] | None = None) -> DataFrame:
    """One row per row and sample: ``keep``, ``sample_idx``, ``sample_typed`` (a struct of the declared FORMAT fields,
    or of ``fields``), ``sample_rest`` (undeclared keys as text) and ``violations``.

    Trailing fields that a sample leaves out are NULL and break nothing; without a genotype its number of
    chromosome copies is unknown, so its G counts aren't judged.
    """
    chosen = [schema.format[x] for x in (schema.format if fields is None else fields)]
    at = {f.id: f"_k{i}" for i, f in enumerate(schema.format.values())}
    places = [F.array_position("format", F.lit(f)).cast("int").alias(c) for f, c in at.items()]
    one = rows.select(*keep, "format", _n_alt().alias("_n"), _gt_place().alias("_gt"), *places,
                      # not the bare column: its own filter would be planned down to the scan, cutting every line again
                      F.posexplode(F.coalesce("samples", F.array().cast("array<string>"))).alias("sample_idx", "_s"))
    one = one.withColumn("_v", F.split("_s", ":")).withColumn("_p", ploidy_of(F.col("_v"), F.col("_gt")))
    one = one.withColumn("_g", F.when(F.col("_p").isNotNull(), genotypes(F.col("_n") + 1, F.coalesce("_p", F.lit(2)))))
    one = one.withColumns({f"_t{c}": F.when(F.col(c) > 0, F.get("_v", F.col(c) - 1)) for c in at.values()})
    text = lambda f: F.col(f"_t{at[f.id]}")
    values = [(text(f).isNotNull() if f.is_flag else typed_value(text(f), f)).alias(f.id) for f in chosen]
    one, known = _judged(one, "FORMAT", list(schema.format.values()), text, lambda f: text(f).isNotNull(), F.col("_n"), F.col("_g"))
    undeclared = F.filter(F.arrays_zip(F.slice("format", 1, F.size("_v")).alias("id"), F.col("_v").alias("value")),
                          lambda e: e["id"].isNotNull() & ~e["id"].isin(*schema.format))
    one = one.withColumn("_rest", undeclared)
    unknown = F.transform("_rest", lambda e: _violation("FORMAT", e["id"], F.lit("undeclared"), e["value"]))
    return one.select(*keep, "sample_idx", (F.struct(*values) if values else F.lit(None)).alias("sample_typed"),
                      F.map_from_entries("_rest").alias("sample_rest"), F.concat(known, unknown).alias("violations"))


def violation_counts(rows: DataFrame) -> DataFrame:
    """``kind, id, problem, n`` over the rows' ``violations``."""
    # grouped by the whole struct: asked for its fields, the planner would compute the violations once for each
    one = F.transform("violations", lambda v: F.struct(v["kind"].alias("kind"), v["id"].alias("id"), v["problem"].alias("problem")))
    return rows.select(F.explode(one).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n")).select("v.*", "n")


# ---------------------------------------------------------------- alleles

def genotype_places(allele: Column, ploidy: Column) -> Column:
    """Places of the genotypes of the reference and ``allele`` alone, from no copy of the allele to all."""
    one_more = lambda m: choose(allele + m - 1, m)
    return F.transform(F.sequence(F.lit(0), ploidy), lambda copies: F.when(copies == 0, F.lit(0).cast("bigint")).otherwise(
        F.aggregate(F.sequence(ploidy - F.greatest(copies, F.lit(1)) + 1, ploidy), F.lit(0).cast("bigint"), lambda acc, m: acc + one_more(m))))


def split_alleles(rows: DataFrame, schema: HeaderSchema, other: str = fv.MISSING) -> DataFrame:
    """One row per alternative allele (B4), with the values of that allele alone.

    ``alt`` keeps one allele and ``allele_num`` says which it was. A fields lose the other alleles'
    values, R fields keep the reference's and the allele's, G fields keep the genotypes of these
    two; G of a sample follows its genotype's ploidy, or its own count where there is none, of INFO two copies. In genotypes the allele becomes 1, other
    alternative alleles ``other``. Rows with one alternative allele keep their text unchanged; rows without
    one are kept, with allele number NULL. A value whose count isn't the declared one stays as it is
    (``typed_info`` and ``typed_samples`` report it).
    """
    def kinds(fields):
        return {x: alleles.KINDS[f.number] for x, f in fields.items() if f.number in alleles.KINDS}

    info_kinds, format_kinds = kinds(schema.info), kinds(schema.format)

    def own(n, keys, values, formats, samples):
        return alleles.own_values(n, keys, values, formats, samples, info_kinds, format_kinds, other)

    keep = [c for c in rows.columns if c not in ("alt", "info", "samples")]
    # rows with one alternative allele hand nothing over
    several = F.size("alt") > 1
    given = [F.when(several, c) for c in (F.size("alt"), F.map_keys("info"), F.map_values("info"), F.col("format"), F.col("samples"))]
    one = rows.withColumn("_own", F.arrow_udf(own, "array<struct<info: map<string,string>, samples: array<string>>>")(*given))
    one = one.select("*", F.posexplode_outer("alt").alias("_i", "_alt"))
    of_allele = F.get("_own", F.col("_i"))
    return one.select(
        *keep, (F.col("_i") + 1).cast("int").alias("allele_num"), F.when(F.col("_alt").isNotNull(), F.array("_alt")).alias("alt"),
        *[F.when(several, of_allele[c]).otherwise(F.col(c)).alias(c) for c in ("info", "samples")])
