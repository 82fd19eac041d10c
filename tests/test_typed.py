"""Fields typed by the header, and values realigned when alleles are split, against brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from varframe.operators import typed, vcf

HEAD = ["##fileformat=VCFv4.2",
        '##INFO=<ID=AC,Number=A,Type=Integer,Description="Count, with Number=2,Type=Float inside">',
        '##INFO=<ID=AD,Number=R,Type=Float,Description="x">', '##INFO=<ID=GL,Number=G,Type=Float,Description="x">',
        '##INFO=<ID=DP,Number=1,Type=Integer,Description="x">', '##INFO=<ID=DP,Number=.,Type=String,Description="again">',
        '##INFO=<ID=DB,Number=0,Type=Flag,Description="x">', '##INFO=<ID=MB,Number=2,Type=Integer,Description="x">',
        '##INFO=<ID=X.1,Number=.,Type=String,Description="x">', '##INFO=<ID=half,Description="no type">',
        '##FORMAT=<ID=GT,Number=1,Type=String,Description="x">', '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="x">',
        '##FORMAT=<ID=AF,Number=A,Type=Float,Description="x">', '##FORMAT=<ID=PL,Number=G,Type=Integer,Description="x">',
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2"]
SCHEMA = typed.schema_of(HEAD)


def rows(spark, lines):
    return vcf.parse(spark.createDataFrame([(v,) for v in lines], "value string"))


def line(pos, alt, info, *samples):
    return "\t".join(["c", str(pos), ".", "A", alt, ".", ".", info, *samples])


def test_schema_from_header(spark):
    assert list(SCHEMA.info) == ["AC", "AD", "GL", "DP", "DB", "MB", "X.1"] and list(SCHEMA.format) == ["GT", "AD", "AF", "PL"]
    assert SCHEMA.info["AC"].sql_type == "array<int>" and SCHEMA.info["DP"].sql_type == "int" and SCHEMA.info["DB"].sql_type == "boolean"
    head = spark.createDataFrame(list(enumerate(HEAD)), "k long, value string")
    assert typed.header_schema(head, ["k"]) == SCHEMA
    t = typed.typed_info(rows(spark, [line(1, "C", ".")]), SCHEMA)
    kinds = {f.name: f.dataType.simpleString() for f in t.schema["info_typed"].dataType}
    assert kinds == {i: f.sql_type.replace(": ", ":") for i, f in SCHEMA.info.items()}


def test_typed_info_values_and_violations(spark):
    r = rows(spark, [
        line(1, "C", "AC=3;AD=1.5,-2e3;DP=7;DB;MB=1,.;X.1=a,.,b;other=5"),
        line(2, "C,G", "AC=3;AD=.;GL=0,1,2,3,4,nan;DP=.;DB=1;MB=1,2,3"),
        line(3, "C", "AC=x;DP=1.5;AD=1f,+inf;MB;flag"),
        line(4, ".", "DP=99999999999"), line(5, "C", ".")])
    t = {x.pos: x for x in typed.typed_info(r, SCHEMA).collect()}
    i = {p: x.info_typed for p, x in t.items()}
    assert (i[1].AC, i[1].AD, i[1].DP, i[1].DB, i[1].MB, i[1]["X.1"], i[1].GL) == ([3], [1.5, -2000.0], 7, True, [1, None], ["a", None, "b"], None)
    assert t[1].info_rest == {"other": "5"}
    assert (i[2].AC, i[2].AD, i[2].DP, i[2].DB) == ([3], None, None, True) and str(i[2].GL) == "[0.0, 1.0, 2.0, 3.0, 4.0, nan]"
    assert (i[3].AC, i[3].DP, i[3].AD, i[3].MB, i[4].DP, i[5].DB) == ([None], None, [None, float("inf")], None, None, False)
    bad = {p: sorted((v.id, v.problem) for v in x.violations) for p, x in t.items()}
    assert bad == {1: [("other", "undeclared")], 2: [("AC", "number"), ("DB", "value"), ("MB", "number")],
                   3: [("AC", "type"), ("AD", "type"), ("DP", "type"), ("MB", "value"), ("flag", "undeclared")], 4: [("DP", "type")], 5: []}
    counts = {(c.id, c.problem): c.n for c in typed.violation_counts(typed.typed_info(r, SCHEMA)).collect()}
    assert counts[("DP", "type")] == 2 and counts[("AC", "number")] == 1
    only = typed.typed_info(r, SCHEMA, fields=["DP"]).schema["info_typed"].dataType
    assert only.names == ["DP"]


def test_typed_samples(spark):
    r = rows(spark, [line(1, "C,G", ".", "GT:AD:PL:ZZ", "0/1:1,2,3:1,2,3,4,5,6:q", "1:4,.,6:7,8,9"),
                     line(2, "C", ".", "AD", "1,2,3", "."), line(3, "C", "."), line(4, "C", ".", "GT:PL", "./.", ".:1,2,3")])
    got = {(x.pos, x.sample_idx): x for x in typed.typed_samples(r, SCHEMA, keep=["pos"]).collect()}
    assert set(got) == {(1, 0), (1, 1), (2, 0), (2, 1), (4, 0), (4, 1)}
    one, two = got[1, 0].sample_typed, got[1, 1].sample_typed
    assert (one.GT, one.AD, one.PL, one.AF) == ("0/1", [1, 2, 3], [1, 2, 3, 4, 5, 6], None) and got[1, 0].sample_rest == {"ZZ": "q"}
    assert (two.GT, two.AD, two.PL) == ("1", [4, None, 6], [7, 8, 9])
    bad = {k: [(v.id, v.problem) for v in x.violations] for k, x in got.items()}
    assert bad == {(1, 0): [("ZZ", "undeclared")], (1, 1): [], (2, 0): [("AD", "number")], (2, 1): [], (4, 0): [], (4, 1): []}


def ordered_genotypes(alleles, ploidy):
    """Sorted allele tuples in the order of VCF: by the last allele, then the one before it, ..."""
    return sorted(itertools.combinations_with_replacement(range(alleles), ploidy), key=lambda g: g[::-1])


@pytest.mark.parametrize("ploidy", [1, 2, 3, 4])
def test_genotype_order(spark, ploidy):
    for n_alt in (1, 2, 3, 4):
        all_of = ordered_genotypes(n_alt + 1, ploidy)
        r = spark.range(1, n_alt + 1).select(
            "id", typed.genotypes(F.lit(n_alt + 1), F.lit(ploidy)).alias("n"), typed.genotype_places(F.col("id"), F.lit(ploidy)).alias("at")).collect()
        for x in r:
            assert x.n == len(all_of)
            assert x["at"] == [all_of.index(tuple([0] * (ploidy - k) + [x.id] * k)) for k in range(ploidy + 1)]


def test_split_alleles_against_brute_force(spark):
    rand = random.Random(4)
    num = lambda n: [str(rand.randrange(100)) for _ in range(n)]
    lines, want = [], []
    for pos in range(300):
        n = rand.randrange(1, 5)
        alts = ["C", "G", "T", "<DEL>"][:n]
        info = {"AC": num(n), "AD": num(n + 1), "GL": num((n + 1) * (n + 2) // 2), "DP": ["7"]}
        if pos % 7 == 0:
            info["AC"] = num(n + 2)
        samples = []
        for _ in range(2):
            p = rand.randrange(1, 4)
            gt = [rand.choice([*map(str, range(n + 1)), "."]) for _ in range(p)]
            seps = [rand.choice("/|") for _ in range(p - 1)]
            samples.append((p, gt, seps, num(n + 1), num(n), num(len(ordered_genotypes(n + 1, p)))))
        text = lambda gt, seps: gt[0] + "".join(s + g for s, g in zip(seps, gt[1:]))
        lines.append(line(pos, ",".join(alts), ";".join(f"{k}={','.join(v)}" for k, v in info.items()) + ";DB;zz=1,2", "GT:AD:AF:PL:ZZ",
                          *[":".join([text(gt, seps), ",".join(ad), ",".join(af), ",".join(pl), "z"]) for _, gt, seps, ad, af, pl in samples]))
        for a in range(1, n + 1):
            if n == 1:
                want.append((pos, 1, lines[-1].split("\t")))
                continue
            own = lambda p, a=a, n=n: [i for i, g in enumerate(ordered_genotypes(n + 1, p)) if set(g) <= {0, a}]
            cut = {"AC": info["AC"] if pos % 7 == 0 else [info["AC"][a - 1]], "AD": [info["AD"][0], info["AD"][a]], "GL": [info["GL"][i] for i in own(2)], "DP": ["7"]}
            new = [":".join([text([g if g in "0." else "1" if g == str(a) else "." for g in gt], seps), f"{ad[0]},{ad[a]}", af[a - 1],
                             ",".join(pl[i] for i in own(p)), "z"]) for p, gt, seps, ad, af, pl in samples]
            want.append((pos, a, line(pos, alts[a - 1], ";".join(f"{k}={','.join(v)}" for k, v in cut.items()) + ";DB;zz=1,2", "GT:AD:AF:PL:ZZ", *new).split("\t")))
    split = typed.split_alleles(rows(spark, lines), SCHEMA)
    got = [(r.pos, r.allele_num, r.value.split("\t")) for r in vcf.format_rows(split, keep=("pos", "allele_num")).collect()]
    assert sorted(got) == sorted(want)


def test_split_alleles_edges(spark):
    r = rows(spark, [line(1, ".", "DP=1", "GT", "0/0", "./."), line(2, "C,G", ".", "AD:PL", "1,2,3:1,2,3,4,5,6", "."), line(3, "C,G", "AC=."),
                     line(4, "C,G", "AC=1,2", "GT", "2|1|10", ".")])
    got = sorted((x.pos, x.allele_num or 0, ",".join(x.alt or []), x.info.get("AC"), tuple(x.samples or ())) for x in typed.split_alleles(r, SCHEMA, other="0").collect())
    assert got == [(1, 0, "", None, ("0/0", "./.")), (2, 1, "C", None, ("1,2:1,2,3", ".")), (2, 2, "G", None, ("1,3:1,4,6", ".")),
                   (3, 1, "C", ".", ()), (3, 2, "G", ".", ()), (4, 1, "C", "1", ("0|1|0", ".")), (4, 2, "G", "2", ("1|0|0", "."))]
