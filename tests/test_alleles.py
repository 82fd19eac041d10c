"""Alleles' values cut from whole batches: plans without nested lambdas, odd texts against brute force."""

import contextlib
import io
import itertools
import random
import re

import pyarrow as pa
import pytest

from varframe.operators import alleles, typed, vcf
from varframe.operators.lines import header_lines
from varframe.plans import fixtures as fx

SCHEMA = typed.schema_of([
    "##INFO=<ID=AC,Number=A,Type=Integer>", "##INFO=<ID=AD,Number=R,Type=Integer>", "##INFO=<ID=GL,Number=G,Type=Float>",
    "##FORMAT=<ID=GT,Number=1,Type=String>", "##FORMAT=<ID=AD,Number=R,Type=Integer>", "##FORMAT=<ID=AF,Number=A,Type=Float>",
    "##FORMAT=<ID=PL,Number=G,Type=Integer>"])


def printed(df, mode):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def test_alleles_are_split_without_lambdas(spark):
    split = typed.split_alleles(vcf.parse(spark.createDataFrame([("c\t1\t.\tA\tC,G\t.\t.\tAC=1,2\tGT\t0/1",)], "value string")), SCHEMA)
    assert "lambda" not in printed(split, "extended")


def test_line_of_the_fixture_is_short_enough_for_the_compiler(spark):
    lines = fx._multi_keys(spark, "/root/testdata/sf0.001").select(fx._multi_line().alias("value"))
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", printed(lines, "codegen"))]
    assert sizes and max(sizes) < 8000


def genotypes(alleles, copies):
    return sorted(itertools.combinations_with_replacement(range(alleles), copies), key=lambda g: g[::-1])


def kept(text, number, n, a, copies):
    parts = text.split(",")
    if number == "A" and len(parts) == n:
        return parts[a - 1]
    if number == "R" and len(parts) == n + 1:
        return f"{parts[0]},{parts[a]}"
    if number == "G" and copies and len(parts) == len(all_of := genotypes(n + 1, copies)):
        return ",".join(p for p, g in zip(parts, all_of, strict=True) if set(g) <= {0, a})
    return text


def renamed(gt, a, other):
    return "".join(sep + (name if name in ("0", ".") else "1" if name == str(a) else other) for sep, name in re.findall("([/|]?)([^/|]+)", gt))


def own_sample(text, fmt, every, n, a, other):
    cut = text.split(":")
    gt = fmt.index("GT") if "GT" in fmt else -1
    ploidy = lambda s: len(re.split("[/|]", s[gt])) if 0 <= gt < len(s) and s[gt] != "." else None
    most = max([2, *[ploidy(s.split(":")) or 0 for s in every if s is not None]])
    out = []
    for i, v in enumerate(cut):
        number = SCHEMA.format[fmt[i]].number if i < len(fmt) and fmt[i] in SCHEMA.format else ""
        copies = ploidy(cut) or next((p for p in range(1, most + 1) if len(genotypes(n + 1, p)) == len(v.split(","))), 0)
        out.append(renamed(v, a, other) if i == gt else kept(v, number, n, a, copies))
    return ":".join(out)


@pytest.mark.parametrize("slice_bytes", [64, 1 << 20])
@pytest.mark.parametrize("other", [".", "0", "<*>", ""])
def test_odd_texts_against_brute_force(monkeypatch, slice_bytes, other):
    monkeypatch.setattr(alleles, "SLICE_BYTES", slice_bytes)
    rand = random.Random(slice_bytes + len(other))
    value = lambda: rand.choice(["1", "22", ".", "", "é", "-3.5"])
    texts = lambda n: ",".join(value() for _ in range(max(1, n + rand.choice([0] * 6 + [1, -1]))))
    rows = []
    for _ in range(400):
        n = rand.choice([None, 2, 3, 4, 12])
        size = {"A": n or 1, "R": (n or 1) + 1, "G": len(genotypes((n or 1) + 1, 2)), "": 2}
        info = {k: rand.choice([None, texts(size[c]), texts(size[c])]) for k, c in (("AC", "A"), ("AD", "R"), ("GL", "G"), ("zz", "")) if rand.random() < 0.7}
        fmt = [k for k in rand.sample(["GT", "AD", "AF", "PL", "XX", "GT"], 6) if rand.random() < 0.8]
        gt = lambda p, n=n: rand.choice(["".join(rand.choice(["0", "1", "12", "01", "|", "/", ".", "a,"]) for _ in range(5)),
                                         *["|".join(str(rand.randrange(0, (n or 1) + 1)) for _ in range(p))] * 3, ".", "/1", "0//1", "1/"])
        samples = []
        for _ in range(rand.randrange(4)):
            p = rand.choice([1, 2, 3, 4] if n != 12 else [1, 2])
            made = [gt(p) if k == "GT" else texts({"AD": size["R"], "AF": size["A"], "PL": len(genotypes((n or 1) + 1, p))}.get(k, 1)) for k in fmt]
            samples.append(rand.choice([None, "", ":".join(made[:2])]) if rand.random() < 0.2 else ":".join([*made, *rand.choice([[], [], ["more"]])]))
        rows.append((n, info if rand.random() < 0.9 else None, fmt if rand.random() < 0.9 else None, samples if rand.random() < 0.9 else None))
    lists = pa.list_(pa.string())
    got = alleles.own_values(
        pa.array([r[0] for r in rows], pa.int32()), pa.array([None if r[1] is None else list(r[1]) for r in rows], lists),
        pa.array([None if r[1] is None else list(r[1].values()) for r in rows], lists), pa.array([r[2] for r in rows], lists),
        pa.array([r[3] for r in rows], lists), {k: alleles.KINDS[f.number] for k, f in SCHEMA.info.items()},
        {k: alleles.KINDS[f.number] for k, f in SCHEMA.format.items() if f.number in alleles.KINDS}, other)
    got.validate(full=True)
    for (n, info, fmt, samples), own in zip(rows, got.to_pylist(), strict=True):
        if n is None:
            assert own is None
            continue
        number = lambda k: SCHEMA.info[k].number if k in SCHEMA.info else ""
        want = [{"info": info and [(k, v and kept(v, number(k), n, a, 2)) for k, v in info.items()] if info != {} else [],
                 "samples": samples and [s if s is None else own_sample(s, fmt or [], samples, n, a, other) for s in samples]} for a in range(1, n + 1)]
        assert own == want, (n, info, fmt, samples)


def test_no_rows():
    lists = pa.array([], pa.list_(pa.string()))
    assert len(alleles.own_values(pa.array([], pa.int32()), lists, lists, lists, lists, {}, {}, ".")) == 0


def test_header_lines_in_order(spark):
    head = spark.createDataFrame([("b", 10, "4"), ("a", 9, "3"), ("b", 2, None), (None, 7, "1"), ("a", 10, "é"), ("a", 1, "2")], "file string, block long, value string")
    want = [r.value for r in head.orderBy("file", "block").collect()]
    assert header_lines(head.repartition(4), ["file", "block"]) == want == ["1", "2", "3", "é", None, "4"]
