"""Random-string models by class: held-out likelihood, planted kinds, and spans against a plain recomputation."""

import random
import string

import numpy as np
import pytest

from varframe.llm import near_dedup, secrets
from varframe.llm.registry import QUERIES

KEY = set(string.ascii_letters + string.digits + "+/_=-")


def plain_spans(text, ratios):
    """Added spans by single characters and all windows."""
    base = secrets.base_spans(text)
    inside = set()
    for s, _, e in base:
        inside.update(range(s, e))
    runs, i = [], 0
    while i < len(text):  # runs of key characters, and single dots between two of them
        j = i
        while j < len(text) and (text[j] in KEY or (text[j] == "." and j > i and text[j - 1] != "." and j + 1 < len(text) and text[j + 1] in KEY)):
            j += 1
        if j - i >= 20:
            runs.append((i, j))
        i = max(j, i + 1)
    out = []
    for s, e in runs:
        at = s
        while at < e:
            stop = next((k for k in range(at, e) if k in inside), e)
            run = text[at:stop]
            if len(run) >= 20:
                r = ratios[secrets.class_of(run)][secrets.transitions(run)]
                if any(r[a:b].mean() > 1.0 for a in range(len(r)) for b in range(a + 20, len(r) + 1)):
                    out.append((at, 3, stop))
            at = next((k for k in range(stop, e) if k not in inside), e)
    return sorted(base + out)


@pytest.fixture(scope="module")
def trained(spark):
    r = random.Random(1)
    some = lambda a, n: "".join(r.choice(a) for _ in range(n))
    kinds = [string.hexdigits[:16], string.ascii_letters + string.digits, string.digits]
    texts = [f"the configuration of something ordinary has password={some(kinds[i % 3], 40)} and understandable identifiers_everywhere" for i in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return secrets.counted(df)


def test_fitted_models_beat_uniform_ones_on_held_out_values(trained):
    found = {r[0]: r for r in secrets.held_out(trained)}
    assert {"hex", "base62", "digits"} <= set(found)
    for _, n, weight, fitted, uniform, over_all in found.values():
        assert n > 0 and 0 <= weight <= 1 and fitted >= uniform - 0.01 and fitted > over_all
    for c in range(len(secrets.CLASSES)):
        chances, _ = secrets.random_chances(trained, c)
        own = [secrets.ALPHABET.index(x) for x in list(secrets.CLASSES.values())[c]] + [secrets.STATES - 1]
        assert np.allclose(chances[np.ix_(own, own)].sum(1), 1)


def test_classes():
    name = lambda run: list(secrets.CLASSES)[secrets.class_of(run)]
    assert [name(x) for x in ("0123", "12ab", "12AB", "xyz", "MFRGG2=", "xyz1", "XYZ1", "xY1", "a/B+", "a_B-", "a/_B")] == [
        "digits", "hex", "HEX", "lower", "BASE32", "lower+digits", "upper+digits", "base62", "base64", "base64url", "all"]
    assert name("ab.12") == "hex" and name("") == "digits"


def test_planted_kinds_and_plain_recomputation(trained):
    ratios, r = secrets.pair_ratios(trained), random.Random(9)
    some = lambda a, n: "".join(r.choice(a) for _ in range(n))
    low, b62 = string.ascii_lowercase, string.ascii_letters + string.digits
    found = 0
    for i in range(150):
        key = [some(low, 32), some(b62, 20), ".".join(some(b62, 15) for _ in range(3)), some("ABCDEF" + string.digits, 40)][i % 4]
        found += (4, 3, 4 + len(key)) in secrets.all_spans(f"see {key} now", ratios)
    assert found >= 145
    pieces = ["understandable", "identifiers", "_", "-", "/", ".", "..", " ", "token=", "AKIA", "é", "\n", "0123456789abcdef0", "="]
    for _ in range(400):
        text = "".join(r.choice([*pieces, some(b62, r.randrange(1, 30)), some(low, 9)]) for _ in range(r.randrange(12)))
        assert secrets.all_spans(text, ratios) == plain_spans(text, ratios), text


def test_query_spans_by_plain_recomputation(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    ratios, texts = secrets.train(docs), {r.doc_id: r.text or "" for r in docs.collect()}
    got = QUERIES["op5_secret_scan"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.spans == ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in plain_spans(texts[r.doc_id], ratios))


def test_long_text_and_rows_without_ids(spark, trained):
    text = "ordinary words " * 80000 + "".join(random.Random(3).choice(string.ascii_letters) for _ in range(40)) + " end"
    df = spark.createDataFrame([(None, text), (None, None)], "doc_id long, text string")
    got = secrets.scan(df, secrets.pair_ratios(trained)).select("spans").collect()
    assert sorted([tuple(s) for s in r.spans] for r in got) == [[], [("random", 1200000, 1200040)]]
    assert secrets.counted(df).sum() > 0


def test_near_copies_of_repeated_rows(spark):
    t = "one two three four five six seven eight"
    rows = [(1, t), (1, t), (2, t), (2, t), (5, "other words that stand quite alone here"), (7, None), (7, None), (8, "short"), (8, "short"), (None, "x y"), (None, "x y")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, n string")
    got = sorted(((r.doc_id, r.text, r.n) for r in near_dedup.drop_near_copies(df).collect()), key=str)
    assert got == sorted([(2, t, "k"), (5, rows[4][1], "k"), (7, None, "k"), (8, "short", "k"), (None, "x y", "k")], key=str)
