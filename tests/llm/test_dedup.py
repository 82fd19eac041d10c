"""Exact, near and line deduplication against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from varframe.llm import dartminhash as dart
from varframe.llm import exact_dedup, line_dedup, near_dedup, words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "doc_id long, text string, id long, sha string, n_bytes string, h1 string, doc string, keep_id string"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def exact_brute(rows):
    """(id, keep, size) of the distinct (id, text) rows."""
    docs = {(i, t or "") for i, t in rows}
    classes = collections.defaultdict(list)
    for i, t in docs:
        classes[t].append(i)
    top = lambda ids: max((i for i in ids if i is not None), default=None)
    return sorted(((i, hashlib.sha256(t.encode()).hexdigest(), top(classes[t]), len(classes[t])) for i, t in docs), key=str)


EDGES = [(1, "same"), (2, "same"), (3, None), (4, ""), (None, "same"), (None, "alone"), (5, "Same"), (6, "same "), (7, "é" * 40),
         (8, "é" * 40), (9, "x" * 1000), (10, "x" * 1000), (11, "x" * 999 + "y"), (2, "same"), (2, "other"), (12, "\x00"), (13, "\x00\x00")]


@pytest.mark.parametrize("chunk, primes", [(65536, exact_dedup.PRIMES), (7, exact_dedup.PRIMES), (7, (2, 3)), (64, (1, 1))])
def test_exact_groups(spark, chunk, primes):
    rng = random.Random(1)
    rows = EDGES + [(100 + i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))) for i in range(60)]
    got = exact_dedup.exact_groups(frame(spark, rows), chunk_bytes=chunk, primes=primes).collect()
    assert sorted(((r.id, r.sha, r.keep_id, r.group_size) for r in got), key=str) == exact_brute(rows)
    assert all(r.kept == (r.id == r.keep_id) for r in got)


def test_exact_empty_and_clashing_columns(spark):
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0
    rows = [(1, "a", 1, "s", "n", "h", "d", "k"), (2, "a", 1, None, "n", "h", "d", "k")]
    df = frame(spark, rows, CLASH)
    assert {r.id: r.keep_id for r in exact_dedup.exact_groups(df).collect()} == {1: 2, 2: 2}
    kept = exact_dedup.drop_exact_copies(df)
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [2]


def test_drop_exact_copies_of_repeated_rows(spark):
    kept = exact_dedup.drop_exact_copies(frame(spark, [(1, "a"), (1, "a"), (1, "b"), (2, "b"), (None, None), (None, "")]))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, "a"), (2, "b"), (None, None)], key=str) or \
        sorted(map(tuple, kept.collect()), key=str) == sorted([(1, "a"), (2, "b"), (None, "")], key=str)


def test_chunk_hashes_compose():
    rng = random.Random(2)
    data = bytes(rng.randrange(256) for _ in range(1000))
    p, r = exact_dedup.PRIMES[0], exact_dedup.BASES[0]
    whole = 0
    for b in data:
        whole = (whole * r + b + 1) % p
    for size in (1, 17, 1000):
        value = 0
        for at in range(0, len(data), size):
            part = data[at : at + size]
            value = (value * pow(r, len(part), p) + exact_dedup.chunk_hash(part, r, p, size)) % p
        assert value == whole


# ------------------------------------------------------------------ lines

def lines_brute(rows, min_chars, min_docs):
    strip = " \t\n\x0b\x0c\r"
    low = str.maketrans(line_dedup.BLANK and "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(strip).translate(low)
    held = collections.defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                held[key(x)].add(i)
    gone = {k: max(x for x in ids if x is not None) for k, ids in held.items() if len(ids) >= min_docs}
    out = []
    for i, t in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if key(x) not in gone or gone[key(x)] == i]
        out.append((i, len(every), len(every) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_line_dedup(spark):
    rng = random.Random(3)
    pool = ["Line one", " line ONE\t", "ÉCOLE", "école", "line two\r", "", "ab", "\x0bline two", "日本語日本", "日本語日本 "]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 200 if i % 9 == 0 else 5)))) for i in range(40)]
    rows += [(50, None), (51, ""), (None, "line one"), (52, "\n\n"), (53, "line one\n" * 130), (53, "line one\n" * 130)]
    df = frame(spark, rows).withColumn("pos", F.lit("x")).withColumn("words", F.lit(1))
    maps = line_dedup.keep_bitmaps(df, min_chars=5, min_docs=3)
    got = line_dedup.apply_bitmaps(df, maps).select("id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == lines_brute(rows, 5, 3)
    assert line_dedup.apply_bitmaps(frame(spark, []), line_dedup.keep_bitmaps(frame(spark, []))).count() == 0


# ------------------------------------------------------------------ near copies

def test_dartminhash_estimates_weighted_jaccard():
    e = dart.mix(np.arange(1, 81, dtype=np.uint64))
    rng = np.random.default_rng(0)
    for a, b in ((np.ones(80), (np.arange(80) < 60) * 1.0), (rng.uniform(0.1, 9, 80), rng.uniform(0.1, 9, 80)), (np.full(80, 0.01), np.full(80, 0.02))):
        doc = np.repeat([0, 1], 80)
        w, every = np.concatenate([a, b]), np.concatenate([e, e])
        on = w > 0
        s = dart.signatures(doc[on], every[on], w[on], 2, 2000)
        assert abs((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.05
    assert (dart.signatures(np.empty(0, int), np.empty(0, np.uint64), np.empty(0), 3, 10) == 0).all()


def test_words_match_the_pattern():
    import re

    text = "Été 12,3 Ab_c\u00a0d\x7fe漢字 x" + "y" * 3000
    low = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    assert [w.decode() for w in words.split(text)] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    h, at = words.word_hashes([text, None, "", "x", text])
    assert at.tolist()[1:4] == [at[1]] * 3 and (h[: at[1]] == h[at[4] :]).all()


def test_long_texts_hash_like_short_ones(monkeypatch):
    texts = ["ab cd " * 200 + "x" * 300, "ab", "q" * 1000]
    whole, at = words.word_hashes(texts)
    monkeypatch.setattr(words, "SEGMENT", 64)
    parts, at2 = words.word_hashes(texts)
    assert (at == at2).all() and (whole == parts).all()


def near_brute(rows, similarity=0.8):
    def multiset(t):
        w = words.split(t)
        grams = zip(*[w[i:] for i in range(5)], strict=False) if len(w) >= 5 else [tuple(w)] * bool(w)
        return collections.Counter(grams)

    docs = list({(i, t or "") for i, t in rows})
    sets = [multiset(t) for _, t in docs]
    part = list(range(len(docs)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both, every = (sets[i] & sets[j]).total(), (sets[i] | sets[j]).total()
            if every and both >= similarity * every:
                part[find(i)] = find(j)
    classes = collections.defaultdict(list)
    for i in range(len(docs)):
        classes[find(i)].append(docs[i][0])
    return sorted((docs[i][0], max(classes[find(i)], key=lambda x: -1 if x is None else x), len(classes[find(i)])) for i in range(len(docs)))


def test_near_classes(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, n = [], 0
    for family in range(6):
        base = [word() for _ in range(rng.choice([30, 80, 300]))]
        for _ in range(25):
            text = list(base)
            for _ in range(rng.randint(0, 6)):
                text[rng.randrange(len(text))] = word()
            rows.append((n, " ".join(text)))
            n += 1
    rows += [(900, None), (901, ""), (902, "..."), (903, "one two"), (904, "One, two!"), (905, rows[0][1].upper()), (905, rows[0][1].upper())]
    rows += [(906, rows[30][1] + " " + "again and again and again " * 20), (907, rows[30][1] + " " + "again and again and again " * 21)]
    got = near_dedup.near_classes(frame(spark, rows).withColumn("node", F.lit(1)).withColumn("n", F.lit("x"))).collect()
    assert sorted((r.id, r.class_id, r.class_size) for r in got) == near_brute(rows)
    assert all(r.kept == (r.id == r.class_id) for r in got)
    kept = near_dedup.drop_near_copies(frame(spark, rows))
    assert {r.doc_id for r in kept.collect()} == {c for _, c, _ in near_brute(rows)}


def test_near_classes_of_nothing(spark):
    assert near_dedup.near_classes(frame(spark, [])).count() == 0
    assert near_dedup.near_classes(frame(spark, [(1, None), (2, "")])).filter("kept").count() == 2


def test_components_of_a_chain(spark):
    edges = [(bytes([i]), bytes([i + 1])) for i in range(60)] + [(b"\xf0", b"\xf1"), (b"\xf1", b"\xf0")]
    got = near_dedup.components(spark, frame(spark, edges, "a binary, b binary")).collect()
    assert {bytes(r.node): bytes(r.comp) for r in got} == {bytes([i]): bytes([60]) for i in range(61)} | {b"\xf0": b"\xf1", b"\xf1": b"\xf1"}
