"""Queries without SQL against plain recomputations of the whole table."""

import collections
import zlib

import pytest

from varframe.llm import token_counts
from varframe.llm.registry import QUERIES


@pytest.fixture(scope="module")
def rows(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").collect()


def grams(text):
    out = collections.Counter()
    word = []
    for c in text.lower() + " ":
        if c.isalpha():
            word.append(ord(c))
            continue
        if word:
            w = [0, *word, 0]
            out.update((1, c) for c in word)
            out.update((2, a, b) for a, b in zip(w, w[1:]))
            out.update((3, a, b, c) for a, b, c in zip(w, w[1:], w[2:]))
        word = []
    return out


def code(gram):
    """Ties go by number: three letters below two below one."""
    n, *letters = gram
    return {1: 3 << 62, 2: 1 << 63, 3: 0}[n] | sum(x << 21 * i for i, x in enumerate(reversed(letters)))


def ranked(counts):
    return sorted(counts, key=lambda g: (-counts[g], code(g)))[:400]


def test_op7_by_plain_out_of_place_distances(spark, sf, rows):
    fold = lambda r: zlib.crc32(str(r.doc_id).encode()) % 3 == 1
    totals = collections.defaultdict(collections.Counter)
    for r in rows:
        if not fold(r) and r.lang is not None and r.text is not None:
            totals[r.lang].update(grams(r.text))
    learned = {lang: {g: i for i, g in enumerate(ranked(c))} for lang, c in totals.items()}
    want = {}
    for r in rows:
        own = ranked(grams(r.text or ""))
        away = {lang: sum(min(abs(p[g] - i), 400) if g in p else 400 for i, g in enumerate(own)) for lang, p in learned.items()}
        best = min(sorted(away), key=away.get)
        want[r.doc_id] = (fold(r), best, 1 - away[best] / (400 * len(own))) if own else (fold(r), "und", 0.0)
    got = {r.doc_id: r for r in QUERIES["op7_language_id"](spark, sf).collect()}
    assert set(got) == set(want)
    for i, (held, lang, score) in want.items():
        assert (got[i].held_out, got[i].lang_pred) == (held, lang) and abs(got[i].score - score) < 1e-9


def test_op9_by_the_library(spark, sf, rows):
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces, unknown = token_counts.vocabulary(token_counts.model_file())
    library = Tokenizer(models.Unigram(pieces, unk_id=unknown, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement=token_counts.MARK, prepend_scheme="always")
    got = {r.doc_id: r.n_tokens for r in QUERIES["op9_token_counts"](spark, sf).collect()}
    assert got == {r.doc_id: len(library.encode(r.text or "").ids) for r in rows}
