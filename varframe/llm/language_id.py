"""Language identification by rank-order profiles of character n-grams.

A text's letters (lower-cased; anything else ends a word) give 1-, 2- and 3-grams, the
longer ones with word borders. A language's profile is its ``PROFILE`` most frequent
n-grams over all training texts, in order. A text's own most frequent n-grams, up to as
many, are compared with each profile: the distance sums, per n-gram, how far its rank is
out of place, at most ``PROFILE``. The nearest language wins.

Training counts cover every training text: tasks sum up what they read, and only the top of
each language leaves the cluster (``languages`` x ``PROFILE`` rows, checked against
``MAX_LANGUAGES``). N-grams are exact code points in 63 bits, not hashes.

Defined results: a null text, or one without letters, is ``und`` with score 0; texts of any
length count whole; of equally near languages the first by name wins, of equally frequent
n-grams the smaller code; a null id counts as an empty id; without training rows every text
is ``und``; repeated rows give repeated rows; an empty table gives an empty result; all
columns of the documents are kept in ``doc``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_docs, ready, table, text_slices

PROFILE = 400
MAX_LANGUAGES = 1000
SEGMENT = 1 << 20
FLUSH = 1 << 20  # entries a training task holds at most before it hands them on

NO_LETTER = regex.compile(r"\P{L}")
_LETTERS: list = []


def letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([not 0xD800 <= c < 0xE000 and chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0]


def _segment_ngrams(text: str) -> np.ndarray:
    cps = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    x = np.zeros(len(cps) + 2, dtype=np.uint64)
    x[1:-1] = np.where(letters()[cps], cps, 0)
    used = x != 0
    used[1:] |= used[:-1]  # a border after each word
    used[0] = True
    x = x[used]
    if x[-1]:
        x = np.append(x, np.uint64(0))
    two = (x[:-1] << np.uint64(21)) | x[1:]
    three = (two[:-1] << np.uint64(21)) | x[2:]
    inner = x[1:-1] != 0
    return np.concatenate([x[x != 0] | np.uint64(3 << 62), two[x[:-1] + x[1:] > 0] | np.uint64(1 << 63), three[inner]])


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes of the whole text, sorted, and how often each occurs."""
    if len(text) <= SEGMENT:
        return np.unique(_segment_ngrams(text), return_counts=True)
    codes, counts = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    at = 0
    while at < len(text):  # segments end between words
        border = NO_LETTER.search(text, at + SEGMENT)
        end = border.start() if border else len(text)
        c, n = np.unique(_segment_ngrams(text[at:end]), return_counts=True)
        codes, counts = summed(np.concatenate([codes, c]), np.concatenate([counts, n]))
        at = end
    return codes, counts


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out, where = np.unique(codes, return_inverse=True)
    return out, np.bincount(where, weights=counts, minlength=len(out)).astype(np.int64)


def in_order(codes: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    return codes[np.lexsort((codes, -counts))[:k]]


def training_fold(id_col: str = "doc_id") -> Column:
    """True for the documents a model may learn from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 != 1


def profiles(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> dict[str, np.ndarray]:
    """The ranked n-grams of every language of ``labelled``."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def count(batches):
        import pyarrow as pa

        held: dict[str, list] = {}

        def flush():
            for lang, parts in held.items():
                codes, n = summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes)), pa.array(codes.view(np.int64)), pa.array(n)], ["lang", "code", "n"])
            held.clear()

        size_held = 0
        for batch in batches:
            for lo, hi in text_slices(batch.column(1)):
                langs, texts = (batch.column(i).slice(lo, hi - lo).to_pylist() for i in (0, 1))
                for lang, text in zip(langs, texts, strict=True):
                    part = ngram_counts(text)
                    held.setdefault(lang, []).append(part)
                    size_held += len(part[0])
                if size_held > FLUSH:
                    for lang, parts in held.items():
                        held[lang] = [summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))]
                    size_held = sum(len(p[0][0]) for p in held.values())
                    if size_held > FLUSH // 2:
                        yield from flush()
                        size_held = 0
        yield from flush()

    counts = rows.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    # unsigned order of the codes: the sign bit flipped. A limit per group keeps each task's top before the exchange
    rank = Window.partitionBy("lang").orderBy(F.desc("n"), F.expr("code ^ (-9223372036854775807L - 1L)"))
    top = counts.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= size)
    found = top.limit(MAX_LANGUAGES * size + 1).collect()
    if len({r["lang"] for r in found}) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out = {}
    for lang in sorted({r["lang"] for r in found}):
        own = sorted((r["rank"], r["code"]) for r in found if r["lang"] == lang)
        out[lang] = np.array([c for _, c in own], dtype=np.int64).view(np.uint64)
    return out


class Judge:
    """Compares texts with the profiles."""

    def __init__(self, learned: dict[str, np.ndarray], size: int = PROFILE):
        self.langs, self.size = sorted(learned), size
        self.codes = np.unique(np.concatenate([np.empty(0, dtype=np.uint64), *learned.values()]))
        self.ranks = np.full((len(self.langs), len(self.codes) + 1), -1, dtype=np.int64)
        for i, lang in enumerate(self.langs):
            self.ranks[i, np.searchsorted(self.codes, learned[lang])] = np.arange(len(learned[lang]))

    def __call__(self, text: str | None) -> tuple[str, float]:
        own = in_order(*ngram_counts(text or ""), self.size)
        if not len(own) or not self.langs:
            return "und", 0.0
        at = np.searchsorted(self.codes, own)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != own)] = len(self.codes)
        ranks = self.ranks[:, at]
        away = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))))
        distance = np.minimum(away, self.size).sum(axis=1)
        best = int(np.argmin(distance))
        return self.langs[best], 1.0 - float(distance[best]) / (self.size * len(own))


def identify(docs: DataFrame, learned: dict[str, np.ndarray], text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """``doc`` (all columns), lang_pred and score (1: every n-gram in place) of every document."""
    ready(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(learned)

    def make():
        judge = Judge(sent.value, size)

        def run(texts: list):
            found = [judge(t) for t in texts]
            return [[x[0] for x in found], [x[1] for x in found]]

        return run

    return map_docs(docs, text_col, "lang_pred string, score double", make)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Profiles from the documents of the training fold."""
    ready(docs.sparkSession)
    return profiles(docs.filter(training_fold(id_col)), text_col, lang_col)


def op7_language_id(spark, sf_dir):
    """The predicted language of every document."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text"), learn(docs.select("doc_id", "text", "lang"))).select(
        "doc.doc_id", (~training_fold("doc.doc_id")).alias("held_out"), "lang_pred", "score")
