"""Secret scanning: fixed patterns, and strings that look random to character Markov models.

Base spans come from three patterns (assignments of a password, token or key; access key
ids; long hex strings). The method adds spans of kind ``random``: runs of key characters, of
``MIN_RUN`` or more, in which two kinds of first-order character models disagree. Runs are maximal
outside base spans: what a base span leaves of a run is judged by itself. Random strings have
a model for each character class (``CLASSES``: digits, hex, base32, base62, base64, ...),
trained on the values of base spans of that class; ordinary words and identifiers have one. A
run is judged by the model of the smallest class that holds it, and reported, as a whole, if in any window of it, of
``MIN_RUN`` transitions or more, the mean log-likelihood ratio exceeds ``MIN_RATIO`` nats.

A class's model mixes the trained transitions with the class's uniform distribution. The samples are
dealt by a hash of the value into thirds: one trains the transitions, one fits the mixture's weight by expectation
maximisation, one is held out (``held_out`` reports its likelihood against the uniform distribution). A class
without samples is uniform. A small share of the ordinary model (``ODD``) is uniform, which bounds
the ratio of every pair, so it doesn't drift as the training data grows. Characters no word has end a
word. Dots join the parts of a run (as in web tokens) and count for neither side.

Training reads at most about ``SAMPLE`` documents, chosen by a hash of their id; scanning
reads every text whole.

Defined results: null and empty texts have no spans; spans are counted in code points, ends
exclusive, sorted by start, then kind in the order of ``KINDS``; repeated rows give repeated
rows; without training examples no ``random`` span is reported; an empty table gives an
empty result; all columns of the documents are kept in ``doc``, whatever their names.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_docs, ready, table, text_or_empty, text_slices

KINDS = ("assign", "access", "hex", "random")
SAMPLE = 20_000
MIN_RUN = 20
MIN_RATIO = 1.0
PRIOR = 100.0
ODD = 0.05
MIN_VALUE, MIN_ACCESS, MIN_HEX = 12, 18, 16


def _either_case(word: str) -> str:
    """A-Z and a-z only: the ignore-case flag would also accept letters outside ASCII."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile(
    "(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token"))) + "|"
    + _either_case("api") + "_?" + _either_case("key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# runs are maximal, so asking for the length at once finds the same runs
HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
RUN = re.compile(r"[A-Za-z0-9+/_=.-]{%d,}" % MIN_RUN)
# within such a run: single dots join, others separate
JOINED = re.compile(r"[^.]+(?:\.[^.]+)*")
# words too short to be judged themselves: a longer run may be an unlabelled secret
WORD = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z][A-Za-z0-9_-]{7,%d}(?![A-Za-z0-9+/_=-])" % (MIN_RUN - 2))

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
STATES = len(ALPHABET) + 1  # the last one: any other character, and the border
_CODE = np.full(256, STATES - 1, dtype=np.int64)
for _i, _c in enumerate(ALPHABET):
    _CODE[ord(_c)] = _i
_NOT_IN_WORDS = [ALPHABET.index(c) for c in "+/.="]
_DOT = ALPHABET.index(".")

_UPPER, _LOWER, _DIGITS = ALPHABET[:26], ALPHABET[26:52], ALPHABET[52:62]
# from small to large: a run belongs to the first that holds all its characters
CLASSES = {
    "digits": _DIGITS, "hex": _DIGITS + "abcdef", "HEX": _DIGITS + "ABCDEF", "lower": _LOWER, "upper": _UPPER, "BASE32": _UPPER + "234567=",
    "lower+digits": _LOWER + _DIGITS, "upper+digits": _UPPER + _DIGITS, "base62": ALPHABET[:62], "base64": ALPHABET[:62] + "+/=",
    "base64url": ALPHABET[:62] + "_-=", "all": ALPHABET.replace(".", "")}
_SETS = [frozenset(c) for c in CLASSES.values()]
PARTS = 3  # of the samples: train, fit the mixture, held out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, sorted."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def transitions(word: str) -> np.ndarray:
    """The pairs of neighbouring states of ``word`` with its borders, as numbers."""
    s = np.full(len(word) + 2, STATES - 1, dtype=np.int64)
    s[1:-1] = _CODE[np.frombuffer(word.encode("latin-1", "replace"), dtype=np.uint8)]
    return s[:-1] * STATES + s[1:]


def class_of(run: str) -> int:
    """The number of the smallest class that holds all characters of a run but its dots."""
    chars = set(run)
    chars.discard(".")
    return next(i for i, known in enumerate(_SETS) if chars <= known)


def samples(text: str) -> list[tuple[int, str]]:
    """Labelled strings of a text: 0 for ordinary words, else 1 + class * PARTS + part for values of base spans."""
    spans = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    spans += [(s, e) for s, k, e in base_spans(text) if k]
    covered = {p for s, e in spans for p in range(s, e)}
    values = [text[s:e] for s, e in spans]
    out = [(1 + class_of(v) * PARTS + zlib.crc32(v.encode()) % PARTS, v) for v in values]
    return out + [(0, m.group()) for m in WORD.finditer(text) if m.start() not in covered]


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> np.ndarray:
    """Transitions seen in the labelled strings of at most about ``sample`` documents: label by pair of states."""
    ready(docs.sparkSession)
    total = docs.select(F.lit(1)).count()
    share = max(1, -(-total // sample))
    by = F.xxhash64(F.col(id_col), F.xxhash64(text_or_empty(text_col)))  # rows without ids are dealt by their texts
    chosen = docs.filter(F.pmod(by, F.lit(share)) == 0).select(text_or_empty(text_col).alias("text"))
    labels = 1 + len(CLASSES) * PARTS

    def count(batches):
        import pyarrow as pa

        seen = np.zeros((labels, STATES * STATES), dtype=np.int64)
        for batch in batches:
            for lo, hi in text_slices(batch.column(0)):
                held: dict[int, list[str]] = {}
                for text in batch.column(0).slice(lo, hi - lo).to_pylist():
                    for label, word in samples(text):
                        held.setdefault(label, []).append(word)
                for label, found in held.items():  # words end to end, with a border between
                    seen[label] += np.bincount(transitions("\0".join(found)), minlength=STATES * STATES)
        label, pair = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(pair), pa.array(seen[label, pair])],
                                         ["label", "pair", "n"])

    counts = np.zeros((labels, STATES * STATES))
    for r in chosen.mapInArrow(count, "label long, pair long, n long").groupBy("label", "pair").agg(
            F.sum("n").alias("n")).collect():  # at most one row per label and pair of states
        counts[r["label"], r["pair"]] = r["n"]
    return counts


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> np.ndarray | None:
    """Per class the log-likelihood ratios of all pairs of states, or None without examples of either kind."""
    counts = counted(docs, id_col, text_col, sample)
    return pair_ratios(counts) if counts[0].any() and counts[1:].any() else None


def pair_ratios(counts: np.ndarray) -> np.ndarray:
    """Log-likelihood ratios of all pairs of states, class by class, from the counts by label."""
    words = transition_chances(counts[0].reshape(STATES, STATES), np.arange(STATES))
    words[_NOT_IN_WORDS, :] = words[-1, :]
    words[:, _NOT_IN_WORDS] = words[:, -1:]
    out = np.stack([np.log(random_chances(counts, c)[0]) - np.log((1 - ODD) * words + ODD / STATES) for c in range(len(CLASSES))])
    out[:, _DOT, :] = out[:, :, _DOT] = 0.0
    return out.reshape(len(CLASSES), -1)


def random_chances(counts: np.ndarray, c: int) -> tuple[np.ndarray, float]:
    """Chances of the next state in a random string of a class, and the weight of the trained ones among them."""
    train_, fit, _ = (counts[1 + c * PARTS + i].reshape(STATES, STATES) for i in range(PARTS))
    own = np.array([ALPHABET.index(x) for x in list(CLASSES.values())[c]] + [STATES - 1])
    uniform = np.full((STATES, STATES), 1 / len(own))
    trained = uniform.copy()
    trained[np.ix_(own, own)] = transition_chances(train_, own)[np.ix_(own, own)]
    weight = 0.0
    if train_.any() and fit.any():
        weight = 0.5
        for _ in range(50):
            part = weight * trained / (weight * trained + (1 - weight) * uniform)
            weight = float((fit * part).sum() / fit.sum())
    return weight * trained + (1 - weight) * uniform, weight


def held_out(counts: np.ndarray) -> list[tuple[str, int, float, float, float, float]]:
    """Per class with held-out samples: name, their transitions, the fitted weight, and the mean log-likelihood of a
    transition by the fitted model, by the class's uniform distribution and by one over all states."""
    out = []
    for c, (name, alphabet) in enumerate(CLASSES.items()):
        test = counts[1 + c * PARTS + PARTS - 1].reshape(STATES, STATES)
        if test.any():
            chances, weight = random_chances(counts, c)
            out.append((name, int(test.sum()), weight, float((test * np.log(chances)).sum() / test.sum()),
                        -float(np.log(len(alphabet) + 1)), -float(np.log(STATES))))
    return out


def transition_chances(counts: np.ndarray, states: np.ndarray) -> np.ndarray:
    """Chances of the next state; what a state has rarely or never been seen with follows the overall shares of ``states``."""
    overall = np.zeros(STATES)
    overall[states] = counts.sum(axis=0)[states] + 0.5
    overall /= overall.sum()
    return (counts + PRIOR * overall) / (counts.sum(axis=1, keepdims=True) + PRIOR)


def looks_random(run: str, ratios: np.ndarray) -> bool:
    """Whether the mean ratio of some window of at least ``MIN_RUN`` transitions exceeds ``MIN_RATIO``."""
    gain = np.concatenate([[0.0], np.cumsum(ratios[class_of(run)][transitions(run)] - MIN_RATIO)])
    return bool((gain[MIN_RUN:] > np.minimum.accumulate(gain[:-MIN_RUN])).any())


def runs(text: str):
    """(start, end) of the runs of key characters that are long enough."""
    for m in RUN.finditer(text):
        a, b = m.span()
        if text.find(".", a, b) < 0:
            yield a, b
        else:
            yield from (p.span() for p in JOINED.finditer(text, a, b) if p.end() - p.start() >= MIN_RUN)


def all_spans(text: str, ratios: np.ndarray | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of base and added spans, sorted."""
    base = base_spans(text)
    if ratios is None:
        return base
    cover: list = []  # of base spans, joined where they overlap
    for s, _, e in base:
        if cover and s < cover[-1][1]:
            cover[-1][1] = max(e, cover[-1][1])
        else:
            cover.append([s, e])
    added, i = [], 0
    for a, b in runs(text):
        while i < len(cover) and cover[i][1] <= a:
            i += 1
        j = i
        while a < b:
            s, e = cover[j] if j < len(cover) else (b, b)
            rest = min(s, b)
            if rest - a >= MIN_RUN and looks_random(text[a:rest], ratios):
                added.append((a, 3, rest))
            a, j = e, j + 1
    return sorted(base + added)


SPANS = "spans array<struct<kind: string, start: long, end: long>>"


def scan(docs: DataFrame, ratios: np.ndarray | None, text_col: str = "text") -> DataFrame:
    """``doc`` (all columns) and the spans of every whole text."""
    sent = ready(docs.sparkSession).sparkContext.broadcast(ratios)

    def make():
        def run(texts: list):
            return [[[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in all_spans(t or "", sent.value)] for t in texts]]

        return run

    return map_docs(docs, text_col, SPANS, make)


def op5_secret_scan(spark, sf_dir):
    """Secrets of every document, as counts and spans."""
    ready(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    shown = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["kind"] != KINDS[3])
    number = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scan(docs, train(docs)).select(
        "doc.doc_id", *[number(k) for k in KINDS[:3]], F.sha2(shown(base), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"))
