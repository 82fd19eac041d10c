"""Weighted signatures of shingle multisets by DartMinHash.

An element of weight w is the strip [0, w) x [0, inf) of a plane of weight and rank. Each
element's plane holds hashed darts, one per unit of area on average, the same in every
document: cells of area 1 (one weight octave wide) get a Poisson number of darts from the
cell's hash. Of the darts under a document's elements, those up to rank t / (total weight)
are thrown, t = k (ln k + 2), to one of k coordinates each; the earliest per coordinate is
its value. Documents agree in a coordinate with the probability of their weighted Jaccard
similarity. If a coordinate stays empty the ranks are doubled, which changes no value found
before. The work is linear in elements and coordinates, not their product.
"""

from __future__ import annotations

import math

import numpy as np

from . import words
from .words import mix

SHINGLE = 5
CHUNK = 1 << 17  # elements whose darts are held at once
_RADIX = np.uint64(0xD1342543DE82EF95)
_LEVEL, _CELL, _DART = (np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))
_UNIT = 2.0 ** -53

# chances of at most 0, 1, 2 ... darts in a cell, as 64-bit thresholds
POISSON = np.array([min(2**64 - 1, int(sum(math.exp(-1) / math.factorial(i) for i in range(n + 1)) * 2**64))
                    for n in range(18)], dtype=np.uint64)


def shingles(texts: list, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, count), sorted; a text of fewer words has one shingle of all of them."""
    h, offsets = words.word_hashes(texts)
    n = np.diff(offsets)
    parts_doc, parts_hash = [], []
    for width in np.unique(np.minimum(n[n > 0], size)).tolist():
        own = np.flatnonzero(np.minimum(n, size) == width)
        many = n[own] - width + 1
        doc = np.repeat(own, many)
        first = np.repeat(offsets[own] - np.cumsum(many) + many, many) + np.arange(many.sum())
        value = np.full(len(first), width, dtype=np.uint64)
        for j in range(width):
            value = value * _RADIX + h[first + j]
        parts_doc.append(doc)
        parts_hash.append(mix(value))
    if not parts_doc:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    doc, value = np.concatenate(parts_doc), np.concatenate(parts_hash)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return doc[at], value[at], np.diff(np.append(at, len(doc)))


def _spread(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Repeat index i n[i] times, and count 0, 1 ... within each."""
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)


def _throw(doc, element, weight, limit, k, rank, value) -> None:
    """Throw the darts of all elements up to their document's ``limit``; keep the earliest per (document, coordinate)."""
    level = 0
    low = 0.0
    while True:
        own = np.flatnonzero(weight > low)
        if not len(own):
            return
        span = max(1.0, low)
        cells = np.ceil(limit[doc[own]] * span).astype(np.int64)
        which, cell = _spread(cells)
        h = mix(mix(element[own[which]] + np.uint64(int(_LEVEL) * (level + 1) & (2**64 - 1))) + _CELL * cell.astype(np.uint64))
        many = np.searchsorted(POISSON, h, side="right")
        dart, nth = _spread(many)
        h = mix(h[dart] + _DART * (nth + 1).astype(np.uint64))
        i = own[which[dart]]
        under = low + span * ((h >> np.uint64(11)) * _UNIT) < weight[i]
        h, i, dart = h[under], i[under], dart[under]
        g = mix(h ^ _DART)
        r = (cell[dart] + (g >> np.uint64(11)) * _UNIT) / span
        early = r <= limit[doc[i]]
        h, i, r, g = h[early], i[early], r[early], g[early]
        slot = doc[i] * k + (mix(g + _CELL) % np.uint64(k)).astype(np.int64)
        before = rank[slot]
        np.minimum.at(rank, slot, r)
        won = (r == rank[slot]) & (r < before)
        value[slot[won]] = h[won]
        low = max(1.0, low * 2)
        level += 1


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """(n_docs, k) values; documents without elements have zeros. ``doc`` is sorted."""
    weight = np.asarray(weight, dtype=np.float64)
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    value = np.zeros(n_docs * k, dtype=np.uint64)
    rank = np.full(n_docs * k, np.inf)
    limit = np.divide(k * (math.log(k) + 2), total, out=np.zeros(n_docs), where=total > 0)
    todo = total > 0
    while todo.any():
        chosen = np.flatnonzero(todo[doc])
        for lo in range(0, len(chosen), CHUNK):
            part = chosen[lo : lo + CHUNK]
            _throw(doc[part], element[part], weight[part], limit, k, rank, value)
        todo &= np.isinf(rank.reshape(n_docs, k)).any(axis=1)
        limit[todo] *= 2
    return value.reshape(n_docs, k)


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """(n_docs, bands) hashes of equal parts of the signatures."""
    parts = signature.reshape(len(signature), bands, -1)
    key = np.arange(bands, dtype=np.uint64)[None, :] + np.zeros((len(signature), 1), dtype=np.uint64)
    for j in range(parts.shape[2]):
        key = mix(key * _RADIX + parts[:, :, j])
    return key


def elements(text: str) -> np.ndarray:
    """The shingle multiset of one text as a sorted set: each further copy of a shingle is an element of its own."""
    _, value, count = shingles([text])
    which, copy = _spread(count)
    value = value[which]
    again = copy > 0
    value[again] = mix(value[again] + _CELL * copy[again].astype(np.uint64))
    return np.sort(value)
