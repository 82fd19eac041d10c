"""Values of one allele cut out of the texts of many rows at once.

Works on Arrow batches inside tasks, with numpy over the bytes of a whole batch: a text is never
a Python object. A text is cut into fields, a field into values or, a genotype, alleles; what an allele
keeps of them are pieces of the batch's bytes, and all pieces of all its texts are copied in one step.
``typed.split_alleles`` says what is kept.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHOLE, PER_ALT, PER_ALLELE, PER_GENOTYPE, GENOTYPE = range(5)
KINDS = {"A": PER_ALT, "R": PER_ALLELE, "G": PER_GENOTYPE}
DOT, ZERO, COLON, COMMA, SLASH, BAR = b".0:,/|"
SLICE_BYTES = 4 << 20
MANY = 1 << 40
# what a genotype's allele is, if it has no number: the reference or missing, another name, or nothing between two separators
SAME, OTHER, NONE = 0, -1, -2


def _places(lengths: np.ndarray) -> np.ndarray:
    """Where each of these stretches starts when they stand one after the other, and where the last ends."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def _within(lengths: np.ndarray, at: np.ndarray) -> np.ndarray:
    """0, 1, ... in each stretch."""
    return np.arange(at[-1]) - np.repeat(at[:-1], lengths)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the places of its texts in them."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(data or b"", np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def _strings(data: np.ndarray, at: np.ndarray, null: np.ndarray) -> pa.Array:
    mask = pa.array(~null).buffers()[1] if null.any() else None
    return pa.LargeStringArray.from_buffers(len(null), pa.py_buffer(at), pa.py_buffer(data), mask).cast(pa.string())


def _counter(found: np.ndarray):
    """Places of the bytes found, and how many of them are before each place."""
    before = np.zeros(len(found) + 1, np.int32)
    np.cumsum(found, out=before[1:])
    return np.flatnonzero(found), before


def _for_alleles(row: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The members of each row, given by their ``row``, once for each of its ``n`` alleles: their numbers, and the alleles."""
    size, of_row = np.bincount(row, minlength=len(n)), np.repeat(np.arange(len(n)), n)
    blocks = size[of_row]
    at = _places(blocks)
    allele = _within(n, _places(n)) + 1
    return np.arange(at[-1]) + np.repeat(_places(size)[of_row] - at[:-1], blocks), np.repeat(allele, blocks)


def genotype_counts(most_alleles: int, most_copies: int) -> np.ndarray:
    """[alleles, copies]: the number of genotypes, C(alleles + copies - 1, copies); beyond ``MANY`` it isn't exact."""
    out = np.zeros((most_alleles + 1, most_copies + 1), np.int64)
    out[0, 0] = 1
    for a in range(1, most_alleles + 1):
        out[a] = np.minimum(np.cumsum(out[a - 1]), MANY)
    return out


class Fields:
    """The fields of a batch's texts: their bytes, kinds, and for each text its row."""

    def __init__(self, texts: pa.Array, row: np.ndarray, separated: bool):
        self.data, at = _bytes(texts)
        self.null, self.row = np.asarray(texts.is_null()), row
        self.commas, self.commas_before = _counter(self.data == COMMA)
        self.bars, self.bars_before = _counter((self.data == SLASH) | (self.data == BAR))
        cuts, before = _counter((self.data == COLON) & separated)
        self.n = np.diff(before[at]) + 1
        self.at = _places(self.n)
        self.i, self.text = _within(self.n, self.at), np.repeat(np.arange(len(self.n)), self.n)
        self.start, self.end = np.empty(self.at[-1], np.int64), np.empty(self.at[-1], np.int64)
        first = self.i == 0
        last = np.roll(first, -1)
        self.start[first], self.start[~first] = at[:-1], cuts + 1
        self.end[last], self.end[~last] = at[1:], cuts
        self.values = self.commas_before[self.end] - self.commas_before[self.start] + 1
        self.copies = np.zeros(self.at[-1], np.int64)

    def cut(self, kind: np.ndarray, n: np.ndarray, counts: np.ndarray, other: bytes) -> tuple[pa.Array, np.ndarray]:
        """The texts of each allele of each row, by row, allele and text, and the number of the text each comes from.

        ``n`` are the rows' alleles. A field whose count of values isn't that of its kind is kept whole.
        """
        alts, copies = n[self.row[self.text]], np.minimum(self.copies, counts.shape[1] - 1)
        wanted = np.select([kind == PER_ALT, kind == PER_ALLELE, copies > 0], [alts, alts + 1, counts[alts + 1, copies]], -1)
        kind = np.where((kind == GENOTYPE) | (self.values == wanted), kind, WHOLE)
        mark, at_mark = self._marks(kind)
        names, separators = self._names(np.flatnonzero(kind == GENOTYPE), mark, at_mark)
        # every field of a row for every allele of the row, and the pieces it keeps: at first its first values
        f, allele = _for_alleles(self.row[self.text], n)
        pieces = np.choose(kind, [1, 1, 2, copies + 1, np.diff(at_mark) - 1])[f]
        at = _places(pieces)
        value = np.arange(at[-1]) + np.repeat(at_mark[f] - at[:-1], pieces)
        kind = kind[f]
        a, r, g = (np.flatnonzero(kind == x) for x in (PER_ALT, PER_ALLELE, PER_GENOTYPE))
        value[at[a]] += allele[a] - 1
        value[at[r] + 1] += allele[r] - 1
        p = copies[f[g]]
        g, q = np.repeat(g, p), _within(p, _places(p)) + 1
        p = copies[f[g]]
        # q copies of the allele among p: C(allele + m - 1, m) summed over m from p - q + 1 to p
        sums = np.concatenate([np.zeros((len(counts), 1), np.int64), np.cumsum(counts, axis=1)], axis=1)
        value[at[g] + q] += sums[allele[g], p + 1] - sums[allele[g], p - q + 1] - q
        # a piece begins with the separator before it, but where a text begins
        lead = np.ones(at[-1], np.int64)
        lead[at[:-1]] = self.i[f] > 0
        begin, end = mark[value] + 1 - lead, mark[value + 1]
        # alleles of genotypes under their new names, which follow the batch's bytes, each after every separator
        gt = np.flatnonzero(kind == GENOTYPE)
        x, of = np.repeat(at[gt], pieces[gt]) + _within(pieces[gt], _places(pieces[gt])), np.repeat(allele[gt], pieces[gt])
        name = names[value[x]]
        x, of, name = x[name != SAME], of[name != SAME], name[name != SAME]
        new = b"".join(bytes([sep]) + word for word in (other, b"1") for sep in b":/|")
        data = np.concatenate([self.data, np.frombuffer(new, np.uint8)])
        word, sep = (name == of).astype(np.int64), separators[value[x]]
        size = np.array([len(other), 1])[word]
        place = len(self.data) + 1 + word * 3 * (len(other) + 1) + sep * (size + 1)
        begin[x] = place - lead[x]
        end[x] = np.where(name == NONE, begin[x], place + size)
        length = end - begin
        to = _places(length)
        out = data[np.repeat(begin - to[:-1], length) + np.arange(to[-1])]
        # a value that wasn't the first of its field and is now
        out[to[at[a]][lead[at[a]] > 0]] = COLON
        text, _ = _for_alleles(self.row, n)
        return _strings(out, to[at[_places(self.n[text])]], self.null[text]), text

    def _marks(self, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each field's values end and the next begin: value j lies between marks j and j + 1 of the field."""
        values = np.where((kind == PER_ALT) | (kind == PER_ALLELE) | (kind == PER_GENOTYPE), self.values, 1)
        bars = self.bars_before[self.end] - self.bars_before[self.start]
        values = np.where(kind == GENOTYPE, bars + 1, values)
        at = _places(values + 1)
        mark = np.empty(at[-1], np.int64)
        inner = np.ones(at[-1], bool)
        inner[at[:-1]] = inner[at[1:] - 1] = False
        mark[at[:-1]], mark[at[1:] - 1] = self.start - 1, self.end
        commas = self.commas[np.repeat((kind != WHOLE) & (kind != GENOTYPE), self.values - 1)]
        bars = self.bars[np.repeat(kind == GENOTYPE, bars)]
        mark[inner] = np.sort(np.concatenate([commas, bars]), kind="stable")
        return mark, at

    def _names(self, gt: np.ndarray, mark: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the alleles of the genotypes ``gt``, by their marks: their number, and which separator is before it."""
        n = at[gt + 1] - at[gt] - 1
        i = _within(n, _places(n))
        x = np.repeat(at[gt], n) + i
        data = np.append(self.data, 0)
        begin, size = mark[x] + 1, mark[x + 1] - mark[x] - 1
        number, digits = np.zeros(len(x), np.int64), (size > 0) & (size < 10) & (data[begin] != ZERO)
        for d in range(min(int(size.max(initial=0)), 9)):
            more = size > d
            digit = data[np.where(more, begin + d, -1)].astype(np.int64) - ZERO
            digits &= ~more | ((digit >= 0) & (digit <= 9))
            number = np.where(more, 10 * number + digit, number)
        single = np.where(size == 1, data[begin], 0)
        same = (single == ZERO) | (single == DOT) | ((size == 0) & (i == 0))
        names, separators = np.full(len(mark), SAME), np.zeros(len(mark), np.int64)
        names[x] = np.select([same, size == 0, digits], [SAME, NONE, number], OTHER)
        separators[x] = np.where(i == 0, 0, np.where(data[begin - 1] == SLASH, 1, 2))
        return names, separators

def _listed(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The number of values of each list, and the row of each value."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)
    return lengths, np.repeat(np.arange(len(lengths)), lengths)


def _codes(names: pa.Array, kinds: Mapping[str, int]) -> np.ndarray:
    coded = pc.fill_null(names, "").dictionary_encode()
    return np.array([kinds.get(x, WHOLE) for x in coded.dictionary.to_pylist()] or [WHOLE])[np.asarray(coded.indices)]


def _samples(samples: pa.Array, formats: pa.Array, n: np.ndarray, kinds: Mapping[str, int], other: bytes):
    """The sample columns of each allele as one list per row and allele."""
    columns, row = _listed(samples)
    fields = Fields(samples.flatten(), row, separated=True)
    keys, key_row = _listed(formats)
    key_at = _places(keys)
    names = formats.flatten()
    codes = np.append(_codes(names, kinds), WHOLE)
    is_gt = np.flatnonzero(np.asarray(pc.fill_null(pc.equal(names, "GT"), False)))[::-1]
    gt = np.full(len(n), -1)
    gt[key_row[is_gt]] = is_gt - key_at[key_row[is_gt]]  # the first of several stays
    f_row = row[fields.text]
    kind = codes[np.where(fields.i < keys[f_row], key_at[f_row] + fields.i, len(codes) - 1)]
    kind[fields.i == gt[f_row]] = GENOTYPE
    # chromosome copies of each sample by its genotype, 0 where it has none
    copies = np.zeros(len(row), np.int64)
    has = np.flatnonzero((gt[row] >= 0) & (gt[row] < fields.n) & ~fields.null)
    at = fields.at[has] + gt[row[has]]
    begin, end = fields.start[at], fields.end[at]
    dot = (end - begin == 1) & (fields.data[np.where(end > begin, begin, 0)] == DOT) if len(fields.data) else np.zeros(len(has), bool)
    copies[has] = np.where(dot, 0, fields.bars_before[end] - fields.bars_before[begin] + 1)
    most = np.full(len(n), 2)
    np.maximum.at(most, row, copies)
    # n alternative alleles, two at least, of p copies have (p + 1)(p + 2) / 2 genotypes or more
    longest = int(fields.values.max(initial=1))
    counts = genotype_counts(int(n.max(initial=0)) + 1, min(int(most.max(initial=2)), int((2 * longest) ** 0.5)) + 1)
    fields.copies = copies[fields.text]
    open_ = np.flatnonzero((kind == PER_GENOTYPE) & (fields.copies == 0))
    for p in range(1, counts.shape[1]):
        # the number of genotypes tells the copies apart, as it grows with them
        fits = (counts[n[f_row[open_]] + 1, p] == fields.values[open_]) & (p <= most[f_row[open_]])
        fields.copies[open_[fits]] = p
    texts, _ = fields.cut(kind, n, counts, other)
    return _lists(pa.ListArray, np.repeat(columns, n), np.repeat(np.asarray(samples.is_null()), n), texts)


def _info(keys: pa.Array, values: pa.Array, n: np.ndarray, kinds: Mapping[str, int]):
    """The INFO entries of each allele as one map per row and allele; genotypes are those of two copies."""
    entries, row = _listed(keys)
    fields = Fields(values.flatten(), row, separated=False)
    fields.copies[:] = 2
    names = keys.flatten()
    texts, entry = fields.cut(_codes(names, kinds), n, genotype_counts(int(n.max(initial=0)) + 1, 3), b"")
    return _lists(pa.MapArray, np.repeat(entries, n), np.repeat(np.asarray(keys.is_null()), n), names.take(pa.array(entry)), texts)


def _lists(kind, lengths: np.ndarray, null: np.ndarray, *children: pa.Array) -> pa.Array:
    return kind.from_arrays(pa.array(_places(lengths), pa.int32()), *children, mask=pa.array(null) if null.any() else None)


def _slices(n: np.ndarray, *texts: pa.Array):
    """Ranges of rows whose texts have about ``SLICE_BYTES``, counted once for every allele."""
    size = np.ones(len(n))
    for t in texts:
        size += np.bincount(_listed(t)[1], np.asarray(pc.fill_null(pc.binary_length(t.flatten()), 0)), len(n))
    ends = np.flatnonzero(np.diff(_places(n * size)[:-1] // SLICE_BYTES)) + 1
    return zip([0, *ends], [*ends, len(n)], strict=True)


def own_values(n: pa.Array, keys: pa.Array, values: pa.Array, formats: pa.Array, samples: pa.Array,
               info_kinds: Mapping[str, int], format_kinds: Mapping[str, int], other: str) -> pa.Array:
    """For each row a list with INFO and samples of each of its ``n`` alternative alleles; NULL where ``n`` is."""
    counts = np.asarray(pc.fill_null(n, 0)).astype(np.int64)
    made = []
    for lo, hi in _slices(counts, values, samples):
        some, rows = counts[lo:hi], slice(lo, hi)
        info = _info(keys[rows], values[rows], some, info_kinds)
        columns = _samples(samples[rows], formats[rows], some, format_kinds, other.encode())
        made.append(_lists(pa.ListArray, some, some == 0, pa.StructArray.from_arrays([info, columns], ["info", "samples"])))
    return pa.concat_arrays(made)
