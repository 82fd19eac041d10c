"""Byte-pair encoding by a tokenization automaton compiled from the merges, and decoding.

The automaton starts as one state that reads any byte. Each merge ``u v -> uv``, in order
of priority, adds a gadget: wherever ``u`` and then ``v`` could be read, the arc ``uv`` leads
to where ``v`` led, and the arc ``u`` is redirected to a copy of its target that no longer
reads ``v``. What remains accepts, for each byte string, exactly the one sequence of tokens
that the merges produce. All arcs of one label lead to one state, so a state is stored as
the label before it and the merge that made it, which say what it reads; answers are kept in
a transition table.

Encoding: texts are cut into words as the tokenizer's pre-tokenizer does (whole buffers at
once), distinct words are run through the table, longest arcs first, and results are joined
back. Since each prefix has one path only, an offset that once led nowhere needs no second
visit, and the work per word is linear in its length. Decoding emits the arcs' labels.

Supported files: byte-level BPE in the tokenizers JSON format, without normalizer,
post-processor, dropout or added prefix space. Special tokens in a text become their ids,
as the library does by default.

Defined results: null and empty texts have no tokens; any code point is encoded; repeated
rows give repeated rows; an empty table gives an empty result; all columns of the documents
are kept in ``doc``, whatever their names.
"""

from __future__ import annotations

import json
from array import array

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_docs, ready, table
from .words import RADIX, RADIX_INV, mix, powers

ROOT = 0
NO_ARC = -2
PREFIX = 4  # bytes by which the lengths of possible arcs are looked up


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level tokenizers: printable Latin-1 bytes stand for themselves."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Automaton:
    """The tokenization automaton; ``label[id]`` are a token's bytes, ``to[id]`` the state after it."""

    CACHE = 1 << 20

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]], specials: dict[str, int]):
        self.vocabulary = vocabulary
        size = max([*vocabulary.values(), *specials.values()], default=0) + 1
        self.label = [b""] * size
        for piece, i in vocabulary.items():
            self.label[i] = piece
        for piece, i in specials.items():
            self.label[i] = piece.encode()
        self.specials = specials
        # per label: its merge's rank (bytes: -1; NO_ARC: no merge led to it yet), left part, state after it, and that state when the label was new
        self.rank = [-1 if len(x) == 1 else NO_ARC for x in self.label]
        self.left, self.to, self.base = [-1] * size, [ROOT] * size, [ROOT] * size
        # per state: the label whose arcs lead to it and the merge that made it; per label and label taken away after it: that merge
        self.owner, self.made = [-1], [-1]
        self.taken: dict[int, int] = {}
        self.reads: dict[int, bool] = {}
        for rank, (a, b) in enumerate(merges):
            self._gadget(rank, vocabulary[a], vocabulary[b], vocabulary[a + b])
        self.arcs = {p: i for p, i in vocabulary.items() if self.rank[i] != NO_ARC}
        found: dict[bytes, set[int]] = {}
        for piece in self.arcs:
            found.setdefault(piece[:PREFIX], set()).add(len(piece))
        self.sizes = {p: tuple(sorted(found[p] | {n for n in range(1, len(p)) if p[:n] in self.arcs}, reverse=True)) for p in found}

    def _gadget(self, rank: int, u: int, v: int, uv: int) -> None:
        if self.rank[uv] >= 0 or NO_ARC in (self.rank[u], self.rank[v]) or not self._reads(self.to[u], v):
            return  # never read one after the other, so the merge never happens
        self.rank[uv], self.left[uv], self.to[uv], self.base[uv] = rank, u, self.to[v], self.to[v]
        # the copy reads what its original does, but for v: what it reads follows from owner and merge
        self.owner.append(u)
        self.made.append(rank)
        self.taken[u << 20 | v] = rank
        self.to[u] = len(self.owner) - 1

    def _reads(self, state: int, label: int) -> bool:
        """Whether a state has an arc: followed back through the copies and the merges that brought the arc."""
        rank, taken = self.rank, self.taken
        while state != ROOT:
            u, upto = self.owner[state], self.made[state]
            while True:
                gone = taken.get(u << 20 | label)
                if gone is not None and gone <= upto:
                    return False
                if rank[label] <= rank[u]:  # the arc is no newer than u: inherited with u's first state
                    break
                upto = min(upto, rank[label])  # it came with a merge: there if its left part was
                label = self.left[label]
            state = self.base[u]
        return True

    def transition(self, state: int, label: int) -> bool:
        key = state << 20 | label
        known = self.reads.get(key)
        if known is None:
            if len(self.reads) >= self.CACHE:
                self.reads.clear()
            known = self.reads[key] = self._reads(state, label)
        return known

    def _sizes(self, prefix: bytes) -> tuple[int, ...]:
        """Lengths of arcs that may begin with ``prefix`` (``PREFIX`` bytes, fewer at a word's end), longest first."""
        known = self.sizes.get(prefix)
        if known is None:
            known = self.sizes[prefix] = tuple(n for n in range(len(prefix), 0, -1) if prefix[:n] in self.arcs)
        return known

    def encode_word(self, word: bytes) -> list[int]:
        whole = self.arcs.get(word)
        if whole is not None:
            return [whole]
        n, arc, table, to = len(word), self.arcs.get, self.reads.get, self.to
        ids: list[int] = []
        dead: set[int] = set()
        at, state, below = 0, ROOT, n + 1
        while at < n:
            for size in self._sizes(word[at : at + PREFIX]):
                end = at + size
                if size >= below or end > n or end in dead:
                    continue
                token = arc(word[at:end])
                if token is None:
                    continue
                reads = table(state << 20 | token)
                if reads is None:
                    reads = self.transition(state, token)
                if reads:
                    ids.append(token)
                    at, state, below = end, to[token], n + 1
                    break
            else:  # no arc leads on: this offset is on no path
                dead.add(at)
                if not ids:
                    raise ValueError("the vocabulary lacks a byte of the text")
                below = len(self.label[ids.pop()])
                at -= below
                state = to[ids[-1]] if ids else ROOT
        return ids

    def decode(self, ids) -> bytes:
        return b"".join(map(self.label.__getitem__, ids))


def compile_file(text: str) -> Automaton:
    """The automaton of a tokenizer file's JSON text."""
    spec = json.loads(text)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    if (model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"]
            or model.get("ignore_merges") or model.get("dropout") or not pre.get("use_regex", True)):
        raise ValueError("only plain byte-level BPE files are supported")
    alphabet = byte_alphabet()
    raw = lambda piece: bytes(alphabet[c] for c in piece)
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocabulary = {raw(p): i for p, i in model["vocab"].items() if p not in specials}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return Automaton(vocabulary, [(raw(a), raw(b)) for a, b in pairs], specials)


# ---------------------------------------------------------------- pre-tokenizer

LETTERS, NUMBERS, SPACES, OTHERS = 0, 1, 2, 3


def character_classes() -> np.ndarray:
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every = "".join(map(chr, points))
    out = np.full(0x110000, OTHERS, dtype=np.uint8)
    for kind, pattern in ((LETTERS, r"\p{L}+"), (NUMBERS, r"\p{N}+"), (SPACES, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[[points[i] for i in range(m.start(), m.end())]] = kind
    return out


def token_starts(cps: np.ndarray, breaks: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where the pre-tokenizer's words begin. ``breaks``: where a text begins (sorted, the first is 0).

    The rules: an apostrophe and s, t, m, d, re, ve or ll; else one blank at most and a run of
    letters, numbers or other signs; of white space before something else the last character
    is left for the next word (a blank goes with it, anything else stands alone).
    """
    n = len(cps)
    kind = classes[cps]
    border = np.zeros(n + 1, dtype=bool)
    border[breaks] = True
    border[n] = True
    run = border.copy()
    run[1:n] |= kind[1:] != kind[:-1]
    start = run.copy()
    runs = np.flatnonzero(run)
    lo, hi = runs[:-1], runs[1:]
    blank = (kind[lo] == SPACES) & ~border[hi]
    lo, hi = lo[blank], hi[blank]
    joins = cps[hi - 1] == 0x20
    start[hi[joins]] = False
    start[hi - 1] = True
    # contractions, where an apostrophe begins a word
    quote = np.flatnonzero((cps == 0x27) & start[:n])
    wide = np.concatenate([cps, np.zeros(3, dtype=cps.dtype)])
    edge = np.concatenate([border, np.ones(3, dtype=bool)])
    a, b = wide[quote + 1], wide[quote + 2]
    one = ~edge[quote + 1] & np.isin(a, [ord(c) for c in "stmd"])
    two = ~edge[quote + 1] & ~edge[quote + 2] & (
        ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
    start[quote[one] + 1] = False
    start[quote[one] + 2] = True
    start[quote[two] + 1] = False
    start[quote[two] + 3] = True
    return start[:n]


class Encoder:
    """Encodes lists of texts; keeps the tokens of words it has met, up to ``words`` of them."""

    SEGMENT = 1 << 19

    def __init__(self, automaton: Automaton, words: int = 600_000):
        self.automaton, self.limit = automaton, words
        self.classes = character_classes()
        self.up, self.down = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64)
        self.special = regex.compile("|".join(map(regex.escape, sorted(automaton.specials, key=len, reverse=True)))
                                     ) if automaton.specials else None
        self.lengths = np.array([len(x) for x in automaton.label], dtype=np.int64)
        self.labels = np.frombuffer(b"".join(automaton.label), dtype=np.uint8)
        self.label_at = np.cumsum(self.lengths) - self.lengths
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.arena, self.first, self.count = array("i"), array("q"), array("q")

    def _learn(self, key: int, ids: list[int]) -> int:
        i = self.known[key] = len(self.first)
        self.first.append(len(self.arena))
        self.count.append(len(ids))
        self.arena.extend(ids)
        return i

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids begin (and the last end)."""
        ids, counts = [], []
        for group in self._groups([t or "" for t in texts]):
            got, per = self._encode_segment(group)
            ids.append(got)
            counts.append(per)
        # a long text came as several segments, the continuing ones marked
        ids = np.concatenate(ids) if ids else np.empty(0, dtype=np.int32)
        offsets = np.zeros(len(texts) + 1, dtype=np.int64)
        flat = [x for per in counts for x in per]
        for i, n in flat:
            offsets[i + 1] += n
        return ids, np.cumsum(offsets)

    def _groups(self, texts: list):
        """Lists of (text number, piece) of about ``SEGMENT`` characters; pieces end before white space."""
        held, size = [], 0
        for i, text in enumerate(texts):
            at = 0
            while True:
                piece, end = text, len(text)
                if len(text) - at > self.SEGMENT:
                    end = self._cut(text, at)
                if at or end < len(text):
                    piece = text[at:end]
                if held and size + len(piece) > self.SEGMENT:
                    yield held
                    held, size = [], 0
                held.append((i, piece))
                size += len(piece)
                at = end
                if at >= len(text):
                    break
        if held:
            yield held

    def _cut(self, text: str, at: int) -> int:
        """An offset before white space that follows something else: no word crosses it."""
        for m in regex.finditer(r"(?<=\S)\s", text, pos=at + self.SEGMENT):
            return m.start()
        return len(text)

    def _encode_segment(self, group: list) -> tuple[np.ndarray, list]:
        joined = "".join(p for _, p in group)
        n = len(joined)
        if not n:
            return np.empty(0, dtype=np.int32), []
        cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum([len(p) for _, p in group])
        begins = ends - [len(p) for _, p in group]
        breaks = set(begins[begins < n].tolist())
        found = []
        if self.special is not None:
            at = 0
            for _, piece in group:
                found += [(at + m.start(), at + m.end()) for m in self.special.finditer(piece)]
                at += len(piece)
        breaks.update(x for span in found for x in span if x < n)
        start = token_starts(cps, np.array(sorted(breaks)), self.classes)
        for a, b in found:
            start[a + 1 : b] = False
        lo = np.flatnonzero(start)
        hi = np.append(lo[1:], n)
        if len(self.up) <= n:
            self.up, self.down = powers(int(RADIX), n + 1), powers(RADIX_INV, n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mix(cps.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=total[1:])
        keys, sample, which = np.unique((total[hi] - total[lo]) * self.down[lo], return_index=True, return_inverse=True)
        if len(self.known) + len(keys) > self.limit:
            self._forget()
        specials = {a for a, _ in found}
        index = np.empty(len(keys), dtype=np.int64)
        get, word = self.known.get, self.automaton.encode_word
        for j, (key, a, b) in enumerate(zip(keys.tolist(), lo[sample].tolist(), hi[sample].tolist(), strict=True)):
            i = get(key)
            if i is None:
                piece = joined[a:b]
                ids = [self.automaton.specials[piece]] if a in specials else word(piece.encode("utf-8", "surrogatepass"))
                i = self._learn(key, ids)
            index[j] = i
        picked = index[which]
        counts = np.frombuffer(self.count, dtype=np.int64)[picked]
        first = np.frombuffer(self.first, dtype=np.int64)[picked]
        edge = np.cumsum(counts)
        ids = np.frombuffer(self.arena, dtype=np.int32)[np.repeat(first - edge + counts, counts) + np.arange(edge[-1])]
        if self.decode_bytes(ids) != joined.encode("utf-8", "surrogatepass"):
            # two words with one 64-bit key: without the shared table
            ids_of = [[self.automaton.specials[joined[a:b]]] if a in specials else word(joined[a:b].encode("utf-8", "surrogatepass"))
                      for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
            ids = np.array([x for w in ids_of for x in w], dtype=np.int32)
            edge = np.cumsum([len(w) for w in ids_of])
        upto = np.concatenate([[0], edge])
        at = np.searchsorted(lo, np.concatenate([begins, [n]]))
        per = np.diff(upto[at])
        return ids, [(i, int(k)) for (i, _), k in zip(group, per, strict=True)]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The labels of the arcs ``ids``, one after the other."""
        size = self.lengths[ids]
        edge = np.cumsum(size)
        total = int(edge[-1]) if len(ids) else 0
        return self.labels[np.repeat(self.label_at[ids] - edge + size, size) + np.arange(total)].tobytes()


_ENCODERS: dict[int, Encoder] = {}


def _make(sent):
    """One encoder per worker process and tokenizer: its tables outlive a task."""
    def make():
        key = hash(sent.value)
        if key not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[key] = Encoder(compile_file(sent.value))
        encoder = _ENCODERS[key]

        def run(texts: list):
            import pyarrow as pa

            ids, offsets = encoder.encode(texts)
            decoded = []
            for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
                decoded.append(encoder.decode_bytes(ids[lo:hi]).decode("utf-8", "replace"))
            return [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)), decoded]

        return run

    return make


def encode_documents(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """``doc`` (all columns), ids (tokens of the whole text) and decoded (the text read back from the ids)."""
    spark = ready(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())
    return map_docs(docs, text_col, "ids array<int>, decoded string", _make(sent))


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc.doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_bpe(spark, sf_dir):
    """Tokens of every document and the text decoded from them, as digests."""
    ready(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(encode_documents(docs, tokenizer_file()))
