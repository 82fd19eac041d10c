"""Words of a text as bytes and as 64-bit hashes, computed over whole buffers at once.

A word is a maximal run of digits, letters a-z (A-Z are lower-cased first) and characters
outside ASCII. ``str.lower`` isn't used: only A-Z change.
"""

from __future__ import annotations

import numpy as np

KEEP = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in KEEP else 0x20 for b in range(256))

SEGMENT = 1 << 20
RADIX = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
RADIX_INV = pow(int(RADIX), -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out[:n]


LETTER = mix(np.arange(1, 257, dtype=np.uint64))
_POWERS: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SEGMENT + 1)
        _POWERS["up"], _POWERS["down"] = powers(int(RADIX), size), powers(RADIX_INV, size)
    return _POWERS["up"], _POWERS["down"]


def normalised(text: str | None) -> bytes:
    """The words of ``text`` with single blanks for every other byte."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE)


def split(text: str | None) -> list[bytes]:
    return normalised(text).split()


def _segment_hashes(buf: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the words of one buffer."""
    a = np.frombuffer(buf, dtype=np.uint8)
    inside = np.zeros(len(a) + 2, dtype=np.int8)
    inside[1:-1] = a != 0x20
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _tables(len(a) + 1)
    total = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum(LETTER[a] * up[: len(a)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts]), starts


def _long_hashes(buf: bytes) -> np.ndarray:
    """As above for one long text, in segments that end between words."""
    out, at = [], 0
    while at < len(buf):
        end = at + SEGMENT
        if end < len(buf):
            cut = buf.rfind(b" ", at, end)
            end = cut if cut > at else (buf.find(b" ", end) + 1 or len(buf) + 1) - 1
        out.append(_segment_hashes(buf[at:end])[0])
        at = end
        while buf[at : at + 1] == b" ":
            at += 1
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` one after the other, and where each text's words begin (and the last end)."""
    bufs = [normalised(t) for t in texts]
    hashes, counts = [], []
    lo = 0
    while lo < len(bufs):
        hi, held = lo, 0
        while hi < len(bufs) and (hi == lo or held + len(bufs[hi]) + 1 <= SEGMENT):
            held += len(bufs[hi]) + 1
            hi += 1
        if hi == lo + 1 and len(bufs[lo]) > SEGMENT:
            h = _long_hashes(bufs[lo])
            counts.append(np.array([len(h)]))
        else:
            h, starts = _segment_hashes(b" ".join(bufs[lo:hi]))
            bounds = np.cumsum([len(b) + 1 for b in bufs[lo:hi]])
            counts.append(np.diff(np.searchsorted(starts, bounds), prepend=0))
        hashes.append(h)
        lo = hi
    if not bufs:
        return np.empty(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64)
