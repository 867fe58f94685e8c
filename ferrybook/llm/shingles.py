"""Hashed words and word shingles of many texts at once, on the bytes of an Arrow column."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

_ONE = np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SEGMENT = 1 << 20
_rng = np.random.default_rng(20240229)
_LETTER = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | _ONE
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | _ONE

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

# separators of words made of ASCII letters, digits and everything beyond ASCII, after lower-casing
MARKS = np.zeros(256, bool)
MARKS[:0x80] = True
MARKS[0x30:0x3A] = MARKS[0x61:0x7B] = False


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up, down = np.full(n + 1, _BASE), np.full(n + 1, _INVERSE)
        up[0] = down[0] = _ONE
        return np.cumprod(up), np.cumprod(down)


_UP, _DOWN = _powers(_SEGMENT)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits so that every bit of the result depends on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a text column: bounds in its lower-cased bytes, and the first word of every row."""

    def __init__(self, texts: pa.Array, separators: np.ndarray):
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        self.raw, self.data = data, _LOWER[data]
        self.offsets = offsets - offsets[0]
        inner = np.zeros(len(data) + 2, bool)
        inner[1:-1] = ~separators[self.data]
        first = inner[1:] & ~inner[:-1]  # first[i]: byte i begins a word
        last = inner[:-1] & ~inner[1:]  # last[i]: a word ends before byte i
        cuts = self.offsets[1:-1]
        cuts = cuts[inner[cuts] & inner[cuts + 1]]  # a word must not run over into the next row
        first[cuts] = True
        last[cuts] = True
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last)
        self.rows = np.searchsorted(self.starts, self.offsets)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word."""
        out = np.empty(len(self.starts), np.uint64)
        i = 0
        with np.errstate(over="ignore"):
            while i < len(out):
                base = self.starts[i]
                j = max(i + 1, int(np.searchsorted(self.ends, base + _SEGMENT, "right")))
                length = int(self.ends[j - 1] - base)
                up, down = (_UP, _DOWN) if length <= _SEGMENT else _powers(length)
                sums = np.zeros(length + 1, np.uint64)
                np.cumsum(_LETTER[self.data[base : base + length]] * up[:length], out=sums[1:])
                s, e = self.starts[i:j] - base, self.ends[i:j] - base
                out[i:j] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
                i = j
        return out


def shingle_sets(texts: pa.Array, size: int = 5) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its ``size``-word shingles.

    A row with fewer words has its whole sequence as one shingle; without words, or null, none.
    Hashes are below 2**63 and equal the same for equal word sequences whatever stands between words.
    """
    words = Words(texts, SPACES)
    hashes = words.hashes()
    grams = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            grams += hashes[k : k + len(grams)] * _PLACE[k]
        grams = mixed(grams) >> _ONE
        out = []
        for a, b in zip(words.rows[:-1], words.rows[1:]):
            if b - a >= size:
                out.append(np.unique(grams[a : b - size + 1]))
            elif b > a:
                whole = (hashes[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a) * _PLACE[-1]
                out.append(mixed(np.array([whole], np.uint64)) >> _ONE)
            else:
                out.append(np.empty(0, np.uint64))
    return out


def digest(values: np.ndarray) -> bytes:
    """16 bytes that stand for a whole sorted set."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()
