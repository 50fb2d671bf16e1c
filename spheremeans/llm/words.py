"""Words of many texts at once, in NumPy over Arrow's own buffers.

A word is a run of bytes other than ASCII white space (0x20, 0x09-0x0D). Hashes ignore
the case of A-Z and no other case.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


def fold_case(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case, and nothing else changed."""
    return _FOLD[data]


_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))[_FOLD]


def _powers_of(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        factors[0] = 1
        known = _powers[base] = np.cumprod(factors)
    return known[:n]


@dataclass
class Words:
    """start, end: byte positions in data; doc: the text's number; first: each text's first word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # one more entry than texts

    def hashes(self) -> np.ndarray:
        """64 bits for each word."""
        n = len(self.data)
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.data] * _powers_of(_BASE, n), out=total[1:])
        sums = (total[self.end] - total[self.start]) * _powers_of(_INVERSE, n)[self.start]
        return mix(sums + (self.end - self.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 in one array, and where each begins (and the last ends). Null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def _runs(data: np.ndarray, at: np.ndarray, cut_before: np.ndarray | None = None) -> Words:
    inside = ~_SPACE[data]
    joined = np.zeros(len(data) + 1, dtype=bool)  # does a byte continue the run of the one before?
    joined[1:-1] = inside[:-1] & inside[1:]
    joined[at] = False
    if cut_before is not None:
        joined[:-1] &= ~cut_before
    start = np.flatnonzero(inside & ~joined[:-1])
    end = np.flatnonzero(inside & ~joined[1:]) + 1
    first = np.searchsorted(start, at)
    return Words(data, start, end, np.repeat(np.arange(len(at) - 1), np.diff(first)), first)


def words_of(texts: pa.Array) -> Words:
    return _runs(*bytes_of(texts))


def units_of(texts: pa.Array) -> Words:
    """Words, also cut where an ASCII letter meets another ASCII sign; A-Z in lower case."""
    data, at = bytes_of(texts)
    data = _FOLD[data]
    letter = (data >= 0x61) & (data <= 0x7A)
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = letter[:-1] & ~letter[1:] & (data[1:] < 0x80)
    return _runs(data, at, cut)


def word_strings(words: Words) -> pa.Array:
    """The words as Arrow binary, without copying them one by one."""
    offsets = np.zeros(len(words.start) + 1, dtype=np.int64)
    np.cumsum(words.end - words.start, out=offsets[1:])
    kept = words.data[~_SPACE[words.data]]
    return pa.Array.from_buffers(
        pa.large_binary(), len(words.start), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]
    )


def shingle_hashes(word_hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``size`` words as 64-bit hashes, and the text each belongs to.

    A text of fewer words has one run: all its words. A text without words has none.
    """
    counts = np.diff(first)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(counts)), runs)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs) + first[:-1][doc]
    end = np.minimum(at + size, first[1:][doc])
    out = np.zeros(len(doc), dtype=np.uint64)
    for k in range(size):
        here = at + k
        ok = here < end
        word = np.where(ok, word_hashes[np.minimum(here, max(len(word_hashes) - 1, 0))], np.uint64(0)) if len(word_hashes) else out
        out = mix(out * np.uint64(_BASE) + word + np.uint64(k + 1))
    return out, doc
