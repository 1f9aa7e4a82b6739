"""Words of many texts at once: bounds and 64-bit keys from the UTF-8 bytes, in numpy.

Words are runs of bytes other than the blank and 0x09-0x0D, if no other bytes are given. A word's key is a polynomial in
its bytes modulo 2^64, taken from running sums, then scrambled. Two different words share a key
with a chance of about 2^-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from presswork.llm.shared import mix64, utf8

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# letters, digits and all bytes of longer characters make words of prose; other ASCII parts them
PUNCTUATED = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# a fixed random-looking number for each byte value
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, kept between calls."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        up = np.full(size, _BASE, dtype=np.uint64)
        down = np.full(size, _INVERSE, dtype=np.uint64)
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up), np.cumprod(down)]
    return _powers[0][:n], _powers[1][:n]


class Sums:
    """Keys of any stretch of an integer sequence, each in constant time."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.total = np.empty(len(values) + 1, dtype=np.uint64)
        self.total[0] = 0
        np.cumsum(values * up[: len(values)], out=self.total[1:])

    def keys(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.total[end] - self.total[start]) * self.down[start] + (end - start).astype(np.uint64))


class Words:
    """``start`` and ``end`` of each word in the bytes, ``rows``: bounds of each row in the words."""

    def __init__(self, column: pa.Array, lower: bool = True, between: np.ndarray = _SPACE):
        flat, bounds = utf8(column)
        self.flat = _LOWER[flat] if lower else flat
        inside = ~between[flat]
        n = len(flat)
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = bounds[:-1][(bounds[:-1] < n) & (np.diff(bounds) > 0)]
        begins[edges] = inside[edges]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        last = edges[edges > 0] - 1
        ends[last] = inside[last]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.bounds = bounds
        self.rows = np.searchsorted(self.start, bounds)

    def keys(self) -> np.ndarray:
        self.sums = Sums(_BYTE[self.flat])
        return self.sums.keys(self.start, self.end)

    def prefix_keys(self, n: int) -> np.ndarray:
        """Keys of the first ``n`` bytes of each word, after ``keys``."""
        return self.sums.keys(self.start, np.minimum(self.end, self.start + n))

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


def word_key(word: str) -> int:
    """Key of a single word, as ``Words.keys`` gives it."""
    return int(Words(pa.array([word]), lower=False).keys()[0])
