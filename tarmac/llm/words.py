"""Word boundaries and 64-bit word and window hashes of many texts at once, with NumPy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tarmac.llm.common import text_bytes

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def numbers(count: int, seed: int) -> np.ndarray:
    """``count`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, count + 1, dtype=_U) + _U(seed * 1_000_003)) * _U(0x9E3779B97F4A7C15))


class Powers:
    """Powers of an odd base modulo 2**64 and their inverses, extended as longer inputs come."""

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self.up = self.down = np.ones(0, _U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                powers = np.full(size, base, _U)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype=_U))
        return self.up[:n], self.down[:n]


class Hasher:
    """Splits texts into words and hashes words and windows of words. One per task.

    ``separators`` are the bytes between words; the default is the ASCII white space. Bytes above 127 always
    belong to words, so no code point is cut. Equal words have equal hashes in every task.
    """

    def __init__(self, separators: bytes = b" \t\n\v\f\r", seed: int = 0):
        self.inside = np.ones(256, bool)
        self.inside[list(separators)] = False
        self.byte_codes = numbers(256, 7 + seed)
        self.bytes_base, self.words_base = Powers(0x9E3779B97F4A7C15 + 2 * seed), Powers(0xD1342543DE82EF95 + 2 * seed)

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order, and the number of the first word of each text (one more at the end)."""
        data, offsets = text_bytes(texts)
        starts, ends, first = self.bounds(data, offsets)
        return self.hashes(data, starts, ends), first

    def bounds(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inside = self.inside[data]
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        before = np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        after = np.empty_like(inside)
        after[-1], after[:-1] = False, inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        before[edges] = False
        after[edges - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(starts, offsets)

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, _U)
        up, down = self.bytes_base.get(len(data))
        terms = self.byte_codes[data] * up
        sums = np.cumsum(terms, dtype=_U)
        value = (sums[ends - 1] - sums[starts] + terms[starts]) * down[starts]
        return mix(value + (ends - starts).astype(_U) * _U(0xA0761D6478BD642F))

    def windows(self, hashes: np.ndarray, width: int) -> np.ndarray:
        """Hash of the ``width`` words from each position, also across texts; the caller picks valid positions."""
        n = len(hashes)
        if n < width:
            return np.zeros(0, _U)
        up, down = self.words_base.get(n)
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(hashes * up, dtype=_U)])
        return mix((sums[width:] - sums[:-width]) * down[: n - width + 1])

    def spans(self, hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words from ``start`` up to ``end``, also for spans of different lengths."""
        if not len(hashes):
            return np.zeros(len(start), _U)
        up, down = self.words_base.get(len(hashes))
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(hashes * up, dtype=_U)])
        scaled = (sums[end] - sums[start]) * down[np.minimum(start, len(hashes) - 1)]
        return mix(scaled + mix((end - start).astype(_U)))


def window_starts(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a window of ``width`` words lies in one text, and that text's row."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + first[:-1][rows], rows
