"""Hashes of words and of runs of words, vectorised."""

from __future__ import annotations

import numpy as np
import pandas as pd

_BASE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03))
_INVERSE = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in _BASE)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit keyed hashes, the same in every process."""
    if not words:
        return np.zeros(0, np.uint64)
    held = np.empty(len(words), object)
    held[:] = words
    return pd.util.hash_array(held, categorize=False)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Runs:
    """Hashes of any runs of consecutive words of one text."""

    def __init__(self, hashes: np.ndarray, which: int = 0):
        n = len(hashes)
        self.total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * powers(_BASE[which], n), dtype=np.uint64)))
        self.back = powers(_INVERSE[which], n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (np.asarray(end) - np.asarray(start)).astype(np.uint64)
        return mix((self.total[end] - self.total[start]) * self.back[start] + length)


def fixed_runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words, at every place that has one."""
    n = len(hashes) - size + 1
    out = hashes[:n].copy()
    for i in range(1, size):
        out *= _BASE[0]
        out += hashes[i : i + n]
    return mix(out + np.uint64(size))


def sorted_distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.concatenate(([True], h[1:] != h[:-1]))] if len(h) else h


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's bigint."""
    return h.view(np.int64)
