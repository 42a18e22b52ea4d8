"""Sets of word n-grams as sorted hashes, their sketches, and exact Jaccard tests."""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.llm.hashing import fixed_runs, sorted_distinct, word_hashes

#: Bits of the longest sketch kept with a set: 1 KB.
MOST_BITS = 8192
#: Bits that all sketches have at least, and to which they are folded to be compared first.
LEAST_BITS = 512


def shingle_set(data: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of the whole
    sequence, if it is shorter; none without words."""
    h = word_hashes((data or b"").lower().split())
    return sorted_distinct(fixed_runs(h, min(size, len(h)))) if len(h) else h


def set_id(tokens: np.ndarray) -> int:
    """64 bits of a digest of the set, never null; sets are told apart by it."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def links(x: bytes, y: bytes, percent: int) -> bool:
    """100 * intersection >= percent * union, of two sets as bytes."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = np.concatenate((a, b))
    both.sort()
    same = int((both[1:] == both[:-1]).sum())
    return 100 * same >= percent * (len(a) + len(b) - same)


def lane(n: Column, percent: int) -> Column:
    """Sets that link lie in equal or adjacent lanes: their sizes differ by a factor
    of 100 / percent at most."""
    step = math.log(100 / percent) * 1.0001 if percent < 100 else 1e-9
    return F.floor(F.log(n) / F.lit(step)).cast("bigint")


def mark(tokens: np.ndarray) -> bytes:
    """Size and a bitmap of parities: tokens hashed to about two bits each. Sets differ
    in at least as many tokens as their bitmaps of one length differ in bits."""
    n = len(tokens)
    bits = min(max(64 << (n // 40).bit_length(), LEAST_BITS), MOST_BITS)
    counts = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return n.to_bytes(8, "little") + np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _folded(x: np.ndarray, words: int) -> np.ndarray:
    """A bitmap folded to ``words`` words of 64 bits."""
    return np.bitwise_xor.reduce(x.reshape(-1, words), 0)


def _may(n, m, apart, percent: int):
    # sizes n, m and a difference of d: union (n + m + d) / 2, intersection (n + m - d) / 2
    return 100 * (n + m - apart) >= percent * (n + m + apart)


def table(marks: list[bytes]):
    """Sizes, short bitmaps, and whole bitmaps of marks."""
    own = [np.frombuffer(x, np.uint64) for x in marks]
    sizes = np.array([int(x[0]) for x in own], np.int64)
    own = [x[1:] for x in own]
    return sizes, np.stack([_folded(x, LEAST_BITS // 64) for x in own]), own


def near(held, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which of the pairs of places can link by their sizes and parities."""
    n, short, own = held
    good = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
    at = np.flatnonzero(good)
    apart = np.zeros(len(at), np.int64)
    for w in range(short.shape[1]):
        column = short[:, w]
        apart += np.bitwise_count(column[i[at]] ^ column[j[at]])
    at = at[_may(n[i[at]], n[j[at]], apart, percent)]
    good[:] = False
    good[at] = True
    length = np.array([len(x) for x in own])
    words = np.minimum(length[i[at]], length[j[at]])
    for k in np.unique(words).tolist():
        if 64 * k <= LEAST_BITS:
            continue
        some = at[words == k]
        places = np.unique(np.concatenate((i[some], j[some])))
        folded = np.stack([_folded(own[p], k) for p in places.tolist()])
        for part in np.array_split(some, len(some) * k // 500_000 + 1):
            a, b = (folded[np.searchsorted(places, side[part])] for side in (i, j))
            apart = np.bitwise_count(a ^ b).sum(1, dtype=np.int64)
            good[part] = _may(n[i[part]], n[j[part]], apart, percent)
    return good
