"""Near duplicates by HyperMinHash registers.

A set's tokens are hashed into ``BUCKETS`` buckets. Of the smallest hash in each, a
register keeps one byte: the number of leading zeros and the bits after the first one
(the mantissa). Two sets agree in a register with the probability of their Jaccard
similarity, but for a collision now and then, whose rate follows from the sizes.

A small set would leave buckets empty, so each token of a set is placed several times,
more often the fewer tokens there are: the number of places follows the size level (the
bit length of the size). Sets that link differ by one level at most, so a set has
registers for each level that a smaller partner can have.

Registers are signed in bands, as long as pairs at the limit still share one. Sets that
share a band are compared, in the bucket of their first common band, by the share of
equal registers, less the expected collisions: what may link by that estimate, with
seven standard deviations to spare, and by a bitmap of parities, is tested on the full
sets. A pair at the limit of 85 % is missed with a probability of about 3e-9, and less
above it.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import shingles
from starloom.llm.hashing import mix
from starloom.llm.set_join import narrowed, set_components

SHINGLE = 5
PERCENT = 85
BUCKETS = 256
#: Probability at most with which a pair at the limit shares no band.
MISSED = 1e-8
#: Places for each bucket that a set has at least.
FILL = 4
MANTISSA = 4
#: Register of a bucket without a token.
EMPTY = 255
SPARE = 7

_SEEDS = mix(np.arange(1, FILL * BUCKETS + 1, dtype=np.uint64))
_STARTS = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(56)
_TIMES = mix(np.arange(1 << 20, (1 << 20) + BUCKETS, dtype=np.uint64)) | np.uint64(1)
_PAIRS = 10_000  # compared at once


def levels(n: int, percent: int) -> range:
    """Size levels of a set of n tokens and of the smaller sets that it can link with."""
    return range(int(-(-percent * n // 100)).bit_length(), n.bit_length() + 1)


@lru_cache
def band_length(percent: int) -> int:
    """Registers of a band: 6 for 85 %, in 42 bands."""
    fits = lambda r: (1 - (percent / 100) ** r) ** (BUCKETS // r) <= MISSED
    return max(r for r in range(1, BUCKETS + 1) if r == 1 or fits(r))


def registers(tokens: np.ndarray, level: int) -> np.ndarray:
    """One byte for each bucket."""
    places = max(1, -(-FILL * BUCKETS // (1 << level - 1)))
    h = np.sort(mix(tokens[:, None] ^ _SEEDS[None, :places]).ravel())
    at = np.minimum(np.searchsorted(h, _STARTS), len(h) - 1)
    least = h[at]
    filled = (least >> np.uint64(56)).astype(np.int64) == np.arange(BUCKETS)
    rest = least << np.uint64(8)
    below = rest.copy()
    for k in (1, 2, 4, 8, 16, 32):
        below |= below >> np.uint64(k)
    zeros = np.uint64(64) - np.bitwise_count(below)
    mantissa = (rest << np.minimum(zeros, 62) << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    made = (np.minimum(zeros, 15) << np.uint64(MANTISSA)) + mantissa
    return np.where(filled, np.minimum(made, EMPTY - 1), EMPTY).astype(np.uint8)


def _hashes(bands: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Signatures of bands; a band's number tells its place and level."""
    size = bands.shape[-1]
    return mix((bands.astype(np.uint64) * _TIMES[:size]).sum(-1, dtype=np.uint64) + mix(number))


def _bands(rows: np.ndarray, percent: int) -> np.ndarray:
    size = band_length(percent)
    return rows[..., : BUCKETS // size * size].reshape(*rows.shape[:-1], BUCKETS // size, size)


def signatures(tokens: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """A hash for each band of registers that is not empty, at each level."""
    out = []
    for level in levels(len(tokens), percent):
        bands = _bands(registers(tokens, level), percent)
        h = _hashes(bands, np.arange(len(bands), dtype=np.uint64) + np.uint64(level * BUCKETS))
        out.append(h[(bands != EMPTY).any(1)])
    return np.concatenate(out)


def mark(tokens: np.ndarray, percent: int = PERCENT) -> bytes:
    """Number of levels, registers of each from the highest down, and the mark of the set
    itself (size and parities)."""
    at = levels(len(tokens), percent)[::-1]
    return bytes([len(at)]) + b"".join(registers(tokens, k).tobytes() for k in at) + shingles.mark(tokens)


def collisions(n, m):
    """Probability that two unlike smallest hashes get one register: the cells are as
    wide as 2 ** -MANTISSA of the power of two below, which on the average is
    1 / (2 ln 2) of the value; integrated over two exponential densities."""
    return n * m / (n + m) ** 2 / (2 * np.log(2)) * 2.0**-MANTISSA


def estimate(n, m, equal, filled):
    """Jaccard similarity of sets of n and m tokens, of whose ``filled`` buckets
    ``equal`` have equal registers, less the expected collisions."""
    chance = collisions(n, m)
    return (equal / np.maximum(filled, 1) - chance) / (1 - chance)


def _may(n, m, equal, filled, percent: int):
    p = percent / 100
    return estimate(n, m, equal, filled) >= p - SPARE * np.sqrt(p * (1 - p) / np.maximum(filled, 1))


def table(marks: list[bytes]):
    """Of marks: sizes, their levels, where their registers begin, how many levels they
    have, all registers, and the table of the sets' own marks."""
    count = np.array([x[0] for x in marks], np.int64)
    ends = (1 + BUCKETS * count).tolist()
    rows = np.frombuffer(b"".join(x[1:e] for x, e in zip(marks, ends)), np.uint8).reshape(-1, BUCKETS)
    own = shingles.table([x[e:] for x, e in zip(marks, ends)])
    high = np.array([int(k).bit_length() for k in own[0]])
    return own[0], high, np.cumsum(count) - count, count, rows, own


def near(held, i: np.ndarray, j: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Which of the pairs of places may link by the estimate, at the smaller's level, and
    by their parities."""
    n, high, start, _, rows, own = held
    good = shingles.near(own, i, j, percent)
    for at in np.array_split(np.flatnonzero(good), len(i) // _PAIRS + 1):
        level = np.minimum(high[i[at]], high[j[at]])
        a, b = (rows[start[k[at]] + high[k[at]] - level] for k in (i, j))
        none = ((a == EMPTY) & (b == EMPTY)).sum(1)
        good[at] = _may(n[i[at]], n[j[at]], (a == b).sum(1) - none, BUCKETS - none, percent)
    return good


def first(held, i: np.ndarray, j: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Signature of the first band, from the smaller's level down, that each pair of
    places shares; zero if there is none."""
    _, high, start, count, rows, _ = held
    out = np.zeros(len(i), np.uint64)
    for part in np.array_split(np.arange(len(i)), len(i) // _PAIRS + 1):
        left, level = part, np.minimum(high[i[part]], high[j[part]])
        while len(left):
            down = [high[k[left]] - level for k in (i, j)]
            some = (down[0] < count[i[left]]) & (down[1] < count[j[left]])
            left, level = left[some], level[some]
            a, b = (_bands(rows[start[k[left]] + high[k[left]] - level], percent) for k in (i, j))
            same = (a == b).all(2) & (a != EMPTY).any(2)
            at = same.argmax(1)
            met = same[np.arange(len(left)), at]
            number = (level * BUCKETS + at).astype(np.uint64)
            out[left[met]] = _hashes(a[met, at[met]], number[met])
            left, level = left[~met], level[~met] - 1
    return out.view(np.int64)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` and ``kept`` of each row: the smallest key
    that links reach, its own included, and whether that is the row's own. Sets of
    ``size``-word shingles link if 100 * intersection is at least ``percent`` * union.

    Null, empty and blank texts have an empty set and link with nothing, not even each
    other; fewer words than ``size`` are one shingle. Equal sets link. A null key stays
    null and is not kept; it links others but names a component only if that has no other
    key. Repeated rows each give a row; other columns are not read.
    """
    found = set_components(
        narrowed(docs, key, text),
        size,
        percent,
        signatures=lambda tokens: signatures(tokens, percent),
        mark=lambda tokens: mark(tokens, percent),
        table=table,
        near=lambda held, i, j: near(held, i, j, percent),
        first=lambda held, i, j: first(held, i, j, percent),
    )
    kept = F.coalesce(F.col("key") == F.col("low"), F.lit(False))
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("low").alias("component_id"), kept.alias("kept"))
