"""Bounded picks of a frame that never send more than the bound to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.context import materialise

_STEPS = 1 << 30


def hash_sample(df: DataFrame, key: str, n: int, total: int) -> DataFrame:
    """About ``n`` of the ``total`` rows at most, those of the smallest key hashes.
    Rows that can't be among them go before the sort, so that its tasks together
    keep little more than ``n``."""
    place = F.pmod(F.xxhash64(key), F.lit(_STEPS))
    if total > n:
        df = df.filter(place < int((1.1 * n + 100) / total * _STEPS))
    return df.orderBy(place, key).limit(n)


def most_frequent(counted: DataFrame, key: str, least: int, most: int) -> DataFrame:
    """Keys whose ``n`` add up to over ``least``; if those are over ``most``, to
    over the next power of two minus one that leaves at most ``most`` of them."""
    often = counted.groupBy(key).agg(F.sum("n").alias("n")).filter(F.col("n") > least)
    often = materialise(often, "frequent")
    octaves = {r.octave: r.n for r in often.groupBy(F.floor(F.log2("n")).alias("octave")).agg(F.count("*").alias("n")).collect()}
    while sum(octaves.values()) > most:
        octaves.pop(low := min(octaves))
        least = 2 ** (low + 1) - 1
    return often.filter(F.col("n") > least).select(key)
