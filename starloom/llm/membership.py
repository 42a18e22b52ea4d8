"""A fixed-size bitmap of 64-bit ids, to leave rows out before a shuffle."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 8 MB, whatever the number of ids: beyond some ten million ids it lets more and
#: more rows through, which the join behind it then drops.
BITS = 1 << 26


class Bitmap:
    """Tells "surely not among the ids" from "perhaps"."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def __contains__(self, i: int | None) -> bool:
        if i is None:
            return False
        at = i & (BITS - 1)
        return bool(int(self.words[at >> 6]) >> (at & 63) & 1)


def bitmap(ids: DataFrame, column: str) -> Bitmap:
    """Built in Spark; the driver gets the fixed number of words at most. The low
    bits of the ids must be spread out (counted or hashed ids)."""
    at = F.col(column).bitwiseAND(F.lit(BITS - 1))
    set_words = (
        ids.filter(F.col(column).isNotNull())
        .select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, cast({column} & 63 AS int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toPandas()
    )
    words = np.zeros(BITS >> 6, np.int64)
    words[set_words["word"].to_numpy(np.int64)] = set_words["bits"].to_numpy(np.int64)
    return Bitmap(words.view(np.uint64))


def perhaps(members, column: str) -> Column:
    """True for rows whose id may be among ``members`` (a broadcast bitmap). Only
    the id goes through Python; a null id is not a member."""

    @F.pandas_udf("boolean")
    def test(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        at = ids.fillna(0).to_numpy(np.int64) & (BITS - 1)
        words = members.value.words[at >> 6] >> (at & 63).astype(np.uint64)
        return pd.Series((words & np.uint64(1)).astype(bool) & known)

    return test(F.col(column).cast("bigint"))
