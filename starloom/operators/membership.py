"""A bitmap of fixed size over keys, as rows that join by broadcast: tells rows whose
key is surely not among the keys before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 64-bit words of a bitmap: 65,536 rows, about a megabyte, whatever the number of keys.
WORDS = 1 << 16


def _place(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def _word(place: Column) -> Column:
    return F.shiftright(place, 6).bitwiseAND(WORDS - 1).cast("int")


def bitmap(df: DataFrame, keys: list[str], count: str | None = None) -> DataFrame:
    """Rows (_word, _bits) of the bits that the keys of ``df`` set, with the number of its
    rows for each word in the column ``count``. Its partial aggregates are as small as itself."""
    bit = F.expr("shiftleft(1L, cast(_place & 63L AS int))")
    rows = [F.count(F.lit(1)).alias(count)] if count else []
    return (
        df.select(_place(keys).alias("_place"))
        .groupBy(_word(F.col("_place")).alias("_word"))
        .agg(F.bit_or(bit).alias("_bits"), *rows)
    )


def marked(df: DataFrame, keys: list[str], bits: DataFrame, flag: str) -> DataFrame:
    """``df`` with a column that tells whether its key may be one of those in the bitmap."""
    placed = df.withColumn("_place", _place(keys)).withColumn("_word", _word(F.col("_place")))
    met = placed.join(F.broadcast(bits), "_word", "left")  # <= WORDS rows
    hit = F.expr("shiftright(_bits, cast(_place & 63L AS int)) & 1L") == 1
    return met.select(*df.columns, F.coalesce(hit, F.lit(False)).alias(flag))


def may_be_among(df: DataFrame, keys: list[str], bits: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key may be one of those in the bitmap."""
    marked = df.withColumn("_place", _place(keys)).withColumn("_word", _word(F.col("_place")))
    met = marked.join(F.broadcast(bits), "_word")  # <= WORDS rows
    hit = F.expr("shiftright(_bits, cast(_place & 63L AS int)) & 1L") == 1
    return met.filter(hit).select(*df.columns)
