"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from starloom.context import materialise
from starloom.operators import membership


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row of every key group in ``order``.

    ``order`` should be total; rows that tie on it must be interchangeable.
    NULL key values form one group. Spark turns the ``rank = 1`` filter into a
    group limit on both sides of the shuffle, so each map task ships at most one
    row per key, however many copies a key has.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def repeated_digests(df: DataFrame, keys: list[str]) -> DataFrame:
    """``_digest`` of 64 bits of every key that ``df`` has more than once, and of the few
    other keys that share a digest. Only digests are shuffled, however wide the keys are."""
    met = df.groupBy(F.xxhash64(*keys).alias("_digest")).agg(F.count(F.lit(1)).alias("_n"))
    return materialise(met.filter("_n > 1").select("_digest"), "repeated")


def keep_first_stored(stored: DataFrame, keys: list[str], order: list) -> DataFrame:
    """:func:`keep_first` of a written frame; ``stored`` itself if no key repeats.

    Rows whose key surely stands once stay where they are. Those whose digest a bitmap
    of the repeated ones may hold are shuffled and told apart by their keys; with very
    many repeated keys these are all rows.
    """
    again = repeated_digests(stored, keys)
    if again.isEmpty():
        return stored
    digested = stored.withColumn("_digest", F.xxhash64(*keys))
    met = membership.marked(digested, ["_digest"], membership.bitmap(again, ["_digest"]), "_again")
    once = met.filter("NOT _again").drop("_digest", "_again")
    return once.unionByName(keep_first(met.filter("_again").drop("_digest", "_again"), keys, order))


def few_duplicate_groups(stored: DataFrame, keys: list[str], count_name: str = "dup_count") -> DataFrame:
    """:func:`duplicate_groups` of a written frame of wide keys few of which repeat: only
    rows whose digest may be a repeated one are grouped by the keys themselves."""
    digested = stored.select(*keys).withColumn("_digest", F.xxhash64(*keys))
    bits = membership.bitmap(repeated_digests(stored, keys), ["_digest"])
    return duplicate_groups(membership.may_be_among(digested, ["_digest"], bits), keys, count_name)


def duplicate_groups(df: DataFrame, keys: list[str], count_name: str = "dup_count") -> DataFrame:
    """Key groups with more than one row, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1)


def one_label_per_key(df: DataFrame, keys: list[str], labels: list[str]) -> DataFrame:
    """Distinct ``keys`` with the smallest ``labels`` row seen for each.

    The distinct runs first: it is a hash aggregate without buffers, which
    shrinks a long feed to its few label variants inside the map tasks.
    (``min_by``, because above a plain ``min`` the optimizer drops the distinct
    and sorts the whole feed instead.)
    """
    variants = df.select(*keys, *labels).distinct()
    row = F.struct(*labels)
    pick = variants.groupBy(*keys).agg(F.min_by(row, row).alias("_pick"))
    return pick.select(*keys, *[F.col("_pick")[c].alias(c) for c in labels])


def latest_label_per_key(
    df: DataFrame, keys: list[str], labels: list[str], clock: str
) -> DataFrame:
    """One row per key: the labels with the newest ``clock``, ties by label.

    Again the label variants are collapsed first, with their newest time as the
    only aggregate buffer.
    """
    variants = df.groupBy(*keys, *labels).agg(F.max(clock).alias("_clock"))
    newest = variants.groupBy(*keys).agg(
        F.max_by(F.struct(*labels), F.struct("_clock", *labels)).alias("_pick")
    )
    return newest.select(*keys, *[F.col("_pick")[c].alias(c) for c in labels])
