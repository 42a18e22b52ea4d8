"""Insert-if-absent and change-only upsert as pure functions on frames.

Each takes the table as it is and the incoming rows, and returns the rows to
write; publishing is the store's business.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.context import LoadContext, materialise
from starloom.operators import keys as surrogate
from starloom.operators import membership


#: A bitmap holds most other rows back while less than one in so many of its bits is set.
SPARSE = 32


@dataclass(frozen=True)
class MergeResult:
    """Outcome of a merge: the whole new table and its two deltas."""

    table: DataFrame
    inserted: DataFrame
    updated: DataFrame

    def counts(self) -> tuple[int, int]:
        return self.inserted.count(), self.updated.count()


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``source`` (unique on ``keys``, none NULL) whose key ``target`` lacks.

    A source that was just made unique on the same keys is partitioned by them
    already, so the anti join moves only the target's keys.
    """
    return source.join(target.select(*keys), keys, "left_anti")


def _digest_columns(keys: list[str]) -> list[Column]:
    """128 bits (_a, _b) of a key, NULL if a part of it is."""
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return [F.when(whole, F.xxhash64(*keys)).alias("_a"), F.when(whole, F.xxhash64(F.lit("b"), *keys)).alias("_b")]


def _digests(df: DataFrame, keys: list[str]) -> DataFrame:
    """128 bits (_a, _b) of every key, NULL if a part of it is."""
    return df.select(*_digest_columns(keys))


def known_digests(target: DataFrame, rows: DataFrame, keys: list[str]) -> tuple[int, DataFrame]:
    """How many ``rows`` have a key that ``target`` has, by digests of 128 bits, and a
    bitmap of those digests. Only digests are shuffled, and just the bitmap is written."""
    met = _digests(rows, keys).join(_digests(target, keys).dropna(), ["_a", "_b"], "left_semi")
    bits = materialise(membership.bitmap(met, ["_a"], count="_n"), "known")
    return bits.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0], bits.drop("_n")


def missing_stored(target: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """:func:`insert_missing` of a written frame; ``stored`` itself if no key is known.

    Digests of 128 bits are shuffled. Only if they say that a part of the rows is known,
    the rows that a bitmap cannot tell to be new meet the target: by the keys themselves
    while they are few, by the digests where the bitmap would hold back little.
    """
    if target.isEmpty():
        return stored
    n, bits = known_digests(target, stored, keys)
    if n == 0:
        return stored
    if n == stored.count():
        return stored.limit(0)
    if n > membership.WORDS * 64 // SPARSE:
        digested = stored.select("*", *_digest_columns(keys))
        known = _digests(target, keys).dropna()
        return digested.join(known, ["_a", "_b"], "left_anti").select(*stored.columns)
    told = membership.marked(stored.withColumn("_a", F.xxhash64(*keys)), ["_a"], bits, "_met")
    old = membership.may_be_among(target.select(*keys).withColumn("_a", F.xxhash64(*keys)), ["_a"], bits)
    met = insert_missing(old, told.filter("_met").select(*stored.columns), keys)
    return told.filter("NOT _met").select(*stored.columns).unionByName(met)


def append_new(
    target: DataFrame, source: DataFrame, keys: list[str], id_col: str, start: int | None = None
) -> DataFrame:
    """New rows for ``target`` with surrogate keys that continue its own.

    The new rows are written once before they are numbered, so a long feed is
    read a single time.
    """
    start = surrogate.max_id(target, id_col) if start is None else start
    fresh = materialise(insert_missing(target, source, keys), "fresh")
    return surrogate.assign(fresh, keys, id_col, start).select(*target.columns)


def changed(columns: list[str], old: str, new: str) -> Column:
    """Any of the columns differs, NULL counted as a value."""
    return reduce(
        Column.__or__, [~F.col(f"{old}{c}").eqNullSafe(F.col(f"{new}{c}")) for c in columns]
    )


def _settle(
    target: DataFrame, source: DataFrame, keys: list[str], tracked: list[str], how: str
) -> DataFrame:
    """Target rows joined with their source row, tracked columns decided, and the
    row's ``_fate``: insert, update or keep."""
    new = source.select(
        *keys, *[F.col(c).alias(f"_n_{c}") for c in tracked], F.lit(True).alias("_in_source")
    )
    joined = target.withColumn("_in_target", F.lit(True)).join(new, keys, how)
    fate = (
        F.when(F.col("_in_target").isNull(), "insert")
        .when(F.col("_in_source") & changed(tracked, "", "_n_"), "update")
        .otherwise("keep")
    )
    settled = {
        c: F.when(F.col("_fate") == "keep", F.col(c)).otherwise(F.col(f"_n_{c}")) for c in tracked
    }
    return joined.withColumn("_fate", fate).withColumns(settled).select(*target.columns, "_fate")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    tracked: list[str],
    id_col: str,
    start: int | None = None,
) -> MergeResult:
    """Update the tracked columns of changed rows and insert missing rows.

    One full outer join on the business key settles every row's fate; unchanged
    rows and rows without a source pass through. ``source`` is unique on
    ``keys``. The settled frame is written once; the deltas and the new table
    are cut from it.
    """
    start = surrogate.max_id(target, id_col) if start is None else start
    settled = materialise(_settle(target, source, keys, tracked, "full_outer"), "upsert")
    fresh = settled.filter("_fate = 'insert'").drop("_fate", id_col)
    inserted = surrogate.assign(fresh, keys, id_col, start).select(*target.columns)
    updated = settled.filter("_fate = 'update'").drop("_fate")
    stay = settled.filter("_fate <> 'insert'").drop("_fate")
    return MergeResult(stay.unionByName(inserted), inserted, updated)


def update_changed(
    target: DataFrame, source: DataFrame, keys: list[str], tracked: list[str]
) -> MergeResult:
    """The update half of :func:`upsert`; source rows without a target are ignored."""
    settled = _settle(target, source, keys, tracked, "left")
    updated = settled.filter("_fate = 'update'").drop("_fate")
    return MergeResult(settled.drop("_fate"), target.limit(0), updated)


def delta_report(delta: DataFrame, src_id: str, action: str = "INSERT") -> DataFrame:
    """What a load did, one row per affected row, over all sources."""
    return delta.select(
        F.lit(action).alias("action"),
        F.col(src_id).cast("string").alias("ret_src_id"),
        F.col("source_system").alias("src_system"),
    )


def stamp(df: DataFrame, ctx: LoadContext) -> DataFrame:
    """Load times of new rows."""
    return df.withColumns({"insert_dt": ctx.load_ts_col, "update_dt": ctx.load_ts_col})
