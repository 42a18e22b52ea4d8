"""Key resolution: equi joins of a long feed against a lookup with unique keys.

Which join it is follows from sizes in bytes: the estimate of the optimised plan, or
what was written where a plan of joins makes the estimate worthless. A lookup within
Spark's own broadcast limit is left to Spark to broadcast. Beyond it, keys that fill
more than a task's fair share of the feed are spread over as many tasks as they fill.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from math import ceil

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.context import scratch_path

#: A key of fewer rows is never spread.
LEAST_HOT = 200
#: Keys that a task's summary follows at least, and for each shuffle partition.
FOLLOWED = 4_096
FOLLOWED_EACH = 8
#: Tasks' summaries meet in so many groups first.
MERGERS = 32


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class Census:
    """Hot keys of a stored frame, for several sets of key columns in one pass, which
    runs when the first of them is asked for.

    Each task follows its most frequent keys in a summary of bounded size; the summaries
    are merged. A key is hot if it has more rows than a task's fair share, so there are
    at most as many as shuffle partitions. Its number of salts is the number of fair
    shares it fills.
    """

    def __init__(self, df: DataFrame, *key_sets: list[str]):
        self.df = df
        self.key_sets = [tuple(k) for k in key_sets]
        self._found: dict[tuple[str, ...], tuple[list[tuple[int, int]], int]] = {}

    def salts(self, keys: list[str]) -> tuple[list[tuple[int, int]], int]:
        """(hash of the key, salts) of the hot keys, and the salts of NULL keys (1 if
        they are few)."""
        keys = tuple(keys)
        if keys not in self._found:
            sets = self.key_sets if keys in self.key_sets else [keys]
            self._found.update(self._count([k for k in sets if k not in self._found]))
        return self._found[keys]

    def _count(self, key_sets):
        parts = partitions(self.df)
        followed = min(max(FOLLOWED, FOLLOWED_EACH * parts), 1_000_000)
        hashed = self.df.select(*[key_hash(self.df, k).alias(f"h{i}") for i, k in enumerate(key_sets)])
        summed = [F.expr(f"approx_top_k_accumulate(h{i}, {followed})").alias(f"s{i}") for i in range(len(key_sets))]
        nulls = [F.count_if(F.col(f"h{i}").isNull()).alias(f"e{i}") for i in range(len(key_sets))]
        met = hashed.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("part"))
        met = met.agg(F.count(F.lit(1)).alias("n"), *nulls, *summed)
        top = min(parts + 1, followed)  # NULL may be one of them
        # by a constant: a task without summaries then makes none
        row = met.groupBy(F.lit(0).alias("all")).agg(
            F.sum("n").alias("n"),
            *[F.sum(f"e{i}").alias(f"e{i}") for i in range(len(key_sets))],
            *[
                F.expr(f"approx_top_k_estimate(approx_top_k_combine(s{i}, {followed}), {top})").alias(f"s{i}")
                for i in range(len(key_sets))
            ],
        ).first()
        if row is None:
            return {keys: ([], 1) for keys in key_sets}
        share, found = max(row["n"] / parts, LEAST_HOT), {}
        for i, keys in enumerate(key_sets):
            hot = [(k["item"], ceil(k["count"] / share)) for k in row[f"s{i}"] if k["item"] is not None and k["count"] > share]
            found[keys] = (hot, ceil(max(row[f"e{i}"], 1) / share))
        return found


def key_hash(df: DataFrame, keys) -> Column:
    """One number per key, whatever the width of its numbers; NULL if any column is."""
    any_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    wide = []
    for k in keys:
        kind = df.schema[k].dataType
        whole = isinstance(kind, T.IntegralType)
        wide.append(F.col(k).cast("bigint") if whole else F.col(k).cast("double") if isinstance(kind, T.NumericType) else F.col(k))
    return F.when(~any_null, F.xxhash64(*wide))


def hot_frame(spark: SparkSession, found: list[tuple[int, int]]) -> DataFrame:
    """(_key_hash, _salts) of hot keys, at most a row per partition, as a constant."""
    text = json.dumps([{"_key_hash": h, "_salts": n} for h, n in found])
    rows = F.from_json(F.lit(text), "array<struct<_key_hash bigint, _salts int>>")
    return spark.range(1).select(F.inline(rows))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    residual: Callable[[], Column] | None = None,
    census: DataFrame | Census | None = None,
) -> DataFrame:
    """Shuffle join that splits the hot keys of ``left`` over several tasks.

    Lookup rows of a hot key are copied once per salt of it; all others keep salt 0.
    Left rows with a NULL key match nothing and are spread as well. Every left row meets
    exactly one copy, so the result equals the plain join. ``left`` should be free of
    full copies (the salt is a hash of the whole row).

    Hot keys are counted in ``census``, a stored frame with the same key columns or its
    :class:`Census`: where ``left`` is a chain of joins, counting in it would run the
    chain twice.
    """
    if not isinstance(census, Census):
        census = Census(left if census is None else census, keys)
    found, null_salts = census.salts(keys)
    if not found and null_salts == 1:
        return _join(left, right, keys, how, residual)
    hot = F.broadcast(hot_frame(left.sparkSession, found))
    spread = F.xxhash64(*left.columns)
    salted_left = left.withColumn("_key_hash", key_hash(left, keys)).join(hot, "_key_hash", "left")
    salted_left = salted_left.withColumn(
        "_salt",
        F.when(F.col("_key_hash").isNull(), F.pmod(spread, F.lit(null_salts)))
        .when(F.col("_salts").isNotNull(), F.pmod(spread, F.col("_salts")))
        .otherwise(F.lit(0))
        .cast("int"),
    ).drop("_key_hash", "_salts")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    salted_right = right.withColumn("_key_hash", key_hash(right, keys)).join(hot, "_key_hash", "left")
    salted_right = salted_right.withColumn("_salt", F.explode(copies)).drop("_key_hash", "_salts")
    return _join(salted_left, salted_right, [*keys, "_salt"], how, residual).drop("_salt")


def _join(left, right, keys, how, residual):
    if residual is None:
        return left.join(right, keys, how)
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    equal = [F.col(k) == F.col(f"_r_{k}") for k in keys]
    on = reduce(Column.__and__, [*equal, residual()])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def broadcast_bytes(df: DataFrame) -> int:
    """Spark's own limit of what it broadcasts, -1 if it broadcasts nothing."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").lower()
    number = text.rstrip("bkmg")
    return int(number) * _UNITS[text[len(number) :]]


def plan_bytes(df: DataFrame) -> tuple[int, int]:
    """Estimates of the optimised plan: bytes of its result, and of all it reads."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    size = lambda p: int(str(p.stats().sizeInBytes()))
    return size(plan), sum(size(leaves.apply(i)) for i in range(leaves.size()))


def row_bytes(df: DataFrame) -> Column:
    """Bytes that a row's values take in memory, about."""
    def of(field) -> Column:
        kind = field.dataType
        if isinstance(kind, T.StringType):
            return F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
        if isinstance(kind, T.BinaryType):
            return F.coalesce(F.length(F.col(field.name)), F.lit(0))
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
        return F.lit(8)

    return reduce(Column.__add__, [of(f) for f in df.schema], F.lit(16)).cast("bigint")


def sized(df: DataFrame, limit: int | None = None) -> tuple[DataFrame, bool]:
    """The frame, or what of it was written, and whether it is within ``limit`` bytes
    (Spark's own limit of what it broadcasts).

    An estimate above the limit is believed of a plan that only narrows what it reads.
    One that joins is written once and counted in bytes by the write: its estimate is
    a product of sizes, and it may well be small."""
    limit = broadcast_bytes(df) if limit is None else limit
    estimate, read = plan_bytes(df)
    if estimate <= limit:
        return df, True
    if estimate <= read:
        return df, False
    path, seen = scratch_path(df.sparkSession, "sized"), Observation()
    df.observe(seen, F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    try:
        return stored, seen.get["bytes"] <= limit
    except Py4JJavaError:  # a plan that the optimizer found to be empty leaves no figure
        return stored, True


def sized_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    residual: Callable[[], Column] | None = None,
    limit: int | None = None,
    census: DataFrame | Census | None = None,
) -> DataFrame:
    """Join with a lookup that Spark broadcasts by itself if it is small, else
    :func:`spread_join`. ``right`` is evaluated once in either case."""
    right, small = sized(right, limit)
    if small:
        return _join(left, right, keys, how, residual)
    return spread_join(left, right, keys, how, residual, census)


#: A lookup of one number by another is broadcast in blocks while these take so many
#: times the bytes of Spark's own limit: packed, an entry takes a tenth of a broadcast row.
PACKED = 12
BLOCK_BITS = 8  # keys of a block
#: A lookup whose plan is estimated at more than so many times the packed limit isn't tried.
UNLIKELY = 8


def packed(table: DataFrame, keys: list[str], value: str, limit: int) -> DataFrame | None:
    """The lookup in blocks of 256 consecutive keys: the tags, which are the keys other
    than the one number, ``_block``, and the places, the values above ``_base`` and the
    smallest value of its keys. None if that is not possible, or is more than ``limit``
    bytes: keys that repeat, missing values, values too far from each other. It is written
    once, by which its bytes are counted."""
    kinds = {f.name: f.dataType for f in table.schema}
    numbers = [k for k in keys if isinstance(kinds[k], T.IntegralType)]
    if len(numbers) != 1 or not isinstance(kinds[value], T.IntegralType):
        return None
    if not 0 <= plan_bytes(table)[0] <= UNLIKELY * limit:
        return None
    tags = [k for k in keys if k not in numbers]
    number, at = F.col(numbers[0]).cast("bigint"), F.struct("_place", "_value")
    rows = table.dropna(subset=keys).select(
        *tags,
        F.shiftright(number, BLOCK_BITS).alias("_block"),
        number.bitwiseAND((1 << BLOCK_BITS) - 1).cast("short").alias("_place"),
        F.col(value).cast("bigint").alias("_value"),
    )
    met = rows.groupBy(*tags, "_block").agg(
        F.array_sort(F.collect_list(at)).alias("_at"), F.min("_value").alias("_base"), F.count("_value").alias("_n")
    )
    blocks = met.select(
        *tags,
        "_block",
        "_base",
        F.col("_at._place").alias("_places"),
        F.transform("_at._value", lambda v: F.try_subtract(v, F.col("_base")).try_cast("int")).alias("_values"),
        "_n",
    )
    path, seen = scratch_path(table.sparkSession, "packed"), Observation()
    whole = (F.size("_places") == F.col("_n")) & (F.size(F.array_distinct("_places")) == F.col("_n"))
    whole = whole & ~F.exists("_values", lambda v: v.isNull())
    room = reduce(Column.__add__, [F.octet_length(F.col(t).cast("string")) for t in tags], F.lit(128)) + F.col("_n") * 6
    blocks.observe(
        seen, F.coalesce(F.sum(room), F.lit(0)).alias("bytes"), F.count_if(~whole).alias("torn")
    ).drop("_n").write.parquet(path)
    try:
        if seen.get["torn"] or seen.get["bytes"] > limit:
            return None
    except Py4JJavaError:  # an empty plan
        return None
    return table.sparkSession.read.schema(blocks.drop("_n").schema).parquet(path)


def packed_join(feed: DataFrame, blocks: DataFrame, keys: list[str], alias: str, how: str) -> DataFrame:
    """Join with a :func:`packed` lookup, which is broadcast: no row of the feed moves."""
    tags = [k for k in keys if k in blocks.columns]
    number = next(F.col(k).cast("bigint") for k in keys if k not in tags)
    inside = number.bitwiseAND((1 << BLOCK_BITS) - 1).cast("short")
    met = feed.withColumn("_block", F.shiftright(number, BLOCK_BITS))
    met = met.join(F.broadcast(blocks), [*tags, "_block"], how)
    found = F.try_element_at("_values", F.nullif(F.array_position("_places", inside), F.lit(0)).cast("int"))
    rest = [c for c in feed.columns if c not in keys]  # columns in the order that a join gives
    met = met.select(*keys, *rest, (F.col("_base") + found).alias(alias))
    return met.dropna(subset=[alias]) if how == "inner" else met


def inner_join(
    left: DataFrame, right: DataFrame, keys: list[str], limit: int | None = None
) -> DataFrame:
    """Inner join of two frames either of which may be the small one, which Spark then
    broadcasts, so a value that fills the other side is not gathered in one task; when
    neither is small, the hot keys of ``left`` are spread."""
    right, small = sized(right, limit)
    if not small:
        left, small = sized(left, limit)
    if small:
        return left.join(right, keys)
    return spread_join(left, right, keys, "inner")


def resolve(
    feed: DataFrame,
    table: DataFrame,
    match: dict[str, str],
    value: str,
    alias: str | None = None,
    default=None,
    how: str = "left",
    limit: int | None = None,
    census: DataFrame | Census | None = None,
) -> DataFrame:
    """Add ``table.value`` for the rows whose ``match`` columns agree.

    ``match`` maps feed columns to lookup columns; the lookup is unique on the
    latter. ``how="left"`` keeps unmatched rows with ``default``;
    ``how="inner"`` drops them. ``census``: see :func:`spread_join`.
    """
    alias = alias or value
    narrow = table.select(
        *[F.col(t).alias(f) for f, t in match.items()], F.col(value).alias(alias)
    )
    joined = _number_join(feed, narrow, list(match), alias, how, limit, census)
    if default is None:
        return joined
    return joined.withColumn(alias, F.coalesce(F.col(alias), F.lit(default)))


def _number_join(feed, narrow, keys, alias, how, limit, census):
    """:func:`sized_join`, where a lookup of numbers beyond the limit is packed if it can be."""
    limit = broadcast_bytes(feed) if limit is None else limit
    narrow, small = sized(narrow, limit)
    alike = all(
        feed.schema[k].dataType == narrow.schema[k].dataType
        or isinstance(feed.schema[k].dataType, T.IntegralType) and isinstance(narrow.schema[k].dataType, T.IntegralType)
        for k in keys
    )
    if not small and alike and limit > 0 and how in ("left", "inner") and alias not in feed.columns:
        blocks = packed(narrow, keys, alias, PACKED * limit)
        if blocks is not None:
            kind = narrow.schema[alias].dataType
            return packed_join(feed, blocks, keys, alias, how).withColumn(alias, F.col(alias).cast(kind))
    if small:
        return _join(feed, narrow, keys, how, None)
    return spread_join(feed, narrow, keys, how, None, census)


def resolve_one(
    feed: DataFrame,
    table: DataFrame,
    match: dict[str, str],
    value: str,
    order: list,
    alias: str | None = None,
    default=None,
    last: bool = False,
) -> DataFrame:
    """As :func:`resolve` for a lookup that may hold several rows per key: the first in
    ``order`` (the last, with ``last``) answers, NULLs being the smallest. It is picked
    by an aggregate, of which each task sends one row per key."""
    pick = F.max_by if last else F.min_by
    one = table.groupBy(*match.values()).agg(pick(F.struct(value), F.struct(*order)).alias("_one"))
    one = one.select(*match.values(), F.col("_one")[value].alias(value))
    return resolve(feed, one, match, value, alias, default)
