"""Slowly changing dimension, type 2: versions with validity dates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.context import OPEN_END, LoadContext, materialise
from starloom.operators import keys as surrogate
from starloom.operators.lookup import Census, _join, hot_frame, key_hash, sized
from starloom.operators.merge import changed


@dataclass(frozen=True)
class VersionResult:
    """The whole table; versions closed, opened and corrected; and all that are open
    now. What is neither closed by this load nor open is as it was."""

    table: DataFrame
    closed: DataFrame
    opened: DataFrame
    corrected: DataFrame
    still_open: DataFrame


def current(versions: DataFrame, flag: str = "is_active") -> DataFrame:
    return versions.filter(F.col(flag))


def history(versions: DataFrame, key: str, start: str, n: int) -> DataFrame:
    """First ``n`` versions ordered by key and start."""
    return versions.orderBy(key, start).limit(n)


def apply(
    target: DataFrame,
    source: DataFrame,
    ctx: LoadContext,
    key: str = "customer_src_id",
    tracked: tuple[str, ...] = ("first_name", "last_name"),
    derived: tuple[str, ...] = ("full_name",),
    id_col: str = "customer_id",
    start: int | None = None,
) -> VersionResult:
    """Bring the version table up to ``source`` (one row per key, unique).

    * changed and opened by an earlier load: close on the day before the load
      date, open a new version from the load date;
    * changed but opened by this load (an earlier source of it) or starting on
      the load date: correct the open version in place, so no version ends
      before it starts;
    * no open version: open one, from ``ctx.first_version_start`` when the key is
      new altogether, else from the load date;
    * unchanged, or absent from ``source``: untouched.

    Changes are told null-safe. At most one version per key is active. The
    joined frame is written once; table and deltas are cut from it.
    """
    start = surrogate.max_id(target, id_col) if start is None else start
    attrs = [*tracked, *derived, "source_system", "source_entity"]
    incoming = source.select(
        key, *[F.col(c).alias(f"_n_{c}") for c in attrs], F.lit(True).alias("_in_source")
    )
    active = target.filter("is_active").withColumn("_in_target", F.lit(True))
    past = target.filter("not is_active")

    joined = active.join(incoming, key, "full_outer")
    differs = F.col("_in_source") & changed(list(tracked), "", "_n_")
    earlier = (F.col("start_dt") < ctx.load_dt_col) & (F.col("insert_dt") < ctx.load_ts_col)
    fate = (
        F.when(F.col("_in_target").isNull(), "open")
        .when(differs & earlier, "replace")
        .when(differs, "correct")
        .otherwise("keep")
    )
    joined = materialise(joined.withColumn("_fate", fate), "versions")

    replace, correct = F.col("_fate") == "replace", F.col("_fate") == "correct"
    settled = joined.filter("_fate <> 'open'").withColumns(
        {
            **{
                c: F.when(correct, F.col(f"_n_{c}")).otherwise(F.col(c))
                for c in (*tracked, *derived)
            },
            "end_dt": F.when(replace, F.date_sub(ctx.load_dt_col, 1)).otherwise(F.col("end_dt")),
            "is_active": ~replace,
            "update_dt": F.when(replace | correct, ctx.load_ts_col).otherwise(F.col("update_dt")),
        }
    )

    known = past.select(key).distinct().withColumn("_known", F.lit(True))
    newborn = joined.filter("_fate = 'open'").join(known, key, "left")
    first_start = F.lit(ctx.first_version_start or ctx.load_dt)
    opening = newborn.withColumn(
        "start_dt", F.when(F.col("_known"), ctx.load_dt_col).otherwise(first_start)
    ).drop("_known")
    opening = opening.unionByName(
        joined.filter("_fate = 'replace'").withColumn("start_dt", ctx.load_dt_col)
    ).select(
        key,
        *[F.col(f"_n_{c}").alias(c) for c in attrs],
        "start_dt",
        F.lit(OPEN_END).alias("end_dt"),
        F.lit(True).alias("is_active"),
        ctx.load_ts_col.alias("insert_dt"),
        ctx.load_ts_col.alias("update_dt"),
    )
    opened = surrogate.assign(opening, [key], id_col, start).select(*target.columns)

    table = past.unionByName(settled.select(*target.columns)).unionByName(opened)
    return VersionResult(
        table,
        settled.filter("_fate = 'replace'").select(*target.columns),
        opened,
        settled.filter("_fate = 'correct'").select(*target.columns),
        settled.filter("is_active").select(*target.columns).unionByName(opened),
    )


#: Versions of a key that a row may be compared with in a join; beyond, rows are swept.
FEW_VERSIONS = 4


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    start: str = "start_date_key",
    end: str = "end_date_key",
    how: str = "inner",
    limit: int | None = None,
    census: DataFrame | Census | None = None,
) -> DataFrame:
    """Each fact row with the version of its key valid at ``at`` (both ends included);
    facts without a valid version are dropped (``inner``) or kept (``left``). Versions of
    a key must not overlap.

    A small version table with short histories is joined on the key, the validity range
    being a residual condition. Otherwise facts and versions are swept together in
    order of time, each fact taking the version that started last: the work is that of
    one sort, however long the histories are. ``census``: see :func:`spread_join`.
    """
    versions, small = sized(versions, limit)
    if small:
        long = versions.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > FEW_VERSIONS)
        if long.isEmpty():
            valid = lambda: F.col(at).between(F.col(start), F.col(end))
            return _join(facts, versions, [key], how, valid)
    return sweep_join(facts, versions, key, at, start, end, how, census)


def month_number(c: Column, kind: T.DataType) -> Column:
    """Months since year 0 of a date or of a number yyyymmdd."""
    if isinstance(kind, T.IntegralType):
        return F.floor(c / 10000).cast("int") * 12 + F.floor(c / 100).cast("int") % 100
    return F.year(c) * 12 + F.month(c)


def sweep_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    how: str = "inner",
    census: DataFrame | Census | None = None,
) -> DataFrame:
    """:func:`as_of_join` by one sort of facts and versions. A key that fills more than
    a task's fair share of the facts is dealt over the months of its facts, and its
    versions are copied to those of these months in which they are valid."""
    if not isinstance(census, Census):
        census = Census(facts if census is None else census, [key])
    hot, _ = census.salts([key])
    about = [c for c in versions.columns if c != key]
    kind = facts.schema[at].dataType
    here = F.col(key).isNotNull() & F.col(at).isNotNull()
    rest = [c for c in facts.columns if c not in (key, at)]
    rows = facts.filter(here).select(
        key, F.col(at).alias("_at"), F.lit(1).alias("_is_fact"), F.struct(F.lit(True).alias("_"), *rest).alias("_fact")
    )
    spans = versions.filter(F.col(key).isNotNull() & F.col(start).isNotNull())
    spans = spans.select(key, F.col(start).cast(kind).alias("_at"), F.lit(0).alias("_is_fact"), F.struct(*about).alias("_version"))
    group = [key]
    if hot:
        group.append("_month")
        ids = F.broadcast(hot_frame(facts.sparkSession, hot).select("_key_hash", F.lit(True).alias("_hot")))

        def marked(df):
            return df.withColumn("_key_hash", key_hash(df, [key])).join(ids, "_key_hash", "left").drop("_key_hash")

        month = month_number(F.col("_at"), kind)
        rows = marked(rows).withColumn("_month", F.when(F.col("_hot"), month).otherwise(F.lit(0))).drop("_hot")
        seen = rows.filter("_month > 0").agg(F.min("_month"), F.max("_month")).first()
        first, last = (F.lit(m if m is not None else 0) for m in seen)
        until = F.coalesce(month_number(F.col(f"_version.{end}"), versions.schema[end].dataType), first - 1)
        valid = F.sequence(F.least(F.greatest(month, first), last + 1), F.greatest(F.least(until, last), first - 1))
        valid = F.when((month <= last) & (until >= first) & (month <= until), valid).otherwise(F.array().cast("array<int>"))
        spans = marked(spans).withColumn("_months", F.when(F.col("_hot"), valid).otherwise(F.array(F.lit(0))))
        spans = spans.withColumn("_month", F.explode("_months")).drop("_hot", "_months")
    both = rows.unionByName(spans, allowMissingColumns=True)
    so_far = W.partitionBy(*group).orderBy("_at", "_is_fact").rowsBetween(W.unboundedPreceding, 0)
    swept = both.withColumn("_last", F.last("_version", ignorenulls=True).over(so_far)).filter("_is_fact = 1")
    valid = F.col("_at").between(F.col(f"_last.{start}"), F.col(f"_last.{end}"))
    # the key itself, by which the rows lie together now, not its copy
    own = {key: F.col(key), at: F.col("_at").alias(at)}
    columns = [own[c] if c in own else F.col("_fact")[c].alias(c) for c in facts.columns]
    if how == "inner":
        return swept.filter(valid).select(*columns, *[F.col("_last")[c].alias(c) for c in about])
    found = swept.select(*columns, *[F.when(valid, F.col("_last")[c]).alias(c) for c in about])
    return found.unionByName(facts.filter(~here), allowMissingColumns=True)
