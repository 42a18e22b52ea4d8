"""Verification listings run after a load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.sources.store import MONTH


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counted = [
        t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
        for n, t in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def counts_by_source(df: DataFrame) -> DataFrame:
    return df.groupBy("source_system", "source_entity").agg(F.count(F.lit(1)).alias("n_rows"))


def rows_by_month(fact: DataFrame, n: int | None = 6, ts: str = "invoice_ts") -> DataFrame:
    """Rows per month, newest ``n`` months first."""
    months = fact.groupBy(F.date_format(ts, "yyyy-MM").alias("yyyymm")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return months if n is None else months.orderBy(F.desc("yyyymm")).limit(n)


def null_keys(fact: DataFrame, *keys: str) -> DataFrame:
    """One row with the number of NULLs in each key."""
    return fact.agg(*[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys])


def latest_month(fact: DataFrame, ts: str = "invoice_ts") -> DataFrame:
    """Rows of the newest month. The month is a scalar subquery, evaluated once;
    on a month-partitioned fact it is found and read by folder."""
    if MONTH in fact.columns:
        return fact.filter(F.col(MONTH) == fact.agg(F.max(MONTH)).scalar())
    newest = fact.agg(F.date_trunc("month", F.max(ts)).cast("timestamp_ntz")).scalar()
    return fact.filter(F.col(ts) >= newest)


def latest_month_sample(fact: DataFrame, order: list, n: int = 20) -> DataFrame:
    return preview(latest_month(fact), order, n)


def preview(df: DataFrame, order: list, n: int) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)
