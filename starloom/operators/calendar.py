"""Calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import long_calendar_columns, star_calendar_columns
from starloom.operators.merge import insert_missing

# Range of the standalone calendar, fallback start of the star calendar.
STANDALONE_RANGE = (date(2020, 1, 1), date(2030, 12, 31))
FALLBACK_FROM = date(2010, 1, 1)


def date_series(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Every day from ``first`` to ``last`` of a one-row frame."""
    days = F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("d"))


def _range(spark: SparkSession, first: date, last: date) -> DataFrame:
    return spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))


def build(spark: SparkSession, first: date, last: date) -> DataFrame:
    """Star calendar over a closed date range."""
    return build_over(_range(spark, first, last))


def build_over(bounds: DataFrame) -> DataFrame:
    """Star calendar over the ``first``..``last`` of a one-row frame."""
    return date_series(bounds, "first", "last").select(*star_calendar_columns(F.col("d")))


def build_standalone(bounds: DataFrame, padded: bool = False) -> DataFrame:
    """Standalone calendar with long names over a one-row frame's range."""
    return date_series(bounds, "first", "last").select(
        *long_calendar_columns(F.col("d"), padded)
    )


def standalone(spark: SparkSession, padded: bool = False) -> DataFrame:
    return build_standalone(_range(spark, *STANDALONE_RANGE), padded)


def fact_range(sales: DataFrame, today: date, clock: str = "invoice_ts") -> DataFrame:
    """First and last sale day; a table without sales spans the fallback start
    to today."""
    return sales.agg(
        F.coalesce(F.min(clock).cast("date"), F.lit(FALLBACK_FROM)).alias("first"),
        F.coalesce(F.max(clock).cast("date"), F.lit(today)).alias("last"),
    )


def ensure_dates(calendar: DataFrame, dates: DataFrame, column: str) -> DataFrame:
    """Calendar rows for the dates that ``calendar`` lacks."""
    wanted = dates.select(F.col(column).cast("date").alias("d")).filter("d is not null").distinct()
    rows = wanted.select(*star_calendar_columns(F.col("d")))
    return insert_missing(calendar, rows, ["date_key"])


def extend(calendar: DataFrame, bounds: DataFrame) -> DataFrame:
    """Calendar rows of a range that ``calendar`` lacks."""
    return insert_missing(calendar, build_over(bounds), ["date_key"])
