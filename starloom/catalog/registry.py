"""Registry of the queries that run on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, so results compare across engines."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, T.DecimalType):
            out.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            out.append(F.col(f.name).cast("string").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Integer columns with NULLs as doubles; result tables differ in how they
    hold a missing integer."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def query(oracle: str | None = None, name: str | None = None):
    """Register a query, with the SQL that gives the same rows."""

    def add(fn: Query) -> Query:
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(spark, sf_dir))

        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return add
