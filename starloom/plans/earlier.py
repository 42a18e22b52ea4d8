"""The first version of the star: its own unknown members, a calendar with long names,
geography keyed ``geography_key``, and a fact with a key of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions.dates import star_calendar_columns
from starloom.operators import calendar, keys
from starloom.operators.merge import upsert
from starloom.plans import dims

KEYS = {**schemas.SURROGATE, "dim_geography": "geography_key"}


def seeded(spark: SparkSession, table: str) -> DataFrame:
    """A dimension before its first load: the unknown member only."""
    none = spark.createDataFrame([], schemas.struct(schemas.EARLIER_STAR[table]))
    return keys.ensure_default_member(none, schemas.EARLIER_MEMBERS[table], KEYS[table])


def long_calendar(bounds: DataFrame) -> DataFrame:
    """Calendar rows over the ``first``..``last`` of a one-row frame, with months and
    days by their full names, and the unknown date, which has no other attributes."""
    d = F.col("d")
    days = calendar.date_series(bounds, "first", "last").select(*star_calendar_columns(d), d)
    days = days.withColumns({"month_name": F.date_format("d", "MMMM"), "day_name": F.date_format("d", "EEEE")})
    return seeded(bounds.sparkSession, "dim_date").unionByName(days.drop("d"))


def geography(target: DataFrame, city: DataFrame, state: DataFrame, region: DataFrame) -> DataFrame:
    """The geography dimension after a load."""
    source = dims.flatten_hierarchy(city.filter("city_id <> -1"), state, region)
    tracked = ["city_name", "state_id", "state_name", "region_id", "region_name"]
    return upsert(target, source, ["city_id"], tracked, "geography_key").table


def dimensions(spark: SparkSession, nf3: dict[str, DataFrame], bounds: DataFrame) -> dict[str, DataFrame]:
    """All dimensions after their first load from the normalised layer."""
    return {
        "dim_date": long_calendar(bounds),
        "dim_customer": dims.load_customer(seeded(spark, "dim_customer"), nf3["ce_customer_scd"]).table,
        "dim_product": dims.load_product(seeded(spark, "dim_product"), nf3["ce_product"], nf3["ce_category"]).table,
        "dim_retailer": dims.load_retailer(seeded(spark, "dim_retailer"), nf3["ce_retailer"]).table,
        "dim_geography": geography(seeded(spark, "dim_geography"), nf3["ce_city"], nf3["ce_state"], nf3["ce_region"]),
        **{
            f"dim_{kind}": dims.load_method(seeded(spark, f"dim_{kind}"), nf3[f"ce_{kind}"], kind).table
            for kind in ("sales_method", "payment_method")
        },
    }
