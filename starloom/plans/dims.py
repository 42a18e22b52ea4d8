"""Loads of the star dimensions: change-only upserts from the normalised layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions.dates import date_key
from starloom.operators.lookup import sized_join
from starloom.operators.merge import MergeResult, upsert

SRC = ["source_system", "source_entity"]


def _members(table: DataFrame, id_col: str) -> DataFrame:
    """Rows other than the unknown member, which every dimension has of its own."""
    return table.filter(F.col(id_col) != -1)


def product_source(product: DataFrame, category: DataFrame) -> DataFrame:
    parents = category.select(
        "category_id", "category_src_id", F.col("category").alias("category_name")
    )
    return (
        sized_join(_members(product, "product_id"), parents, ["category_id"], "inner")
        .select(*SRC, "product_src_id", "product_name", "category_src_id", "category_name")
    )


def load_product(
    target: DataFrame, product: DataFrame, category: DataFrame
) -> MergeResult:
    return upsert(
        target,
        product_source(product, category),
        schemas.BUSINESS_KEY["dim_product"],
        ["product_name", "category_src_id", "category_name"],
        "product_key",
    )


def load_retailer(target: DataFrame, retailer: DataFrame) -> MergeResult:
    source = _members(retailer, "retailer_id").select(
        *SRC, "retailer_src_id", F.col("retailer").alias("retailer_name")
    )
    keys = schemas.BUSINESS_KEY["dim_retailer"]
    return upsert(target, source, keys, ["retailer_name"], "retailer_key")


def load_method(target: DataFrame, method: DataFrame, kind: str) -> MergeResult:
    """``kind`` is ``sales_method`` or ``payment_method``."""
    source = _members(method, f"{kind}_id").select(
        *SRC, f"{kind}_src_id", F.col(kind).alias(f"{kind}_name")
    )
    keys = schemas.BUSINESS_KEY[f"dim_{kind}"]
    return upsert(target, source, keys, [f"{kind}_name"], f"{kind}_key")


def flatten_hierarchy(city: DataFrame, state: DataFrame, region: DataFrame) -> DataFrame:
    """City rows with their state and region; a city without either drops out."""
    states = state.select("state_id", "state_name", "region_id")
    regions = region.select("region_id", "region_name")
    placed = sized_join(
        city.select("city_id", "city_name", "state_id"), states, ["state_id"], "inner"
    )
    return sized_join(placed, regions, ["region_id"], "inner")


def load_geography(
    target: DataFrame, city: DataFrame, state: DataFrame, region: DataFrame
) -> MergeResult:
    source = flatten_hierarchy(_members(city, "city_id"), state, region)
    tracked = ["city_name", "state_id", "state_name", "region_id", "region_name"]
    return upsert(
        target, source, schemas.BUSINESS_KEY["dim_geography"], tracked, "geo_key"
    )


def customer_source(versions: DataFrame) -> DataFrame:
    """Customer versions with date keys. The unknown customer is left out: the
    dimension has one of its own, valid on all dates."""
    return _members(versions, "customer_id").select(
        "customer_src_id",
        "first_name",
        "last_name",
        "full_name",
        date_key(F.col("start_dt")).alias("start_date_key"),
        date_key(F.col("end_dt")).alias("end_date_key"),
        F.col("is_active").alias("is_current"),
    )


def load_customer(
    target: DataFrame, versions: DataFrame
) -> MergeResult:
    """Mirror of the customer versions. A version is known by customer and
    start, so closing one updates its row instead of adding a second. Further
    columns of ``target`` are kept, NULL in new rows."""
    return upsert(
        target,
        customer_source(versions),
        schemas.BUSINESS_KEY["dim_customer"],
        ["first_name", "last_name", "full_name", "end_date_key", "is_current"],
        "customer_key",
    )


def version_dates(versions: DataFrame) -> DataFrame:
    """All validity dates of the versions, for the calendar."""
    return versions.select(F.explode(F.array("start_dt", "end_dt")).alias("d")).distinct()
