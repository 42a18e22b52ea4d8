"""Loads of the normalised layer.

Each function takes the table as it is and the staging rows of all sources and
returns the rows to append (or, for customers, the new table). Staging rows
carry their lineage tags, so both sources load in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import schemas
from starloom.context import CODEC, LoadContext, materialise
from starloom.functions import clean
from starloom.functions.measures import with_measures
from starloom.operators import lookup, scd2
from starloom.operators.dedup import keep_first_stored, latest_label_per_key, one_label_per_key
from starloom.operators.merge import append_new, insert_missing, missing_stored, stamp

SRC = ["source_system", "source_entity"]


def _entity(staging: DataFrame, src_col: str, src_id: str, names: dict) -> DataFrame:
    """Distinct source ids with one label each. Rows without a source id name no
    entity; their facts resolve to the unknown member."""
    rows = staging.filter(F.col(src_col).isNotNull()).select(
        *SRC, F.col(src_col).alias(src_id), *[e.alias(n) for n, e in names.items()]
    )
    return one_label_per_key(rows, [*SRC, src_id], list(names))


def entity_rejects(staging: DataFrame, src_col: str) -> DataFrame:
    """Staging rows that name no entity."""
    return staging.filter(F.col(src_col).isNull())


def load_category(target: DataFrame, staging: DataFrame, ctx: LoadContext) -> DataFrame:
    rows = _entity(
        staging,
        "product_category_id",
        "category_src_id",
        {"category": clean.text_or_na(F.col("product_category"))},
    )
    return append_new(
        target, stamp(rows, ctx), schemas.BUSINESS_KEY["ce_category"], "category_id"
    )


def load_product(
    target: DataFrame, staging: DataFrame, category: DataFrame, ctx: LoadContext
) -> DataFrame:
    """Products with their category key; a product whose category is not loaded
    is not loaded either."""
    rows = (
        staging.filter("product_id is not null and product_category_id is not null")
        .select(
            *SRC,
            F.col("product_id").alias("product_src_id"),
            clean.text_or_na(F.col("product")).alias("product_name"),
            F.col("product_category_id").alias("category_src_id"),
        )
        .distinct()
    )
    match = {**{c: c for c in SRC}, "category_src_id": "category_src_id"}
    keyed = lookup.resolve(rows, category, match, "category_id", how="inner")
    keys = schemas.BUSINESS_KEY["ce_product"]
    one = one_label_per_key(keyed, keys, ["product_name", "category_id"])
    return append_new(target, stamp(one, ctx), keys, "product_id")


def load_retailer(target: DataFrame, staging: DataFrame, ctx: LoadContext) -> DataFrame:
    """Retailers by name; blank names name nobody."""
    named = staging.filter(clean.is_present(F.col("retailer")))
    name = clean.na_then_trim(F.col("retailer"))
    rows = (
        named.select(*SRC, name.alias("retailer"))
        .distinct()
        .withColumn("retailer_src_id", F.col("retailer"))
    )
    return append_new(
        target, stamp(rows, ctx), schemas.BUSINESS_KEY["ce_retailer"], "retailer_id"
    )


def load_sales_method(target: DataFrame, staging: DataFrame, ctx: LoadContext) -> DataFrame:
    return _load_method(target, staging, "sales_method", ctx)


def load_payment_method(target: DataFrame, staging: DataFrame, ctx: LoadContext) -> DataFrame:
    return _load_method(target, staging, "payment_method", ctx)


def _load_method(
    target: DataFrame, staging: DataFrame, kind: str, ctx: LoadContext
) -> DataFrame:
    rows = _entity(
        staging, f"{kind}_id", f"{kind}_src_id", {kind: clean.text_or_na(F.col(kind))}
    )
    return append_new(
        target, stamp(rows, ctx), schemas.BUSINESS_KEY[f"ce_{kind}"], f"{kind}_id"
    )


def load_place(
    target: DataFrame,
    staging: DataFrame,
    level: str,
    parent: str | None,
    ctx: LoadContext,
) -> DataFrame:
    """Region, state or city, keyed by source id (NULL as -1). Insert-only: a
    renamed or moved place keeps its first label."""
    id_col = f"{level}_id"
    rows = staging.select(
        *SRC,
        F.coalesce(id_col, F.lit(ctx.unknown).cast("bigint")).alias("place_id"),
        F.col(id_col).alias(f"{level}_src_id"),
        clean.text_or_na(F.col(level)).alias(f"{level}_name"),
        *(
            [F.coalesce(f"{parent}_id", F.lit(ctx.unknown).cast("bigint")).alias("parent_id")]
            if parent
            else []
        ),
    ).withColumnRenamed("place_id", id_col)
    if parent:
        rows = rows.withColumnRenamed("parent_id", f"{parent}_id")
    labels = [c for c in rows.columns if c != id_col]
    fresh = insert_missing(target, one_label_per_key(rows, [id_col], labels), [id_col])
    return stamp(fresh, ctx).select(*target.columns)


def customer_batch(staging: DataFrame) -> DataFrame:
    """One row per customer: the names of the latest sale. A sale without a
    customer id belongs to business key 0."""
    rows = staging.select(
        F.coalesce("customer_id", F.lit(0).cast("bigint")).alias("customer_src_id"),
        clean.na_then_trim(F.col("customer_firstname")).alias("first_name"),
        clean.na_then_trim(F.col("customer_lastname")).alias("last_name"),
        *SRC,
        "invoice_ts",
    )
    latest = latest_label_per_key(
        rows, ["customer_src_id"], ["first_name", "last_name", *SRC], "invoice_ts"
    )
    return latest.withColumn(
        "full_name", clean.full_name(F.col("first_name"), F.col("last_name"))
    )


def load_customer(
    target: DataFrame, staging: DataFrame, ctx: LoadContext
) -> scd2.VersionResult:
    """Customer versions from one source's staging rows."""
    return scd2.apply(target, customer_batch(staging), ctx)


def resolve_sales(
    staging: DataFrame,
    customer: DataFrame,
    product: DataFrame,
    retailer: DataFrame,
    city: DataFrame,
    sales_method: DataFrame,
    payment_method: DataFrame,
    ctx: LoadContext,
) -> DataFrame:
    """Staging sales with all keys resolved (unknown = -1) and measures derived.

    Sales without geography get city -1. Customers resolve to their current
    version; the business key is kept beside it.
    """
    src = {c: c for c in SRC}
    unknown = F.lit(ctx.unknown).cast("bigint")
    rows = staging.withColumns(
        {
            "customer_src_id": F.coalesce("customer_id", F.lit(0).cast("bigint")),
            "retailer_name": clean.na_then_trim(F.col("retailer")),
            "product_src_id": F.col("product_id"),
            "city_src_id": F.col("city_id"),
            "sales_method_src_id": F.col("sales_method_id"),
            "payment_method_src_id": F.col("payment_method_id"),
        }
    )
    rows = rows.withColumnRenamed("source_id", "sale_src_id").drop(
        "customer_id", "product_id", "retailer_id", "city_id", "sales_method_id",
        "payment_method_id",
    )
    base = rows  # staging columns only: hot keys of all lookups are counted here at once
    lookups = [
        (sales_method, {**src, "sales_method_src_id": "sales_method_src_id"}, "sales_method_id"),
        (
            payment_method,
            {**src, "payment_method_src_id": "payment_method_src_id"},
            "payment_method_id",
        ),
        (city, {"city_src_id": "city_id"}, "city_id"),
        (retailer, {**src, "retailer_name": "retailer_src_id"}, "retailer_id"),
        (product, {**src, "product_src_id": "product_src_id"}, "product_id"),
        (scd2.current(customer), {"customer_src_id": "customer_src_id"}, "customer_id"),
    ]
    default = ctx.unknown
    census = lookup.Census(base, *[list(match) for _, match, _ in lookups])
    for table, match, value in lookups:
        rows = lookup.resolve(rows, table, match, value, default=default, census=census)
    # measures last: what follows from other columns need not travel through the joins
    return with_measures(rows, ctx).withColumn(
        "customer_src_id",
        F.when(F.col("customer_id") == default, unknown).otherwise(F.col("customer_src_id")),
    )


def sales_rejects(staging: DataFrame) -> DataFrame:
    """Staging rows that cannot become sales: no id or no time."""
    return staging.filter("source_id is null or invoice_ts is null")


def sales_rows(resolved: DataFrame, ctx: LoadContext, *numbered: str) -> DataFrame:
    """Resolved sales in the layout of the table, but for ``sale_id`` unless ``numbered``
    names it. Sales without id or time are no sales: see :func:`sales_rejects`."""
    columns = [c for c in schemas.names(schemas.NF3["ce_sales"]) if c != "sale_id" or c in numbered]
    return stamp(resolved.dropna(subset=["sale_src_id", "invoice_ts"]), ctx).select(*columns)


def new_sales(target: DataFrame, stored: DataFrame) -> DataFrame:
    """Of the written :func:`sales_rows`, those whose natural key is new, one row per
    key; ``stored`` itself if these are all. Of a row that is not repeated only digests
    of its key are shuffled, unless a part of the others is known."""
    natural = schemas.BUSINESS_KEY["ce_sales"]
    rest = ["operating_profit", "operating_margin", "customer_id"]
    once = keep_first_stored(stored, natural, rest)
    if once is stored:
        return missing_stored(target, stored, natural)
    return once if target.isEmpty() else insert_missing(target, once, natural)


def load_sales(target: DataFrame, resolved: DataFrame, ctx: LoadContext) -> DataFrame:
    """Sales whose natural key is new, one row per key, without ``sale_id``.

    The natural key holds the customer's business key, so an old sale stays
    known after its customer's name changed. The rows are written once.
    """
    return new_sales(target, materialise(sales_rows(resolved, ctx), "sales", CODEC))
