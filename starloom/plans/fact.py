"""The month-partitioned sales fact and its rolling refresh."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions.dates import date_key, ntz
from starloom.operators import keys, lookup, scd2
from starloom.operators.dedup import keep_first

WINDOW_MONTHS = 3
SRC = ["source_system", "source_entity"]


def refresh_window(sales: DataFrame, today: date, months: int = WINDOW_MONTHS) -> DataFrame:
    """One row ``first, last``: from the first day of the window's oldest month
    to the last day of the newest sale month (of today's month without sales)."""
    newest = sales.agg(F.coalesce(F.max("invoice_ts").cast("date"), F.lit(today)).alias("d"))
    return newest.select(
        F.add_months(F.trunc("d", "MM"), 1 - months).alias("first"),
        F.last_day("d").alias("last"),
    )


def window_of(newest: int | None, today: date, months: int = WINDOW_MONTHS) -> tuple[date, date]:
    """First and last day of the window that ends with the month ``newest``
    (yyyymm; today's month without one)."""
    year, month = divmod(newest, 100) if newest else (today.year, today.month)
    start, after = year * 12 + month - months, year * 12 + month
    last = date(after // 12, after % 12 + 1, 1) - timedelta(days=1)
    return date(start // 12, start % 12 + 1, 1), last


def check_window(first: date | None, last: date | None) -> None:
    if first is None or last is None or first > last:
        raise ValueError(f"Invalid window {first}..{last}")


def window_bounds(first: date, last: date) -> tuple[datetime, datetime]:
    """Half-open bounds over the whole months the window touches."""
    check_window(first, last)
    start = datetime(first.year, first.month, 1)
    end = datetime(last.year + last.month // 12, last.month % 12 + 1, 1)
    return start, end


def in_window(ts: Column, first: date, last: date) -> Column:
    start, end = (ntz(d) for d in window_bounds(first, last))
    return (ts >= start) & (ts < end)


def in_months(first: date, last: date) -> Column:
    """The same window on the partition column, so folders outside it are not read."""
    return F.col("yyyymm").between(first.year * 100 + first.month, last.year * 100 + last.month)


def window_months(window: DataFrame) -> DataFrame:
    """The months of a window, one row each."""
    months = F.sequence(F.trunc("first", "MM"), F.col("last"), F.expr("interval 1 month"))
    return window.select(F.explode(months).alias("m")).select(
        F.date_format("m", "yyyyMM").cast("int").alias("yyyymm"),
        F.col("m").alias("month_start"),
        F.add_months("m", 1).alias("month_end"),
    )


def key_map(entity: DataFrame, dim: DataFrame, keys: list[str], id_col: str, key_col: str):
    """Normalised surrogate -> dimension key, joined on the source's own id.
    Composing the two hops here leaves one join on the fact side."""
    return entity.select(id_col, *keys).join(dim.select(*keys, key_col), keys).select(
        id_col, key_col
    )


def dimension_maps(nf3: dict[str, DataFrame], star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four surrogate translations of the fact."""
    plan = {
        "product": ("ce_product", "dim_product", "product_src_id"),
        "retailer": ("ce_retailer", "dim_retailer", "retailer_src_id"),
        "sales_method": ("ce_sales_method", "dim_sales_method", "sales_method_src_id"),
        "payment_method": ("ce_payment_method", "dim_payment_method", "payment_method_src_id"),
    }
    return {
        name: key_map(nf3[ce], star[dim], [*SRC, src], f"{name}_id", f"{name}_key")
        for name, (ce, dim, src) in plan.items()
    }


#: Columns of a sale that lookups of the fact join on.
LOOKUP_KEYS = ["city_id", "sales_method_id", "payment_method_id", "retailer_id", "product_id", "customer_src_id"]


def sales_census(sales: DataFrame) -> lookup.Census:
    """Hot keys of all joins of the fact, found in one pass over the stored sales."""
    return lookup.Census(sales, *[[k] for k in LOOKUP_KEYS])


def translate_keys(
    sales: DataFrame,
    maps: dict[str, DataFrame],
    geography: DataFrame,
    census: lookup.Census | None = None,
) -> DataFrame:
    """Dimension keys of every sale; a missing geography is -1, a sale without
    one of the other dimensions drops out."""
    census = census or sales_census(sales)
    rows = sales.withColumn("date_key", date_key(F.col("invoice_ts")))
    rows = lookup.resolve(
        rows, geography, {"city_id": "city_id"}, "geo_key", default=-1, census=census
    )
    for name in ("sales_method", "payment_method", "retailer", "product"):
        own = f"{name}_id"
        rows = lookup.resolve(
            rows, maps[name], {own: own}, f"{name}_key", how="inner", census=census
        )
    return rows


def candidates(
    sales: DataFrame,
    maps: dict[str, DataFrame],
    geography: DataFrame,
    customer: DataFrame,
    *sources: str,
) -> DataFrame:
    """Fact rows before the key constraint: keys translated and the customer
    version of the sale date joined. ``sources`` are columns of the sales kept beside."""
    versions = customer.select(
        "customer_key", "customer_src_id", "start_date_key", "end_date_key"
    )
    census = sales_census(sales)
    dated = scd2.as_of_join(
        translate_keys(sales, maps, geography, census),
        versions,
        "customer_src_id",
        "date_key",
        census=census,
    )
    return dated.select(*schemas.names(schemas.STAR["fct_sales"]), *sources)


#: Columns of a sale that follow from its product and customer key.
JOINED_BY = ("product_id", "customer_src_id")


def one_per_key(rows: DataFrame) -> DataFrame:
    """First row per fact key. The key leaves out geography, methods and date;
    among rows that differ only there, the smallest survives. Rows that still have the
    columns by which their product and customer were joined are met by these as well,
    which changes no group: where such a join has shuffled the rows, they lie together
    already and are not shuffled again."""
    also = [c for c in JOINED_BY if c in rows.columns]
    key = [*schemas.BUSINESS_KEY["fct_sales"], *also]
    order = [c for c in rows.columns if c not in key]
    return keep_first(rows, key, order).drop(*also)


def refresh(
    sales: DataFrame,
    maps: dict[str, DataFrame],
    geography: DataFrame,
    customer: DataFrame,
    first: date,
    last: date,
) -> DataFrame:
    """Fact rows of the window, all months in one job."""
    recent = sales.filter(in_window(F.col("invoice_ts"), first, last))
    if "yyyymm" in sales.columns:  # stored by month: folders outside are not read
        recent = recent.filter(in_months(first, last)).drop("yyyymm")
    valid = versions_in_window(customer, first, last)
    return one_per_key(candidates(recent, maps, geography, valid, *JOINED_BY))


def versions_in_window(customer: DataFrame, first: date, last: date) -> DataFrame:
    """Versions valid on some day of the window. A customer with a long history
    then meets its sales with few versions."""
    start, end = window_bounds(first, last)
    low, high = (d.year * 10000 + d.month * 100 + d.day for d in (start, end))
    return customer.filter((F.col("end_date_key") >= low) & (F.col("start_date_key") < high))


def earlier_layout(rows: DataFrame, start: int = 0) -> DataFrame:
    """Fact rows in the first star layout: one row per 13-column key, numbered."""
    key = schemas.EARLIER_FACT_KEY
    renamed = rows.withColumnRenamed("geo_key", "geography_key")
    rest = ["operating_profit", "operating_margin", "avg_unit_price", "invoice_ts"]
    once = keep_first(renamed, key, rest)
    numbered = keys.assign(once, key, "sales_key", start)
    return numbered.select(*schemas.names(schemas.EARLIER_STAR["fact_sales"]))


def dropped_by_key(rows: DataFrame) -> DataFrame:
    """How many candidates the fact key merges away, per fact key."""
    key = schemas.BUSINESS_KEY["fct_sales"]
    groups = rows.groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("dropped_rows"))
    return groups.filter("dropped_rows > 0")


def expired_partitions(names: DataFrame, first: date, column: str = "name") -> DataFrame:
    """Partition names ``fct_sales_yyyymm`` whose month lies before the window."""
    suffix = F.right(F.col(column), F.lit(6))
    return names.filter(
        F.col(column).like("fct\\_sales\\_%")
        & suffix.rlike("^[0-9]{6}$")
        & (suffix.try_cast("int") < first.year * 100 + first.month)
    )
