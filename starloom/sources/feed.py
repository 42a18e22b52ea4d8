"""The retail feed read from the given order tables.

One feed row per order line, in the staging layout. A caller names the columns
it needs and only the tables behind those columns are joined; all joins are
left joins on unique keys, so a feed never gains or loses rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.lookup import broadcast_bytes, plan_bytes
from starloom.sources.extracts import INSTORE, ONLINE

# Code lists of the given tables, in code order.
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
SALES_METHODS = ["A", "N", "R"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Codes of labels outside the lists start here.
OTHER_CODES = 1000


def _code(c: Column, names: list[str]) -> Column:
    """Place of a label in its list; another label gets a number of its own from the
    first 28 bits of its MD5."""
    at = F.array_position(F.array(*[F.lit(n) for n in names]), c)
    other = F.conv(F.substring(F.md5(c.cast("binary")), 1, 7), 16, 10).cast("bigint") + OTHER_CODES
    return F.when(at > 0, at).otherwise(other)


def _columns() -> dict[str, tuple[tuple[str, ...], Column]]:
    """Feed column -> (tables it needs, expression)."""
    instore = F.col("l_linestatus") == "F"

    def place(c: Column) -> Column:
        return F.when(instore, c)

    base, orders = (), ("orders",)
    customer = (*orders, "customer")
    nation = (*customer, "nation")
    region = (*nation, "region")
    nation_id = F.col("c_nationkey").cast("bigint")
    margin = F.col("l_discount") * 5
    return {
        "source_system": (base, F.when(instore, INSTORE.system).otherwise(ONLINE.system)),
        "source_entity": (base, F.when(instore, INSTORE.entity).otherwise(ONLINE.entity)),
        "source_id": (base, F.concat_ws("-", "l_orderkey", "l_linenumber")),
        "retailer": (("supplier",), F.col("s_name")),
        "retailer_id": (base, F.col("l_suppkey")),
        "region": (region, place(F.col("r_name"))),
        "region_id": (nation, place(F.col("n_regionkey").cast("bigint"))),
        "state": (nation, place(F.col("n_name"))),
        "state_id": (customer, place(nation_id)),
        "city": (nation, place(F.concat_ws("_", "n_name", "c_mktsegment"))),
        "city_id": (
            customer,
            place(nation_id * 10 + _code(F.col("c_mktsegment"), SEGMENTS) - 1),
        ),
        "product": (("part",), F.col("p_name")),
        "product_id": (base, F.col("l_partkey")),
        "product_category": (("part",), F.col("p_type")),
        "product_category_id": (("part",), _code(F.col("p_type"), CATEGORIES)),
        "price_per_unit": (("part",), F.col("p_retailprice").cast("decimal(12,2)")),
        "units_sold": (base, F.col("l_quantity").cast("int")),
        "total_sales": (base, F.col("l_extendedprice").cast("decimal(14,2)")),
        "operating_profit": (
            base,
            (
                F.col("l_extendedprice").cast("decimal(12,2)") * margin.cast("decimal(4,2)")
            ).cast("decimal(14,2)"),
        ),
        "operating_margin": (base, margin.cast("decimal(7,4)")),
        "sales_method": (base, F.col("l_returnflag")),
        "sales_method_id": (base, _code(F.col("l_returnflag"), SALES_METHODS).cast("int")),
        "payment_method": (orders, F.col("o_orderpriority")),
        "payment_method_id": (orders, F.substring("o_orderpriority", 1, 1).cast("int")),
        "invoice_ts": (base, F.col("l_shipdate")),
        "customer_id": (orders, F.col("o_custkey")),
        "customer_firstname": (base, F.lit("Customer")),
        "customer_lastname": (customer, F.substr("c_name", F.lit(10))),
        "l_orderkey": (base, F.col("l_orderkey")),
        "l_linenumber": (base, F.col("l_linenumber")),
    }


#: Joined in this order: the long tables first, while the lines have few columns.
_KEYS = {
    "orders": ("l_orderkey", "o_orderkey"),
    "part": ("l_partkey", "p_partkey"),
    "customer": ("o_custkey", "c_custkey"),
    "nation": ("c_nationkey", "n_nationkey"),
    "region": ("n_regionkey", "r_regionkey"),
    "supplier": ("l_suppkey", "s_suppkey"),
}


def _beyond_broadcast(orders: DataFrame) -> bool:
    """Whether Spark would shuffle the order lines to join them with their orders."""
    narrow = orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    return not 0 <= plan_bytes(narrow)[0] <= broadcast_bytes(orders)


def sales(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The feed with the named columns (all of them when none is named)."""
    catalogue = _columns()
    wanted = list(columns) or [c for c in catalogue if not c.startswith("l_")]
    needed = {t for c in wanted for t in catalogue[c][0]}
    out = table(spark, sf_dir, "lineitem")
    long = needed >= {"orders", "customer"} and _beyond_broadcast(table(spark, sf_dir, "orders"))
    for name, (fk, pk) in _KEYS.items():
        if name not in needed or (long and name == "customer"):
            continue
        right = table(spark, sf_dir, name)
        if long and name == "orders":  # with their customers, so that lines are shuffled once
            customer = table(spark, sf_dir, "customer")
            right = right.join(customer, right["o_custkey"] == customer["c_custkey"], "left")
        out = out.join(right, out[fk] == right[pk], "left")
    return out.select(*[catalogue[c][1].alias(c) for c in wanted])


# Columns of the faulty variant that are changed by the order key, and the
# divisor that selects them.
_FAULTS = {
    "product_id": (53, None),
    "retailer": (59, ""),
    "units_sold": (61, 0),
    "total_sales": (67, None),
    "operating_margin": (71, None),
    "customer_id": (73, None),
}


def faulty_sales(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The feed with missing products, customers and measures, blank retailers
    and zero units, each on a fixed share of the orders."""
    out = sales(spark, sf_dir, *columns, "l_orderkey")
    for column, (divisor, value) in _FAULTS.items():
        if column in columns:
            kind = out.schema[column].dataType
            hit = F.col("l_orderkey") % divisor == 0
            out = out.withColumn(
                column, F.when(hit, F.lit(value).cast(kind)).otherwise(F.col(column))
            )
    return out.drop("l_orderkey")


def raw_text(spark: SparkSession, sf_dir: str, spec) -> DataFrame:
    """One source's feed as the text of its CSV extract, with blank amounts
    (order key divisible by 97) and unreadable units (by 101)."""
    staged = [
        c
        for c in ("source_id", *spec.raw_columns, "invoice_ts", "source_system")
        if c not in ("index", "invoice_date")
    ]
    rows = sales(spark, sf_dir, *staged, "l_orderkey").filter(
        F.col("source_system") == spec.system
    )
    order = F.col("l_orderkey")
    text = {
        "index": F.col("source_id"),
        "price_per_unit": F.concat(F.lit("$"), F.col("price_per_unit").cast("string")),
        "units_sold": F.when(order % 101 == 0, "12-3").otherwise(
            F.col("units_sold").cast("string")
        ),
        "total_sales": F.when(order % 97 == 0, "").otherwise(
            F.concat(F.lit("$"), F.format_number("total_sales", 2))
        ),
        "operating_margin": F.concat(
            (F.col("operating_margin") * 100).cast("int").cast("string"), F.lit("%")
        ),
        "invoice_date": F.date_format("invoice_ts", "M/d/yyyy H:mm"),
    }
    return rows.select(
        *[text.get(c, F.col(c).cast("string")).alias(c) for c in spec.raw_columns]
    )
