"""Queries: data-quality checks on an example warehouse with known faults.

Clients come from two sources (even and odd customer keys), products, places
and sales from the given tables; faults are planted on fixed shares of the rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from starloom import schemas
from starloom.catalog.registry import ORACLES, doubles, query
from starloom.catalog.sql import STG
from starloom.functions import clean
from starloom.quality import checks, verify
from starloom.sources import feed

AS_OF = date(2021, 1, 20)


def _key(df, column):
    return df, F.col(column)


def clients(spark, sf_dir):
    """Warehouse clients; every 83rd has a wrong validity, phone and middle name."""
    rows, k = _key(feed.table(spark, sf_dir, "customer"), "c_custkey")
    bad = k % 83 == 0
    return rows.select(
        k.alias("client_id"),
        k.alias("client_src_id"),
        F.when(bad, "0").otherwise(
            F.concat(F.lit("+"), F.col("c_nationkey").cast("string"), k.cast("string"))
        ).alias("phone_number"),
        F.when(bad, "X").otherwise("N/A").alias("middle_name"),
        F.when(bad, F.lit(date(2001, 1, 1))).otherwise(F.lit(date(2000, 1, 1))).alias("valid_from"),
        F.when(k % 5 == 0, F.lit(date(2020, 6, 1)))
        .otherwise(F.lit(date(2100, 1, 1)))
        .alias("valid_to"),
        F.when((k % 5 == 0) == bad, "Y").otherwise("N").alias("is_valid"),
    )


_CLIENTS = """
clients AS (
  SELECT c_custkey AS client_id, c_custkey AS client_src_id,
    CASE WHEN c_custkey % 83 = 0 THEN '0' ELSE '+' || c_nationkey || c_custkey END AS phone_number,
    CASE WHEN c_custkey % 83 = 0 THEN 'X' ELSE 'N/A' END AS middle_name,
    CASE WHEN c_custkey % 83 = 0 THEN '2001-01-01' ELSE '2000-01-01' END AS valid_from,
    CASE WHEN c_custkey % 5 = 0 THEN '2020-06-01' ELSE '2100-01-01' END AS valid_to,
    CASE WHEN (c_custkey % 5 = 0) = (c_custkey % 83 = 0) THEN 'Y' ELSE 'N' END AS is_valid
  FROM customer
)"""


def s1_clients(spark, sf_dir):
    rows = feed.table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0")
    return rows.select(F.col("c_custkey").alias("client_id"))


def s2_clients(spark, sf_dir):
    rows = feed.table(spark, sf_dir, "customer").filter("c_custkey % 2 = 1")
    return rows.select(
        F.col("c_custkey").alias("client_id"),
        F.concat(F.lit("+"), F.col("c_nationkey").cast("string")).alias("phone_code"),
        F.col("c_custkey").cast("string").alias("phone_number"),
    )


def products(spark, sf_dir):
    """Warehouse products; every 89th has a cost that is 1 too high."""
    rows = feed.table(spark, sf_dir, "part")
    price = F.col("p_retailprice").cast("decimal(18,2)")
    return rows.select(
        F.col("p_partkey").alias("product_src_id"),
        F.concat_ws("#", "p_name", "p_partkey").alias("product_name"),
        F.when(F.col("p_partkey") % 89 == 0, price + 1).otherwise(price)
        .cast("decimal(18,2)").alias("product_cost"),
    )


_PRODUCTS = """
products AS (
  SELECT p_partkey AS product_src_id, p_name || '#' || p_partkey AS product_name,
    CAST(CAST(p_retailprice AS DECIMAL(18,2)) + CASE WHEN p_partkey % 89 = 0 THEN 1 ELSE 0 END
      AS DOUBLE) AS product_cost
  FROM part
)"""


def _price_text(column="p_retailprice"):
    return F.col(column).cast("decimal(18,2)").cast("string")


def locations(spark, sf_dir):
    """Warehouse locations: from channels (id 'N/A') below nation 12, from the
    second source above; nation 3 and 20 carry a wrong id."""
    k = F.col("n_nationkey")
    own = F.when(k == 3, "7").when(k == 20, "99").when(k < 12, "N/A").otherwise(k.cast("string"))
    return feed.table(spark, sf_dir, "nation").select(
        k.alias("location_id"), own.alias("location_src_id"), F.col("n_name").alias("location_name")
    )


_LOCATIONS = """
locations AS (
  SELECT n_nationkey AS location_id, CASE WHEN n_nationkey = 3 THEN '7' WHEN n_nationkey = 20
    THEN '99' WHEN n_nationkey < 12 THEN 'N/A' ELSE CAST(n_nationkey AS VARCHAR) END
    AS location_src_id, n_name AS location_name
  FROM nation
)"""


def channels(spark, sf_dir):
    """One channel per supplier; suppliers of nation 7 point nowhere."""
    k = F.col("s_nationkey")
    return feed.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("channel_id"),
        F.when(k == 7, 700).otherwise(k).alias("location_id"),
    )


def sales(spark, sf_dir):
    """Warehouse sales; some quantities negative or missing, some orders not
    completed, some keys missing."""
    o = F.col("l_orderkey")
    rows = feed.table(spark, sf_dir, "lineitem")
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("sale_id"),
        F.when(o % 107 != 0, o).alias("client_id"),
        F.when(o % 109 != 0, F.col("l_suppkey")).alias("channel_id"),
        F.col("l_partkey").alias("product_id"),
        F.when(o % 103 == 0, -F.col("l_quantity"))
        .when(o % 127 != 0, F.col("l_quantity"))
        .cast("int")
        .alias("quantity"),
        F.col("l_shipdate").alias("order_created"),
        F.when(o % 113 != 0, F.col("l_shipdate")).alias("order_completed"),
    )


_SALES = """
sales AS (
  SELECT l_orderkey || '-' || l_linenumber AS sale_id,
    CASE WHEN l_orderkey % 107 <> 0 THEN l_orderkey END AS client_id,
    CASE WHEN l_orderkey % 109 <> 0 THEN l_suppkey END AS channel_id, l_partkey AS product_id,
    CAST(CASE WHEN l_orderkey % 103 = 0 THEN -l_quantity
      WHEN l_orderkey % 127 <> 0 THEN l_quantity END AS INT) AS quantity,
    l_shipdate AS order_created, CASE WHEN l_orderkey % 113 <> 0 THEN l_shipdate END
      AS order_completed
  FROM lineitem
)"""


_GAPPY_KEYS = ("client_id", "channel_id", "quantity")
_GAPPY_SQL = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _GAPPY_KEYS)


def dashboard(spark, sf_dir):
    """Mart rows; the total cost of every 131st order is 5 too low."""
    rows = sales_with_cost(spark, sf_dir)
    total = F.col("quantity") * F.col("product_cost")
    wrong = F.col("l_orderkey") % 131 == 0
    return rows.select(
        "sale_id",
        "product_name",
        "quantity",
        F.when(wrong, total - 5).otherwise(total).cast("decimal(18,2)").alias("total_cost"),
    )


def sales_with_cost(spark, sf_dir):
    rows = feed.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("sale_id"),
        F.col("l_partkey").alias("product_src_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )
    return rows.join(products(spark, sf_dir), "product_src_id")


@query(
    """
    SELECT count(*) AS dwh_clients, count(*) FILTER (c_custkey % 2 = 0)
      + count(*) FILTER (c_custkey % 2 = 1) AS sum_src FROM customer
    """
)
def dq_client_counts(spark, sf_dir):
    sources = [s1_clients(spark, sf_dir), s2_clients(spark, sf_dir)]
    return checks.count_reconcile(clients(spark, sf_dir), sources, ("dwh_clients", "sum_src"))


@query("SELECT count(*) AS dm_rows, count(*) AS dwh_sales_rows FROM lineitem")
def dq_mart_counts(spark, sf_dir):
    return checks.count_reconcile(
        dashboard(spark, sf_dir), [sales(spark, sf_dir)], ("dm_rows", "dwh_sales_rows")
    )


@query(
    f"""
    WITH {_CLIENTS}
    SELECT * FROM clients WHERE client_id % 2 = 0
      AND (valid_from <> '2000-01-01' OR valid_to <> '2100-01-01')
    """
)
def dq_client_validity(spark, sf_dir):
    return checks.reconcile(
        clients(spark, sf_dir),
        s1_clients(spark, sf_dir),
        {"client_src_id": "client_id"},
        {"valid_from": F.lit(date(2000, 1, 1)), "valid_to": F.lit(date(2100, 1, 1))},
    )


@query(f"WITH {_CLIENTS} SELECT * FROM clients WHERE client_id % 2 = 1 AND client_id % 83 = 0")
def dq_client_phone(spark, sf_dir):
    blank = F.lit("")
    phone = F.concat(
        F.coalesce(F.col("s_phone_code"), blank), F.coalesce(F.col("s_phone_number"), blank)
    )
    return checks.reconcile(
        clients(spark, sf_dir),
        s2_clients(spark, sf_dir),
        {"client_src_id": "client_id"},
        {"phone_number": phone},
    )


@query(f"WITH {_CLIENTS} SELECT * FROM clients WHERE client_id % 2 = 1 AND middle_name = 'X'")
def dq_client_middle_name(spark, sf_dir):
    return checks.reconcile(
        clients(spark, sf_dir),
        s2_clients(spark, sf_dir),
        {"client_src_id": "client_id"},
        {"middle_name": F.lit("N/A")},
    )


@query(f"WITH {_CLIENTS} SELECT * FROM clients WHERE client_id % 83 = 0")
def dq_client_flag(spark, sf_dir):
    return checks.flag_consistency(clients(spark, sf_dir), "valid_to", "is_valid", AS_OF)


@query(
    f"""
    WITH {_PRODUCTS}
    SELECT products.*, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS cost
    FROM products JOIN part ON p_partkey = product_src_id
    WHERE p_partkey % 89 = 0 AND p_partkey % 7 <> 0
    """
)
def dq_product_cost(spark, sf_dir):
    """Costs against the first source, whose text is blank for every 7th product."""
    source = feed.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 7 == 0, "").otherwise(_price_text()).alias("cost"),
    )
    found = checks.reconcile(
        products(spark, sf_dir).withColumn("checked", clean.as_decimal(F.col("product_cost"))),
        source,
        {"product_src_id": "product_id"},
        {"checked": clean.as_decimal(F.col("s_cost"))},
        show=("cost",),
    )
    return found.drop("checked")


@query(
    f"""
    WITH {_PRODUCTS}
    SELECT products.*, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS product_price
    FROM products JOIN part ON p_partkey = product_src_id
    WHERE p_partkey % 89 = 0 AND p_partkey IN (SELECT l_partkey FROM lineitem)
    """
)
def dq_product_price(spark, sf_dir):
    """Costs against the distinct prices of the second source's sales."""
    lines = feed.table(spark, sf_dir, "lineitem").select("l_partkey").distinct()
    priced = feed.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), _price_text().alias("product_price")
    )
    source = lines.join(priced, "l_partkey").withColumnRenamed("l_partkey", "product_id")
    found = checks.reconcile(
        products(spark, sf_dir).withColumn("checked", clean.as_decimal(F.col("product_cost"))),
        source,
        {"product_src_id": "product_id"},
        {"checked": clean.as_decimal(F.col("s_product_price"))},
        show=("product_price",),
    )
    return found.drop("checked")


@query(
    f"""
    WITH {_LOCATIONS}
    SELECT l.* FROM supplier JOIN locations l ON l.location_id = s_nationkey
    WHERE s_nationkey = 3
    """
)
def dq_location_default_id(spark, sf_dir):
    """Places of channels below nation 12 must have id 'N/A'; one row per channel."""
    nation = feed.table(spark, sf_dir, "nation").filter("n_nationkey < 12")
    channel = feed.table(spark, sf_dir, "supplier").join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    return checks.reconcile(
        locations(spark, sf_dir),
        channel.select(F.col("n_name").alias("channel_location")),
        {"location_name": "channel_location"},
        {"location_src_id": F.lit("N/A")},
    )


@query(
    f"""
    WITH {_LOCATIONS}
    SELECT location_id AS dwh_id, location_src_id, location_name, '20' AS location_id
    FROM locations l WHERE l.location_id = 20
    """
)
def dq_location_source_id(spark, sf_dir):
    nation = feed.table(spark, sf_dir, "nation").filter("n_nationkey >= 12")
    source = nation.select(
        F.col("n_nationkey").cast("string").alias("location_id"), F.col("n_name").alias("name")
    )
    return checks.reconcile(
        locations(spark, sf_dir).withColumnRenamed("location_id", "dwh_id"),
        source,
        {"location_name": "name"},
        {"location_src_id": F.col("s_location_id")},
        show=("location_id",),
    )


@query(
    """
    SELECT s_suppkey AS channel_id, 700 AS location_id FROM supplier WHERE s_nationkey = 7
    """
)
def dq_channel_orphans(spark, sf_dir):
    return checks.orphans(
        channels(spark, sf_dir), locations(spark, sf_dir), "location_id", "location_id"
    )


@query(
    f"WITH {_SALES} SELECT * REPLACE ({_GAPPY_SQL}) FROM sales WHERE coalesce(quantity, -1) < 0"
)
def dq_sales_quantity(spark, sf_dir):
    return doubles(checks.range_check(sales(spark, sf_dir), "quantity", low=0), *_GAPPY_KEYS)


@query(f"WITH {_SALES} SELECT * REPLACE ({_GAPPY_SQL}) FROM sales WHERE order_completed IS NULL")
def dq_sales_dates(spark, sf_dir):
    return doubles(checks.not_null(sales(spark, sf_dir), "order_created", "order_completed"), *_GAPPY_KEYS)


@query(
    f"""
    WITH {_PRODUCTS}
    SELECT l_orderkey || '-' || l_linenumber AS sale_id, product_name,
      CAST(l_quantity AS INT) AS quantity, CAST(CAST(l_quantity AS INT)
        * CAST(product_cost AS DECIMAL(18,2)) - 5 AS DOUBLE) AS total_cost,
      CAST(CAST(l_quantity AS INT) * CAST(product_cost AS DECIMAL(18,2)) AS DOUBLE)
        AS expected_total
    FROM lineitem JOIN products ON product_src_id = l_partkey WHERE l_orderkey % 131 = 0
    """
)
def dq_mart_total_cost(spark, sf_dir):
    cost = products(spark, sf_dir).select("product_name", "product_cost")
    return checks.recompute(
        dashboard(spark, sf_dir),
        cost,
        "product_name",
        "total_cost",
        F.col("quantity") * F.col("product_cost"),
        "expected_total",
    )


@query(
    """
    SELECT c_custkey - c_custkey % 2 AS client_id, count(*) AS dup_count FROM customer
    WHERE c_custkey % 50 < 2 GROUP BY ALL HAVING count(*) > 1
    """
)
def dq_client_key_unique(spark, sf_dir):
    """Client keys, two clients of every fifty given the same one."""
    k = F.col("client_id")
    merged = clients(spark, sf_dir).withColumn("client_id", F.when(k % 50 == 1, k - 1).otherwise(k))
    return checks.duplicates(merged, "client_id")


@query(
    f"WITH {_SALES} SELECT sale_id, count(*) AS dup_count FROM sales GROUP BY 1 HAVING count(*) > 1"
)
def dq_sale_key_unique(spark, sf_dir):
    return checks.duplicates(sales(spark, sf_dir), "sale_id")


@query(
    f"""
    WITH {_SALES}
    SELECT * REPLACE ({_GAPPY_SQL}) FROM sales WHERE client_id IS NULL OR channel_id IS NULL OR product_id IS NULL
    """
)
def dq_sales_foreign_keys(spark, sf_dir):
    return doubles(checks.not_null(sales(spark, sf_dir), "client_id", "channel_id", "product_id"), *_GAPPY_KEYS)


@query(
    f"""
    WITH {STG}
    SELECT source_id, product_id, CAST(operating_margin AS DOUBLE) AS operating_margin
    FROM stg WHERE operating_margin > 0.45
    """
)
def dq_margin_range(spark, sf_dir):
    rows = feed.sales(spark, sf_dir, "source_id", "product_id", "operating_margin")
    return checks.range_check(rows, "operating_margin", low=0, high=0.45)


@query("SELECT p_partkey, p_name FROM part WHERE length(p_name) > 11")
def dq_text_length(spark, sf_dir):
    rows = feed.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return checks.too_long(rows, {"p_name": 11})


@query(
    f"""
    WITH {_CLIENTS}, {_SALES},
    found AS (
      SELECT 'client validity' AS check_name, (SELECT count(*) FROM clients WHERE client_id % 2 = 0
        AND (valid_from <> '2000-01-01' OR valid_to <> '2100-01-01')) AS violations
      UNION ALL SELECT 'client phone', (SELECT count(*) FROM clients
        WHERE client_id % 2 = 1 AND client_id % 83 = 0)
      UNION ALL SELECT 'client flag', (SELECT count(*) FROM clients WHERE client_id % 83 = 0)
      UNION ALL SELECT 'channel orphans', (SELECT count(*) FROM supplier WHERE s_nationkey = 7)
      UNION ALL SELECT 'client key', 0
      UNION ALL SELECT 'sale keys present', (SELECT count(*) FROM sales
        WHERE client_id IS NULL OR channel_id IS NULL)
      UNION ALL SELECT 'sale quantity', (SELECT count(*) FROM sales
        WHERE coalesce(quantity, -1) < 0))
    SELECT *, violations = 0 AS passed FROM found
    """
)
def dq_summary(spark, sf_dir):
    return checks.summary(
        {
            "client validity": dq_client_validity(spark, sf_dir),
            "client phone": dq_client_phone(spark, sf_dir),
            "client flag": dq_client_flag(spark, sf_dir),
            "channel orphans": dq_channel_orphans(spark, sf_dir),
            "client key": checks.duplicates(clients(spark, sf_dir), "client_id"),
            "sale keys present": dq_sales_foreign_keys(spark, sf_dir),
            "sale quantity": dq_sales_quantity(spark, sf_dir),
        }
    )


_ROW_CHECKS = {
    "client validity": dq_client_validity,
    "client phone": dq_client_phone,
    "client middle name": dq_client_middle_name,
    "client flag": dq_client_flag,
    "client key": dq_client_key_unique,
    "product cost": dq_product_cost,
    "product price": dq_product_price,
    "location default id": dq_location_default_id,
    "location source id": dq_location_source_id,
    "channel orphans": dq_channel_orphans,
    "sale quantity": dq_sales_quantity,
    "sale dates": dq_sales_dates,
    "sale key": dq_sale_key_unique,
    "sale foreign keys": dq_sales_foreign_keys,
    "mart total cost": dq_mart_total_cost,
}
_COUNT_CHECKS = {"client counts": dq_client_counts, "mart counts": dq_mart_counts}


@query(
    "SELECT *, violations = 0 AS passed FROM ("
    + " UNION ALL ".join(
        [f"SELECT '{name}' AS check_name, count(*) AS violations FROM ({ORACLES[fn.__name__]})" for name, fn in _ROW_CHECKS.items()]
        + [f"SELECT '{name}', count(*) FROM ({ORACLES[fn.__name__]}) t(ours, theirs) WHERE ours <> theirs" for name, fn in _COUNT_CHECKS.items()]
    )
    + ")"
)
def dq_summary_all(spark, sf_dir):
    """All checks, each with its violations; a count that does not agree is one."""
    rows = {name: fn(spark, sf_dir) for name, fn in _ROW_CHECKS.items()}
    for name, fn in _COUNT_CHECKS.items():
        counts = fn(spark, sf_dir)
        ours, theirs = counts.columns
        rows[name] = counts.filter(F.col(ours) != F.col(theirs))
    return checks.summary(rows)


@query(
    f"""
    WITH {STG}
    SELECT source_id, product_id, invoice_ts FROM stg
    ORDER BY invoice_ts, source_id, product_id LIMIT 100
    """
)
def staging_preview(spark, sf_dir):
    rows = feed.sales(spark, sf_dir, "source_id", "product_id", "invoice_ts")
    return verify.preview(rows, ["invoice_ts", "source_id", "product_id"], 100)
