"""Building blocks of the comparison SQL (DuckDB dialect).

The SQL is written from the rules of the data model, not from the Spark plans:
it ranks where Spark aggregates and computes ratios in integers.
"""

from __future__ import annotations

SRC = "source_system, source_entity"



def _code(label: str, names: list[str]) -> str:
    """Place of a label in its list; another label has a number from its MD5."""
    other = f"CAST('0x' || substr(md5({label}), 1, 7) AS BIGINT) + 1000"
    return f"coalesce(CAST(list_position({names}, {label}) AS BIGINT), {other})"


_SEGMENT = _code("c.c_mktsegment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"])
_CATEGORY = _code("p.p_type", ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"])
_METHOD = _code("l.l_returnflag", ["A", "N", "R"])

STG = f"""
stg AS (
  SELECT l.l_orderkey, l.l_linenumber,
    CASE l.l_linestatus WHEN 'F' THEN 'SA_INSTORE' ELSE 'SA_ONLINE' END AS source_system,
    CASE l.l_linestatus WHEN 'F' THEN 'SRC_INSTORE' ELSE 'SRC_ONLINE' END AS source_entity,
    l.l_orderkey || '-' || l.l_linenumber AS source_id,
    s.s_name AS retailer, l.l_suppkey AS retailer_id,
    CASE WHEN l.l_linestatus = 'F' THEN r.r_name END AS region,
    CASE WHEN l.l_linestatus = 'F' THEN CAST(n.n_regionkey AS BIGINT) END AS region_id,
    CASE WHEN l.l_linestatus = 'F' THEN n.n_name END AS state,
    CASE WHEN l.l_linestatus = 'F' THEN CAST(c.c_nationkey AS BIGINT) END AS state_id,
    CASE WHEN l.l_linestatus = 'F' THEN n.n_name || '_' || c.c_mktsegment END AS city,
    CASE WHEN l.l_linestatus = 'F' THEN CAST(c.c_nationkey AS BIGINT) * 10 + {_SEGMENT} - 1 END AS city_id,
    p.p_name AS product, l.l_partkey AS product_id, p.p_type AS product_category,
    {_CATEGORY} AS product_category_id,
    CAST(p.p_retailprice AS DECIMAL(12,2)) AS price_per_unit,
    CAST(l.l_quantity AS INT) AS units_sold,
    CAST(l.l_extendedprice AS DECIMAL(14,2)) AS total_sales,
    CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount * 5 AS DECIMAL(4,2))
      AS DECIMAL(14,2)) AS operating_profit,
    CAST(l.l_discount * 5 AS DECIMAL(7,4)) AS operating_margin,
    l.l_returnflag AS sales_method,
    CAST({_METHOD} AS INT) AS sales_method_id,
    o.o_orderpriority AS payment_method,
    CAST(substr(o.o_orderpriority, 1, 1) AS INT) AS payment_method_id,
    l.l_shipdate AS invoice_ts, o.o_custkey AS customer_id,
    'Customer' AS customer_firstname, substr(c.c_name, 10) AS customer_lastname
  FROM lineitem l
  LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
  LEFT JOIN part p ON p.p_partkey = l.l_partkey
  LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
)"""

# The feed with its fixed faults.
FAULTY = """
faulty AS (
  SELECT * REPLACE (
    CASE WHEN l_orderkey % 53 <> 0 THEN product_id END AS product_id,
    CASE WHEN l_orderkey % 59 = 0 THEN '' ELSE retailer END AS retailer,
    CASE WHEN l_orderkey % 61 = 0 THEN 0 ELSE units_sold END AS units_sold,
    CASE WHEN l_orderkey % 67 <> 0 THEN total_sales END AS total_sales,
    CASE WHEN l_orderkey % 71 <> 0 THEN operating_margin END AS operating_margin,
    CASE WHEN l_orderkey % 73 <> 0 THEN customer_id END AS customer_id)
  FROM stg
)"""

# Staging after the removal of later duplicates, per source.
STAGE = """
stage AS (
  SELECT * FROM stg
  QUALIFY row_number() OVER (
    PARTITION BY source_system, customer_id, product_id, invoice_ts
    ORDER BY source_id, total_sales) = 1
)"""


def ident(keys: str, start: str = "0") -> str:
    """Surrogate key: running number in digest order of the key text."""
    text = ", ".join(f"coalesce(CAST({k.strip()} AS VARCHAR), '<null>')" for k in keys.split(","))
    return (
        f"CAST({start} + row_number() OVER (ORDER BY substr(md5(concat_ws('|', {text})), 1, 3), "
        f"{keys}) AS BIGINT)"
    )


def d4(numerator_cents: str, units: str) -> str:
    """Cents over units as an amount with four decimals, half away from zero, in
    whole numbers (DuckDB divides decimals as doubles)."""
    n = f"CAST({numerator_cents} AS HUGEINT)"
    size = f"((2 * abs({n}) * 100 + {units}) // (2 * {units}))"
    return f"CAST(sign({n}) * {size} AS DOUBLE) / 10000.0"


def category(b: str = "stg") -> str:
    return f"""
cat AS (
  SELECT {ident(SRC + ', category_src_id')} AS category_id, * FROM (
    SELECT {SRC}, product_category_id AS category_src_id,
      min(coalesce(trim(product_category), 'N/A')) AS category
    FROM {b} WHERE product_category_id IS NOT NULL GROUP BY ALL)
)"""


def product(b: str = "stg") -> str:
    return f"""
prod AS (
  SELECT {ident(SRC + ', product_src_id')} AS product_id, * FROM (
    SELECT v.source_system, v.source_entity, v.product_src_id, v.product_name, c.category_id
    FROM (SELECT DISTINCT {SRC}, product_id AS product_src_id,
            coalesce(trim(product), 'N/A') AS product_name, product_category_id
          FROM {b} WHERE product_id IS NOT NULL) v
    JOIN cat c ON c.source_system = v.source_system AND c.source_entity = v.source_entity
      AND c.category_src_id = v.product_category_id
    QUALIFY row_number() OVER (PARTITION BY v.source_system, v.source_entity, v.product_src_id
      ORDER BY v.product_name, c.category_id) = 1)
)"""


def retailer(b: str = "stg") -> str:
    return f"""
ret AS (
  SELECT {ident(SRC + ', retailer_src_id')} AS retailer_id, * FROM (
    SELECT DISTINCT {SRC}, trim(retailer) AS retailer_src_id, trim(retailer) AS retailer
    FROM {b} WHERE trim(coalesce(retailer, '')) <> '')
)"""


def method(kind: str, b: str = "stg") -> str:
    return f"""
{kind} AS (
  SELECT {ident(SRC + f', {kind}_src_id')} AS {kind}_id, * FROM (
    SELECT {SRC}, {kind}_id AS {kind}_src_id, min(coalesce(trim({kind}), 'N/A')) AS {kind}
    FROM {b} WHERE {kind}_id IS NOT NULL GROUP BY ALL)
)"""


def customers(b: str = "stg") -> str:
    """First load of both sources, in-store before online: all versions open; a
    customer of both carries the online names."""
    return f"""
cust_src AS (
  SELECT source_system, source_entity, coalesce(customer_id, 0) AS customer_src_id,
    trim(coalesce(customer_firstname, 'N/A')) AS first_name,
    trim(coalesce(customer_lastname, 'N/A')) AS last_name
  FROM {b}
  QUALIFY row_number() OVER (PARTITION BY source_system, coalesce(customer_id, 0)
    ORDER BY invoice_ts DESC, customer_firstname DESC, customer_lastname DESC) = 1
),
cust_off AS (SELECT * FROM cust_src WHERE source_system = 'SA_INSTORE'),
cust_on AS (SELECT * FROM cust_src WHERE source_system = 'SA_ONLINE'),
cust AS (
  SELECT {ident('i.customer_src_id')} AS customer_id, i.source_system, i.source_entity,
    i.customer_src_id, coalesce(o.first_name, i.first_name) AS first_name,
    coalesce(o.last_name, i.last_name) AS last_name
  FROM cust_off i LEFT JOIN cust_on o ON o.customer_src_id = i.customer_src_id
  UNION ALL
  SELECT {ident('customer_src_id', '(SELECT count(*) FROM cust_off)')}, *
  FROM cust_on o WHERE customer_src_id NOT IN (SELECT customer_src_id FROM cust_off)
)"""


def entities(b: str) -> str:
    return ",".join(
        [
            category(b),
            product(b),
            retailer(b),
            method("sales_method", b),
            method("payment_method", b),
            customers(b),
        ]
    )


MEASURES = f"""
    CAST(coalesce(units_sold, 0) AS INT) AS units_sold,
    CAST(coalesce(price_per_unit, 0) AS DOUBLE) AS price_per_unit,
    CAST(coalesce(total_sales, 0) AS DOUBLE) AS total_sales,
    CAST(operating_profit AS DOUBLE) AS operating_profit,
    CAST(operating_margin AS DOUBLE) AS operating_margin,
    CASE WHEN total_sales <> 0 AND units_sold <> 0
      THEN {d4('total_sales * 100', 'units_sold')} END AS avg_unit_price,
    CASE WHEN units_sold > 0 AND total_sales IS NOT NULL
      THEN {d4('(total_sales - coalesce(operating_profit, 0)) * 100', 'units_sold')}
      END AS profit_per_unit,
    coalesce(operating_margin >= 0.30, FALSE) AS is_high_margin"""


def sales(b: str) -> str:
    """Resolved sales, one row per natural key."""
    def ref(t: str, on: str) -> str:
        return (
            f"LEFT JOIN {t} ON {t}.source_system = s.source_system "
            f"AND {t}.source_entity = s.source_entity AND {on}"
        )

    return f"""
sales AS (
  SELECT DISTINCT ON (source_system, source_entity, sale_src_id, invoice_ts, customer_src_id,
      product_id, retailer_id, city_id, sales_method_id, payment_method_id, units_sold,
      price_per_unit, total_sales) *
  FROM (
    SELECT s.source_system, s.source_entity, s.source_id AS sale_src_id, s.invoice_ts,
      coalesce(cust.customer_id, -1) AS customer_id,
      CASE WHEN cust.customer_id IS NULL THEN -1 ELSE cust.customer_src_id END AS customer_src_id,
      coalesce(prod.product_id, -1) AS product_id,
      coalesce(ret.retailer_id, -1) AS retailer_id,
      coalesce(s.city_id, -1) AS city_id,
      coalesce(sales_method.sales_method_id, -1) AS sales_method_id,
      coalesce(payment_method.payment_method_id, -1) AS payment_method_id, {MEASURES.replace(
          "units_sold", "s.units_sold").replace("price_per_unit", "s.price_per_unit").replace(
          "total_sales", "s.total_sales").replace("operating_profit", "s.operating_profit").replace(
          "operating_margin", "s.operating_margin").replace("AS s.", "AS ")}
    FROM {b} s
    LEFT JOIN cust ON cust.customer_src_id = coalesce(s.customer_id, 0)
    {ref('prod', 'prod.product_src_id = s.product_id')}
    {ref('ret', "ret.retailer_src_id = trim(coalesce(s.retailer, 'N/A'))")}
    {ref('sales_method', 'sales_method.sales_method_src_id = s.sales_method_id')}
    {ref('payment_method', 'payment_method.payment_method_src_id = s.payment_method_id')}
  )
  ORDER BY operating_profit NULLS FIRST, operating_margin NULLS FIRST, customer_id
)"""


STAR = f"""
dprod AS (
  SELECT {ident('p.source_system, p.source_entity, p.product_src_id')} AS product_key,
    p.source_system, p.source_entity, p.product_src_id, p.product_name, c.category_src_id,
    c.category AS category_name, p.product_id
  FROM prod p JOIN cat c ON c.category_id = p.category_id
),
dret AS (
  SELECT {ident(SRC + ', retailer_src_id')} AS retailer_key, {SRC}, retailer_src_id,
    retailer AS retailer_name, retailer_id
  FROM ret
),
dgeo AS (
  SELECT {ident('city_id')} AS geo_key, city_id, city_name, state_id, state_name, region_id,
    region_name
  FROM (SELECT city_id, min(city) AS city_name, min(state_id) AS state_id,
          min(state) AS state_name, min(region_id) AS region_id, min(region) AS region_name
        FROM stage WHERE source_system = 'SA_INSTORE' GROUP BY city_id)
),
dcust AS (
  SELECT {ident('customer_src_id, start_date_key')} AS customer_key, *
  FROM (SELECT customer_src_id, first_name, last_name, first_name || ' ' || last_name AS full_name,
          19000101 AS start_date_key, 99991231 AS end_date_key, TRUE AS is_current FROM cust)
),
dsm AS (
  SELECT {ident(SRC + ', sales_method_src_id')} AS sales_method_key, * FROM sales_method
),
dpm AS (
  SELECT {ident(SRC + ', payment_method_src_id')} AS payment_method_key, * FROM payment_method
)"""

FACT = """
fact AS (
  SELECT year(s.invoice_ts) * 10000 + month(s.invoice_ts) * 100 + day(s.invoice_ts) AS date_key,
    dprod.product_key, dret.retailer_key, coalesce(dgeo.geo_key, -1) AS geo_key,
    dsm.sales_method_key, dpm.payment_method_key, dcust.customer_key,
    s.sale_src_id, s.source_system, s.source_entity, s.invoice_ts, s.units_sold,
    s.price_per_unit, s.total_sales, s.operating_profit, s.operating_margin,
    s.avg_unit_price, s.profit_per_unit, s.is_high_margin
  FROM sales s
  JOIN dprod ON dprod.product_id = s.product_id
  JOIN dret ON dret.retailer_id = s.retailer_id
  JOIN dsm ON dsm.sales_method_id = s.sales_method_id
  JOIN dpm ON dpm.payment_method_id = s.payment_method_id
  JOIN dcust ON dcust.customer_src_id = s.customer_src_id
  LEFT JOIN dgeo ON dgeo.city_id = s.city_id
  QUALIFY row_number() OVER (
    PARTITION BY s.source_system, s.source_entity, s.sale_src_id, s.invoice_ts,
      dprod.product_key, dret.retailer_key, dcust.customer_key
    ORDER BY date_key, geo_key, dsm.sales_method_key, dpm.payment_method_key, s.units_sold,
      s.price_per_unit, s.total_sales, s.operating_profit, s.operating_margin) = 1
)"""

WINDOW = """
win AS (
  SELECT date_trunc('month', max(invoice_ts)) - INTERVAL 2 MONTH AS w0,
    date_trunc('month', max(invoice_ts)) + INTERVAL 1 MONTH AS w1
  FROM sales
)"""


def warehouse(final: str, b: str = "stage", extra: str = "") -> str:
    """A query over the loaded warehouse: stage, entities, sales, star, fact."""
    parts = [STG, STAGE, entities(b), sales(b), STAR, FACT, WINDOW]
    return "WITH " + ",".join(parts) + (f",{extra}" if extra else "") + "\n" + final
