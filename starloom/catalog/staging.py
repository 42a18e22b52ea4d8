"""Queries: cleaning, staging, file round trips, duplicates."""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import functions as F

from starloom.catalog.registry import doubles, query
from starloom.catalog.sql import STG
from starloom.context import LoadContext, scratch_path, together
from starloom.functions import clean
from starloom.operators.dedup import duplicate_groups, keep_first
from starloom.plans import runs
from starloom.plans.audit import AuditLog
from starloom.quality import profile
from starloom.quality.verify import counts_by_source
from starloom.sources import extracts, feed
from starloom.sources.extracts import INSTORE, ONLINE
from starloom.sources.store import Store

CTX = LoadContext.on(date(2002, 1, 1))


@query(
    """
    SELECT l_orderkey || '-' || l_linenumber AS source_id,
      TRY_CAST(NULLIF(regexp_replace(CAST(l_quantity AS VARCHAR), '[^0-9\\-]', '', 'g'), '')
        AS BIGINT) AS quantity_digits,
      CASE WHEN l_orderkey % 101 <> 0 THEN CAST(l_linenumber AS DOUBLE) END AS line_no,
      CASE WHEN l_orderkey % 97 = 0 THEN NULL
        ELSE CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS DOUBLE) END AS amount,
      contains(CAST(l_quantity AS VARCHAR), '.') AS loses_point
    FROM lineitem
    """
)
def clean_numeric_text(spark, sf_dir):
    rows = feed.table(spark, sf_dir, "lineitem")
    amount = F.col("l_extendedprice").cast("decimal(14,2)")
    texts = rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("source_id"),
        F.col("l_quantity").cast("string").alias("quantity"),
        F.when(F.col("l_orderkey") % 101 == 0, "12-3")
        .otherwise(F.concat(F.lit(" no. "), F.col("l_linenumber").cast("string")))
        .alias("line"),
        F.when(F.col("l_orderkey") % 97 == 0, "")
        .otherwise(F.concat(F.lit("$"), F.format_number(amount, 2)))
        .alias("amount"),
    )
    read = texts.select(
        "source_id",
        clean.to_long(F.col("quantity")).alias("quantity_digits"),
        clean.to_int(F.col("line")).alias("line_no"),
        clean.to_decimal(F.col("amount"), 14, 2).alias("amount"),
        clean.loses_point(F.col("quantity")).alias("loses_point"),
    )
    return doubles(read, "line_no")


@query(
    """
    SELECT l_orderkey || '-' || l_linenumber AS source_id,
      CAST(CAST(l_discount * 5 AS DECIMAL(7,4)) AS DOUBLE) AS margin,
      round(l_discount * 100) / 10000.0 AS fraction_again
    FROM lineitem
    """
)
def clean_percent(spark, sf_dir):
    rows = feed.table(spark, sf_dir, "lineitem")
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("source_id"),
        clean.percent_to_fraction(
            F.concat(F.round(F.col("l_discount") * 500).cast("int").cast("string"), F.lit("%"))
        ).alias("margin"),
        clean.percent_to_fraction(F.col("l_discount").cast("string")).alias("fraction_again"),
    )


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 89 = 0 THEN NULL
        ELSE o_orderdate + INTERVAL (o_orderkey % 24) HOUR END AS invoice_ts
    FROM orders
    """
)
def parse_us_timestamp(spark, sf_dir):
    orders = feed.table(spark, sf_dir, "orders")
    moment = F.expr("o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int))")
    text = (
        F.when(F.col("o_orderkey") % 89 == 0, "2/30/2023 10:52")
        .when(F.col("o_orderkey") % 2 == 0, F.date_format(moment, "M/d/yyyy H:mm"))
        .otherwise(F.date_format(moment, "MM/dd/yyyy HH:mm"))
    )
    return orders.select("o_orderkey", clean.to_ts(text).alias("invoice_ts"))


@query(
    """
    SELECT c_custkey,
      CASE WHEN c_custkey % 7 = 0 AND c_custkey % 11 = 0 THEN ''
           WHEN c_custkey % 7 = 0 THEN substr(c_name, 10)
           WHEN c_custkey % 11 = 0 THEN 'Customer'
           WHEN c_custkey % 13 = 0 THEN ' ' || substr(c_name, 10)
           ELSE 'Customer ' || substr(c_name, 10) END AS full_name
    FROM customer
    """
)
def full_name(spark, sf_dir):
    key = F.col("c_custkey")
    first = F.when(key % 7 == 0, F.lit(None)).when(
        (key % 13 == 0) & (key % 11 != 0), ""
    ).otherwise("Customer")
    last = F.when(key % 11 == 0, F.lit(None)).otherwise(F.substr("c_name", F.lit(10)))
    names = feed.table(spark, sf_dir, "customer").select(
        "c_custkey",
        clean.na_then_trim(first).alias("first"),
        clean.text_or_na(last).alias("last"),
    )
    return names.select(
        "c_custkey", clean.full_name(F.col("first"), F.col("last")).alias("full_name")
    )


_TYPED = """
    source_system, source_entity, source_id, retailer, retailer_id, {geo}
    product, product_id, product_category, product_category_id,
    CAST(price_per_unit AS DOUBLE) AS price_per_unit, units_sold,
    CASE WHEN l_orderkey % 97 <> 0 THEN CAST(total_sales AS DOUBLE) END AS total_sales,
    CAST(operating_profit AS DOUBLE) AS operating_profit,
    CAST(operating_margin AS DOUBLE) AS operating_margin,
    sales_method, sales_method_id, payment_method, payment_method_id, invoice_ts, customer_id,
    customer_firstname, customer_lastname, TIMESTAMP '2002-01-01' AS insert_dt,
    TIMESTAMP '2002-01-01' AS update_dt
"""
_GEO = "region, region_id, state, state_id, city, city_id,"


def _typed_sql(system: str, geo: str) -> str:
    return (
        f"WITH {STG} SELECT {_TYPED.format(geo=geo)} FROM stg "
        f"WHERE source_system = '{system}' AND l_orderkey % 101 <> 0"
    )


def _extract(spark, sf_dir, spec):
    """One source's feed written as its CSV extract and read back as text."""
    path = scratch_path(spark, f"extract-{spec.table}")
    extracts.convert(feed.raw_text(spark, sf_dir, spec), path)
    return extracts.read_raw(spark, path, spec)


def _extracts(spark, sf_dir):
    """Both sources' extracts, written at the same time so that their last tasks share the cores."""
    raws = together(*[partial(_extract, spark, sf_dir, s) for s in (INSTORE, ONLINE)])
    return dict(zip((INSTORE, ONLINE), raws))


@query(_typed_sql("SA_INSTORE", _GEO))
def staging_instore(spark, sf_dir):
    return extracts.clean_rows(_extract(spark, sf_dir, INSTORE), INSTORE, CTX)


@query(_typed_sql("SA_ONLINE", ""))
def staging_online(spark, sf_dir):
    return extracts.clean_rows(_extract(spark, sf_dir, ONLINE), ONLINE, CTX)


@query(
    f"""
    WITH {STG}
    SELECT source_system, source_entity, source_id, 'units_sold' AS bad_columns
    FROM stg WHERE l_orderkey % 101 = 0
    """
)
def staging_rejects(spark, sf_dir):
    parts = [extracts.rejects(raw, s) for s, raw in _extracts(spark, sf_dir).items()]
    return parts[0].unionByName(parts[1])


def _staged(spark, sf_dir):
    """Both extracts through the staging step, in a store of their own."""
    store = Store(spark, scratch_path(spark, "staged"))
    log = AuditLog(spark, f"{store.root}/_log")
    marked = {s.table: extracts.marked_rows(raw, s, CTX) for s, raw in _extracts(spark, sf_dir).items()}
    runs.stage(store, log, CTX, marked)
    return store, log


@query(
    f"""
    WITH {STG}
    SELECT source_system, source_entity, source_id, 'units_sold' AS bad_columns,
      strftime(TIMESTAMP '2002-01-01', '%Y-%m-%d') AS loaded
    FROM stg WHERE l_orderkey % 101 = 0
    """
)
def load_rejects(spark, sf_dir):
    """What a staging load stored of the rows that it could not read."""
    rows = _staged(spark, sf_dir)[0].read("load_rejects")
    return rows.withColumn("loaded", F.date_format("load_ts", "yyyy-MM-dd")).drop("load_ts")


@query(
    f"""
    WITH {STG},
    kept AS (
      SELECT source_system, count(DISTINCT (coalesce(customer_id, -9), coalesce(product_id, -9),
        date_trunc('minute', invoice_ts))) AS kept
      FROM stg WHERE l_orderkey % 101 <> 0 GROUP BY ALL),
    raw AS (
      SELECT source_system, count(*) AS n, count(*) FILTER (l_orderkey % 101 = 0) AS bad FROM stg GROUP BY ALL)
    SELECT CASE source_system WHEN 'SA_INSTORE' THEN 'stage_src_instore_sales' ELSE 'stage_src_online_sales' END
        AS procedure_name, kept AS rows_affected,
      'read=' || n || ', kept=' || kept || ', duplicates=' || (n - bad - kept) || ', rejects=' || bad AS message
    FROM raw JOIN kept USING (source_system)
    """
)
def load_outcome(spark, sf_dir):
    """The log of a staging load: every row read was kept, a duplicate or a reject."""
    rows = _staged(spark, sf_dir)[1].rows()
    return rows.select("procedure_name", "rows_affected", "message")


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
      CAST(CAST(c_acctbal AS DECIMAL(14,2)) AS VARCHAR) AS c_acctbal, c_mktsegment
    FROM customer
    """
)
def csv_roundtrip(spark, sf_dir):
    customer = feed.table(spark, sf_dir, "customer")
    path = scratch_path(spark, "csv")
    extracts.convert(customer.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(14,2)")), path)
    ddl = ", ".join(f"{c} string" for c in customer.columns)
    return spark.read.schema(ddl).option("header", True).csv(path)


@query(
    """
    SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
    FROM part
    """
)
def csv_inferred_types(spark, sf_dir):
    path = scratch_path(spark, "csv")
    extracts.convert(feed.table(spark, sf_dir, "part"), path)
    rows = profile.read_for_profile(spark, path)
    return rows.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query(
    f"""
    WITH {STG}
    SELECT source_system, source_entity, count(*) AS n_rows FROM stg GROUP BY ALL
    """
)
def staging_append(spark, sf_dir):
    store = Store(
        spark,
        scratch_path(spark, "append"),
        {"feed": "source_system string, source_entity string, source_id string"},
    )
    rows = feed.sales(spark, sf_dir, "source_system", "source_entity", "source_id")
    for spec in (INSTORE, ONLINE):
        txn = store.begin()
        txn.append("feed", rows.filter(F.col("source_system") == spec.system))
        txn.commit()
    return counts_by_source(store.read("feed"))


_KEYS = ["customer_id", "product_id", "invoice_ts"]


def _with_copies(spark, sf_dir):
    """The feed with a second copy of every twentieth order."""
    rows = feed.sales(
        spark,
        sf_dir,
        "source_system",
        "source_id",
        *_KEYS,
        "total_sales",
        "retailer_id",
        "l_orderkey",
    )
    copies = rows.filter(F.col("l_orderkey") % 20 == 0)
    both = rows.withColumn("copy_no", F.lit(0)).unionByName(copies.withColumn("copy_no", F.lit(1)))
    return both.drop("l_orderkey")


_COPIES = f"""
    WITH {STG},
    copies AS (
      SELECT *, 0 AS copy_no FROM stg UNION ALL
      SELECT *, 1 AS copy_no FROM stg WHERE l_orderkey % 20 = 0)
"""


@query(
    _COPIES
    + """
    SELECT source_system, customer_id, product_id, invoice_ts, count(*) AS dup_count
    FROM copies GROUP BY ALL HAVING count(*) > 1
    """
)
def staging_duplicates(spark, sf_dir):
    return duplicate_groups(_with_copies(spark, sf_dir), ["source_system", *_KEYS])


@query(
    _COPIES
    + """
    SELECT source_system, source_id, customer_id, product_id, invoice_ts,
      CAST(total_sales AS DOUBLE) AS total_sales, retailer_id, copy_no
    FROM copies
    QUALIFY row_number() OVER (PARTITION BY source_system, customer_id, product_id, invoice_ts
      ORDER BY copy_no, source_id, total_sales, retailer_id) = 1
    """
)
def staging_dedup(spark, sf_dir):
    return keep_first(
        _with_copies(spark, sf_dir),
        ["source_system", *_KEYS],
        ["copy_no", "source_id", "total_sales", "retailer_id"],
    )


@query(
    f"""
    WITH {STG}
    SELECT source_system, source_entity, source_id, invoice_ts, product_id, retailer_id,
      CAST(total_sales AS DOUBLE) AS total_sales
    FROM stg
    QUALIFY row_number() OVER (PARTITION BY source_system, source_entity, source_id
      ORDER BY invoice_ts, product_id, retailer_id, total_sales) = 1
    """
)
def dedup_source_id(spark, sf_dir):
    rows = feed.sales(
        spark,
        sf_dir,
        "source_system",
        "source_entity",
        "source_id",
        "invoice_ts",
        "product_id",
        "retailer_id",
        "total_sales",
    )
    return keep_first(
        rows,
        ["source_system", "source_entity", "source_id"],
        ["invoice_ts", "product_id", "retailer_id", "total_sales"],
    )
