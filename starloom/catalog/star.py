"""Queries: calendar, star dimensions, the fact and whole load runs."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import schemas
from starloom.catalog import loads, sql
from starloom.catalog.registry import doubles, query
from starloom.catalog.sql import SRC, STG, ident, warehouse
from starloom.context import LoadContext, materialise, scratch_path
from starloom.functions.dates import date_key
from starloom.operators import calendar, keys, scd2
from starloom.operators.merge import update_changed
from starloom.plans import dims, fact, runs
from starloom.plans.audit import AuditLog
from starloom.quality import verify
from starloom.quality.checks import duplicates
from starloom.sources import feed
from starloom.sources.extracts import SOURCES
from starloom.sources.store import Store

CTX = LoadContext.on(date(2002, 1, 1))

_CALENDAR = """
    CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(CAST(d AS DATE) AS VARCHAR) AS full_date,
    CAST(year(d) AS INT) AS year_num, CAST(quarter(d) AS INT) AS quarter_num,
    CAST(month(d) AS INT) AS month_num, strftime(d, '%b') AS month_name,
    CAST(day(d) AS INT) AS day_of_month, CAST(isodow(d) AS INT) AS day_of_week,
    strftime(d, '%a') AS day_name, isodow(d) IN (6, 7) AS is_weekend
"""


# ---------------------------------------------------------------- calendar


@query(
    f"""
    SELECT {_CALENDAR} FROM (
      SELECT unnest(range(min(l_shipdate), max(l_shipdate) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d
      FROM lineitem)
    """
)
def calendar_fact_range(spark, sf_dir):
    sales = feed.sales(spark, sf_dir, "invoice_ts")
    return calendar.build_over(calendar.fact_range(sales, CTX.load_dt))


@query(
    """
    SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_surr_id,
      CAST(CAST(d AS DATE) AS VARCHAR) AS date_dt, CAST(day(d) AS INT) AS day_of_month,
      strftime(d, '%B') AS month_name, CAST(month(d) AS INT) AS month_no,
      CAST(year(d) AS INT) AS year_no, strftime(d, '%A') AS weekday_name,
      CAST(isodow(d) AS INT) AS weekday_no, isodow(d) IN (6, 7) AS is_weekend
    FROM (SELECT unnest(range(min(o_orderdate), max(o_orderdate) + INTERVAL 1 DAY,
            INTERVAL 1 DAY)) AS d FROM orders)
    """
)
def calendar_long_names(spark, sf_dir):
    orders = feed.table(spark, sf_dir, "orders")
    bounds = calendar.fact_range(orders, CTX.load_dt, "o_orderdate")
    return calendar.build_standalone(bounds)


@query(
    f"""
    SELECT {_CALENDAR} FROM (
      SELECT DISTINCT l_shipdate AS d FROM lineitem
      WHERE l_shipdate NOT IN (SELECT o_orderdate FROM orders WHERE o_orderdate < '1998-01-01'))
    """
)
def ensure_dates(spark, sf_dir):
    """Calendar rows that sales need and a calendar of early orders lacks."""
    orders = feed.table(spark, sf_dir, "orders").filter("o_orderdate < '1998-01-01'")
    none = spark.createDataFrame([], schemas.struct(schemas.STAR["dim_date"]))
    have = calendar.ensure_dates(none, orders, "o_orderdate")
    return calendar.ensure_dates(have, feed.table(spark, sf_dir, "lineitem"), "l_shipdate")


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 83 = 0 THEN -1
      ELSE CAST(strftime(o_orderdate, '%Y%m%d') AS INT) END AS date_key
    FROM orders
    """
)
def date_keys(spark, sf_dir):
    orders = feed.table(spark, sf_dir, "orders")
    known = F.when(F.col("o_orderkey") % 83 != 0, F.col("o_orderdate"))
    return orders.select("o_orderkey", date_key(known).alias("date_key"))


# ---------------------------------------------------------------- dimensions


def seeded(spark, table: str):
    none = spark.createDataFrame([], schemas.struct(schemas.STAR[table]))
    return keys.ensure_default_member(
        none, schemas.DEFAULT_MEMBERS[table], schemas.SURROGATE[table]
    )


@query(
    f"""
    WITH {STG}, {sql.category()}, {sql.product()},
    known AS (SELECT * FROM prod WHERE product_src_id % 40 <> 1),
    keyed AS (
      SELECT {ident(SRC + ', product_src_id')} AS product_key, product_id FROM known
      UNION ALL
      SELECT {ident(SRC + ', product_src_id', '(SELECT count(*) FROM known)')}, product_id
      FROM prod WHERE product_src_id % 40 = 1)
    SELECT k.product_key, p.source_system, p.source_entity, p.product_src_id,
      p.product_name || CASE WHEN p.product_src_id % 25 = 0 THEN ' v2' ELSE '' END AS product_name,
      c.category_src_id, c.category AS category_name
    FROM prod p JOIN cat c USING (category_id) JOIN keyed k USING (product_id)
    UNION ALL BY NAME
    SELECT -1 AS product_key, 'MANUAL' AS source_system, 'MANUAL' AS source_entity,
      -1 AS product_src_id, 'N/A' AS product_name, -1 AS category_src_id, 'N/A' AS category_name
    """
)
def dim_product_upsert(spark, sf_dir):
    """Second product load: some names changed, some products are new."""
    target, product, category = _product_loads(spark, sf_dir)
    return dims.load_product(target, product, category).table


def _product_loads(spark, sf_dir):
    rows = feed.sales(
        spark, sf_dir, "source_system", "source_entity", "product", "product_id",
        "product_category", "product_category_id",
    )
    category = materialise(loads.category_table(spark, rows), "category")
    product = materialise(loads.product_table(spark, rows, category), "product")
    early = product.filter("product_src_id % 40 <> 1")
    first = dims.load_product(seeded(spark, "dim_product"), early, category)
    renamed = F.when(
        F.col("product_src_id") % 25 == 0, F.concat("product_name", F.lit(" v2"))
    ).otherwise(F.col("product_name"))
    later = product.withColumn(
        "product_name", F.when(F.col("product_id") != -1, renamed).otherwise("N/A")
    )
    return materialise(first.table, "dim"), later, category


@query(
    f"""
    WITH {STG}, {sql.category()}, {sql.product()}
    SELECT 'inserted' AS outcome, count(*) AS n_rows FROM prod WHERE product_src_id % 40 = 1
    UNION ALL
    SELECT 'updated', count(*) FROM prod WHERE product_src_id % 40 <> 1 AND product_src_id % 25 = 0
    UNION ALL SELECT 'inserted again', 0 UNION ALL SELECT 'updated again', 0
    UNION ALL SELECT 'update only', (SELECT count(*) FROM prod WHERE product_src_id % 40 <> 1
      AND product_src_id % 25 = 0)
    """
)
def upsert_counts(spark, sf_dir):
    """Deltas of a changed load, and of the same load run again: none."""
    target, product, category = _product_loads(spark, sf_dir)
    result = dims.load_product(target, product, category)
    table = materialise(result.table, "dim")
    again = dims.load_product(table, product, category)
    only = update_changed(
        target,
        dims.product_source(product, category),
        schemas.BUSINESS_KEY["dim_product"],
        ["product_name"],
    )
    return verify.table_counts(
        {
            "inserted": result.inserted,
            "updated": result.updated,
            "inserted again": again.inserted,
            "updated again": again.updated,
            "update only": only.updated,
        }
    ).withColumnRenamed("table_name", "outcome")


@query(
    f"""
    WITH {STG}, {sql.retailer()}
    SELECT {ident(SRC + ', retailer_src_id')} AS retailer_key, {SRC}, retailer_src_id,
      CASE WHEN CAST(right(retailer, 3) AS INT) % 10 = 0 THEN upper(retailer) ELSE retailer END
        AS retailer_name
    FROM ret
    UNION ALL BY NAME SELECT -1 AS retailer_key, 'N/A' AS retailer_src_id, 'N/A' AS retailer_name,
      'MANUAL' AS source_system, 'MANUAL' AS source_entity
    """
)
def dim_retailer_upsert(spark, sf_dir):
    """Retailer names restyled by a second load under unchanged ids."""
    rows = feed.sales(spark, sf_dir, "source_system", "source_entity", "retailer")
    retailer = materialise(loads.retailer_table(spark, rows), "retailer")
    first = dims.load_retailer(seeded(spark, "dim_retailer"), retailer)
    loud = F.right("retailer", F.lit(3)).try_cast("int") % 10 == 0
    restyled = retailer.withColumn(
        "retailer", F.when(loud, F.upper("retailer")).otherwise(F.col("retailer"))
    )
    return dims.load_retailer(materialise(first.table, "dim"), restyled).table


def _method_dim_sql(kind: str) -> str:
    return f"""
    WITH {STG}, {sql.method(kind)}
    SELECT {ident(SRC + f', {kind}_src_id')} AS {kind}_key, {SRC}, {kind}_src_id,
      {kind} AS {kind}_name FROM {kind}
    UNION ALL BY NAME SELECT -1 AS {kind}_key, -1 AS {kind}_src_id, 'Unknown' AS {kind}_name,
      'MANUAL' AS source_system, 'MANUAL' AS source_entity
    """


@query(_method_dim_sql("sales_method"))
def dim_sales_method(spark, sf_dir):
    rows = feed.sales(
        spark, sf_dir, "source_system", "source_entity", "sales_method", "sales_method_id"
    )
    method = loads.method_table(spark, rows, "sales_method")
    return dims.load_method(seeded(spark, "dim_sales_method"), method, "sales_method").table


@query(_method_dim_sql("payment_method"))
def dim_payment_method(spark, sf_dir):
    rows = feed.sales(
        spark, sf_dir, "source_system", "source_entity", "payment_method", "payment_method_id"
    )
    method = loads.method_table(spark, rows, "payment_method")
    return dims.load_method(seeded(spark, "dim_payment_method"), method, "payment_method").table


@query(
    f"""
    WITH {STG}
    SELECT {ident('city_id')} AS geo_key, * FROM (
      SELECT DISTINCT city_id, city AS city_name, state_id, state AS state_name, region_id,
        region AS region_name
      FROM stg WHERE source_system = 'SA_INSTORE')
    UNION ALL BY NAME SELECT -1 AS geo_key, -1 AS city_id, 'Unknown' AS city_name, -1 AS state_id,
      'Unknown' AS state_name, -1 AS region_id, 'Unknown' AS region_name
    """
)
def dim_geography(spark, sf_dir):
    rows = feed.sales(
        spark, sf_dir, "source_system", "source_entity", "region", "region_id", "state",
        "state_id", "city", "city_id",
    ).filter("source_system = 'SA_INSTORE'")
    rows = materialise(rows, "places")
    city, state, region = (
        loads.place_table(spark, rows, level, parent)
        for level, parent in (("city", "state"), ("state", "region"), ("region", None))
    )
    return dims.load_geography(seeded(spark, "dim_geography"), city, state, region).table


_DCUST = f"""
    WITH {loads._VERSIONS},
    early AS (SELECT {ident('customer_src_id, start_date_key')} AS customer_key, * FROM (
      SELECT customer_src_id, 19970101 AS start_date_key FROM v1)),
    late AS (SELECT {ident('customer_src_id, start_date_key', '(SELECT count(*) FROM early)')}
      AS customer_key, * FROM (SELECT customer_src_id, 19990101 AS start_date_key FROM opened))
    SELECT k.customer_key, v.customer_src_id, v.first_name, v.last_name,
      v.first_name || ' ' || v.last_name AS full_name, k.start_date_key,
      CAST(replace(v.end_dt, '-', '') AS INT) AS end_date_key, v.is_active AS is_current
    FROM versions v JOIN (FROM early UNION ALL FROM late) k
      ON k.customer_src_id = v.customer_src_id
      AND k.start_date_key = CAST(replace(v.start_dt, '-', '') AS INT)
    UNION ALL BY NAME SELECT -1 AS customer_key, -1 AS customer_src_id, 'Unknown' AS first_name,
      'Unknown' AS last_name, 'Unknown' AS full_name, 19000101 AS start_date_key,
      99991231 AS end_date_key, FALSE AS is_current
"""


@query(_DCUST)
def dim_customer_mirror(spark, sf_dir):
    """Customer dimension after two version loads: closed versions are updated
    in place, new ones inserted."""
    none = spark.createDataFrame([], schemas.struct(schemas.NF3["ce_customer_scd"]))
    one = loads.scd2.apply(
        none, loads._snapshot(spark, sf_dir, False), loads._context(loads._DAY1)
    )
    first = dims.load_customer(seeded(spark, "dim_customer"), one.table)
    versions = loads._versions(spark, sf_dir).table
    return dims.load_customer(materialise(first.table, "dim"), versions).table


# ---------------------------------------------------------------- whole runs

_LOADED: dict[tuple[str, str], Store] = {}


def load_warehouse(spark, sf_dir: str, all_months: bool = False) -> tuple[Store, AuditLog]:
    """Stage the feed and run every load into a new store."""
    store = Store(spark, scratch_path(spark, "warehouse"))
    log = AuditLog(spark, f"{store.root}/_log")
    rows = feed.sales(spark, sf_dir)
    stamped = rows.withColumns({"insert_dt": CTX.load_ts_col, "update_dt": CTX.load_ts_col})
    cleaned = {
        spec.table: stamped.filter(F.col("source_system") == spec.system).select(
            *schemas.names(schemas.STAGING[spec.table])
        )
        for spec in SOURCES
    }
    runs.stage(store, log, CTX, cleaned)
    runs.run_nf3(store, log, CTX)
    runs.run_dims(store, log, CTX)
    runs.extend_calendar(store, log, CTX)
    runs.refresh_fact(store, log, CTX)
    return store, log


def warehouse_of(spark, sf_dir: str) -> Store:
    """The loaded warehouse of a folder, built once per Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOADED:
        _LOADED[key] = load_warehouse(spark, sf_dir)[0]
    return _LOADED[key]


def _corrected(df: DataFrame, column: str, key: str, divisor: int) -> DataFrame:
    hit = F.col(key) % divisor == 0
    return df.withColumn(column, F.when(hit, F.concat(column, F.lit(" *"))).otherwise(F.col(column)))


_CORRECTED = {  # table: (label, source id, divisor)
    "ce_product": ("product_name", "product_src_id", 7),
    "ce_category": ("category", "category_src_id", 3),
    "ce_city": ("city_name", "city_id", 5),
    "ce_sales_method": ("sales_method", "sales_method_src_id", 2),
    "ce_payment_method": ("payment_method", "payment_method_src_id", 2),
}


@query(
    warehouse(
        """
        SELECT * FROM (
          SELECT 1 AS run, 'dim_product' AS dimension, 0 AS inserted,
            (SELECT count(*) FROM dprod WHERE product_src_id % 7 = 0 OR category_src_id % 3 = 0) AS updated
          UNION ALL SELECT 1, 'dim_geography', 0, (SELECT count(*) FROM dgeo WHERE city_id % 5 = 0)
          UNION ALL SELECT 1, 'dim_sales_method', 0,
            (SELECT count(*) FROM dsm WHERE sales_method_src_id % 2 = 0)
          UNION ALL SELECT 1, 'dim_payment_method', 0,
            (SELECT count(*) FROM dpm WHERE payment_method_src_id % 2 = 0)
          UNION ALL SELECT 1, 'dim_retailer', 0, 0
          UNION ALL SELECT 1, 'dim_customer', 0, 0
          UNION ALL SELECT 2, unnest(['dim_product', 'dim_geography', 'dim_sales_method',
            'dim_payment_method', 'dim_retailer', 'dim_customer']), 0, 0)
        """
    )
)
def second_run_deltas(spark, sf_dir):
    """Rows that each dimension takes over after corrections in the normalised
    layer, and in one more run after that."""
    store = warehouse_of(spark, sf_dir).branch(scratch_path(spark, "corrected"))
    txn = store.begin()
    for table, (label, key, divisor) in _CORRECTED.items():
        txn.replace(table, _corrected(store.read(table), label, key, divisor))
    txn.commit()
    log = AuditLog(spark, f"{store.root}/_log")
    done = [(run, runs.run_dims(store, log, CTX)) for run in (1, 2)]
    rows = [(run, dim, *counts) for run, deltas in done for dim, counts in deltas.items()]
    return spark.createDataFrame(rows, "run int, dimension string, inserted bigint, updated bigint")


@query(
    warehouse(
        """
        SELECT f.sale_src_id, f.date_key, f.total_sales, c.customer_src_id,
          c.last_name || CASE WHEN c.customer_src_id % 10 = 0 AND f.date_key >= 19950601
            THEN '_B' ELSE '' END AS last_name,
          CASE WHEN c.customer_src_id % 10 = 0 AND f.date_key >= 19950601 THEN 19950601
            ELSE 19000101 END AS start_date_key
        FROM fact f JOIN dcust c USING (customer_key)
        """
    )
)
def fact_two_versions(spark, sf_dir):
    """The fact of all months where one customer in ten has two versions: each sale
    gets the version of its date."""
    base = warehouse_of(spark, sf_dir)
    store = base.branch(scratch_path(spark, "versions"))
    known = base.read("ce_customer_scd").filter("customer_id <> -1")
    attrs = ["customer_src_id", "first_name", "last_name", "full_name", "source_system", "source_entity"]
    none = known.limit(0)
    one = scd2.apply(none, known.select(*attrs), LoadContext.on(date(1994, 1, 1)))
    renamed = F.when(F.col("customer_src_id") % 10 == 0, F.concat("last_name", F.lit("_B"))).otherwise(F.col("last_name"))
    later = known.select(*attrs).withColumn("last_name", renamed)
    later = later.withColumn("full_name", F.concat_ws(" ", "first_name", "last_name"))
    two = scd2.apply(materialise(one.table, "versions"), later, LoadContext.on(date(1995, 6, 1)))
    txn = store.begin()
    txn.replace("ce_customer_scd", two.table.unionByName(base.read("ce_customer_scd").filter("customer_id = -1")))
    txn.replace("dim_customer", base.read("dim_customer").filter("customer_key = -1"))
    txn.commit()
    runs.run_dims(store, AuditLog(spark, f"{store.root}/_log"), CTX)
    rows = _fact_rows(store, date(1990, 1, 1), CTX.load_dt)
    versions = store.read("dim_customer").select("customer_key", "customer_src_id", "last_name", "start_date_key")
    return rows.join(versions, "customer_key").select(
        "sale_src_id", "date_key", "total_sales", "customer_src_id", "last_name", "start_date_key"
    )


_FACT_COLUMNS = ", ".join(schemas.names(schemas.STAR["fct_sales"]))
_IN_WINDOW = "invoice_ts >= (SELECT w0 FROM win) AND invoice_ts < (SELECT w1 FROM win)"


@query(
    """
    SELECT CAST(CAST(date_trunc('month', max(l_shipdate)) - INTERVAL 2 MONTH AS DATE) AS VARCHAR)
        AS first,
      CAST(last_day(max(l_shipdate)) AS VARCHAR) AS last
    FROM lineitem
    """
)
def refresh_window(spark, sf_dir):
    return fact.refresh_window(feed.sales(spark, sf_dir, "invoice_ts"), CTX.load_dt)


@query(
    """
    SELECT CAST(strftime(m, '%Y%m') AS INT) AS yyyymm, CAST(CAST(m AS DATE) AS VARCHAR)
      AS month_start, CAST(CAST(m + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS month_end
    FROM (SELECT unnest(range(date_trunc('month', max(l_shipdate)) - INTERVAL 11 MONTH,
      max(l_shipdate) + INTERVAL 1 SECOND, INTERVAL 1 MONTH)) AS m FROM lineitem)
    """
)
def window_months(spark, sf_dir):
    sales = feed.sales(spark, sf_dir, "invoice_ts")
    return fact.window_months(fact.refresh_window(sales, CTX.load_dt, months=12))


@query(warehouse(f"SELECT {_FACT_COLUMNS} FROM fact WHERE {_IN_WINDOW}"))
def fact_refresh(spark, sf_dir):
    """The fact after its rolling three-month refresh."""
    return warehouse_of(spark, sf_dir).read("fct_sales").drop("yyyymm")


@query(warehouse(f"SELECT {_FACT_COLUMNS} FROM fact"))
def fact_all_months(spark, sf_dir):
    """Fact rows of every sale month, all months in one job."""
    store = warehouse_of(spark, sf_dir)
    return _fact_rows(store, date(1990, 1, 1), CTX.load_dt)


def _fact_rows(store: Store, first: date, last: date):
    tables = {t: store.read(t) for t in schemas.TABLES}
    maps = fact.dimension_maps(tables, tables)
    return fact.refresh(
        tables["ce_sales"], maps, tables["dim_geography"], tables["dim_customer"], first, last
    )


@query(
    warehouse(
        f"""
        SELECT count(*) AS n_rows, 1 AS first_key, count(*) AS last_key,
          count(DISTINCT (sale_src_id, product_key, geo_key)) AS n_sales,
          round(sum(total_sales), 2) AS total_sales
        FROM fact WHERE {_IN_WINDOW}
        """
    )
)
def fact_earlier_layout(spark, sf_dir):
    """The refreshed fact in the first star layout, summed up; its keys are 1..n."""
    rows = fact.earlier_layout(warehouse_of(spark, sf_dir).read("fct_sales"))
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("sales_key").alias("first_key"),
        F.max("sales_key").alias("last_key"),
        F.countDistinct("sale_src_id", "product_key", "geography_key").alias("n_sales"),
        F.sum("total_sales").alias("total_sales"),
    )


@query(
    warehouse(
        f"""
        SELECT strftime(invoice_ts, '%Y-%m') AS yyyymm, count(*) AS n_rows FROM fact
        WHERE {_IN_WINDOW} GROUP BY ALL ORDER BY 1 DESC LIMIT 6
        """
    )
)
def fact_rows_by_month(spark, sf_dir):
    return verify.rows_by_month(warehouse_of(spark, sf_dir).read("fct_sales"), 6)


@query(
    warehouse(
        """
        SELECT CAST(strftime(invoice_ts, '%Y%m') AS INT) AS yyyymm, count(*) AS n_rows FROM fact
        WHERE invoice_ts >= (SELECT max(w0) - INTERVAL 1 MONTH FROM win)
        GROUP BY ALL
        """
    )
)
def fact_retention(spark, sf_dir):
    """A fact of five months refreshed over a two-month window in its middle:
    those months are reloaded, older ones dropped, newer ones kept."""
    store = warehouse_of(spark, sf_dir)
    newest = store.read("ce_sales").agg(F.max("invoice_ts").cast("date")).first()[0]
    at = newest.year * 12 + newest.month - 1
    months = {k: divmod(at - k, 12) for k in (2, 3, 4)}
    start = {k: date(y, m + 1, 1) for k, (y, m) in months.items()}
    own = Store(spark, scratch_path(spark, "retention"), {"fct_sales": schemas.STAR["fct_sales"]})
    number = {k: d.year * 100 + d.month for k, d in start.items()}

    rows = _fact_rows(store, start[4], newest)
    txn = own.begin()
    txn.replace_months("fct_sales", rows, number[4], newest.year * 100 + newest.month)
    txn.commit()
    txn = own.begin()
    again = _fact_rows(store, start[3], start[2])
    txn.replace_months("fct_sales", again, number[3], number[2])
    txn.drop_months_before("fct_sales", number[3])
    txn.commit()
    return own.read("fct_sales").groupBy("yyyymm").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    warehouse(
        f"""
        SELECT {_FACT_COLUMNS} FROM fact
        WHERE invoice_ts >= (SELECT date_trunc('month', max(invoice_ts)) FROM fact)
        ORDER BY invoice_ts, sale_src_id, product_key LIMIT 20
        """
    )
)
def latest_month_sample(spark, sf_dir):
    rows = warehouse_of(spark, sf_dir).read("fct_sales")
    order = ["invoice_ts", "sale_src_id", "product_key"]
    return verify.latest_month_sample(rows, order).drop("yyyymm")


_N_DAYS = "(SELECT datediff('day', min(invoice_ts), max(invoice_ts)) + 1 AS n FROM sales)"
_IN_STORE = "SELECT * FROM stage WHERE source_system = 'SA_INSTORE'"


@query(
    warehouse(
        f"""
        SELECT 'ce_sales' AS table_name, count(*) AS n_rows FROM sales
        UNION ALL SELECT 'ce_category', count(*) + 1 FROM cat
        UNION ALL SELECT 'ce_product', count(*) + 1 FROM prod
        UNION ALL SELECT 'ce_retailer', count(*) + 1 FROM ret
        UNION ALL SELECT 'ce_sales_method', count(*) + 1 FROM sales_method
        UNION ALL SELECT 'ce_payment_method', count(*) + 1 FROM payment_method
        UNION ALL SELECT 'ce_region', count(DISTINCT region_id) + 1 FROM ({_IN_STORE})
        UNION ALL SELECT 'ce_state', count(DISTINCT state_id) + 1 FROM ({_IN_STORE})
        UNION ALL SELECT 'ce_city', count(DISTINCT city_id) + 1 FROM ({_IN_STORE})
        UNION ALL SELECT 'ce_customer_scd', count(*) + 1 FROM cust
        UNION ALL SELECT 'src_instore_sales', count(*) FROM ({_IN_STORE})
        UNION ALL SELECT 'src_online_sales', count(*) FROM stage WHERE source_system = 'SA_ONLINE'
        UNION ALL SELECT 'load_rejects', count(*) FROM stg WHERE source_system IS NULL
        UNION ALL SELECT 'constraint_violations', count(*) FROM sales WHERE sale_src_id IS NULL
        UNION ALL SELECT 'dim_date', n + 3 FROM {_N_DAYS}
        UNION ALL SELECT 'dim_product', count(*) + 1 FROM dprod
        UNION ALL SELECT 'dim_retailer', count(*) + 1 FROM dret
        UNION ALL SELECT 'dim_geography', count(*) + 1 FROM dgeo
        UNION ALL SELECT 'dim_sales_method', count(*) + 1 FROM dsm
        UNION ALL SELECT 'dim_payment_method', count(*) + 1 FROM dpm
        UNION ALL SELECT 'dim_customer', count(*) + 1 FROM dcust
        UNION ALL SELECT 'fct_sales', count(*) FROM fact WHERE {_IN_WINDOW}
        """
    )
)
def table_counts(spark, sf_dir):
    """Rows of every table. The calendar has the sale days, the unknown date and the two
    ends of all validity."""
    store = warehouse_of(spark, sf_dir)
    return verify.table_counts({t: store.read(t) for t in schemas.TABLES})


@query(
    warehouse(
        """
        SELECT customer_src_id, full_name, start_date_key, end_date_key FROM dcust
        UNION ALL SELECT -1, 'Unknown', 19000101, 99991231
        ORDER BY customer_src_id, start_date_key LIMIT 20
        """
    )
)
def customer_history(spark, sf_dir):
    listed = runs.customer_history(warehouse_of(spark, sf_dir))
    return listed.select("customer_src_id", "full_name", "start_date_key", "end_date_key")


_LOG_LINES = f"""
    SELECT log_id, procedure_name, CAST(rows_affected AS BIGINT) AS rows_affected, message FROM (
      SELECT CASE k.entity WHEN 'src_instore_sales' THEN 1 ELSE 2 END AS log_id, 'stage_' || k.entity AS procedure_name,
        n AS rows_affected, 'read=' || m || ', kept=' || n || ', duplicates=' || (m - n) || ', rejects=0' AS message
      FROM (SELECT lower(source_entity) || '_sales' AS entity, count(*) AS m FROM stg GROUP BY ALL) k
      JOIN (SELECT lower(source_entity) || '_sales' AS entity, count(*) AS n FROM stage GROUP BY ALL) USING (entity)
      UNION ALL SELECT 3, 'load_category', (SELECT count(*) FROM cat), 'ok'
      UNION ALL SELECT 4, 'load_retailer', (SELECT count(*) FROM ret), 'ok'
      UNION ALL SELECT 5, 'load_methods', (SELECT count(*) FROM sales_method) + (SELECT count(*) FROM payment_method), 'ok'
      UNION ALL SELECT 6, 'load_geo', (SELECT count(DISTINCT region_id) + count(DISTINCT state_id)
        + count(DISTINCT city_id) FROM ({_IN_STORE})), 'ok'
      UNION ALL SELECT 7, 'load_customer', (SELECT count(*) FROM cust), 'versions closed, opened or corrected'
      UNION ALL SELECT 8, 'load_product', (SELECT count(*) FROM prod), 'ok'
      UNION ALL SELECT 9, 'load_sales', (SELECT count(*) FROM sales),
        'read=' || (SELECT count(*) FROM stage) || ', without id or time=0, known or merged='
          || ((SELECT count(*) FROM stage) - (SELECT count(*) FROM sales))
      UNION ALL SELECT 10, 'check_constraints', 0, 'ok'
      UNION ALL SELECT 11, 'load_dim_product', (SELECT count(*) FROM dprod),
        'dim_product: ins=' || (SELECT count(*) FROM dprod) || ', upd=0'
      UNION ALL SELECT 12, 'load_dim_retailer', (SELECT count(*) FROM dret),
        'dim_retailer: ins=' || (SELECT count(*) FROM dret) || ', upd=0'
      UNION ALL SELECT 13, 'load_dim_sales_method', (SELECT count(*) FROM dsm),
        'dim_sales_method: ins=' || (SELECT count(*) FROM dsm) || ', upd=0'
      UNION ALL SELECT 14, 'load_dim_payment_method', (SELECT count(*) FROM dpm),
        'dim_payment_method: ins=' || (SELECT count(*) FROM dpm) || ', upd=0'
      UNION ALL SELECT 15, 'load_dim_geography', (SELECT count(*) FROM dgeo),
        'dim_geography: ins=' || (SELECT count(*) FROM dgeo) || ', upd=0'
      UNION ALL SELECT 16, 'load_dim_customer', (SELECT count(*) FROM dcust),
        'dim_customer: ins=' || (SELECT count(*) FROM dcust) || ', upd=0'
      UNION ALL SELECT 17, 'load_dimensions', 0, 'all dimensions loaded'
      UNION ALL SELECT 18, 'build_calendar', n, 'ok' FROM {_N_DAYS}
      UNION ALL SELECT 19, 'refresh_fact', (SELECT count(*) FROM fact WHERE {_IN_WINDOW}),
        (SELECT CAST(CAST(w0 AS DATE) AS VARCHAR) || '..' || CAST(CAST(w1 - INTERVAL 1 DAY AS DATE) AS VARCHAR) FROM win))
"""


@query(warehouse(_LOG_LINES))
def audit_log_latest(spark, sf_dir):
    """The newest line of every step of a whole load."""
    store = warehouse_of(spark, sf_dir)
    log = AuditLog(spark, f"{store.root}/_log")
    steps = [r[0] for r in log.rows().select("procedure_name").distinct().collect()]
    both = reduce(DataFrame.unionByName, [log.latest(1, step) for step in steps])
    return both.select("log_id", "procedure_name", "rows_affected", "message")


@query(warehouse(f"SELECT * FROM ({_LOG_LINES}) ORDER BY log_id DESC LIMIT 10"))
def audit_log_newest(spark, sf_dir):
    """The ten newest lines of the log of a whole load."""
    store = warehouse_of(spark, sf_dir)
    lines = AuditLog(spark, f"{store.root}/_log").latest(10)
    return lines.select("log_id", "procedure_name", "rows_affected", "message")


@query(
    warehouse(
        """
        SELECT table_name, least(n, CASE table_name WHEN 'ce_sales' THEN 0 ELSE 1 END) AS n_rows FROM (
          SELECT 'ce_category' AS table_name, count(*) AS n FROM cat
          UNION ALL SELECT 'ce_product', count(*) FROM prod
          UNION ALL SELECT 'ce_retailer', count(*) FROM ret
          UNION ALL SELECT 'ce_sales_method', count(*) FROM sales_method
          UNION ALL SELECT 'ce_payment_method', count(*) FROM payment_method
          UNION ALL SELECT 'ce_region', count(region_id) FROM stage
          UNION ALL SELECT 'ce_state', count(state_id) FROM stage
          UNION ALL SELECT 'ce_city', count(city_id) FROM stage
          UNION ALL SELECT 'ce_customer_scd', count(*) FROM cust
          UNION ALL SELECT 'ce_sales', count(*) FROM sales)
        """
    )
)
def reset_keep_defaults(spark, sf_dir):
    """The normalised layer after a reset (never committed)."""
    txn = warehouse_of(spark, sf_dir).begin()
    txn.reset_layer("nf3")
    return verify.table_counts({t: txn.read(t) for t in schemas.NF3})


def _faulty_fact(spark, sf_dir) -> DataFrame:
    """A copy of the fact: sales of every 19th order stand twice, those of every 7th,
    11th and 13th have no product, retailer or customer key."""
    rows = warehouse_of(spark, sf_dir).read("fct_sales")
    order = F.substring_index("sale_src_id", "-", 1).cast("bigint")
    twice = rows.unionByName(rows.filter(order % 19 == 0))
    lost = {"product_key": 7, "retailer_key": 11, "customer_key": 13}
    return twice.withColumns({c: F.when(order % d != 0, F.col(c)) for c, d in lost.items()})


_FAULTY_FACT = f"""
    SELECT * REPLACE (CASE WHEN k % 7 <> 0 THEN product_key END AS product_key,
      CASE WHEN k % 11 <> 0 THEN retailer_key END AS retailer_key,
      CASE WHEN k % 13 <> 0 THEN customer_key END AS customer_key)
    FROM (SELECT *, CAST(split_part(sale_src_id, '-', 1) AS BIGINT) AS k FROM fact WHERE {_IN_WINDOW}),
      (SELECT unnest([1, 2]) AS copy)
    WHERE copy = 1 OR k % 19 = 0
"""


@query(
    warehouse(
        f"""
        SELECT source_system, source_entity, sale_src_id, invoice_ts, CAST(product_key AS DOUBLE) AS product_key,
          CAST(retailer_key AS DOUBLE) AS retailer_key, CAST(customer_key AS DOUBLE) AS customer_key, count(*) AS dup_cnt
        FROM ({_FAULTY_FACT}) GROUP BY ALL HAVING count(*) > 1
        """
    )
)
def dq_fact_duplicates(spark, sf_dir):
    """Repeated fact keys; missing keys count as a value."""
    found = duplicates(_faulty_fact(spark, sf_dir), *schemas.BUSINESS_KEY["fct_sales"], count_name="dup_cnt")
    return doubles(found, "product_key", "retailer_key", "customer_key")


@query(
    warehouse(
        f"""
        SELECT count(*) FILTER (product_key IS NULL) AS null_product_key,
          count(*) FILTER (retailer_key IS NULL) AS null_retailer_key,
          count(*) FILTER (customer_key IS NULL) AS null_customer_key
        FROM ({_FAULTY_FACT})
        """
    )
)
def dq_fact_null_keys(spark, sf_dir):
    return verify.null_keys(_faulty_fact(spark, sf_dir), "product_key", "retailer_key", "customer_key")


@query(
    """
    SELECT 'fct_sales_' || strftime(l_shipdate, '%Y%m') AS name, count(*) AS n_rows FROM lineitem
    WHERE l_shipdate < (SELECT date_trunc('month', max(l_shipdate)) - INTERVAL 2 MONTH
      FROM lineitem)
    GROUP BY ALL
    """
)
def expired_months(spark, sf_dir):
    """Month names of the sales that a refresh would drop, with their rows."""
    sales = feed.sales(spark, sf_dir, "invoice_ts")
    names = sales.groupBy(F.date_format("invoice_ts", "'fct_sales_'yyyyMM").alias("name")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    first = fact.refresh_window(sales, CTX.load_dt).first()[0]
    return fact.expired_partitions(names, first)


@query(
    f"""
    WITH {STG}
    SELECT source_id AS sale_src_id, customer_id, count(*) - 1 AS dropped_rows
    FROM stg GROUP BY ALL HAVING count(*) > 1
    """
)
def rows_merged_by_key(spark, sf_dir):
    """How many feed rows share their (sale, customer) key."""
    rows = feed.sales(spark, sf_dir, "source_id", "customer_id")
    groups = rows.groupBy(F.col("source_id").alias("sale_src_id"), "customer_id").agg(
        (F.count(F.lit(1)) - 1).alias("dropped_rows")
    )
    return groups.filter("dropped_rows > 0")
