"""Queries: loads of the normalised layer."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from starloom import schemas
from starloom.catalog import sql
from starloom.catalog.registry import doubles, query
from starloom.catalog.sql import FAULTY, STG, ident
from starloom.context import CODEC, LoadContext, materialise, together
from starloom.functions.dates import date_key
from starloom.functions.measures import with_measures
from starloom.operators import keys, lookup, merge, scd2
from starloom.plans import nf3
from starloom.quality.constraints import one_active_version, overlapping_versions
from starloom.quality.verify import counts_by_source, table_counts
from starloom.sources import feed

CTX = LoadContext.on(date(2002, 1, 1))
TAGS = ("source_system", "source_entity")
SALES_COLUMNS = (
    *TAGS,
    "source_id",
    "invoice_ts",
    "retailer",
    "product",
    "product_id",
    "product_category",
    "product_category_id",
    "city_id",
    "price_per_unit",
    "units_sold",
    "total_sales",
    "operating_profit",
    "operating_margin",
    "sales_method",
    "sales_method_id",
    "payment_method",
    "payment_method_id",
    "retailer_id",
    "customer_id",
    "customer_firstname",
    "customer_lastname",
)


def empty(spark, table: str):
    """A table of the normalised layer before its first load: the unknown member only."""
    none = spark.createDataFrame([], schemas.struct(schemas.NF3[table]))
    member = schemas.DEFAULT_MEMBERS.get(table)
    if member is None:
        return none
    stamps = {"insert_dt": "2002-01-01", "update_dt": "2002-01-01"}
    return keys.ensure_default_member(none, {**member, **stamps}, schemas.SURROGATE[table])


def shown(df):
    return df.drop("insert_dt", "update_dt")


def whole(target, fresh):
    return target.unionByName(fresh)


def category_table(spark, staging):
    target = empty(spark, "ce_category")
    return whole(target, nf3.load_category(target, staging, CTX))


def product_table(spark, staging, category):
    target = empty(spark, "ce_product")
    return whole(target, nf3.load_product(target, staging, category, CTX))


def retailer_table(spark, staging):
    target = empty(spark, "ce_retailer")
    return whole(target, nf3.load_retailer(target, staging, CTX))


def method_table(spark, staging, kind):
    target = empty(spark, f"ce_{kind}")
    load = nf3.load_sales_method if kind == "sales_method" else nf3.load_payment_method
    return whole(target, load(target, staging, CTX))


_MANUAL = "'MANUAL' AS source_system, 'MANUAL' AS source_entity"


@query(
    f"""
    WITH {STG}, {sql.category()}
    SELECT * FROM cat UNION ALL BY NAME
    SELECT -1 AS category_id, {_MANUAL}, -1 AS category_src_id, 'N/A' AS category
    """
)
def category_load(spark, sf_dir):
    rows = feed.sales(spark, sf_dir, *TAGS, "product_category", "product_category_id")
    return shown(category_table(spark, rows))


@query(
    f"""
    WITH {STG}, {sql.category()}, {sql.product()}
    SELECT * FROM prod UNION ALL BY NAME
    SELECT -1 AS product_id, {_MANUAL}, -1 AS product_src_id, 'N/A' AS product_name,
      -1 AS category_id
    """
)
def product_load(spark, sf_dir):
    rows = feed.sales(
        spark, sf_dir, *TAGS, "product", "product_id", "product_category", "product_category_id"
    )
    category = materialise(category_table(spark, rows), "category")
    return shown(product_table(spark, rows, category))


@query(
    f"""
    WITH {STG}, {FAULTY}, {sql.retailer('faulty')}
    SELECT * FROM ret UNION ALL BY NAME
    SELECT -1 AS retailer_id, {_MANUAL}, 'N/A' AS retailer_src_id, 'N/A' AS retailer
    """
)
def retailer_load(spark, sf_dir):
    return shown(retailer_table(spark, feed.faulty_sales(spark, sf_dir, *TAGS, "retailer")))


@query(
    f"""
    WITH {STG}
    SELECT DISTINCT 'INSERT' AS action, retailer AS ret_src_id, source_system AS src_system
    FROM stg WHERE retailer_id % 4 <> 0
    """
)
def retailer_delta_report(spark, sf_dir):
    """Second retailer load; a quarter of the retailers is known already."""
    rows = feed.sales(spark, sf_dir, *TAGS, "retailer", "retailer_id")
    first = retailer_table(spark, rows.filter(F.col("retailer_id") % 4 == 0))
    return merge.delta_report(nf3.load_retailer(first, rows, CTX), "retailer_src_id")


def _method_sql(kind: str) -> str:
    return f"""
    WITH {STG}, {sql.method(kind)}
    SELECT * FROM {kind} UNION ALL BY NAME
    SELECT -1 AS {kind}_id, {_MANUAL}, -1 AS {kind}_src_id, 'N/A' AS {kind}
    """


@query(_method_sql("sales_method"))
def sales_method_load(spark, sf_dir):
    rows = feed.sales(spark, sf_dir, *TAGS, "sales_method", "sales_method_id")
    return shown(method_table(spark, rows, "sales_method"))


@query(_method_sql("payment_method"))
def payment_method_load(spark, sf_dir):
    rows = feed.sales(spark, sf_dir, *TAGS, "payment_method", "payment_method_id")
    return shown(method_table(spark, rows, "payment_method"))


def place_table(spark, staging, level, parent):
    target = empty(spark, f"ce_{level}")
    return whole(target, nf3.load_place(target, staging, level, parent, CTX))


def _place_sql(level: str, parent: str | None) -> str:
    up = f", min({parent}_id) AS {parent}_id" if parent else ""
    top = f", -1 AS {parent}_id" if parent else ""
    return f"""
    WITH {STG}
    SELECT {level}_id, {level}_id AS {level}_src_id, min({level}) AS {level}_name{up},
      'SA_INSTORE' AS source_system, 'SRC_INSTORE' AS source_entity
    FROM stg WHERE source_system = 'SA_INSTORE' GROUP BY {level}_id
    UNION ALL BY NAME
    SELECT -1 AS {level}_id, -1 AS {level}_src_id, 'N/A' AS {level}_name{top}, {_MANUAL}
    """


def _places(spark, sf_dir, *columns):
    rows = feed.sales(spark, sf_dir, *TAGS, *columns)
    return rows.filter(F.col("source_system") == "SA_INSTORE")


@query(_place_sql("region", None))
def region_load(spark, sf_dir):
    return shown(place_table(spark, _places(spark, sf_dir, "region", "region_id"), "region", None))


@query(_place_sql("state", "region"))
def state_load(spark, sf_dir):
    rows = _places(spark, sf_dir, "state", "state_id", "region_id")
    return shown(place_table(spark, rows, "state", "region"))


@query(_place_sql("city", "state"))
def city_load(spark, sf_dir):
    rows = _places(spark, sf_dir, "city", "city_id", "state_id")
    return shown(place_table(spark, rows, "city", "state"))


@query(
    f"""
    WITH {STG}, {sql.category()},
    first_feed AS (SELECT * FROM stg WHERE product_id % 40 <> 1),
    {sql.product('first_feed').replace('prod AS', 'prod1 AS')},
    later AS (
      SELECT source_system, source_entity, product_id AS product_src_id,
        min(product) AS product_name, any_value(product_category_id) AS cat_src
      FROM stg WHERE product_id % 40 = 1 GROUP BY ALL),
    new_rows AS (
      SELECT {ident('l.source_system, l.source_entity, l.product_src_id',
                    '(SELECT count(*) FROM prod1)')} AS product_id,
        l.source_system, l.source_entity, l.product_src_id, l.product_name, c.category_id
      FROM later l JOIN cat c ON c.source_system = l.source_system
        AND c.source_entity = l.source_entity AND c.category_src_id = l.cat_src)
    SELECT *, 1 AS load_no FROM prod1 UNION ALL BY NAME SELECT *, 2 AS load_no FROM new_rows
    """
)
def insert_missing_second_run(spark, sf_dir):
    """Two product loads; the second brings the products withheld from the first."""
    rows = feed.sales(
        spark, sf_dir, *TAGS, "product", "product_id", "product_category", "product_category_id"
    )
    category = materialise(category_table(spark, rows), "category")
    early = rows.filter(F.col("product_id") % 40 != 1)
    first = materialise(product_table(spark, early, category), "product")
    second = nf3.load_product(first, rows, category, CTX)
    loaded = first.filter("product_id <> -1").withColumn("load_no", F.lit(1))
    return shown(loaded.unionByName(second.withColumn("load_no", F.lit(2))))


@query(
    f"""
    WITH {STG}
    SELECT 'ce_category' AS table_name, count(DISTINCT (source_system, product_category_id)) + 1
      AS n_rows, 1 AS n_default FROM stg
    UNION ALL SELECT 'ce_retailer', count(DISTINCT (source_system, retailer)) + 1, 1 FROM stg
    UNION ALL SELECT 'ce_sales_method', count(DISTINCT (source_system, sales_method_id)) + 1, 1
      FROM stg
    UNION ALL SELECT 'ce_city', count(DISTINCT city_id) + 1, 1 FROM stg
    """
)
def default_members(spark, sf_dir):
    """Tables whose unknown member is asked for twice and present once."""
    rows = feed.sales(
        spark, sf_dir, *TAGS, "product_category", "product_category_id", "retailer",
        "sales_method", "sales_method_id", "city", "city_id", "state_id",
    )
    tables = {
        "ce_category": category_table(spark, rows),
        "ce_retailer": retailer_table(spark, rows),
        "ce_sales_method": method_table(spark, rows, "sales_method"),
        "ce_city": place_table(
            spark, rows.filter(F.col("source_system") == "SA_INSTORE"), "city", "state"
        ),
    }
    again = {
        name: keys.ensure_default_member(t, schemas.DEFAULT_MEMBERS[name], schemas.SURROGATE[name])
        for name, t in tables.items()
    }
    defaults = {n: t.filter(F.col(schemas.SURROGATE[n]) == -1) for n, t in again.items()}
    return table_counts(again).join(
        table_counts(defaults).withColumnRenamed("n_rows", "n_default"), "table_name"
    )


@query(
    f"""
    SELECT {ident('l_orderkey, l_linenumber')} AS line_id, l_orderkey, l_linenumber
    FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
    """
)
def surrogate_keys_large(spark, sf_dir):
    pairs = feed.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return keys.assign(pairs, ["l_orderkey", "l_linenumber"], "line_id")


@query(
    """
    SELECT count(*) AS n_rows, 1001 AS min_id, 1000 + count(*) AS max_id,
      count(*) AS n_ids
    FROM lineitem
    """
)
def surrogate_keys_written(spark, sf_dir):
    """Keys of an already written frame: dense, continuing, one per row."""
    lines = feed.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    written = materialise(keys.stamp_slots(lines.repartition(8, "l_orderkey")), "slots")
    keyed = keys.assign_stamped(written, "line_id", 1000)
    return keyed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("line_id").alias("min_id"),
        F.max("line_id").alias("max_id"),
        F.countDistinct("line_id").alias("n_ids"),
    )


# Customer snapshots: the first lacks some customers, the second renames some.
_DAY1, _DAY2 = date(1997, 1, 1), date(1999, 1, 1)


def _snapshot(spark, sf_dir, second: bool):
    key = F.col("c_custkey")
    rows = feed.table(spark, sf_dir, "customer")
    last = F.substr("c_name", F.lit(10))
    if second:
        last = F.when(key % 10 == 0, F.concat(last, F.lit("_B"))).otherwise(last)
    else:
        rows = rows.filter(key % 50 != 1)
    named = rows.select(
        key.alias("customer_src_id"),
        F.lit("Customer").alias("first_name"),
        last.alias("last_name"),
        F.lit("SA_INSTORE").alias("source_system"),
        F.lit("SRC_INSTORE").alias("source_entity"),
    )
    return named.withColumn("full_name", F.concat_ws(" ", "first_name", "last_name"))


def _context(day, first_start=None):
    return LoadContext.on(day, first_version_start=first_start)


def _versions(spark, sf_dir, first_start=None):
    """Both snapshots applied."""
    none = spark.createDataFrame([], schemas.struct(schemas.NF3["ce_customer_scd"]))
    one = scd2.apply(none, _snapshot(spark, sf_dir, False), _context(_DAY1, first_start))
    first = materialise(one.table, "versions")
    return scd2.apply(first, _snapshot(spark, sf_dir, True), _context(_DAY2, first_start))


_SNAPSHOT1 = f"""
v1 AS (
  SELECT {ident('c_custkey')} AS customer_id, c_custkey AS customer_src_id,
    'Customer' AS first_name, substr(c_name, 10) AS last_name
  FROM customer WHERE c_custkey % 50 <> 1
)"""
_VERSIONS = f"""
{_SNAPSHOT1},
opened AS (
  SELECT {ident('c_custkey', '(SELECT count(*) FROM v1)')} AS customer_id,
    c_custkey AS customer_src_id, 'Customer' AS first_name,
    substr(c_name, 10) || CASE WHEN c_custkey % 10 = 0 THEN '_B' ELSE '' END AS last_name
  FROM customer WHERE c_custkey % 50 = 1 OR c_custkey % 10 = 0
),
versions AS (
  SELECT *, '1997-01-01' AS start_dt,
    CASE WHEN customer_src_id % 10 = 0 THEN '1998-12-31' ELSE '9999-12-31' END AS end_dt,
    customer_src_id % 10 <> 0 AS is_active FROM v1
  UNION ALL SELECT *, '1999-01-01', '9999-12-31', TRUE FROM opened
)"""


@query(
    f"""
    WITH {_SNAPSHOT1}
    SELECT *, first_name || ' ' || last_name AS full_name, '1997-01-01' AS start_dt,
      '9999-12-31' AS end_dt, TRUE AS is_active FROM v1
    """
)
def scd2_initial(spark, sf_dir):
    none = spark.createDataFrame([], schemas.struct(schemas.NF3["ce_customer_scd"]))
    result = scd2.apply(none, _snapshot(spark, sf_dir, False), _context(_DAY1))
    return shown(result.table).drop(*TAGS)


@query(
    f"WITH {_VERSIONS} SELECT *, first_name || ' ' || last_name AS full_name FROM versions"
)
def scd2_second_snapshot(spark, sf_dir):
    return shown(_versions(spark, sf_dir).table).drop(*TAGS)


@query(
    f"""
    WITH {_VERSIONS}
    SELECT customer_id, customer_src_id, last_name, start_dt FROM versions WHERE is_active
    """
)
def scd2_current(spark, sf_dir):
    now = scd2.current(_versions(spark, sf_dir).table)
    return now.select("customer_id", "customer_src_id", "last_name", "start_dt")


@query(
    f"""
    WITH {_VERSIONS}
    SELECT customer_src_id, last_name, start_dt, end_dt FROM versions
    ORDER BY customer_src_id, start_dt LIMIT 20
    """
)
def scd2_history_topk(spark, sf_dir):
    listed = scd2.history(_versions(spark, sf_dir).table, "customer_src_id", "start_dt", 20)
    return listed.select("customer_src_id", "last_name", "start_dt", "end_dt")


@query(
    f"""
    WITH {_VERSIONS}
    SELECT 'closed' AS outcome, count(*) AS n_rows FROM customer
      WHERE c_custkey % 50 <> 1 AND c_custkey % 10 = 0
    UNION ALL SELECT 'opened', count(*) FROM opened
    UNION ALL SELECT 'corrected', 0
    UNION ALL SELECT 'more than one active', 0
    UNION ALL SELECT 'overlapping', 0
    """
)
def scd2_outcomes(spark, sf_dir):
    result = _versions(spark, sf_dir)
    counted = {
        "closed": result.closed,
        "opened": result.opened,
        "corrected": result.corrected,
        "more than one active": one_active_version(result.table),
        "overlapping": overlapping_versions(result.table),
    }
    return table_counts(counted).withColumnRenamed("table_name", "outcome")


@query(
    f"""
    WITH {STG}, {_VERSIONS}
    SELECT s.source_id, s.product_id, s.customer_id AS customer_src_id,
      v.customer_id AS version_id, v.last_name
    FROM stg s JOIN versions v ON v.customer_src_id = s.customer_id
      AND CAST(s.invoice_ts AS DATE) BETWEEN CAST(v.start_dt AS DATE) AND CAST(v.end_dt AS DATE)
    """
)
def scd2_asof_join(spark, sf_dir):
    """Every sale with the customer version valid on its date; versions that
    start on their load date leave earlier sales without one."""
    versions = materialise(
        _versions(spark, sf_dir).table.select(
            "customer_src_id",
            F.col("customer_id").alias("version_id"),
            "last_name",
            date_key(F.col("start_dt")).alias("start_date_key"),
            date_key(F.col("end_dt")).alias("end_date_key"),
        ),
        "versions",
    )
    sales = feed.sales(spark, sf_dir, "source_id", "product_id", "customer_id", "invoice_ts")
    dated = sales.select(
        "source_id",
        "product_id",
        F.col("customer_id").alias("customer_src_id"),
        date_key(F.col("invoice_ts")).alias("date_key"),
    )
    joined = scd2.as_of_join(dated, versions, "customer_src_id", "date_key")
    return joined.select("source_id", "product_id", "customer_src_id", "version_id", "last_name")


@query(
    f"""
    WITH {STG}, {FAULTY}, {sql.customers('faulty')}
    SELECT customer_id, customer_src_id, first_name, last_name, source_system,
      '1900-01-01' AS start_dt, '9999-12-31' AS end_dt, TRUE AS is_active
    FROM cust
    """
)
def customer_load(spark, sf_dir):
    """Customer versions from both sources, in-store before online; sales
    without a customer form business key 0."""
    rows = feed.faulty_sales(
        spark, sf_dir, *TAGS, "customer_id", "customer_firstname", "customer_lastname",
        "invoice_ts",
    )
    table = spark.createDataFrame([], schemas.struct(schemas.NF3["ce_customer_scd"]))
    for system in ("SA_INSTORE", "SA_ONLINE"):
        part = rows.filter(F.col("source_system") == system)
        table = materialise(nf3.load_customer(table, part, CTX).table, "customer")
    return table.select(
        "customer_id", "customer_src_id", "first_name", "last_name", "source_system", "start_dt",
        "end_dt", "is_active",
    )


@query(
    f"""
    WITH {STG}, {FAULTY}
    SELECT source_system, source_id, CAST(product_id AS DOUBLE) AS product_id, {sql.MEASURES}
    FROM faulty
    """
)
def sales_measures(spark, sf_dir):
    columns = (
        "source_system", "source_id", "product_id", "units_sold", "price_per_unit",
        "total_sales", "operating_profit", "operating_margin",
    )
    return doubles(with_measures(feed.faulty_sales(spark, sf_dir, *columns), CTX), "product_id")


def sales_tables(spark, staging):
    """All lookups of the sales load, each written once."""
    places = staging.filter(F.col("source_system") == "SA_INSTORE")

    def product():
        category = materialise(category_table(spark, staging), "category")
        return materialise(product_table(spark, staging, category), "product")

    def customer():
        versions = empty(spark, "ce_customer_scd")
        for system in ("SA_INSTORE", "SA_ONLINE"):
            part = staging.filter(F.col("source_system") == system)
            versions = materialise(nf3.load_customer(versions, part, CTX).table, "customer")
        return versions

    def method(kind):
        return materialise(method_table(spark, staging, kind), "method")

    plan = {
        "customer": customer,
        "product": product,
        "retailer": lambda: materialise(retailer_table(spark, staging), "retailer"),
        "city": lambda: materialise(
            places.select("city_id").filter("city_id is not null").distinct(), "city"
        ),
        "sales_method": lambda: method("sales_method"),
        "payment_method": lambda: method("payment_method"),
    }
    return dict(zip(plan, together(*plan.values()), strict=True))


def resolved_sales(spark, sf_dir, faulty: bool):
    pick = feed.faulty_sales if faulty else feed.sales
    staging = materialise(pick(spark, sf_dir, *SALES_COLUMNS), "staging", CODEC)
    return nf3.resolve_sales(staging, **sales_tables(spark, staging), ctx=CTX)


_SALES_SHOWN = [
    c
    for c in schemas.names(schemas.NF3["ce_sales"])
    if c not in ("sale_id", "insert_dt", "update_dt")
]


def _sales_sql(base: str) -> str:
    faulty = f"{FAULTY}," if base == "faulty" else ""
    return f"""
    WITH {STG}, {faulty} {sql.entities(base)}, {sql.sales(base)}
    SELECT * FROM sales
    """


@query(_sales_sql("stg"))
def sales_3nf_load(spark, sf_dir):
    fresh = nf3.load_sales(empty(spark, "ce_sales"), resolved_sales(spark, sf_dir, False), CTX)
    return fresh.select(*_SALES_SHOWN)


@query(_sales_sql("faulty"))
def sales_unknown_lookups(spark, sf_dir):
    """Sales load over the faulty feed: unknown keys are -1, measures default."""
    fresh = nf3.load_sales(empty(spark, "ce_sales"), resolved_sales(spark, sf_dir, True), CTX)
    return fresh.select(*_SALES_SHOWN)


@query(
    f"""
    WITH {STG}
    SELECT source_system, source_entity, count(*) AS n_rows FROM stg
    WHERE l_orderkey % 4 = 1 GROUP BY ALL
    """
)
def sales_reload(spark, sf_dir):
    """Sales of the second of two loads whose feeds overlap: new ones only."""
    feeds = materialise(nf3.sales_rows(resolved_sales(spark, sf_dir, False), CTX), "resolved", CODEC)
    order = F.substring_index("sale_src_id", "-", 1).cast("bigint")
    first = nf3.new_sales(empty(spark, "ce_sales"), feeds.filter(order % 4 != 1))
    known = materialise(first.withColumn("sale_id", F.lit(None).cast("bigint")), "sales", CODEC)
    return counts_by_source(nf3.new_sales(known, feeds))


@query(
    f"""
    WITH {STG}
    SELECT source_system, source_entity, count(*) AS n_rows FROM stg GROUP BY ALL
    """
)
def sales_counts_by_source(spark, sf_dir):
    return counts_by_source(feed.sales(spark, sf_dir, *TAGS))


@query(
    f"""
    WITH {STG}
    SELECT source_id, product_id, payment_method_id,
      coalesce((SELECT min(o_orderkey) FROM orders WHERE o_custkey = stg.customer_id
        AND o_orderstatus = 'F'), -1) AS first_order
    FROM stg
    """
)
def lookup_one_of_many(spark, sf_dir):
    """A lookup with several rows per key answered by its first one."""
    sales = feed.sales(
        spark, sf_dir, "source_id", "product_id", "payment_method_id", "customer_id"
    )
    orders = feed.table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    found = lookup.resolve_one(
        sales,
        orders.select("o_custkey", "o_orderkey"),
        {"customer_id": "o_custkey"},
        "o_orderkey",
        ["o_orderkey"],
        alias="first_order",
        default=-1,
    )
    return found.drop("customer_id")


@query(
    f"""
    WITH {STG}
    SELECT source_id, product_id, customer_id, c_mktsegment
    FROM stg LEFT JOIN customer ON c_custkey = customer_id AND c_custkey % 3 <> 0
    """
)
def lookup_spread_join(spark, sf_dir):
    """The shuffle form of a lookup, hot keys spread over several tasks."""
    sales = feed.sales(spark, sf_dir, "source_id", "product_id", "customer_id")
    customer = feed.table(spark, sf_dir, "customer").filter("c_custkey % 3 <> 0")
    narrow = customer.select(F.col("c_custkey").alias("customer_id"), "c_mktsegment")
    return lookup.spread_join(sales, narrow, ["customer_id"])
