"""Table layouts of every layer, as Spark DDL."""

from __future__ import annotations

from pyspark.sql import types as T

_LINEAGE = "source_system string, source_entity string"
_STAMPS = "insert_dt timestamp_ntz, update_dt timestamp_ntz"
_MEASURES = (
    "units_sold int, price_per_unit decimal(12,2), total_sales decimal(14,2), "
    "operating_profit decimal(14,2), operating_margin decimal(7,4), "
    "avg_unit_price decimal(12,4), profit_per_unit decimal(12,4), is_high_margin boolean"
)

GEO_COLUMNS = ["region", "region_id", "state", "state_id", "city", "city_id"]

RAW_ONLINE = [
    "index",
    "retailer",
    "retailer_id",
    "product",
    "product_id",
    "product_category",
    "product_category_id",
    "price_per_unit",
    "units_sold",
    "total_sales",
    "operating_profit",
    "operating_margin",
    "sales_method",
    "sales_method_id",
    "payment_method",
    "payment_method_id",
    "invoice_date",
    "customer_id",
    "customer_firstname",
    "customer_lastname",
]
RAW_INSTORE = RAW_ONLINE[:3] + GEO_COLUMNS + RAW_ONLINE[3:]

# Maximum text lengths of the staging tables (a data-quality rule in Spark).
TEXT_LIMITS = {
    "source_system": 50,
    "source_entity": 50,
    "source_id": 100,
    "retailer": 255,
    "region": 100,
    "state": 100,
    "city": 150,
    "product": 255,
    "product_category": 150,
    "sales_method": 100,
    "payment_method": 100,
    "customer_firstname": 100,
    "customer_lastname": 100,
}


def struct(ddl: str) -> T.StructType:
    """Layout as a StructType (needs a running session)."""
    return T.StructType.fromDDL(ddl)


def names(ddl: str) -> list[str]:
    """Column names of a layout."""
    return [column.split()[0] for column in ddl.split(", ")]


def _staging(geo: bool) -> str:
    places = (
        "region string, region_id bigint, state string, state_id bigint, "
        "city string, city_id bigint, "
    )
    return (
        f"{_LINEAGE}, source_id string, retailer string, retailer_id bigint, "
        f"{places if geo else ''}"
        "product string, product_id bigint, product_category string, product_category_id bigint, "
        "price_per_unit decimal(12,2), units_sold int, total_sales decimal(14,2), "
        "operating_profit decimal(14,2), operating_margin decimal(7,4), "
        "sales_method string, sales_method_id int, payment_method string, payment_method_id int, "
        "invoice_ts timestamp_ntz, customer_id bigint, customer_firstname string, "
        f"customer_lastname string, {_STAMPS}"
    )


STAGING = {
    "src_instore_sales": _staging(True),
    "src_online_sales": _staging(False),
}

# Rows that a staging load could not read, with the columns at fault.
LOAD_REJECTS = (
    "source_system string, source_entity string, source_id string, bad_columns string, load_ts timestamp_ntz"
)

# Rows that broke a declared rule and kept a run from being published.
CONSTRAINT_VIOLATIONS = "table_name string, rule string, row_key string, load_ts timestamp_ntz"

NF3 = {
    "ce_category": f"category_id bigint, category_src_id bigint, category string, {_LINEAGE}, {_STAMPS}",
    "ce_product": "product_id bigint, product_src_id bigint, product_name string, category_id bigint, "
    f"{_LINEAGE}, {_STAMPS}",
    "ce_retailer": f"retailer_id bigint, retailer_src_id string, retailer string, {_LINEAGE}, {_STAMPS}",
    "ce_sales_method": "sales_method_id bigint, sales_method_src_id int, sales_method string, "
    f"{_LINEAGE}, {_STAMPS}",
    "ce_payment_method": "payment_method_id bigint, payment_method_src_id int, payment_method string, "
    f"{_LINEAGE}, {_STAMPS}",
    "ce_region": f"region_id bigint, region_src_id bigint, region_name string, {_LINEAGE}, {_STAMPS}",
    "ce_state": "state_id bigint, state_src_id bigint, state_name string, region_id bigint, "
    f"{_LINEAGE}, {_STAMPS}",
    "ce_city": "city_id bigint, city_src_id bigint, city_name string, state_id bigint, "
    f"{_LINEAGE}, {_STAMPS}",
    "ce_customer_scd": "customer_id bigint, customer_src_id bigint, first_name string, "
    "last_name string, full_name string, start_dt date, end_dt date, is_active boolean, "
    f"{_LINEAGE}, {_STAMPS}",
    # customer_src_id is kept beside the version key: the natural key and the
    # point-in-time join use the business key.
    "ce_sales": "sale_id bigint, sale_src_id string, invoice_ts timestamp_ntz, customer_id bigint, "
    "customer_src_id bigint, product_id bigint, retailer_id bigint, city_id bigint, "
    f"sales_method_id bigint, payment_method_id bigint, {_MEASURES}, {_LINEAGE}, {_STAMPS}",
}

STAR = {
    "dim_date": "date_key int, full_date date, year_num int, quarter_num int, month_num int, "
    "month_name string, day_of_month int, day_of_week int, day_name string, is_weekend boolean",
    "dim_customer": "customer_key bigint, customer_src_id bigint, first_name string, "
    "last_name string, full_name string, start_date_key int, end_date_key int, is_current boolean",
    "dim_product": "product_key bigint, product_src_id bigint, product_name string, "
    f"category_src_id bigint, category_name string, {_LINEAGE}",
    "dim_retailer": f"retailer_key bigint, retailer_src_id string, retailer_name string, {_LINEAGE}",
    "dim_geography": "geo_key bigint, city_id bigint, city_name string, state_id bigint, "
    "state_name string, region_id bigint, region_name string",
    "dim_sales_method": "sales_method_key bigint, sales_method_src_id int, "
    f"sales_method_name string, {_LINEAGE}",
    "dim_payment_method": "payment_method_key bigint, payment_method_src_id int, "
    f"payment_method_name string, {_LINEAGE}",
    "fct_sales": "date_key int, product_key bigint, retailer_key bigint, geo_key bigint, "
    "sales_method_key bigint, payment_method_key bigint, customer_key bigint, "
    f"sale_src_id string, {_LINEAGE}, invoice_ts timestamp_ntz, {_MEASURES}",
}

# First version of the star: geography is keyed ``geography_key``, its fact has a
# surrogate key and a natural key over all dimensions and base measures.
EARLIER_STAR = {
    **{t: ddl for t, ddl in STAR.items() if t != "fct_sales"},
    "dim_geography": STAR["dim_geography"].replace("geo_key", "geography_key"),
    "fact_sales": "sales_key bigint, date_key int, customer_key bigint, product_key bigint, "
    "retailer_key bigint, geography_key bigint, sales_method_key bigint, "
    f"payment_method_key bigint, {_MEASURES}, sale_src_id string, {_LINEAGE}",
}
EARLIER_FACT_KEY = [
    "date_key",
    "customer_key",
    "product_key",
    "retailer_key",
    "geography_key",
    "sales_method_key",
    "payment_method_key",
    "units_sold",
    "price_per_unit",
    "total_sales",
    "sale_src_id",
    "source_system",
    "source_entity",
]

ETL_LOG = (
    "log_id bigint, log_ts timestamp_ntz, procedure_name string, rows_affected bigint, message string"
)

SURROGATE = {
    "ce_category": "category_id",
    "ce_product": "product_id",
    "ce_retailer": "retailer_id",
    "ce_sales_method": "sales_method_id",
    "ce_payment_method": "payment_method_id",
    "ce_region": "region_id",
    "ce_state": "state_id",
    "ce_city": "city_id",
    "ce_customer_scd": "customer_id",
    "ce_sales": "sale_id",
    "dim_date": "date_key",
    "dim_customer": "customer_key",
    "dim_product": "product_key",
    "dim_retailer": "retailer_key",
    "dim_geography": "geo_key",
    "dim_sales_method": "sales_method_key",
    "dim_payment_method": "payment_method_key",
}

_SRC = ["source_system", "source_entity"]

BUSINESS_KEY = {
    "ce_category": [*_SRC, "category_src_id"],
    "ce_product": [*_SRC, "product_src_id"],
    "ce_retailer": [*_SRC, "retailer_src_id"],
    "ce_sales_method": [*_SRC, "sales_method_src_id"],
    "ce_payment_method": [*_SRC, "payment_method_src_id"],
    "ce_region": ["region_id"],
    "ce_state": ["state_id"],
    "ce_city": ["city_id"],
    "ce_sales": [
        *_SRC,
        "sale_src_id",
        "invoice_ts",
        "customer_src_id",
        "product_id",
        "retailer_id",
        "city_id",
        "sales_method_id",
        "payment_method_id",
        "units_sold",
        "price_per_unit",
        "total_sales",
    ],
    "dim_date": ["date_key"],
    "dim_customer": ["customer_src_id", "start_date_key"],
    "dim_product": [*_SRC, "product_src_id"],
    "dim_retailer": [*_SRC, "retailer_src_id"],
    "dim_geography": ["city_id"],
    "dim_sales_method": [*_SRC, "sales_method_src_id"],
    "dim_payment_method": [*_SRC, "payment_method_src_id"],
    "fct_sales": [
        *_SRC,
        "sale_src_id",
        "invoice_ts",
        "product_key",
        "retailer_key",
        "customer_key",
    ],
}

_MANUAL = {"source_system": "MANUAL", "source_entity": "MANUAL"}

# The unknown member of every lookup and dimension.
DEFAULT_MEMBERS = {
    "ce_category": {"category_id": -1, "category_src_id": -1, "category": "N/A", **_MANUAL},
    "ce_product": {
        "product_id": -1,
        "product_src_id": -1,
        "product_name": "N/A",
        "category_id": -1,
        **_MANUAL,
    },
    "ce_retailer": {"retailer_id": -1, "retailer_src_id": "N/A", "retailer": "N/A", **_MANUAL},
    "ce_sales_method": {
        "sales_method_id": -1,
        "sales_method_src_id": -1,
        "sales_method": "N/A",
        **_MANUAL,
    },
    "ce_payment_method": {
        "payment_method_id": -1,
        "payment_method_src_id": -1,
        "payment_method": "N/A",
        **_MANUAL,
    },
    "ce_region": {"region_id": -1, "region_src_id": -1, "region_name": "N/A", **_MANUAL},
    "ce_state": {
        "state_id": -1,
        "state_src_id": -1,
        "state_name": "N/A",
        "region_id": -1,
        **_MANUAL,
    },
    "ce_city": {"city_id": -1, "city_src_id": -1, "city_name": "N/A", "state_id": -1, **_MANUAL},
    "ce_customer_scd": {
        "customer_id": -1,
        "customer_src_id": -1,
        "first_name": "N/A",
        "last_name": "N/A",
        "full_name": "N/A",
        "start_dt": "1900-01-01",
        "end_dt": "9999-12-31",
        "is_active": False,
        **_MANUAL,
    },
    "dim_date": {
        "date_key": -1,
        "full_date": "1900-01-01",
        "year_num": 1900,
        "quarter_num": 1,
        "month_num": 1,
        "month_name": "Jan",
        "day_of_month": 1,
        "day_of_week": 1,
        "day_name": "Mon",
        "is_weekend": False,
    },
    # Spans all dates, so sales of unknown customers keep a valid version.
    "dim_customer": {
        "customer_key": -1,
        "customer_src_id": -1,
        "first_name": "Unknown",
        "last_name": "Unknown",
        "full_name": "Unknown",
        "start_date_key": 19000101,
        "end_date_key": 99991231,
        "is_current": False,
    },
    "dim_product": {
        "product_key": -1,
        "product_src_id": -1,
        "product_name": "N/A",
        "category_src_id": -1,
        "category_name": "N/A",
        **_MANUAL,
    },
    "dim_retailer": {
        "retailer_key": -1,
        "retailer_src_id": "N/A",
        "retailer_name": "N/A",
        **_MANUAL,
    },
    "dim_geography": {
        "geo_key": -1,
        "city_id": -1,
        "city_name": "Unknown",
        "state_id": -1,
        "state_name": "Unknown",
        "region_id": -1,
        "region_name": "Unknown",
    },
    "dim_sales_method": {
        "sales_method_key": -1,
        "sales_method_src_id": -1,
        "sales_method_name": "Unknown",
        **_MANUAL,
    },
    "dim_payment_method": {
        "payment_method_key": -1,
        "payment_method_src_id": -1,
        "payment_method_name": "Unknown",
        **_MANUAL,
    },
}

# The unknown members of the first star. All names are N/A, the date has
# no other attributes, and the customer's validity refers to that date.
_NAMELESS = {"first_name": "N/A", "last_name": "N/A", "full_name": "N/A"}
EARLIER_MEMBERS = {
    "dim_date": {"date_key": -1, "month_name": "N/A", "day_name": "N/A"},
    "dim_customer": {
        "customer_key": -1,
        "customer_src_id": -1,
        **_NAMELESS,
        "start_date_key": -1,
        "end_date_key": -1,
        "is_current": False,
    },
    "dim_product": DEFAULT_MEMBERS["dim_product"],
    "dim_retailer": DEFAULT_MEMBERS["dim_retailer"],
    "dim_geography": {
        "geography_key": -1,
        "city_id": -1,
        "city_name": "N/A",
        "state_id": -1,
        "state_name": "N/A",
        "region_id": -1,
        "region_name": "N/A",
    },
    "dim_sales_method": {**DEFAULT_MEMBERS["dim_sales_method"], "sales_method_name": "N/A"},
    "dim_payment_method": {**DEFAULT_MEMBERS["dim_payment_method"], "payment_method_name": "N/A"},
}

LAYERS = {
    "staging": list(STAGING),
    "nf3": list(NF3),
    "star": list(STAR),
}

TABLES = {
    **STAGING,
    "load_rejects": LOAD_REJECTS,
    "constraint_violations": CONSTRAINT_VIOLATIONS,
    **NF3,
    **STAR,
}
