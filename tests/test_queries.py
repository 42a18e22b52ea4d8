"""Registered queries against their SQL on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as entry
from starloom import catalog
from tools_check import TABLES, compare

SF = "/root/testdata/sf0.001"

CHOSEN = [
    "staging_rejects",
    "staging_dedup",
    "product_load",
    "scd2_second_snapshot",
    "scd2_asof_join",
    "sales_unknown_lookups",
    "dim_product_upsert",
    "fact_all_months",
    "fact_refresh",
    "fact_rows_by_month",
    "fact_two_versions",
    "second_run_deltas",
    "load_rejects",
    "load_outcome",
    "audit_log_newest",
    "profile_columns_approx",
    "profile_quantiles_approx",
    "audit_log_latest",
    "dq_summary",
    "profile_quantiles",
    "profile_alerts",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, SF).startswith("ok")


@pytest.mark.parametrize(
    "name", ["sales_unknown_lookups", "fact_all_months", "scd2_asof_join", "dq_summary", "dq_product_price", "lookup_one_of_many"]
)
def test_same_rows_without_any_broadcast(spark, con, name):
    """Every lookup takes the spread shuffle join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert compare(spark, con, name, SF).startswith("ok")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entry(spark):
    assert entry.entry(spark).columns == ["yyyymm", "n_rows"]
