import math
import random
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starloom import schemas
from starloom.context import materialise
from starloom.quality import checks, constraints, profile, verify


def test_mismatch_ignores_nulls_unless_asked(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "b")], "x string, y string")
    assert df.filter(checks.mismatch(F.col("x"), F.col("y"))).count() == 1
    assert df.filter(checks.mismatch(F.col("x"), F.col("y"), null_safe=True)).count() == 2


def test_orphans_include_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    assert rows(checks.orphans(child, parent, "fk", "pk")) == [(2,), (None,)]


def test_count_reconcile_of_empty_tables(spark):
    none = spark.createDataFrame([], "x int")
    assert tuple(checks.count_reconcile(none, [none, none], ("a", "b")).first()) == (0, 0)


def test_flag_consistency(spark):
    df = spark.createDataFrame(
        [(1, date(2022, 1, 1), "Y"), (2, date(2022, 1, 1), "N"), (3, date(2020, 1, 1), "Y"),
         (4, None, "Y"), (5, date(2022, 1, 1), None)],
        "id int, valid_to date, flag string",
    )
    found = checks.flag_consistency(df, "valid_to", "flag", date(2021, 1, 20))
    assert rows(found, "id") == [(2,), (3,)]


def test_recompute_tests_every_match(spark):
    df = spark.createDataFrame([("p", 2, 10)], "name string, q int, total int")
    costs = spark.createDataFrame([("p", 5), ("p", 6)], "name string, cost int")
    found = checks.recompute(df, costs, "name", "total", F.col("q") * F.col("cost"), "want")
    assert rows(found) == [("p", 2, 10, 12)]


def test_summary(spark):
    good, bad = spark.range(0), spark.range(3)
    got = rows(checks.summary({"good": good, "bad": bad}))
    assert got == [("bad", 3, False), ("good", 0, True)]


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_declared_rules_find_faults(spark, limit):
    def table(name, *data):
        return spark.createDataFrame(list(data), schemas.struct(schemas.NF3[name]))

    category = table("ce_category", (1, 5, "a", "S", "E", None, None))
    product = table(
        "ce_product",
        (1, 7, "p", 1, "S", "E", None, None),
        (2, 7, "q", 9, "S", "E", None, None),
        (3, 8, "r", None, None, "E", None, None),
        (4, 8, "s", 1, None, "E", None, None),
        (None, 9, "t", 8, "S", "E", None, None),
    )
    tables, rules = {"ce_category": category, "ce_product": product}, constraints.NF3_RULES["ce_product"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        counts = {r.rule: r.violations for r in constraints.rule_counts("ce_product", tables, rules).collect()}
        broken = rows(constraints.broken_rows("ce_product", tables, rules))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    key = "ce_product unique(source_system, source_entity, product_src_id)"
    assert counts == {
        "ce_product.product_id not null": 1,
        "ce_product.source_system not null": 2,
        "ce_product.source_entity not null": 0,
        "ce_product.product_src_id not null": 0,
        "ce_product.category_id -> ce_category": 2,
        "ce_product unique(product_id)": 0,
        key: 2,
    }
    want = [("ce_product.product_id not null", None), ("ce_product.source_system not null", "3")]
    want += [("ce_product.source_system not null", "4"), ("ce_product.category_id -> ce_category", "2")]
    want += [("ce_product.category_id -> ce_category", None), (key, "1"), (key, "2")]
    assert broken == sorted([("ce_product", *w) for w in want], key=lambda t: tuple(map(str, t)))


def test_rule_counts_of_a_long_table_shuffle_no_wide_rows(spark):
    wide = [F.lit("x" * 40).alias("source_system"), F.lit("y" * 40).alias("source_entity")]
    ids = spark.range(6000).select((F.col("id") % 5990).alias("product_id"), F.col("id").alias("product_src_id"))
    product = ids.withColumn("product_src_id", F.when(F.col("product_src_id") < 5998, F.col("product_src_id")).otherwise(7))
    product = product.select("*", (F.col("product_id") % 3).alias("category_id"), *wide)
    category = spark.range(2).withColumnRenamed("id", "category_id")
    tables, rules = {"ce_category": category, "ce_product": materialise(product)}, constraints.NF3_RULES["ce_product"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        found = constraints.rule_counts("ce_product", tables, rules)
        counts = {r.rule: r.violations for r in found.collect()}
        plan = found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert counts["ce_product unique(product_id)"] == 20
    assert counts["ce_product unique(source_system, source_entity, product_src_id)"] == 3
    assert counts["ce_product.category_id -> ce_category"] == sum(i % 5990 % 3 == 2 for i in range(6000))
    assert "LeftOuter" not in plan  # nothing is joined back to the rows


def test_orphans_read_the_parents_once(spark):
    parent = materialise(spark.range(1000).withColumnRenamed("id", "pk"))
    child = materialise(spark.range(5000).select((F.col("id") % 1200).alias("fk"), F.col("id").cast("string").alias("name")))
    found = checks.orphans(child, parent, "fk", "pk")
    assert found.columns == ["fk", "name"]
    assert found.count() == 200 * 4 and found.agg(F.min("fk")).first()[0] == 1000
    assert parent.inputFiles()[0] not in found._jdf.queryExecution().optimizedPlan().toString()
    assert checks.orphans(child.filter("fk < 1000"), parent, "fk", "pk").isEmpty()


def test_latest_month_and_counts(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-01-31 23:00:00' t union all select timestamp_ntz'2024-02-01 00:00:00' "
        "union all select timestamp_ntz'2024-02-29 10:00:00'"
    )
    assert verify.latest_month(df, "t").count() == 2
    assert rows(verify.rows_by_month(df, 1, "t")) == [("2024-02", 2)]


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(4)
    data = [
        (rng.lognormvariate(3, 2), rng.randrange(5), None if i % 7 == 0 else rng.gauss(0, 1e6))
        for i in range(30_000)
    ]
    data.append((1e12, 0, -1e15))  # far outliers
    return spark.createDataFrame(data, "a double, b int, c double").repartition(6).cache()


def test_quantiles_match_a_full_sort(numbers):
    got = {r["column_name"]: r for r in profile.quantiles(numbers).collect()}
    for c in ("a", "b", "c"):
        values = sorted(r[0] for r in numbers.select(c).collect() if r[0] is not None)
        for p in profile.PROBS:
            x = p * (len(values) - 1)
            low, high = values[math.floor(x)], values[math.ceil(x)]
            want = low + (high - low) * (x - math.floor(x))
            assert got[c][f"q{round(p * 100):02d}"] == pytest.approx(want, rel=1e-12)


def test_order_statistics_narrow_more_than_once(numbers, monkeypatch):
    monkeypatch.setattr(profile, "_SMALL", 2)
    monkeypatch.setattr(profile, "_BINS", 8)
    values = sorted(r[0] for r in numbers.select("a").collect())
    ranks = [0, 1, 777, 15_000, len(values) - 1]
    assert profile.order_statistics(numbers, {"a": ranks})["a"] == {k: values[k] for k in ranks}


def test_profile_edges(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x")], "k int, t string")
    assert tuple(profile.overview(df).first()) == (3, 2, 2, 1)
    by = {r["column_name"]: r for r in profile.columns(df).collect()}
    assert (by["t"]["n_missing"], by["t"]["n_distinct"]) == (2, 1)
    alerts = set(rows(profile.alerts(df)))
    assert ("k", "constant") in alerts and ("t", "missing") in alerts
    flat = rows(profile.histogram(df, ["k"], bins=3), "bin", "n_values")
    assert flat == [(0, 3), (1, 0), (2, 0)]


def test_estimates_are_close(numbers):
    exact = {r["column_name"]: r["n_distinct"] for r in profile.columns(numbers).collect()}
    rough = {r["column_name"]: r["n_distinct"] for r in profile.columns(numbers, exact=False).collect()}
    for c, n in exact.items():
        assert rough[c] == pytest.approx(n, rel=0.1)


def test_quantiles_end_on_infinities_and_extremes(spark):
    inf, big = float("inf"), 1.7e308
    data = [-inf, -big, -1.0, 0.0, 5e-324, 1e-323, 2.0, big, inf, inf, float("nan"), None]
    many = [(v,) for v in data] + [(v,) for v in (5e-324, 1e-323) for _ in range(12_000)]
    df = spark.createDataFrame(many, "v double")
    found = profile.order_statistics(df, {"v": [0, 1, 4, 12_003, 24_005, 24_006, 24_007, 24_009]})
    held = sorted(v for (v,) in many if v is not None and v == v)
    assert found["v"] == {k: held[k] for k in found["v"]} and len(found["v"]) == 8
