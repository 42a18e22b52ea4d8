import io
import re
import time
from contextlib import redirect_stdout
from datetime import date, datetime
from decimal import Decimal as D
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starloom import LoadContext, schemas
from starloom.context import materialise
from starloom.plans import fact, nf3, runs
from starloom.plans.audit import AuditLog
from starloom.quality import constraints
from starloom.sources import extracts, feed
from starloom.sources.extracts import INSTORE, ONLINE
from starloom.sources.store import Store, Txn

DAY1, DAY2 = date(2024, 3, 10), date(2024, 4, 10)

HEAD_IN = ",".join(INSTORE.raw_columns)
IN_LINES = [
    "1,Shop A,11,West,1,Texas,10,Austin,100,Boot,500,Shoes,5,$50.00,2,$100.00,$20.00,35%,In-store,1,Cash,1,1/15/2024 9:05,900,Ann,Lee",
    "2,Shop A,11,West,1,Texas,10,Dallas,101,Boot,500,Shoes,5,$50.00,3,\"$1,150.00\",$30.00,25%,In-store,1,Card,2,2/20/2024 10:00,901,Bob,Ray",
    "3, ,11,,,,,,,Hat,501,Hats,6,$10.00,0,$0.00,,30%,In-store,1,Card,2,3/1/2024 11:00,,,",
    # later copy of sale 1
    "9,Shop A,11,West,1,Texas,10,Austin,100,Boot,500,Shoes,5,$50.00,2,$100.00,$20.00,35%,In-store,1,Cash,1,1/15/2024 9:05,900,Ann,Lee",
    # unreadable units
    "5,Shop A,11,West,1,Texas,10,Austin,100,Boot,500,Shoes,5,$50.00,1-2,$100.00,$20.00,35%,In-store,1,Cash,1,1/16/2024 9:05,900,Ann,Lee",
    # no product id, no category
    "6,Shop B,12,West,1,Texas,10,Austin,100,,,,,$50.00,1,$50.00,$20.00,35%,In-store,1,Cash,1,11/5/2023 9:05,900,Ann,Lee",
]
HEAD_ON = ",".join(ONLINE.raw_columns)
ON_LINES = [
    "1,Web,70,Boot,500,Shoes,5,$40.00,1,$40.00,$8.00,20%,Online,2,Card,2,2/21/2024 10:00,901,Bob,Ray",
    "2,Web,70,Boot,500,Shoes,5,$40.00,1,$40.00,$8.00,20%,Online,2,Card,2,3/21/2024 10:00,902,Cid,Fox",
]


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    """Both extracts, loaded twice; between the loads a customer changes name."""
    base = tmp_path_factory.mktemp("shop")
    store = Store(spark, str(base / "dwh"))
    log = AuditLog(spark, str(base / "log"))

    def cleaned(tag, ctx, extra_online=()):
        out, bad = {}, {}
        for spec, head, lines in (
            (INSTORE, HEAD_IN, IN_LINES),
            (ONLINE, HEAD_ON, [*ON_LINES, *extra_online]),
        ):
            path = base / f"{tag}-{spec.table}.csv"
            path.write_text("\n".join([head, *lines]) + "\n")
            raw = extracts.read_raw(spark, str(path), spec)
            out[spec.table] = extracts.clean_rows(raw, spec, ctx)
            bad[spec.table] = extracts.rejects(raw, spec)
        return out, bad

    def load(tag, ctx, extra=()):
        frames, bad = cleaned(tag, ctx, extra)
        runs.stage(store, log, ctx, frames)
        runs.run_nf3(store, log, ctx)
        dims = runs.run_dims(store, log, ctx)
        runs.extend_calendar(store, log, ctx)
        runs.refresh_fact(store, log, ctx)
        return bad, dims

    one = LoadContext.on(DAY1)
    bad, first_dims = load("one", one)
    state = {"store": store, "log": log, "bad": bad, "first_dims": first_dims}
    state["first"] = {t: rows(store.read(t)) for t in schemas.TABLES}
    _, state["again_dims"] = load("again", LoadContext.on(DAY1))
    state["again"] = {t: rows(store.read(t)) for t in schemas.TABLES}
    late = "3,Web,70,Boot,500,Shoes,5,$40.00,1,$40.00,$8.00,20%,Online,2,Card,2,4/2/2024 10:00,902,Cid,Foxx"
    _, state["second_dims"] = load("two", LoadContext.on(DAY2), [late])
    return state


def test_staging_counts_add_up(shop):
    assert rows(shop["bad"]["src_instore_sales"], "source_id", "bad_columns") == [("5", "units_sold")]
    staged = shop["first"]["src_instore_sales"]
    assert len(IN_LINES) == len(staged) + 1 + 1  # kept + rejected + later copy
    assert {r[2] for r in staged} == {"1", "2", "3", "6"}


def test_cleaned_values(shop):
    names = schemas.names(schemas.STAGING["src_instore_sales"])
    row = dict(zip(names, next(r for r in shop["first"]["src_instore_sales"] if r[2] == "2")))
    assert row["total_sales"] == D("1150.00") and row["operating_margin"] == D("0.2500")
    assert row["invoice_ts"] == datetime(2024, 2, 20, 10, 0)
    assert row["source_entity"] == "SRC_INSTORE" and row["insert_dt"] == datetime(2024, 3, 10)


def test_second_run_changes_nothing(shop):
    for table in schemas.NF3:
        assert shop["again"][table] == shop["first"][table], table
    for table in schemas.STAR:
        assert shop["again"][table] == shop["first"][table], table
    assert set(shop["again_dims"].values()) == {(0, 0)}


def test_unknown_members_and_lookups(shop):
    sales = [
        dict(zip(schemas.names(schemas.NF3["ce_sales"]), r)) for r in shop["first"]["ce_sales"]
    ]
    by = {(s["source_system"], s["sale_src_id"]): s for s in sales}
    blank = by["SA_INSTORE", "3"]
    assert (blank["retailer_id"], blank["city_id"]) == (-1, -1)
    assert blank["customer_src_id"] == 0 and blank["customer_id"] != -1  # NULL id is customer 0
    assert blank["avg_unit_price"] is None and blank["is_high_margin"] is True
    assert by["SA_INSTORE", "6"]["product_id"] == -1
    assert by["SA_ONLINE", "1"]["city_id"] == -1
    assert sorted(s["sale_id"] for s in sales) == list(range(1, len(sales) + 1))


def test_fact_window_and_retention(shop):
    store = shop["store"]
    fact_rows = store.read("fct_sales")
    # newest sale is April: window February..April; January left the fact
    assert rows(fact_rows.select("yyyymm").distinct()) == [(202402,), (202403,), (202404,)]
    first = {r[-1] for r in shop["first"]["fct_sales"]}
    assert first == {202401, 202402, 202403}
    unknown = fact_rows.filter("sale_src_id = '3' and source_system = 'SA_INSTORE'").first()
    assert unknown["retailer_key"] == -1 and unknown["geo_key"] == -1


def test_customer_change_closes_and_fact_follows_the_date(shop):
    store = shop["store"]
    found = rows(
        store.read("dim_customer").filter("customer_src_id = 902"),
        "last_name", "start_date_key", "end_date_key", "is_current",
    )
    assert found == [
        ("Fox", 19000101, 20240409, False),
        ("Foxx", 20240410, 99991231, True),
    ]
    assert shop["second_dims"]["dim_customer"] == (1, 1)
    key = store.read("dim_customer").filter("last_name = 'Fox'").first()["customer_key"]
    sold = store.read("fct_sales").filter("sale_src_id in ('2', '3') and source_system = 'SA_ONLINE'")
    assert {r["customer_key"] for r in sold.collect()} == {key}  # both sold before the change


def test_old_sales_are_not_inserted_again_after_a_change(shop):
    sales = shop["store"].read("ce_sales")
    assert sales.count() == len(shop["first"]["ce_sales"]) + 1


def test_log_lines(shop):
    log = shop["log"]
    newest = log.latest(1).first()
    assert newest["procedure_name"] == "refresh_fact"
    assert newest["message"] == "2024-02-01..2024-04-30"
    lines = [r["message"] for r in log.latest(3, "load_dim_customer").collect()]
    assert lines[0] == "dim_customer: ins=1, upd=1" and lines[1].endswith("ins=0, upd=0")
    ids = [r["log_id"] for r in log.rows().collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_constraints_hold(shop):
    tables = {t: shop["store"].read(t) for t in schemas.NF3}
    for table, rules in constraints.NF3_RULES.items():
        assert constraints.rule_counts(table, tables, rules).filter("violations > 0").isEmpty()
        assert constraints.broken_rows(table, tables, rules).isEmpty()


def test_failed_run_publishes_nothing_but_its_log_line(spark, tmp_path):
    store = Store(spark, str(tmp_path / "dwh"))
    log = AuditLog(spark, str(tmp_path / "log"))
    ctx = LoadContext.on(DAY1)
    txn = store.begin()
    txn.append(INSTORE.table, store.read(INSTORE.table))
    broken = spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in store.read(ONLINE.table).schema]
    ).withColumns({"source_system": F.lit("SA_ONLINE"), "source_entity": F.lit("X"),
                   "product_category_id": F.lit(1).cast("long")})
    txn.append(ONLINE.table, broken)
    txn.commit()
    with pytest.raises(RuntimeError):
        with log.step(ctx, "doomed"):
            raise RuntimeError("no luck\nmore")
    assert rows(log.rows(), "procedure_name", "rows_affected", "message") == [
        ("doomed", 0, "ERROR: no luck\nmore")
    ]
    with pytest.raises(ValueError, match="bad step"):
        log.steps(ctx, {"fine": lambda s: None, "bad": lambda s: (_ for _ in ()).throw(ValueError("bad step"))})
    assert [r["procedure_name"] for r in log.latest(2).collect()] == ["bad", "fine"]
    assert store.snapshot()[0] == 1
    log.clear()
    assert log.rows().count() == 0


def test_snapshots_are_isolated(spark, tmp_path):
    store = Store(spark, str(tmp_path), {"t": "id long"})
    assert store.read("t").count() == 0
    txn = store.begin()
    txn.append("t", spark.range(3))
    assert txn.read("t").count() == 3 and store.read("t").count() == 0
    txn.commit()
    old = store.read("t")
    txn = store.begin()
    txn.replace("t", txn.read("t").filter("id > 0"))
    txn.append("t", spark.range(10, 12))
    txn.commit()
    assert old.count() == 3 and store.read("t").count() == 4
    rival, late = store.begin(), store.begin()
    rival.drop("t")
    rival.commit()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        late.commit()
    assert store.read("t").count() == 0


def test_reset_and_drop_layer(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    txn = store.begin()
    txn.seed_defaults("nf3")
    more = txn.read("ce_region").withColumn("region_id", F.lit(5).cast("long"))
    txn.append("ce_region", more)
    txn.seed_defaults("nf3")
    assert txn.read("ce_region").count() == 2
    txn.reset_layer("nf3")
    assert rows(txn.read("ce_region"), "region_id") == [(-1,)]
    txn.drop_layer("nf3")
    assert txn.read("ce_region").count() == 0


def _sales_on(spark, *days):
    return spark.createDataFrame(
        [(i, datetime(*d)) for i, d in enumerate(days)], "id long, invoice_ts timestamp_ntz"
    )


def test_emptied_month_is_cleared_and_others_stay(spark, tmp_path):
    store = Store(spark, str(tmp_path), {"f": "id long, invoice_ts timestamp_ntz"})
    txn = store.begin()
    txn.replace_months(
        "f", _sales_on(spark, (2024, 1, 5), (2024, 2, 5), (2024, 3, 5), (2024, 4, 5)), 202401, 202404
    )
    txn.commit()
    txn = store.begin()
    txn.replace_months("f", _sales_on(spark, (2024, 3, 9)), 202402, 202403)
    assert txn.months("f") == [202401, 202403, 202404]
    assert txn.drop_months_before("f", 202402) == [202401]
    txn.replace_months("f", _sales_on(spark), 202404, 202404)
    txn.commit()
    assert rows(store.read("f"), "id", "yyyymm") == [(0, 202403)]


def test_month_filter_prunes_folders(spark, tmp_path):
    store = Store(spark, str(tmp_path), {"f": "id long, invoice_ts timestamp_ntz"})
    txn = store.begin()
    txn.replace_months("f", _sales_on(spark, (2024, 1, 5), (2024, 2, 5)), 202401, 202402)
    txn.commit()
    recent = store.read("f").filter(fact.in_months(date(2024, 2, 1), date(2024, 2, 29)))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyymm" in plan
    assert rows(recent, "id") == [(1,)]


def test_window_rules(spark):
    with pytest.raises(ValueError, match="Invalid window"):
        fact.check_window(date(2024, 2, 1), date(2024, 1, 1))
    with pytest.raises(ValueError):
        fact.check_window(None, date(2024, 1, 1))
    assert fact.window_bounds(date(2023, 11, 5), date(2023, 12, 5)) == (
        datetime(2023, 11, 1),
        datetime(2024, 1, 1),
    )
    none = spark.createDataFrame([], "invoice_ts timestamp_ntz")
    assert tuple(fact.refresh_window(none, date(2024, 1, 15)).first()) == (
        date(2023, 11, 1),
        date(2024, 1, 31),
    )
    names = spark.createDataFrame(
        [("fct_sales_202312",), ("fct_sales_202401",), ("fct_sales_old",), ("other_202001",)],
        "name string",
    )
    assert rows(fact.expired_partitions(names, date(2024, 1, 1))) == [("fct_sales_202312",)]


def test_place_load_is_insert_only(spark, ctx):
    known = spark.createDataFrame(
        [(1, 1, "West", "S", "E", None, None)], schemas.struct(schemas.NF3["ce_region"])
    )
    feed = spark.createDataFrame(
        [("S", "E", 1, "Renamed"), ("S", "E", 2, "East"), ("S", "E", None, None)],
        "source_system string, source_entity string, region_id long, region string",
    )
    fresh = nf3.load_place(known, feed, "region", None, ctx)
    assert rows(fresh, "region_id", "region_name") == [(-1, "N/A"), (2, "East")]


def test_fact_key_keeps_one_of_rows_that_differ_elsewhere(spark):
    names = schemas.names(schemas.STAR["fct_sales"])
    base = dict.fromkeys(names)
    base.update(date_key=20240101, product_key=1, retailer_key=1, customer_key=1, sale_src_id="1",
                source_system="S", source_entity="E", invoice_ts=datetime(2024, 1, 1))
    data = [tuple({**base, "geo_key": g}[n] for n in names) for g in (3, 2, 9)]
    df = spark.createDataFrame(data, schemas.struct(schemas.STAR["fct_sales"]))
    assert rows(fact.one_per_key(df), "geo_key") == [(2,)]
    assert rows(fact.dropped_by_key(df), "dropped_rows") == [(2,)]


def test_lost_points_are_reported(spark, tmp_path):
    line = IN_LINES[0].replace(",11,", ",11.0,")
    (tmp_path / "x.csv").write_text(f"{HEAD_IN}\n{line}\n")
    raw = extracts.read_raw(spark, str(tmp_path / "x.csv"), INSTORE)
    assert rows(extracts.lost_points(raw, INSTORE)) == [("1", "retailer_id")]


def test_versions_outside_the_window_are_left_out(spark):
    spans = [(1, 19000101, 20231231), (2, 20240101, 20240131), (3, 20240201, 99991231)]
    df = spark.createDataFrame(spans, "customer_key long, start_date_key int, end_date_key int")
    kept = fact.versions_in_window(df, date(2024, 1, 15), date(2024, 1, 20))
    assert rows(kept, "customer_key") == [(2,)]
    both = fact.versions_in_window(df, date(2024, 1, 1), date(2024, 2, 1))
    assert rows(both, "customer_key") == [(2,), (3,)]


def test_time_windows_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "sales")
    _sales_on(spark, (2024, 1, 5), (2024, 2, 5)).write.parquet(path)
    picked = spark.read.parquet(path).filter(
        fact.in_window(F.col("invoice_ts"), date(2024, 2, 1), date(2024, 2, 2))
    )
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(invoice_ts,2024-02-01" in plan
    assert rows(picked, "id") == [(1,)]


def test_no_folder_is_lost_under_threads(spark, tmp_path):
    """Steps that stage their tables at once, over a long and slow list."""
    from concurrent.futures import ThreadPoolExecutor

    from starloom.sources.store import Folder, Store, Txn

    class Slow(list):
        def __iter__(self):
            for f in super().__iter__():
                if f.path == "old500":
                    time.sleep(0.01)
                yield f

    txn = Txn(Store(spark, str(tmp_path)), 0, [])
    txn.folders = Slow(Folder("x", f"old{i}") for i in range(1000))
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: txn._stage(lambda f: f.table == f"t{i}", [Folder(f"t{i}", f"p{i}")]), range(40)))
    assert {f.table for f in txn.folders} == {"x", *(f"t{i}" for i in range(40))}


def test_fact_rows_stay_where_their_joins_left_them(spark):
    """Rows that a join has shuffled are not shuffled once more to find repeated keys."""
    n = F.col("id")
    here = {
        "sale_src_id": (n % 50).cast("string"),
        "invoice_ts": F.expr("timestamp_ntz'2024-01-05'"),
        "customer_src_id": n % 5,
        **{f"{c}_id": n % m for c, m in (("product", 10), ("retailer", 5), ("city", 3), ("sales_method", 2), ("payment_method", 2))},
        "source_system": F.lit("A"),
        "source_entity": F.lit("B"),
    }
    layout = schemas.struct(schemas.NF3["ce_sales"])
    sales = spark.range(100).select(*[here.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in layout])
    ids = {"product": 10, "retailer": 5, "sales_method": 2, "payment_method": 2}
    maps = {c: spark.range(m).select(n.alias(f"{c}_id"), (n + 100).alias(f"{c}_key")) for c, m in ids.items()}
    places = spark.range(3).select(n.alias("city_id"), n.alias("geo_key"))
    people = spark.range(5).selectExpr("id AS customer_key", "id AS customer_src_id", "19000101 AS start_date_key", "99991231 AS end_date_key")
    ends = date(2024, 1, 1), date(2024, 1, 31)
    want = rows(fact.refresh(materialise(sales), maps, places, people, *ends))
    assert len(want) == 50
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = fact.refresh(materialise(sales), maps, places, people, *ends)
        moved = [e for e in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in e]
        assert moved and not any("sale_src_id" in e for e in moved)
        assert rows(got) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sales_outside_the_window_are_not_read(spark, tmp_path):
    from starloom.sources.store import Store

    store = Store(spark, str(tmp_path), {"f": "id bigint, invoice_ts timestamp_ntz"})
    txn = store.begin()
    rows = spark.range(60).selectExpr("id", "timestamp_ntz'2024-01-05' + make_interval(0, cast(id % 6 AS int)) AS invoice_ts")
    assert txn.append_months("f", rows) == 60
    assert txn.append_rows("f", rows.limit(0)) == 0
    txn.commit()
    assert store.begin().months("f") == [202401, 202402, 202403, 202404, 202405, 202406]
    recent = store.read("f").filter("yyyymm BETWEEN 202405 AND 202406")
    assert recent.count() == 20
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyymm" in plan
    assert fact.window_of(202401, date(2030, 1, 1)) == (date(2023, 11, 1), date(2024, 1, 31))
    assert fact.window_of(None, date(2024, 12, 9)) == (date(2024, 10, 1), date(2024, 12, 31))


def test_closed_versions_keep_their_folders(shop, spark, tmp_path):
    """A later load replaces open versions only; what it closes goes to a folder more."""
    store = shop["store"].branch(str(tmp_path / "later"))
    log = AuditLog(spark, str(tmp_path / "log"))
    tables = ("ce_customer_scd", "dim_customer")

    def folders(kind):
        return {f for f in store.snapshot()[1] if f.table in tables and f.open == kind}

    def renamed(day, customer, name):
        txn = store.begin()
        last = F.when(F.col("customer_id") == customer, name).otherwise(F.col("customer_lastname"))
        txn.replace(ONLINE.table, txn.read(ONLINE.table).withColumn("customer_lastname", last))
        txn.commit()
        runs.run_nf3(store, log, LoadContext.on(day))
        return runs.run_dims(store, log, LoadContext.on(day))["dim_customer"]

    closed, still = folders(False), folders(True)
    before = {t: store.read(t).count() for t in tables}
    assert closed and {f.table for f in still} == set(tables)
    assert renamed(date(2024, 5, 10), 902, "Foxy") == (1, 1)
    assert closed < folders(False) and not still & folders(True)
    closed, still = folders(False), folders(True)
    assert renamed(date(2024, 6, 10), 902, "Foxy") == (0, 0)
    assert (closed, still) == (folders(False), folders(True))
    assert renamed(date(2024, 7, 10), 902, "Foxier") == (1, 1)
    assert closed < folders(False)
    for t in tables:
        assert store.read(t).count() == before[t] + 2
    ends = rows(store.read("dim_customer").filter("customer_src_id = 902"), "start_date_key", "end_date_key", "last_name", "is_current")
    assert ends == [
        (19000101, 20240409, "Fox", False),
        (20240410, 20240509, "Foxx", False),
        (20240510, 20240709, "Foxy", False),
        (20240710, 99991231, "Foxier", True),
    ]
    # a closed version that is repaired in the source is repaired in the dimension
    txn = store.begin()
    fixed = F.when(F.col("last_name") == "Foxy", "Foxey").otherwise(F.col("last_name"))
    txn.replace("ce_customer_scd", txn.read("ce_customer_scd").withColumn("last_name", fixed))
    txn.commit()
    assert runs.run_dims(store, log, LoadContext.on(date(2024, 8, 1)))["dim_customer"] == (0, 1)
    assert store.read("dim_customer").filter("last_name = 'Foxey'").count() == 1


def test_broken_rules_are_kept_and_nothing_else_is_published(shop, spark, tmp_path):
    store = shop["store"].branch(str(tmp_path / "broken"))
    log = AuditLog(spark, str(tmp_path / "log"))
    ctx = LoadContext.on(date(2024, 5, 1))
    txn = store.begin()
    twice = txn.read("ce_retailer").filter("retailer = 'Web'")
    key = twice.first()["retailer_id"]
    txn.append("ce_retailer", twice)
    txn.commit()
    sales = store.read("ce_sales").count()
    with pytest.raises(constraints.ConstraintError, match=r"ce_retailer unique\(retailer_id\): 2"):
        runs.run_nf3(store, log, ctx)
    assert "ERROR: ce_retailer unique(retailer_id): 2" in log.latest(1).first()["message"]
    found = rows(store.read("constraint_violations"), "table_name", "rule", "row_key")
    assert ("ce_retailer", "ce_retailer unique(retailer_id)", str(key)) in found
    assert {r[0] for r in found} == {"ce_retailer"} and store.read("ce_sales").count() == sales
    txn = store.begin()
    txn.replace("ce_retailer", txn.read("ce_retailer").distinct())
    txn.commit()
    runs.run_nf3(store, log, ctx)
    assert log.latest(1).first()["message"] == "ok"


def test_staging_without_repeats_is_written_as_it_comes(spark, tmp_path):
    """Whole rows are shuffled only where keys repeat."""
    ctx, names = LoadContext.on(DAY1), schemas.names(schemas.STAGING[ONLINE.table])
    none = spark.createDataFrame([], schemas.struct(schemas.STAGING[ONLINE.table]))
    line = spark.range(0, 400, 1, 5).select(F.col("id").alias("customer_id"), F.col("id").cast("string").alias("source_id"))
    sales = line.select(*[F.col(c) if c in line.columns else F.lit(None).cast(none.schema[c].dataType).alias(c) for c in names])
    store = Store(spark, str(tmp_path / "dwh"))
    for rows_in, kept in ((sales, 400), (sales.unionByName(sales.filter("customer_id < 30")), 400)):
        log = AuditLog(spark, str(tmp_path / f"log{rows_in.rdd.getNumPartitions()}"))
        runs.stage(store, log, ctx, {ONLINE.table: rows_in})
        assert store.read(ONLINE.table).distinct().count() == store.read(ONLINE.table).count() == kept
        n = rows_in.count()
        assert log.rows().first()["message"] == f"read={n}, kept={kept}, duplicates={n - kept}, rejects=0"
        if n == kept:  # one file per task of the feed: nothing was shuffled on the way
            assert len(store.read(ONLINE.table).inputFiles()) == 5


def test_months_are_written_without_a_shuffle(spark, tmp_path):
    """Each task writes its own rows; a folder taken back leaves the table as it was."""
    store = Store(spark, str(tmp_path), {"f": "id bigint, invoice_ts timestamp_ntz"})
    txn = store.begin()
    line = spark.range(0, 60, 1, 3).selectExpr("id", "timestamp_ntz'2024-01-05' + make_interval(0, cast(id % 2 AS int)) AS invoice_ts")
    folders, n = txn.place_months("f", line)
    assert (n, len(folders), len(txn.read("f").inputFiles())) == (60, 2, 6)
    assert txn.read_folders("f", folders[:1]).count() == 30
    txn.withdraw(folders)
    assert txn.read("f").count() == 0


def test_sales_are_written_once(spark, tmp_path, ctx):
    """A load whose sales are all new writes them to their months and nowhere else; known
    and bad ones leave no gaps in the numbers."""
    names = schemas.names(schemas.STAGING[ONLINE.table])
    none = spark.createDataFrame([], schemas.struct(schemas.STAGING[ONLINE.table]))
    store = Store(spark, str(tmp_path / "dwh"))
    log = AuditLog(spark, str(tmp_path / "log"))
    scratch = Path(spark.conf.get("spark.checkpoint.dir"))
    for number, (first, last, bad) in enumerate(((0, 30, 0), (20, 50, 4), (20, 50, 0)), 1):
        here = {
            "source_id": F.when(F.col("id") >= first + bad, F.col("id").cast("string")),
            "invoice_ts": F.expr("timestamp_ntz'2024-01-05'"),
            "customer_id": F.col("id"),
            "source_system": F.lit(ONLINE.system),
            "source_entity": F.lit(ONLINE.entity),
        }
        cells = [here.get(c, F.lit(None)).cast(none.schema[c].dataType).alias(c) for c in names]
        runs.stage(store, log, ctx, {ONLINE.table: spark.range(first, last, 1, 4).select(*cells)})
        before = set(scratch.glob("sales-*"))
        runs.run_nf3(store, log, ctx)
        ids = sorted(r[0] for r in store.read("ce_sales").select("sale_id").collect())
        assert ids == list(range(1, {1: 31, 2: 51, 3: 51}[number]))
        assert bool(set(scratch.glob("sales-*")) - before) == (number > 1)
    line = log.rows().filter("procedure_name = 'load_sales'").orderBy("log_id").collect()
    assert [r["message"] for r in line] == [
        "read=30, without id or time=0, known or merged=0",
        "read=30, without id or time=4, known or merged=6",
        "read=30, without id or time=0, known or merged=30",
    ]


def test_new_sales_are_the_stored_ones_if_none_is_known_or_repeated(spark):
    columns = [f for f in schemas.struct(schemas.NF3["ce_sales"]) if f.name != "sale_id"]
    n = spark.range(50).select(*[
        F.col("id").cast("string").alias(f.name) if f.name == "sale_src_id" else F.lit(None).cast(f.dataType).alias(f.name)
        for f in columns
    ])
    stored, none = materialise(n), n.limit(0)
    assert nf3.new_sales(none, stored) is stored
    twice = materialise(n.unionByName(n.filter("sale_src_id < '2'")))
    assert rows(nf3.new_sales(none, twice), "sale_src_id") == rows(n, "sale_src_id")


def test_feed_shuffles_the_order_lines_once(spark, tmp_path):
    one = "/root/testdata/sf0.001"
    columns = ("source_id", "invoice_ts", "customer_id", "customer_lastname", "city_id", "payment_method")
    want = feed.sales(spark, one, *columns)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = feed.sales(spark, one, *columns)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("(l_orderkey#") < plan.index("= c_custkey#")  # the customers join the orders first
        assert rows(got) == rows(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_feed_joins_parts_before_the_names_of_places(spark):
    one = "/root/testdata/sf0.001"
    columns = ("source_id", "product", "region", "state", "retailer")
    want = feed.sales(spark, one, *columns)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = feed.sales(spark, one, *columns)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("= n_nationkey#") < plan.index("= p_partkey#")  # the outer join is printed first
        assert rows(got) == rows(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_extracts_are_compressed_in_files_that_many_tasks_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(extracts, "TEXT_ROWS", 40)
    n = spark.range(0, 100, 1, 1).selectExpr("cast(id AS string) AS `index`", "CASE WHEN id % 9 > 0 THEN 'a, \"b\"' END AS product")
    extracts.convert(n, str(tmp_path / "csv"))
    files = sorted(f.name for f in (tmp_path / "csv").glob("part-*"))
    assert len(files) == 3 and all(f.endswith(".csv.gz") for f in files)
    back = spark.read.schema(n.schema).option("header", True).csv(str(tmp_path / "csv"))
    assert rows(back) == rows(n)


def test_long_tables_are_stored_compactly(spark, tmp_path):
    store = Store(spark, str(tmp_path), {"f": "id bigint, invoice_ts timestamp_ntz", "g": "id bigint"})
    txn = store.begin()
    line = spark.range(6).selectExpr("id", "timestamp_ntz'2024-01-05' AS invoice_ts")
    txn.place_months("f", line)
    txn.append("g", line)
    assert all(".zstd." in f for t in ("f", "g") for f in txn.read(t).inputFiles())


def test_known_sales_are_not_written(spark, tmp_path, ctx, monkeypatch):
    """A batch that was loaded before is told by digests, before any of its rows is written."""
    names = schemas.names(schemas.STAGING[ONLINE.table])
    none = spark.createDataFrame([], schemas.struct(schemas.STAGING[ONLINE.table]))
    here = {
        "source_id": F.col("id").cast("string"),
        "invoice_ts": F.expr("timestamp_ntz'2024-01-05'"),
        "customer_id": F.col("id"),
        "source_system": F.lit(ONLINE.system),
        "source_entity": F.lit(ONLINE.entity),
    }
    cells = [here.get(c, F.lit(None)).cast(none.schema[c].dataType).alias(c) for c in names]
    store, log = Store(spark, str(tmp_path / "dwh")), AuditLog(spark, str(tmp_path / "log"))
    runs.stage(store, log, ctx, {ONLINE.table: spark.range(20).select(*cells)})
    written = []
    write = Txn._write_months
    monkeypatch.setattr(Txn, "_write_months", lambda *a, **k: written.append(write(*a, **k)) or written[-1])
    for n in (20, 0):
        runs.run_nf3(store, log, ctx)
        assert sum(rows for _, rows in written) == n and store.read("ce_sales").count() == 20
        written.clear()


def _method_sizes(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]


@pytest.mark.parametrize("spec", [INSTORE, ONLINE])
def test_rows_are_cleaned_in_methods_that_the_jvm_compiles(spark, tmp_path, ctx, spec):
    """HotSpot interprets methods of more than 8,000 bytes for ever."""
    (tmp_path / "raw.csv").write_text(",".join(spec.raw_columns) + "\n")
    raw = extracts.read_raw(spark, str(tmp_path / "raw.csv"), spec)
    for df in (extracts.clean_rows(raw, spec, ctx), extracts.marked_rows(raw, spec, ctx)):
        sizes = _method_sizes(df)
        assert sizes and max(sizes) < 8000


@pytest.mark.parametrize(
    "lines",
    [
        [ON_LINES[0], ON_LINES[0].replace("1,Web", "9,Web", 1), ON_LINES[1].replace(",1,$40", ",1-2,$40"), "," + ON_LINES[1].split(",", 1)[1]],
        [ON_LINES[1].replace(",1,$40", ",1-2,$40").replace("3/21/2024", "2/30/2024")],
        ON_LINES,
        [],
    ],
    ids=["good, repeated and bad", "bad only", "good only", "none"],
)
def test_good_and_bad_rows_are_staged_in_one_pass(spark, tmp_path, lines):
    """The same rows and the same log as from two passes; both kinds lie in one write."""
    ctx = LoadContext.on(DAY1)
    (tmp_path / "raw.csv").write_text("\n".join([HEAD_ON, *lines]) + "\n")
    raw = extracts.read_raw(spark, str(tmp_path / "raw.csv"), ONLINE)
    clean, bad = extracts.clean_rows(raw, ONLINE, ctx), extracts.rejects(raw, ONLINE)
    found = []
    for name, frames in (
        ("one", ({ONLINE.table: extracts.marked_rows(raw, ONLINE, ctx)},)),
        ("two", ({ONLINE.table: clean}, {ONLINE.table: bad})),
    ):
        store, log = Store(spark, str(tmp_path / name)), AuditLog(spark, str(tmp_path / f"{name}-log"))
        runs.stage(store, log, ctx, *frames)
        lines_of = rows(log.rows(), "procedure_name", "rows_affected", "message")
        found.append((rows(store.read(ONLINE.table)), rows(store.read("load_rejects")), lines_of))
        if name == "one":
            paths = {Path(f.path).parent for f in store.snapshot()[1] if "at_fault=" in f.path}
            assert len(paths) == (1 if lines else 0)
    assert found[0] == found[1]
