from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom import LoadContext, schemas
from starloom.context import materialise
from starloom.operators import calendar, dedup, keys, lookup, merge, scd2


# ------------------------------------------------------------------ dedup


def test_keep_first_groups_nulls_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [(1, None, "b"), (1, None, "a"), (2, 5, "z"), (None, None, "q"), (None, None, "p")],
        "k int, v int, id string",
    )
    assert rows(dedup.keep_first(df, ["k", "v"], ["id"])) == [
        (1, None, "a"),
        (2, 5, "z"),
        (None, None, "p"),
    ]


def test_keep_first_ships_one_row_per_key_and_task(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # before and after the shuffle


def test_keep_first_stored_shuffles_rows_of_repeated_keys_only(spark):
    n = F.col("id")
    unique = materialise(spark.range(3000).select(n.alias("a"), F.lit(None).cast("bigint").alias("b"), n.alias("v")))
    assert dedup.keep_first_stored(unique, ["a", "b"], ["v"]) is unique
    swapped = unique.select(F.col("b").alias("a"), F.col("a").alias("b"), "v")  # the same digests
    again = unique.filter("a % 500 = 0").withColumn("v", F.col("v") - 1)
    mixed = materialise(unique.unionByName(swapped.filter("b < 40")).unionByName(again))
    found = dedup.keep_first_stored(mixed, ["a", "b"], ["v"])
    assert rows(found) == rows(dedup.keep_first(mixed, ["a", "b"], ["v"]))
    assert found.count() == 3040
    assert rows(dedup.few_duplicate_groups(mixed, ["a", "b"])) == rows(dedup.duplicate_groups(mixed, ["a", "b"]))


def test_label_choice_is_deterministic_and_hash_aggregated(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None)], "k int, name string")
    got = dedup.one_label_per_key(df, ["k"], ["name"])
    assert rows(got) == [(1, "a"), (2, None)]
    assert "HashAggregate" in got._jdf.queryExecution().executedPlan().toString()


def test_latest_label(spark):
    df = spark.createDataFrame(
        [(1, "old", 1), (1, "new", 3), (1, "mid", 2), (2, "x", 5), (2, "y", 5)],
        "k int, name string, t int",
    )
    assert rows(dedup.latest_label_per_key(df, ["k"], ["name"], "t")) == [(1, "new"), (2, "y")]


# ------------------------------------------------------------------ keys


def test_assign_is_dense_unique_and_repeatable(spark):
    df = spark.range(5000).select(F.col("id").alias("k"))
    one, two = keys.assign(df, ["k"], "sk", 100), keys.assign(df.repartition(7), ["k"], "sk", 100)
    assert rows(one) == rows(two)
    s = one.agg(F.min("sk"), F.max("sk"), F.countDistinct("sk")).first()
    assert tuple(s) == (101, 5100, 5000)


def test_assign_tells_null_from_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("<null>",)], "k string")
    assert sorted(r["sk"] for r in keys.assign(df, ["k"], "sk").collect()) == [1, 2, 3]


def test_assign_placed_numbers_written_rows_without_a_write(spark):
    frames = [materialise(spark.range(n).selectExpr(f"id + {at} AS id").repartition(5)) for n, at in ((1000, 0), (300, 5000))]
    none = spark.createDataFrame([], "id bigint")
    parts = keys.assign_placed([*frames, none], "sk", 40)
    got = [r for p in parts for r in p.collect()]
    assert sorted(r["sk"] for r in got) == list(range(41, 1341))
    assert len({r["id"] for r in got}) == 1300
    assert sorted(got) == sorted(r for p in keys.assign_placed([*frames, none], "sk", 40) for r in p.collect())


def test_missing_stored_moves_digests(spark):
    n = spark.range(100).selectExpr("id AS a", "cast(id % 7 AS string) AS b", "id * 2 AS v")
    stored, names = materialise(n), ["a", "b"]
    assert merge.missing_stored(n.limit(0), stored, names) is stored
    assert merge.missing_stored(n.filter("a < 40").withColumn("b", F.lit("x")), stored, names) is stored
    assert merge.missing_stored(n.unionByName(n), stored, names).count() == 0
    assert rows(merge.missing_stored(n.filter("a < 40"), stored, names)) == rows(n.filter("a >= 40"))
    holes = materialise(n.withColumn("b", F.when(F.col("a") > 4, F.col("b"))))
    assert rows(merge.missing_stored(holes, holes, names), "a") == rows(n.filter("a <= 4"), "a")  # NULL is nobody's equal


def test_missing_stored_of_many_known_keys(spark, monkeypatch):
    """Where a bitmap would hold nothing back, rows are told apart by digests, not by wide keys."""
    monkeypatch.setattr(merge, "SPARSE", 1 << 30)
    n = spark.range(200).selectExpr("id AS a", "cast(id % 7 AS string) AS b", "id * 2 AS v")
    n = n.unionByName(n.filter("a < 9")).withColumn("b", F.when(F.col("a") % 50 > 0, F.col("b")))
    stored, known = materialise(n), n.filter("a < 120 AND b IS NOT NULL")
    count, bits = merge.known_digests(known, stored, ["a", "b"])
    assert count == known.count() and bits.columns == ["_word", "_bits"]
    got = merge.missing_stored(known, stored, ["a", "b"])
    assert rows(got) == rows(merge.insert_missing(known, stored, ["a", "b"]).select(*n.columns))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = merge.missing_stored(known, stored, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("hashpartitioning(_a#") == 2 and plan.count("hashpartitioning") == 2


def test_assign_stamped_continues(spark):
    written = materialise(keys.stamp_slots(spark.range(1000).repartition(5)))
    ids = sorted(r["sk"] for r in keys.assign_stamped(written, "sk", 40).collect())
    assert ids == list(range(41, 1041))


def test_default_member_is_added_once(spark):
    none = spark.createDataFrame([], schemas.struct(schemas.NF3["ce_category"]))
    member = schemas.DEFAULT_MEMBERS["ce_category"]
    once = keys.ensure_default_member(none, member, "category_id")
    twice = keys.ensure_default_member(once, member, "category_id")
    assert twice.count() == 1 and keys.max_id(twice, "category_id") == 0


# ------------------------------------------------------------------ lookup


@pytest.fixture
def feed_and_table(spark):
    hot = [(7, f"r{i}") for i in range(300)]
    feed = spark.createDataFrame(
        [*hot, (1, "a"), (None, "n"), (None, "m"), (9, "z")], "k int, id string"
    )
    table = spark.createDataFrame([(7, 70), (1, 10), (2, 20)], "key int, val int")
    return feed, table


@pytest.mark.parametrize("limit", [None, 1 << 62, 0])
def test_resolve_same_on_both_sides_of_the_size_check(feed_and_table, limit):
    feed, table = feed_and_table
    got = lookup.resolve(feed, table, {"k": "key"}, "val", default=-1, limit=limit)
    want = {"a": 10, "n": -1, "m": -1, "z": -1}
    assert got.count() == 304
    for r in got.collect():
        assert r["val"] == want.get(r["id"], 70)
    inner = lookup.resolve(feed, table, {"k": "key"}, "val", how="inner", limit=limit)
    assert inner.count() == 301


@pytest.mark.parametrize("how", ["left", "inner"])
def test_long_lookups_of_numbers_are_packed(spark, how):
    """Beyond Spark's limit a lookup of numbers is broadcast in blocks: the feed stays where
    it is. Negative, wide, missing and NULL keys and blank tags give what a plain join gives."""
    key = F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 7 == 1, -F.col("id")).otherwise(F.col("id") * 3)
    tag = F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 2 == 0, "x").otherwise("")
    feed = spark.range(0, 5000, 1, 3).select("id", key.alias("k"), tag.alias("t"))
    ids = spark.range(-3000, 9000).withColumn("t", F.explode(F.array(F.lit("x"), F.lit(""), F.lit(None).cast("string"))))
    table = ids.filter("id % 5 <> 0").select("t", F.col("id").cast("int").alias("key"), (F.col("id") * 10**12).alias("v"))
    near = materialise(table.withColumn("v", F.xxhash64("t", "key") % 1_000_000))
    match, limit = {"t": "t", "k": "key"}, 30_000
    for lookup_table, moves in ((near, False), (near.unionByName(near.limit(3)), True), (table, True)):
        got = lookup.resolve(feed, lookup_table, match, "v", how=how, limit=limit)
        want = lookup.resolve(feed, lookup_table, match, "v", how=how, limit=1 << 62)
        assert rows(got) == rows(want) and got.dtypes == want.dtypes
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert ("_places" in plan) != moves  # keys that repeat and values far apart are not packed


def test_hot_keys_are_spread(spark):
    """One key holds a third of the rows, one 0.4 %; NULL keys a tenth."""
    n = 300_000
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).when(F.col("id") % 250 == 2, 9)
    feed = spark.range(n).select(key.otherwise(F.col("id")).cast("int").alias("k"), "id")
    table = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.shuffle.partitions", "500")  # a fair share: 600 rows
    try:
        census = lookup.Census(feed, ["k"], ["id"])
        found, nulls = census.salts(["k"])
        salts = {h: s for h, s in found}
        of = spark.range(1).select(*[F.xxhash64(F.lit(k).cast("bigint")) for k in (7, 9)]).first()
        assert salts[of[0]] == 167 and salts[of[1]] == 2 and set(salts) == set(of)
        assert nulls == 34 and census.salts(["id"]) == ([], 1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    joined = lookup.spread_join(feed, table, ["k"], census=census)
    assert joined.count() == n
    assert joined.filter("v IS NULL").count() == feed.filter("k IS NULL").count()
    assert joined.filter("v <> 2 * k").isEmpty()
    inner = lookup.spread_join(feed, table.filter("k <> 9"), ["k"], "inner", census=census)
    assert inner.count() == feed.filter("k <> 9").count()


def test_no_rows_have_no_hot_keys(spark):
    none = spark.createDataFrame([], "k int, j string")
    assert lookup.Census(none, ["k"]).salts(["k", "j"]) == ([], 1)
    assert lookup.spread_join(none, none.select("k", F.lit(1).alias("v")), ["k"]).isEmpty()


def test_sizes_are_bytes(spark):
    """Few but very wide rows are no broadcast; a small result of a join is one."""
    noise = F.transform(F.sequence(F.lit(1), F.lit(800)), lambda i: F.sha2(F.concat_ws("-", "id", i), 512))
    wide = materialise(spark.range(300).select("id", F.array_join(noise, "").alias("t")))
    assert lookup.sized(wide)[1] is False
    feed = spark.range(1000)
    joined = lookup.sized_join(feed, wide, ["id"])
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.filter("t IS NOT NULL").count() == 300
    big = materialise(spark.range(2_000_000).select("id", F.xxhash64("id").alias("h")))
    few = big.join(big.select("id", F.col("h").alias("g")), "id").filter("id < 10")
    stored, small = lookup.sized(few)
    assert small and len(stored.inputFiles()) > 0 and stored.count() == 10
    repeated = materialise(spark.range(300).select("id", F.repeat(F.lit("x"), 100_000).alias("t")))
    assert not lookup.sized(repeated.join(big, "id"))[1]  # small in the file, not in memory


def test_inner_join_evaluates_each_side_once(spark):
    left, right = spark.range(50).withColumn("a", F.lit(1)), spark.range(20, 90).withColumn("b", F.lit(2))
    met = {lookup.inner_join(left, right, ["id"], limit=limit).count() for limit in (None, 0, -1)}
    assert met == {30}


def test_resolve_one_takes_the_first(spark):
    feed = spark.createDataFrame([(1,), (2,)], "k int")
    table = spark.createDataFrame([(1, 5), (1, 3)], "key int, val int")
    got = lookup.resolve_one(feed, table, {"k": "key"}, "val", ["val"], default=-1)
    assert rows(got) == [(1, 3), (2, -1)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
    last = lookup.resolve_one(feed, table, {"k": "key"}, "val", ["val"], default=-1, last=True)
    assert rows(last) == [(1, 5), (2, -1)]


# ------------------------------------------------------------------ merge

DIM = "sk long, code int, name string"


def test_upsert_changes_only_what_changed(spark):
    target = spark.createDataFrame(
        [(1, 10, "a"), (2, 20, None), (3, 30, "c"), (4, 40, "gone")], DIM
    )
    source = spark.createDataFrame(
        [(10, "a"), (20, "b"), (30, None), (50, "new")], "code int, name string"
    )
    result = merge.upsert(target, source, ["code"], ["name"], "sk")
    assert rows(result.updated) == [(2, 20, "b"), (3, 30, None)]
    assert rows(result.inserted) == [(5, 50, "new")]
    assert result.counts() == (1, 2)
    assert result.table.count() == 5
    again = merge.upsert(result.table, source, ["code"], ["name"], "sk")
    assert again.counts() == (0, 0)
    assert rows(again.table) == rows(result.table)


def test_update_changed_ignores_new_rows(spark):
    target = spark.createDataFrame([(1, 10, "a")], DIM)
    source = spark.createDataFrame([(10, "b"), (50, "new")], "code int, name string")
    result = merge.update_changed(target, source, ["code"], ["name"])
    assert rows(result.table) == [(1, 10, "b")]
    assert result.counts() == (0, 1)


# ------------------------------------------------------------------ scd2


def versions(spark, *data):
    stamp = datetime(2020, 1, 1)
    full = [(*v, "S", "E", stamp, stamp) for v in data]
    return spark.createDataFrame(full, schemas.struct(schemas.NF3["ce_customer_scd"]))


def batch(spark, *data):
    df = spark.createDataFrame(list(data), "customer_src_id long, first_name string, last_name string")
    return df.withColumns(
        {
            "full_name": F.concat_ws(" ", "first_name", "last_name"),
            "source_system": F.lit("S"),
            "source_entity": F.lit("E"),
        }
    )


SHOW = ("customer_id", "customer_src_id", "last_name", "start_dt", "end_dt", "is_active")
END = date(9999, 12, 31)


def test_scd2_close_open_keep(spark):
    old = versions(
        spark,
        (1, 11, "A", "x", "A x", date(2020, 1, 1), END, True),
        (2, 12, "B", "y", "B y", date(2020, 1, 1), END, True),
    )
    ctx = LoadContext.on(date(2021, 5, 1), first_version_start=None)
    result = scd2.apply(old, batch(spark, (11, "A", "x"), (12, "B", "z"), (13, "C", "n")), ctx)
    got = rows(result.table, *SHOW)
    ids = {r[0] for r in got}
    assert ids == {1, 2, 3, 4}
    assert (2, 12, "y", date(2020, 1, 1), date(2021, 4, 30), False) in got
    fresh = {r[1:] for r in got if r[0] in (3, 4)}
    assert fresh == {
        (12, "z", date(2021, 5, 1), END, True),
        (13, "n", date(2021, 5, 1), END, True),
    }
    assert result.closed.count() == 1 and result.opened.count() == 2


def test_scd2_same_day_change_is_corrected_in_place(spark):
    day = date(2021, 5, 1)
    ctx = LoadContext.on(day, first_version_start=None)
    first = scd2.apply(versions(spark), batch(spark, (11, "A", "x")), ctx).table
    result = scd2.apply(first, batch(spark, (11, "A", "z")), ctx)
    assert rows(result.table, *SHOW[1:]) == [(11, "z", day, END, True)]
    assert result.corrected.count() == 1 and result.closed.count() == 0


def test_scd2_null_names_count_as_values(spark):
    old = versions(spark, (1, 11, "A", None, "A", date(2020, 1, 1), END, True))
    ctx = LoadContext.on(date(2021, 5, 1))
    assert scd2.apply(old, batch(spark, (11, "A", "z")), ctx).closed.count() == 1
    assert scd2.apply(old, batch(spark, (11, "A", None)), ctx).closed.count() == 0


def test_scd2_first_version_start_and_return_of_a_closed_key(spark):
    old = versions(spark, (1, 11, "A", "x", "A x", date(2020, 1, 1), date(2020, 6, 1), False))
    ctx = LoadContext.on(date(2021, 5, 1))
    got = rows(scd2.apply(old, batch(spark, (11, "A", "x"), (12, "B", "y")), ctx).opened, *SHOW[1:])
    assert got == [
        (11, "x", date(2021, 5, 1), END, True),
        (12, "y", date(1900, 1, 1), END, True),
    ]


def test_second_change_keeps_all_closed_versions(spark):
    table = versions(spark)
    for year, name in ((2020, "a"), (2021, "b"), (2022, "c")):
        ctx = LoadContext.on(date(year, 1, 1))
        table = scd2.apply(table, batch(spark, (11, "A", name)), ctx).table
    assert [r[2:] for r in rows(table, *SHOW)] == [
        ("a", date(1900, 1, 1), date(2020, 12, 31), False),
        ("b", date(2021, 1, 1), date(2021, 12, 31), False),
        ("c", date(2022, 1, 1), END, True),
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.dictionaries(st.integers(1, 4), st.sampled_from(["p", "q", None]), max_size=4),
        min_size=1,
        max_size=3,
    )
)
def test_scd2_versions_never_overlap(spark, loads):
    from starloom.quality.constraints import one_active_version, overlapping_versions

    table = versions(spark)
    for i, names in enumerate(loads):
        ctx = LoadContext.on(date(2020 + i // 2, 1, 1))  # two loads share a day
        if names:
            incoming = batch(spark, *[(k, "A", v) for k, v in names.items()])
            table = materialise(scd2.apply(table, incoming, ctx).table)
    assert one_active_version(table).isEmpty()
    assert overlapping_versions(table).isEmpty()
    assert table.filter("end_dt < start_dt").isEmpty()


@pytest.mark.parametrize("limit", [None, 0])
def test_as_of_join_against_brute_force(spark, limit):
    spans = [(1, "a", 10, 19), (1, "b", 20, 99), (2, "c", 15, 30), (4, "d", 1, 2), (None, "e", 1, 99)]
    facts = [(i, k, d) for i, (k, d) in enumerate((k, d) for k in (1, 2, 3, None) for d in [*range(5, 40, 3), None])]
    v = spark.createDataFrame(spans, "k int, name string, start_date_key int, end_date_key int")
    f = spark.createDataFrame(facts, "id int, k int, d int")
    want = sorted(
        (i, n) for i, k, d in facts for vk, n, lo, hi in spans if k is not None and d is not None and vk == k and lo <= d <= hi
    )
    got = scd2.as_of_join(f, v, "k", "d", limit=limit)
    assert sorted((r["id"], r["name"]) for r in got.collect()) == want
    left = scd2.as_of_join(f, v, "k", "d", how="left", limit=limit)
    assert left.count() == len(facts) and got.columns == left.columns == ["id", "k", "d", "name", "start_date_key", "end_date_key"]
    assert sorted((r["id"], r["name"]) for r in left.collect() if r["name"]) == want


@pytest.mark.parametrize("how", ["inner", "left"])
def test_long_history_of_a_hot_key(spark, how):
    """10,000 versions of one customer who has a third of all rows: the sweep makes no
    row more than it reads, and deals the customer over months."""
    first = date(1990, 1, 1)
    days = [first + timedelta(days=i) for i in range(10_000)]
    number = lambda d: d.year * 10000 + d.month * 100 + d.day
    spans = [(7, i, number(d), number(d)) for i, d in enumerate(days) if i % 5] + [(8, -8, 19000101, 99991231), (9, -9, 20000101, 20001231)]
    v = spark.createDataFrame(spans, "k bigint, version int, start_date_key int, end_date_key int").repartition(4)
    day = F.date_add(F.lit(first), (F.col("id") % 10_000).cast("int"))
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, 8).otherwise(9)
    f = spark.range(30_000).select("id", key.cast("bigint").alias("k"), F.date_format(day, "yyyyMMdd").cast("int").alias("d"))
    f, v = materialise(f), materialise(v)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert len(lookup.Census(f, ["k"]).salts(["k"])[0]) == 3
        swept = materialise(scd2.sweep_join(f, v, "k", "d", "start_date_key", "end_date_key", how))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    plain = f.join(v.withColumnRenamed("k", "vk"), F.expr("k = vk AND d BETWEEN start_date_key AND end_date_key"), how).drop("vk")
    assert rows(swept) == rows(plain)
    joined = scd2.as_of_join(f, v, "k", "d", how=how)
    assert "Join" not in joined._jdf.queryExecution().optimizedPlan().toString() or "Window" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count() == plain.count()


# ------------------------------------------------------------------ calendar


def test_standalone_calendar(spark):
    df = calendar.standalone(spark)
    assert df.count() == 4018
    day = df.filter("date_surr_id = 20240229").first()
    assert (day["month_name"], day["weekday_name"], day["weekday_no"]) == ("February", "Thursday", 4)
    padded = calendar.standalone(spark, padded=True).filter("date_surr_id = 20240229").first()
    assert (padded["month_name"], padded["weekday_name"]) == ("February ", "Thursday ")


def test_star_calendar_and_extension(spark):
    have = calendar.build(spark, date(2024, 1, 1), date(2024, 1, 31))
    assert have.filter("is_weekend").count() == 8
    assert have.filter("date_key = 20240101").first()["day_name"] == "Mon"
    dates = spark.createDataFrame([(date(2024, 1, 5),), (date(2024, 2, 2),), (None,)], "d date")
    assert rows(calendar.ensure_dates(have, dates, "d"), "date_key") == [(20240202,)]


def test_fact_range_fallback(spark):
    none = spark.createDataFrame([], "invoice_ts timestamp_ntz")
    assert tuple(calendar.fact_range(none, date(2024, 3, 1)).first()) == (
        date(2010, 1, 1),
        date(2024, 3, 1),
    )
