from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from starloom import LoadContext
from starloom.functions import clean, dates, measures


def one(spark, value, kind, expr):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("42", 42),
        (" 1,200 ", 1200),
        ("no. 7", 7),
        ("-5", -5),
        ("12.0", 120),  # the point is dropped
        ("12-3", None),
        ("", None),
        ("abc", None),
        (None, None),
    ],
)
def test_to_long(spark, text, want):
    assert one(spark, text, "string", clean.to_long) == want


def test_to_int_out_of_range(spark):
    assert one(spark, "99999999999", "string", clean.to_int) is None
    assert one(spark, "99999999999", "string", clean.to_long) == 99999999999


@pytest.mark.parametrize(
    "text, want",
    [
        ("$1,200.50", D("1200.50")),
        ("2.345", D("2.35")),
        ("-2.345", D("-2.35")),
        ("1.2.3", None),
        ("", None),
    ],
)
def test_to_decimal(spark, text, want):
    assert one(spark, text, "string", lambda c: clean.to_decimal(c, 12, 2)) == want


@pytest.mark.parametrize(
    "text, want", [("35%", D("0.3500")), ("0.35", D("0.0035")), ("12.345%", D("0.1235")), ("", None)]
)
def test_percent(spark, text, want):
    assert one(spark, text, "string", clean.percent_to_fraction) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("2/17/2023 10:52", datetime(2023, 2, 17, 10, 52)),
        ("02/07/2023 09:05", datetime(2023, 2, 7, 9, 5)),
        ("1/4/2023 7:07", datetime(2023, 1, 4, 7, 7)),
        ("2/30/2023 10:52", None),
        ("soon", None),
    ],
)
def test_us_timestamp(spark, text, want):
    assert one(spark, text, "string", clean.to_ts) == want


def test_text_defaults(spark):
    assert one(spark, None, "string", clean.text_or_na) == "N/A"
    assert one(spark, "  ", "string", clean.text_or_na) == ""  # blank is not missing
    assert one(spark, " a ", "string", clean.na_then_trim) == "a"
    assert one(spark, "\t", "string", clean.is_present) is True  # only blanks are trimmed
    assert one(spark, "  ", "string", clean.is_present) is False


@pytest.mark.parametrize(
    "first, last, want",
    [
        ("Ann", "Lee", "Ann Lee"),
        ("N/A", "Lee", "Lee"),
        ("N/A", "N/A", ""),
        ("", "Smith", " Smith"),
    ],
)
def test_full_name(spark, first, last, want):
    df = spark.createDataFrame([(first, last)], "a string, b string")
    assert df.select(clean.full_name(F.col("a"), F.col("b"))).first()[0] == want


MEASURE_ROWS = [
    # units, price, total, profit, margin -> avg, cost per unit, high
    ((3, "5.00", "10.00", "1.00", "0.3000"), (D("3.3333"), D("3.0000"), True)),
    ((0, "5.00", "10.00", "1.00", "0.2999"), (None, None, False)),
    ((2, None, None, "1.00", None), (None, None, False)),
    ((None, "5.00", "10.00", None, "0.5000"), (None, None, True)),
    ((8, "5.00", "0.00", None, "0.1000"), (None, D("0.0000"), False)),
    ((7, "5.00", "-1.00", None, "0.1000"), (D("-0.1429"), D("-0.1429"), False)),
    ((8, "5.00", "0.01", None, None), (D("0.0013"), D("0.0013"), False)),  # 0.00125 rounds up
]


@pytest.mark.parametrize("given, want", MEASURE_ROWS)
def test_measures(spark, ctx, given, want):
    df = spark.createDataFrame(
        [given], "units_sold int, price_per_unit string, total_sales string, operating_profit string, operating_margin string"
    ).selectExpr(
        "units_sold",
        "cast(price_per_unit as decimal(12,2)) price_per_unit",
        "cast(total_sales as decimal(14,2)) total_sales",
        "cast(operating_profit as decimal(14,2)) operating_profit",
        "cast(operating_margin as decimal(7,4)) operating_margin",
    )
    r = measures.with_measures(df, ctx).first()
    assert (r["avg_unit_price"], r["profit_per_unit"], r["is_high_margin"]) == want
    assert r["units_sold"] == (given[0] or 0)
    assert r["total_sales"] == D(given[2] or "0")
    assert r["operating_profit"] == (D(given[3]) if given[3] else None)


def test_date_columns(spark):
    assert one(spark, date(2024, 2, 29), "date", dates.date_key) == 20240229
    assert one(spark, None, "date", dates.date_key) == -1
    assert one(spark, date(9999, 12, 31), "date", dates.date_key) == 99991231
    assert one(spark, date(2023, 1, 1), "date", dates.iso_weekday) == 7  # a Sunday


def test_context_is_the_only_clock():
    day = LoadContext.on(date(2024, 3, 10))
    assert day.load_ts == datetime(2024, 3, 10)
