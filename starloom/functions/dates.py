"""Calendar columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_DATE_KEY = -1


def ntz(moment: datetime | None) -> Column:
    """A zone-less timestamp constant. (A plain literal of a datetime carries the
    session's zone; comparing with it would keep a filter from the file scan.)"""
    text = None if moment is None else moment.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def date_key(d: Column) -> Column:
    """``yyyymmdd`` as INT; an unknown date has key -1."""
    d = d.cast("date")
    return F.coalesce(
        F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d), F.lit(UNKNOWN_DATE_KEY)
    )


def month_no(ts: Column) -> Column:
    """``yyyymm`` as INT, the partition column of the fact."""
    return F.year(ts) * 100 + F.month(ts)


def iso_weekday(d: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(d) + 1


def star_calendar_columns(d: Column) -> list[Column]:
    """Columns of the star calendar, with short English names."""
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year_num"),
        F.quarter(d).alias("quarter_num"),
        F.month(d).alias("month_num"),
        F.date_format(d, "MMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        iso_weekday(d).alias("day_of_week"),
        F.date_format(d, "E").alias("day_name"),
        iso_weekday(d).isin(6, 7).alias("is_weekend"),
    ]


def long_calendar_columns(d: Column, padded: bool = False) -> list[Column]:
    """Columns of the standalone calendar, with long names; ``padded`` fills
    names with blanks to nine characters."""

    def name(pattern: str) -> Column:
        text = F.date_format(d, pattern)
        return F.rpad(text, 9, " ") if padded else text

    return [
        date_key(d).alias("date_surr_id"),
        d.alias("date_dt"),
        F.dayofmonth(d).alias("day_of_month"),
        name("MMMM").alias("month_name"),
        F.month(d).alias("month_no"),
        F.year(d).alias("year_no"),
        name("EEEE").alias("weekday_name"),
        iso_weekday(d).alias("weekday_no"),
        iso_weekday(d).isin(6, 7).alias("is_weekend"),
    ]
