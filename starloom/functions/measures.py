"""Derived sale measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.context import LoadContext


def avg_unit_price(total: Column, units: Column) -> Column:
    """Total per unit; NULL when either is 0 or NULL. Divided at full scale and
    rounded once."""
    return (F.nullif(total, F.lit(0).cast("decimal(14,2)")) / F.nullif(units, F.lit(0))).cast(
        "decimal(12,4)"
    )


def profit_per_unit(total: Column, profit: Column, units: Column) -> Column:
    """(total - profit) / units for positive units. Despite its name this is the
    cost per unit; name and formula are part of the data model."""
    cost = total - F.coalesce(profit, F.lit(0).cast("decimal(14,2)"))
    return F.when(units > 0, cost / F.nullif(units, F.lit(0))).cast("decimal(12,4)")


def is_high_margin(margin: Column, ctx: LoadContext) -> Column:
    """Margin at or above the threshold; an unknown margin is not high."""
    return F.coalesce(margin >= F.lit(ctx.margin_threshold), F.lit(False))


def with_measures(df: DataFrame, ctx: LoadContext) -> DataFrame:
    """Add the derived measures, then default the stored ones.

    The derived columns read the raw values, so a missing total gives a NULL
    average beside a stored total of 0. Profit and margin stay NULL.
    """
    total, units, profit = F.col("total_sales"), F.col("units_sold"), F.col("operating_profit")
    derived = df.withColumns(
        {
            "avg_unit_price": avg_unit_price(total, units),
            "profit_per_unit": profit_per_unit(total, profit, units),
            "is_high_margin": is_high_margin(F.col("operating_margin"), ctx),
        }
    )
    return derived.withColumns(
        {
            "units_sold": F.coalesce(units, F.lit(0)),
            "price_per_unit": F.coalesce("price_per_unit", F.lit(0).cast("decimal(12,2)")),
            "total_sales": F.coalesce(total, F.lit(0).cast("decimal(14,2)")),
        }
    )
