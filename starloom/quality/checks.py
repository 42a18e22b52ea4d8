"""Data-quality checks. A check returns its violating rows: none means passed."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.context import materialise
from starloom.operators import membership
from starloom.operators.dedup import duplicate_groups
from starloom.operators.lookup import inner_join


def mismatch(a: Column, b: Column, null_safe: bool = False) -> Column:
    """``a`` differs from ``b``. Unless ``null_safe``, a NULL on either side is
    not reported."""
    return ~a.eqNullSafe(b) if null_safe else a != b


def count_reconcile(
    left: DataFrame, right: list[DataFrame], names: tuple[str, str]
) -> DataFrame:
    """One row: rows of ``left`` beside the summed rows of ``right``."""
    ours = left.select(F.lit(1).alias("l"), F.lit(0).alias("r"))
    theirs = [d.select(F.lit(0).alias("l"), F.lit(1).alias("r")) for d in right]
    both = reduce(DataFrame.unionByName, [ours, *theirs])
    return both.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in zip("lr", names, strict=True)]
    )


def reconcile(
    warehouse: DataFrame,
    source: DataFrame,
    on: dict[str, str],
    expected: dict[str, Column],
    show: tuple[str, ...] = (),
    null_safe: bool = False,
) -> DataFrame:
    """Warehouse rows whose columns differ from what their source row demands.

    ``on`` maps warehouse to source columns; ``expected`` maps a warehouse
    column (or expression name added beforehand) to an expression over source
    columns, which are prefixed ``s_``. ``show`` adds source columns.
    """
    match = [F.col(s).alias(w) for w, s in on.items()]
    src = source.select(*match, *[F.col(c).alias(f"s_{c}") for c in source.columns])
    joined = inner_join(warehouse, src, list(on))
    wrong = [mismatch(F.col(c), want, null_safe) for c, want in expected.items()]
    return joined.filter(reduce(Column.__or__, wrong)).select(
        *warehouse.columns, *[F.col(f"s_{c}").alias(c) for c in show]
    )


def flag_consistency(
    df: DataFrame, valid_to: str, flag: str, as_of: date, yes: str = "Y", no: str = "N"
) -> DataFrame:
    """Rows whose validity flag disagrees with their end date."""
    open_ = F.col(valid_to) > F.lit(as_of)
    return df.filter((open_ & (F.col(flag) != yes)) | (~open_ & (F.col(flag) != no)))


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows without a parent; a NULL foreign key has none.

    The distinct foreign keys, of which each task sends one row, are held against the
    parents, which are read once. A bitmap of the orphan keys then leaves the other
    child rows out before the exact join; without orphans the child's rows are not read.
    """
    known = parent.select(F.col(pk).alias(fk)).filter(F.col(fk).isNotNull())
    lost = child.select(fk).filter(F.col(fk).isNotNull()).distinct().join(known, fk, "left_anti")
    lost = materialise(lost, "orphans")
    suspects = membership.may_be_among(child.filter(F.col(fk).isNotNull()), [fk], membership.bitmap(lost, [fk]))
    return suspects.join(lost, fk, "left_semi").unionByName(child.filter(F.col(fk).isNull()))


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with NULL in any of the columns."""
    return df.filter(reduce(Column.__or__, [F.col(c).isNull() for c in columns]))


def range_check(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows whose value is missing or outside the closed range."""
    wrong = F.col(column).isNull()
    if low is not None:
        wrong = wrong | (F.col(column) < F.lit(low))
    if high is not None:
        wrong = wrong | (F.col(column) > F.lit(high))
    return df.filter(wrong)


def too_long(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows with text beyond its column's length."""
    return df.filter(
        reduce(Column.__or__, [F.length(c) > n for c, n in limits.items() if c in df.columns])
    )


def duplicates(df: DataFrame, *keys: str, count_name: str = "dup_count") -> DataFrame:
    return duplicate_groups(df, list(keys), count_name)


def recompute(
    df: DataFrame, lookup: DataFrame, on: str, stored: str, expected: Column, name: str
) -> DataFrame:
    """Rows whose stored value differs from the recomputed one, with the latter.

    The join may be on a column that is not a key of ``lookup``; a row is then
    tested against each of its matches.
    """
    joined = inner_join(df, lookup, [on]).withColumn(name, expected)
    return joined.filter(F.col(stored) != F.col(name)).select(*df.columns, name)


def summary(checks: dict[str, DataFrame]) -> DataFrame:
    """One row per check: violations and whether it passed."""
    counted = [
        rows.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("check_name"),
            "violations",
            (F.col("violations") == 0).alias("passed"),
        )
        for name, rows in checks.items()
    ]
    return reduce(DataFrame.unionByName, counted)
