"""Column profiles as rows. Every statistic is exact unless asked otherwise."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

PROBS = (0.05, 0.25, 0.5, 0.75, 0.95)
_BINS = 1024
_SMALL = 10_000


def read_for_profile(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and inferred column types."""
    return spark.read.csv(path, header=True, inferSchema=True)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def _rows(one_row: DataFrame, per_column: list[Column]) -> DataFrame:
    """Structs of a one-row frame as rows."""
    return one_row.select(F.inline(F.array(*per_column)))


def overview(df: DataFrame) -> DataFrame:
    """One row for the table: rows, columns, missing cells, duplicate rows.

    Grouping by all columns answers all of it: copies collapse before the
    shuffle and every group knows its size and its NULLs.
    """
    nulls = reduce(Column.__add__, [F.col(c).isNull().cast("int") for c in df.columns])
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.withColumn("_nulls", nulls).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.coalesce(F.sum(F.col("_n") * F.col("_nulls")), F.lit(0)).alias("missing_cells"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def value_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """(column, value as text, rows) for every column, NULL included. Each branch
    reads just its own column."""
    branches = [
        df.groupBy(F.col(c).alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(c).alias("column_name"), F.col("v").cast("string").alias("value"), "n")
        for c in columns or df.columns
    ]
    return reduce(DataFrame.unionByName, branches)


def columns(df: DataFrame, exact: bool = True, rsd: float = 0.02) -> DataFrame:
    """Per column: type, values, missing, distinct and their shares.

    ``exact=False`` estimates distinct counts in a single pass.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    if exact:
        counted = value_counts(df).groupBy("column_name").agg(
            F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("n_values"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_missing"),
            F.count("value").alias("n_distinct"),
        )
    else:
        one = df.agg(
            *[F.count(c).alias(f"v_{c}") for c in df.columns],
            *[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in df.columns],
            *[F.approx_count_distinct(c, rsd).alias(f"d_{c}") for c in df.columns],
        )
        counted = _rows(
            one,
            [
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.col(f"v_{c}").alias("n_values"),
                    F.col(f"m_{c}").alias("n_missing"),
                    F.col(f"d_{c}").alias("n_distinct"),
                )
                for c in df.columns
            ],
        )
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    total = F.col("n_values") + F.col("n_missing")
    return counted.select(
        "column_name",
        kind[F.col("column_name")].alias("column_type"),
        "n_values",
        "n_missing",
        F.try_divide("n_missing", total).alias("missing_share"),
        "n_distinct",
        F.try_divide("n_distinct", "n_values").alias("distinct_share"),
    )


def numeric(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Moments and counts of numeric columns, all in one pass over long rows.

    Skewness and kurtosis are the sample-adjusted ones.
    """
    v = F.col("v")
    stats = _long(df, names or numeric_columns(df)).groupBy("column_name").agg(
        F.count(v).cast("double").alias("n"),
        F.avg(v).alias("mean"),
        F.var_samp(v).alias("variance"),
        F.min(v).alias("min_value"),
        F.max(v).alias("max_value"),
        F.sum(v).alias("sum_value"),
        F.count_if(v == 0).alias("n_zeros"),
        F.count_if(v < 0).alias("n_negatives"),
        F.skewness(v).alias("g1"),
        F.kurtosis(v).alias("g2"),
    )
    n, std = F.col("n"), F.sqrt("variance")
    skew = F.col("g1") * F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    kurt = F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6)
    return stats.select(
        "column_name",
        "mean",
        std.alias("std"),
        "variance",
        "min_value",
        "max_value",
        (F.col("max_value") - F.col("min_value")).alias("value_range"),
        "sum_value",
        "n_zeros",
        "n_negatives",
        skew.alias("skewness"),
        kurt.alias("kurtosis"),
        F.try_divide(std, F.col("mean")).alias("cv"),
    )


def _long(df: DataFrame, names: list[str]) -> DataFrame:
    """Numeric cells as (column_name, v) rows, missing ones left out."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in names]
    return df.select(F.inline(F.array(*cells))).filter("v is not null and not isnan(v)")


def order_statistics(
    df: DataFrame, wanted: dict[str, list[int]]
) -> dict[str, dict[int, float]]:
    """Exact values at 0-based ranks of numeric columns, without sorting them.

    A column's value range is cut into equal bins; the bin counts tell which bin
    holds a rank and only that bin is cut again, until it holds one value or few
    rows. Every pass is one aggregate to at most a few thousand bins per rank, and
    one read of all bins of few rows. Infinities are counted, not cut.
    """
    long = _long(df, list(wanted))
    found: dict[str, dict[int, float]] = {c: {} for c in wanted}
    low_end, high_end = float("-inf"), float("inf")
    finite = (F.col("v") != low_end) & (F.col("v") != high_end)
    ends = (
        long.groupBy("column_name")
        .agg(
            F.count_if(F.col("v") == low_end).alias("below"),
            F.count_if(finite).alias("n"),
            F.min(F.when(finite, F.col("v"))).alias("lo"),
            F.max(F.when(finite, F.col("v"))).alias("hi"),
        )
        .collect()
    )
    # open intervals: (column, lo, hi, rows below lo, ranks inside)
    todo = []
    for r in ends:
        c, first, last = r["column_name"], r["below"], r["below"] + r["n"]
        found[c].update({k: low_end if k < first else high_end for k in wanted[c] if not first <= k < last})
        inside = sorted({k for k in wanted[c] if first <= k < last})
        if inside:
            todo.append((c, r["lo"], r["hi"], first, inside))
    while todo:
        slots = []
        for i, (c, lo, hi, _, _) in enumerate(todo):
            inside = (F.col("column_name") == c) & F.col("v").between(lo, hi)
            half = hi / 2 - lo / 2  # the whole width may be more than a double holds
            share = (F.col("v") / 2 - lo / 2) / half if half else F.when(F.col("v") > lo, 1.0).otherwise(0.0)
            cut = F.least(F.floor(share * _BINS), F.lit(_BINS - 1))
            slots.append(F.when(inside, F.struct(F.lit(i).alias("i"), cut.alias("b"))))
        bins = (
            long.select(F.explode(F.array(*slots)).alias("s"), "v")
            .filter("s is not null")
            .groupBy("s.i", "s.b")
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .orderBy("i", "b")
            .collect()
        )
        again = []
        for i, (c, _, _, below, ranks) in enumerate(todo):
            seen = below
            for r in (b for b in bins if b["i"] == i):
                here = [k for k in ranks if seen <= k < seen + r["n"]]
                if here and r["lo"] == r["hi"]:
                    found[c].update({k: r["lo"] for k in here})
                elif here:
                    again.append((c, r["lo"], r["hi"], seen, here, r["n"]))
                seen += r["n"]
        few = [t for t in again if t[5] <= _SMALL]
        if few:
            spots = [
                F.when((F.col("column_name") == c) & F.col("v").between(lo, hi), F.lit(i))
                for i, (c, lo, hi, *_) in enumerate(few)
            ]
            cells = long.select(F.explode(F.array_compact(F.array(*spots))).alias("i"), "v")
            values: dict[int, list[float]] = {}
            for r in cells.collect():  # at most _SMALL rows for each rank
                values.setdefault(r["i"], []).append(r["v"])
            for i, (c, _, _, below, ranks, _) in enumerate(few):
                held = sorted(values[i])
                found[c].update({k: held[k - below] for k in ranks})
        todo = [t[:5] for t in again if t[5] > _SMALL]
    return found


def quantiles(
    df: DataFrame, names: list[str] | None = None, probs: tuple[float, ...] = PROBS
) -> DataFrame:
    """Exact quantiles with linear interpolation, and the interquartile range."""
    names = names or numeric_columns(df)
    sizes = df.agg(*[F.count(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(c) for c in names])
    n_of = sizes.first().asDict()
    where = {
        c: {p: p * (n_of[c] - 1) for p in probs} for c in names if n_of[c]
    }
    ranks = {c: sorted({int(x) + d for x in at.values() for d in (0, 1)}) for c, at in where.items()}
    ranks = {c: [k for k in ks if k < n_of[c]] for c, ks in ranks.items()}
    stats = order_statistics(df, ranks)
    rows = []
    for c, at in where.items():
        q = {}
        for p, x in at.items():
            low = stats[c][int(x)]
            high = stats[c].get(int(x) + 1, low)
            q[p] = low + (high - low) * (x - int(x)) if high != low else low
        iqr = q[0.75] - q[0.25] if 0.25 in q and 0.75 in q else None
        rows.append((c, *[q[p] for p in probs], iqr))
    ddl = ", ".join(f"q{round(p * 100):02d} double" for p in probs)
    return df.sparkSession.createDataFrame(rows, f"column_name string, {ddl}, iqr double")


def quantiles_approx(
    df: DataFrame,
    names: list[str] | None = None,
    probs: tuple[float, ...] = PROBS,
    accuracy: int = 10_000,
) -> DataFrame:
    """Quantile estimates in a single pass, within n/accuracy ranks."""
    names = names or numeric_columns(df)
    one = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(c) for c in names]
    )
    return _rows(
        one,
        [
            F.struct(
                F.lit(c).alias("column_name"),
                *[F.col(c)[i].alias(f"q{round(p * 100):02d}") for i, p in enumerate(probs)],
            )
            for c in names
        ],
    )


def histogram(df: DataFrame, names: list[str] | None = None, bins: int = 10) -> DataFrame:
    """Equal-width bins per numeric column, empty bins included; the last bin
    holds the maximum."""
    names = names or numeric_columns(df)
    long = _long(df, names)
    ends = long.groupBy("column_name").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    small = F.broadcast(ends)  # one row per column
    width = F.col("hi") - F.col("lo")
    cut = F.floor(F.try_divide(F.col("v") - F.col("lo"), width) * bins)
    bin_no = F.least(F.coalesce(cut, F.lit(0)), F.lit(bins - 1)).cast("int")
    counted = (
        long.join(small, "column_name")
        .groupBy("column_name", bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counted, ["column_name", "bin"], "left").select(
        "column_name",
        "bin",
        (F.col("lo") + width * F.col("bin") / bins).alias("bin_low"),
        (F.col("lo") + width * (F.col("bin") + 1) / bins).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n_values"),
    )


def _top(rows: DataFrame, order: list, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("column_name").orderBy(*order))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k)


def top_values(df: DataFrame, k: int = 10, names: list[str] | None = None) -> DataFrame:
    """The ``k`` most frequent values of each column."""
    seen = value_counts(df, names).filter("value is not null")
    return _top(seen, [F.desc("n"), "value"], k).select(
        "column_name", "rank", "value", F.col("n").alias("n_values")
    )


def extreme_values(df: DataFrame, k: int = 5, names: list[str] | None = None) -> DataFrame:
    """The ``k`` smallest and largest values of each numeric column."""
    seen = _long(df, names or numeric_columns(df)).groupBy("column_name", "v").agg(
        F.count(F.lit(1)).alias("n")
    )
    sides = [
        _top(seen, [order("v")], k).select(
            "column_name",
            F.lit(side).alias("side"),
            "rank",
            F.col("v").alias("value"),
            F.col("n").alias("n_values"),
        )
        for side, order in (("low", F.asc), ("high", F.desc))
    ]
    return sides[0].unionByName(sides[1])


def text(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Text lengths and blank values, all in one aggregate."""
    names = names or text_columns(df)
    one = df.agg(
        *[
            F.struct(
                F.min(F.length(c)).alias("lo"),
                F.sum(F.length(c)).alias("total"),
                F.max(F.length(c)).alias("hi"),
                F.count(c).alias("n"),
                F.count_if(F.trim(c) == "").alias("blank"),
            ).alias(c)
            for c in names
        ]
    )
    return _rows(
        one,
        [
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c)["lo"].alias("min_length"),
                F.try_divide(F.col(c)["total"], F.col(c)["n"]).alias("mean_length"),
                F.col(c)["hi"].alias("max_length"),
                F.col(c)["blank"].alias("n_blank"),
            )
            for c in names
        ],
    )


def correlations(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, in one aggregate."""
    names = names or numeric_columns(df)
    pairs = list(combinations(names, 2))
    one = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    return _rows(
        one,
        [
            F.struct(
                F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"r{i}").alias("r")
            )
            for i, (a, b) in enumerate(pairs)
        ],
    )


def alerts(
    df: DataFrame,
    missing: float = 0.05,
    cardinality: int = 50,
    zeros: float = 0.10,
    skew: float = 20.0,
) -> DataFrame:
    """Columns worth a look: constant, unique, mostly missing, high-cardinality
    text, many zeros, strongly skewed."""
    shape, moments = columns(df), numeric(df)
    rows = shape.join(moments.select("column_name", "n_zeros", "skewness"), "column_name", "left")
    total = F.col("n_values") + F.col("n_missing")
    rules = {
        "constant": F.col("n_distinct") == 1,
        "unique": (F.col("n_distinct") == F.col("n_values")) & (F.col("n_values") > 0),
        "missing": F.col("n_missing") > F.lit(missing) * total,
        "high_cardinality": (F.col("column_type") == "string")
        & (F.col("n_distinct") > cardinality),
        "zeros": F.col("n_zeros") > F.lit(zeros) * total,
        "skewed": F.abs("skewness") > skew,
    }
    raised = [F.when(hit, F.lit(name)) for name, hit in rules.items()]
    return rows.select("column_name", F.explode(F.array_compact(F.array(*raised))).alias("alert"))
