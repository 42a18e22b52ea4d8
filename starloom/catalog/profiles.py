"""Queries: column profiles of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.catalog.registry import query
from starloom.quality import profile
from starloom.sources import feed

_LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
_PART_COLUMNS = {
    "p_partkey": "bigint",
    "p_name": "string",
    "p_brand": "string",
    "p_type": "string",
    "p_size": "int",
    "p_retailprice": "double",
}


def _gappy_part(spark, sf_dir):
    """Parts with some brands missing and some sizes zero."""
    k = F.col("p_partkey")
    return feed.table(spark, sf_dir, "part").withColumns(
        {
            "p_brand": F.when(k % 9 != 0, F.col("p_brand")),
            "p_size": F.when(k % 6 == 0, 0).otherwise(F.col("p_size")),
        }
    )


_GAPPY = """
gappy AS (
  SELECT * REPLACE (CASE WHEN p_partkey % 9 <> 0 THEN p_brand END AS p_brand,
    CASE WHEN p_partkey % 6 = 0 THEN 0 ELSE p_size END AS p_size) FROM part
)"""


def _per_column(template: str, columns) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


@query(
    f"""
    WITH {_GAPPY},
    doubled AS (SELECT * EXCLUDE p_partkey FROM gappy)
    SELECT count(*) AS n_rows, 5 AS n_columns,
      CAST(sum(CASE WHEN p_brand IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_cells,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM doubled)) AS duplicate_rows
    FROM doubled
    """
)
def profile_overview(spark, sf_dir):
    return profile.overview(_gappy_part(spark, sf_dir).drop("p_partkey"))


_COLUMN_ROW = """
SELECT '{c}' AS column_name, '{t}' AS column_type, count({c}) AS n_values,
  count(*) - count({c}) AS n_missing, (count(*) - count({c})) / count(*) AS missing_share,
  count(DISTINCT {c}) AS n_distinct, count(DISTINCT {c}) / count({c}) AS distinct_share
FROM gappy"""


@query(
    f"WITH {_GAPPY} "
    + " UNION ALL ".join(_COLUMN_ROW.format(c=c, t=t) for c, t in _PART_COLUMNS.items())
)
def profile_columns(spark, sf_dir):
    return profile.columns(_gappy_part(spark, sf_dir))


_CLOSE_ROW = """
SELECT '{c}' AS column_name, count({c}) AS n_values, count(*) - count({c}) AS n_missing,
  count(DISTINCT {c}) AS n_distinct, TRUE AS close FROM gappy"""


@query(f"WITH {_GAPPY} " + _per_column(_CLOSE_ROW, _PART_COLUMNS))
def profile_columns_approx(spark, sf_dir):
    """Whether the distinct counts estimated in a single pass lie within five
    standard errors of the exact ones, which are shown."""
    rows, rsd = _gappy_part(spark, sf_dir), 0.02
    guess = profile.columns(rows, exact=False, rsd=rsd).select(
        "column_name", "n_values", "n_missing", F.col("n_distinct").alias("guess")
    )
    exact = profile.columns(rows).select("column_name", "n_distinct")
    error = F.abs(F.col("guess") - F.col("n_distinct"))
    close = error <= F.greatest(F.lit(1.0), 5 * rsd * F.col("n_distinct"))
    return guess.join(exact, "column_name").withColumn("close", close).drop("guess")


def _rounded(df, places: int, *names):
    return df.withColumns({c: F.round(c, places) for c in names})


_NUMERIC_ROW = """
SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(var_samp({c}) / 1000, 4) AS variance, CAST(min({c}) AS DOUBLE) AS min_value,
  CAST(max({c}) AS DOUBLE) AS max_value, CAST(max({c}) - min({c}) AS DOUBLE) AS value_range,
  round(CAST(sum(CAST({c} AS DECIMAL(30,6))) AS DOUBLE), 2) AS sum_value,
  count(*) FILTER ({c} = 0) AS n_zeros, count(*) FILTER ({c} < 0) AS n_negatives,
  round(skewness({c}), 6) AS skewness, round(kurtosis({c}), 6) AS kurtosis,
  round(stddev_samp({c}) / avg({c}), 6) AS cv
FROM lineitem"""


@query(_per_column(_NUMERIC_ROW, _LINE_NUMBERS))
def profile_numeric(spark, sf_dir):
    rows = profile.numeric(feed.table(spark, sf_dir, "lineitem"), _LINE_NUMBERS)
    rows = _rounded(rows, 2, "sum_value")
    rows = rows.withColumn("variance", F.round(F.col("variance") / 1000, 4))
    return _rounded(rows, 6, "mean", "std", "skewness", "kurtosis", "cv")


_QUANTILE_ROW = """
SELECT '{c}' AS column_name, round(quantile_cont({c}, 0.05), 6) AS q05,
  round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
  round(quantile_cont({c}, 0.75), 6) AS q75, round(quantile_cont({c}, 0.95), 6) AS q95,
  round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 6) AS iqr
FROM lineitem"""


@query(_per_column(_QUANTILE_ROW, _LINE_NUMBERS))
def profile_quantiles(spark, sf_dir):
    rows = profile.quantiles(feed.table(spark, sf_dir, "lineitem"), _LINE_NUMBERS)
    return _rounded(rows, 6, "q05", "q25", "q50", "q75", "q95", "iqr")


_CLOSE_QUANTILES = """
SELECT '{c}' AS column_name, count({c}) AS n_values, min(CAST({c} AS DOUBLE)) + 0.0 AS min_value,
  max(CAST({c} AS DOUBLE)) + 0.0 AS max_value, 5 AS n_close FROM lineitem"""


@query(_per_column(_CLOSE_QUANTILES, _LINE_NUMBERS))
def profile_quantiles_approx(spark, sf_dir):
    """How many of the five quantiles estimated in a single pass lie within the
    stated n / accuracy ranks, counted exactly, beside the range of the column."""
    lines, accuracy = feed.table(spark, sf_dir, "lineitem"), 10_000
    probs = profile.PROBS
    rows = profile.quantiles_approx(lines, _LINE_NUMBERS, probs, accuracy).collect()  # a row per column
    counts, listed = [], []
    for r in rows:
        c, v = r["column_name"], F.col(r["column_name"]).cast("double")
        room = F.count(v) / accuracy + 1
        close = [
            ((F.count_if(v < r[i]) <= p * F.count(v) + room) & (F.count_if(v <= r[i]) >= p * F.count(v) - room))
            for i, p in enumerate(probs, 1)
        ]
        counts += [
            F.count(v).alias(f"n_{c}"), (F.min(v) + 0.0).alias(f"lo_{c}"), (F.max(v) + 0.0).alias(f"hi_{c}"),  # one kind of zero
            sum((k.cast("int") for k in close), F.lit(0)).alias(f"ok_{c}"),
        ]
        fields = zip((f"n_{c}", f"lo_{c}", f"hi_{c}", f"ok_{c}"), ("n_values", "min_value", "max_value", "n_close"))
        listed.append(F.struct(F.lit(c).alias("column_name"), *(F.col(a).alias(b) for a, b in fields)))
    return lines.agg(*counts).select(F.inline(F.array(*listed)))


_HISTOGRAM_ROW = """
SELECT '{c}' AS column_name, b.bin, round(e.lo + (e.hi - e.lo) * b.bin / 10.0, 6) AS bin_low,
  round(e.lo + (e.hi - e.lo) * (b.bin + 1) / 10.0, 6) AS bin_high,
  (SELECT count(*) FROM lineitem WHERE least(CAST(floor((CAST({c} AS DOUBLE) - e.lo)
    / (e.hi - e.lo) * 10) AS INT), 9) = b.bin) AS n_values
FROM (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM lineitem) e,
  (SELECT CAST(unnest(range(10)) AS INT) AS bin) b"""


@query(_per_column(_HISTOGRAM_ROW, ["l_quantity", "l_extendedprice", "l_linenumber"]))
def profile_histogram(spark, sf_dir):
    rows = profile.histogram(
        feed.table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_linenumber"]
    )
    return _rounded(rows, 6, "bin_low", "bin_high")


_TOP_ROW = """
SELECT * FROM (
  SELECT '{c}' AS column_name, row_number() OVER (ORDER BY count(*) DESC,
    CAST({c} AS VARCHAR)) AS rank, CAST({c} AS VARCHAR) AS value, count(*) AS n_values
  FROM gappy WHERE {c} IS NOT NULL GROUP BY {c}) WHERE rank <= 5"""


@query(f"WITH {_GAPPY} " + _per_column(_TOP_ROW, ["p_name", "p_brand", "p_type", "p_size"]))
def profile_top_values(spark, sf_dir):
    return profile.top_values(
        _gappy_part(spark, sf_dir), 5, ["p_name", "p_brand", "p_type", "p_size"]
    )


_EXTREME_ROW = """
SELECT * FROM (
  SELECT '{c}' AS column_name, 'low' AS side, row_number() OVER (ORDER BY {c}) AS rank,
    CAST({c} AS DOUBLE) AS value, count(*) AS n_values FROM lineitem GROUP BY {c}
  UNION ALL
  SELECT '{c}', 'high', row_number() OVER (ORDER BY {c} DESC), CAST({c} AS DOUBLE), count(*)
  FROM lineitem GROUP BY {c}) WHERE rank <= 5"""


@query(_per_column(_EXTREME_ROW, ["l_quantity", "l_extendedprice"]))
def profile_extreme_values(spark, sf_dir):
    return profile.extreme_values(
        feed.table(spark, sf_dir, "lineitem"), 5, ["l_quantity", "l_extendedprice"]
    )


_TEXT_ROW = """
SELECT '{c}' AS column_name, CAST(min(length({c})) AS INT) AS min_length,
  sum(length({c})) / count({c}) AS mean_length, CAST(max(length({c})) AS INT) AS max_length,
  count(*) FILTER (trim({c}) = '') AS n_blank
FROM gappy"""


@query(f"WITH {_GAPPY} " + _per_column(_TEXT_ROW, ["p_name", "p_brand", "p_type"]))
def profile_text(spark, sf_dir):
    return profile.text(_gappy_part(spark, sf_dir))


@query(
    " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS r FROM lineitem"
        for i, a in enumerate(_LINE_NUMBERS)
        for b in _LINE_NUMBERS[i + 1 :]
    )
)
def profile_correlations(spark, sf_dir):
    rows = profile.correlations(feed.table(spark, sf_dir, "lineitem"), _LINE_NUMBERS)
    return _rounded(rows, 6, "r")


@query(
    f"""
    WITH {_GAPPY}, shape AS (
      {_per_column("SELECT '{c}' AS column_name, count(*) AS n, count({c}) AS v, "
                   "count(DISTINCT {c}) AS d FROM gappy", _PART_COLUMNS)})
    SELECT column_name, 'unique' AS alert FROM shape WHERE d = v
    UNION ALL SELECT column_name, 'constant' FROM shape WHERE d = 1
    UNION ALL SELECT column_name, 'missing' FROM shape WHERE n - v > 0.05 * n
    UNION ALL SELECT column_name, 'high_cardinality' FROM shape
      WHERE d > 50 AND column_name IN ('p_name', 'p_brand', 'p_type')
    UNION ALL SELECT 'p_size', 'zeros' FROM gappy HAVING count(*) FILTER (p_size = 0) > 0.1 * count(*)
    """
)
def profile_alerts(spark, sf_dir):
    return profile.alerts(_gappy_part(spark, sf_dir))


_ORDERS = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}


def _whole_row(c: str, kind: str) -> str:
    number, text = kind in ("bigint", "double"), kind == "string"
    return f"""
    SELECT '{c}' AS column_name, '{kind}' AS column_type, count({c}) AS n_values, count(*) - count({c}) AS n_missing,
      count(DISTINCT {c}) AS n_distinct, {f'CAST(min({c}) AS DOUBLE)' if number else 'NULL'} AS min_value,
      {f'round(avg({c}), 6)' if number else 'NULL'} AS mean, {f'CAST(max({c}) AS DOUBLE)' if number else 'NULL'} AS max_value,
      {f'CAST(min(length({c})) AS DOUBLE)' if text else 'NULL'} AS min_length,
      {f'CAST(max(length({c})) AS DOUBLE)' if text else 'NULL'} AS max_length,
      (SELECT count(*) FROM orders o WHERE o.{c} IS NOT NULL GROUP BY o.{c} ORDER BY 1 DESC LIMIT 1) AS top_count
    FROM orders"""


@query(" UNION ALL ".join(_whole_row(c, kind) for c, kind in _ORDERS.items()))
def profile_whole_table(spark, sf_dir):
    """Every column of a table: values, missing and distinct ones, range and mean of
    numbers, lengths of texts, and how often the most frequent value stands."""
    orders = feed.table(spark, sf_dir, "orders")
    shape = profile.columns(orders).select("column_name", "column_type", "n_values", "n_missing", "n_distinct")
    numbers = _rounded(profile.numeric(orders), 6, "mean").select("column_name", "min_value", "mean", "max_value")
    lengths = profile.text(orders).select(
        "column_name", *[F.col(c).cast("double").alias(c) for c in ("min_length", "max_length")]
    )
    top = profile.top_values(orders, 1).select("column_name", F.col("n_values").alias("top_count"))
    return shape.join(numbers, "column_name", "left").join(lengths, "column_name", "left").join(top, "column_name", "left")
