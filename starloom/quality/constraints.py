"""Declared integrity, checked set-wise before a load is published."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from starloom import schemas
from starloom.context import LoadContext, together
from starloom.operators.dedup import duplicate_groups, few_duplicate_groups
from starloom.operators.lookup import broadcast_bytes, plan_bytes, sized_join
from starloom.quality import checks


@dataclass(frozen=True)
class TableRules:
    """Unique keys, required columns and references of one table."""

    unique: tuple[tuple[str, ...], ...] = ()
    required: tuple[str, ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()  # (column, table, column)


def _rules() -> dict[str, TableRules]:
    refs = {
        "ce_product": (("category_id", "ce_category", "category_id"),),
        "ce_state": (("region_id", "ce_region", "region_id"),),
        "ce_city": (("state_id", "ce_state", "state_id"),),
        "ce_sales": (
            ("customer_id", "ce_customer_scd", "customer_id"),
            ("product_id", "ce_product", "product_id"),
            ("retailer_id", "ce_retailer", "retailer_id"),
            ("city_id", "ce_city", "city_id"),
            ("sales_method_id", "ce_sales_method", "sales_method_id"),
            ("payment_method_id", "ce_payment_method", "payment_method_id"),
        ),
    }
    rules = {}
    for table in schemas.NF3:
        id_col, key = schemas.SURROGATE[table], schemas.BUSINESS_KEY.get(table)
        unique = [(id_col,)] + ([tuple(key)] if key and key != [id_col] else [])
        required = [id_col, *(c for c in key or [] if table != "ce_sales")]
        rules[table] = TableRules(
            tuple(unique), tuple(dict.fromkeys(required)), refs.get(table, ())
        )
    return rules


NF3_RULES = _rules()


def _flagged(table: str, tables: dict[str, DataFrame], rules: TableRules) -> tuple[DataFrame, dict[str, Column]]:
    """The table's rows with, for each declared rule, whether they break it:
    required columns are tested in place, references by joins with the distinct parent
    keys, and each unique key by one grouped pass over that key, whose repeated values
    are joined back. A NULL reference or key part breaks neither."""
    rows = tables[table]
    needed = dict.fromkeys([schemas.SURROGATE[table], *rules.required, *(c for k in rules.unique for c in k)])
    needed.update(dict.fromkeys(c for c, _, _ in rules.references))
    df, flags = rows.select(*needed), {}
    for column in rules.required:
        flags[f"{table}.{column} not null"] = F.col(column).isNull()
    for k, (column, parent, pk) in enumerate(rules.references):
        known = tables[parent].select(F.col(pk).alias(column)).dropna().distinct().withColumn(f"_known{k}", F.lit(True))
        df = sized_join(df, known, [column], "left")
        flags[f"{table}.{column} -> {parent}"] = F.col(column).isNotNull() & F.col(f"_known{k}").isNull()
    for k, key in enumerate(rules.unique):
        again = checks.duplicates(rows.select(*key).dropna(), *key).select(*key).withColumn(f"_again{k}", F.lit(True))
        df = sized_join(df, again, list(key), "left")
        flags[f"{table} unique({', '.join(key)})"] = F.col(f"_again{k}").isNotNull()
    return df, flags


def rule_counts(table: str, tables: dict[str, DataFrame], rules: TableRules) -> DataFrame:
    """One row per declared rule of a table: ``table_name``, ``rule`` and how many rows
    break it. Whole rows are never shuffled: a reference is counted by its distinct
    values, a wide unique key of a long table by its digests."""
    rows, counted = tables[table], []

    def add(df: DataFrame, names: list[str], columns: list[Column]) -> None:
        pairs = [F.struct(F.lit(n).alias("rule"), c.alias("violations")) for n, c in zip(names, columns, strict=True)]
        counted.append(df.agg(F.array(*pairs).alias("_pairs")).select(F.explode("_pairs").alias("r")))

    if rules.required:
        nulls = [F.count_if(F.col(c).isNull()) for c in rules.required]
        add(rows, [f"{table}.{c} not null" for c in rules.required], nulls)
    total = F.coalesce(F.sum("_n"), F.lit(0).cast("bigint"))
    for column, parent, pk in rules.references:
        used = rows.select(column).dropna().groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        known = tables[parent].select(F.col(pk).alias(column)).dropna()
        add(used.join(known, column, "left_anti"), [f"{table}.{column} -> {parent}"], [total])
    for key in rules.unique:
        full = rows.select(*key).dropna()
        wide = len(key) > 1 and plan_bytes(full)[0] > broadcast_bytes(full)
        groups = few_duplicate_groups if wide else duplicate_groups
        add(groups(full, list(key), "_n"), [f"{table} unique({', '.join(key)})"], [total])
    listed = reduce(DataFrame.unionByName, counted)
    return listed.select(F.lit(table).alias("table_name"), "r.rule", "r.violations")


def broken_rows(table: str, tables: dict[str, DataFrame], rules: TableRules) -> DataFrame:
    """The rows that break a rule, once for each rule they break: ``table_name``,
    ``rule`` and ``row_key`` (the surrogate key as text, NULL if it is missing)."""
    df, flags = _flagged(table, tables, rules)
    broken = F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in flags.items()]))
    key = F.col(schemas.SURROGATE[table]).cast("string").alias("row_key")
    return df.select(F.lit(table).alias("table_name"), F.explode(broken).alias("rule"), key)


def one_active_version(versions: DataFrame) -> DataFrame:
    """Customers with more than one active version."""
    return checks.duplicates(versions.filter("is_active"), "customer_src_id")


def overlapping_versions(versions: DataFrame) -> DataFrame:
    """Versions that start before the previous one of their customer has ended."""
    order = W.partitionBy("customer_src_id").orderBy("start_dt", "end_dt")
    return versions.withColumn("previous_end", F.lag("end_dt").over(order)).filter(
        "start_dt <= previous_end"
    )


class ConstraintError(ValueError):
    """A load broke a declared rule and is not published."""


def checked_tables(txn) -> dict[str, dict[str, DataFrame]]:
    """For each table of the normalised layer, the staged tables that its rules read. Of
    sales, which only grow, the rows of the run are checked: their keys against all of
    the other tables, their ids among themselves (numbering continues after the highest)."""
    tables = {t: txn.read(t) for t in schemas.NF3}
    return {t: {**tables, t: txn.added(t)} if t == "ce_sales" else tables for t in NF3_RULES}


def enforce_nf3(txn, ctx: LoadContext) -> None:
    """The rules of the normalised layer, on the staged tables of a run. Rules that are
    broken are an error; the rows at fault are kept in ``constraint_violations``, which
    is published by itself, without the run."""
    found = checked_tables(txn)
    counts = [rule_counts(t, tables, NF3_RULES[t]) for t, tables in found.items()]
    versions = one_active_version(txn.read("ce_customer_scd"))
    name = F.lit("ce_customer_scd").alias("table_name"), F.lit("one active version").alias("rule")
    counts.append(versions.agg(F.count(F.lit(1)).alias("violations")).select(*name, "violations"))
    parts = together(*[c.filter("violations > 0").collect for c in counts])
    broken = [r for rows in parts for r in rows]
    if not broken:
        return
    rows = [broken_rows(t, tables, NF3_RULES[t]) for t, tables in found.items() if any(r.table_name == t for r in broken)]
    rows.append(versions.select(*name, F.col("customer_src_id").cast("string").alias("row_key")))
    kept = txn.store.begin()
    kept.append_rows("constraint_violations", reduce(DataFrame.unionByName, rows).withColumn("load_ts", ctx.load_ts_col))
    kept.commit()
    raise ConstraintError("; ".join(f"{r.rule}: {r.violations}" for r in sorted(broken, key=lambda r: r.rule)))
