"""Whole load runs over a store: every step in dependency order, one publish."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starloom import schemas
from starloom.context import CODEC, LoadContext, materialise, together
from starloom.functions.dates import ntz
from starloom.operators import calendar, keys, scd2
from starloom.operators.merge import MergeResult, known_digests
from starloom.plans import dims, fact, nf3
from starloom.plans.audit import AuditLog, Step
from starloom.quality import constraints
from starloom.sources.extracts import INSTORE, ONLINE
from starloom.sources.store import Store, Txn

STAGING_KEYS = ["customer_id", "product_id", "invoice_ts"]


def stage(
    store: Store,
    log: AuditLog,
    ctx: LoadContext,
    cleaned: dict[str, DataFrame],
    rejected: dict[str, DataFrame] | None = None,
) -> None:
    """Replace the staging tables by cleaned rows, later duplicates removed. Rows
    that could not be read are added to ``load_rejects``; the log has how many rows
    of a source were read, kept, duplicates and rejected. Unreadable rows are frames
    of their own, or stand among the others where these have ``bad_columns``
    (:func:`extracts.marked_rows`): the source is then read once for both."""
    txn = store.begin()

    def load(table: str, step: Step) -> None:
        order = ["insert_dt", "source_id", *_rest(schemas.names(store.tables[table]))]
        bad, n_bad = (rejected or {}).get(table), 0
        if "bad_columns" in cleaned[table].columns:
            marked = cleaned[table].withColumn("load_ts", ctx.load_ts_col)
            n, step.rows, n_bad = txn.replace_unique_marked(
                table, marked, "bad_columns", "load_rejects", STAGING_KEYS, order
            )
            n -= n_bad
        else:
            n, step.rows = txn.replace_unique(table, cleaned[table], STAGING_KEYS, order)
        n_bad += txn.append_rows("load_rejects", bad.withColumn("load_ts", ctx.load_ts_col)) if bad is not None else 0
        step.message = f"read={n + n_bad}, kept={step.rows}, duplicates={n - step.rows}, rejects={n_bad}"

    log.steps(ctx, {f"stage_{t}": partial(load, t) for t in cleaned})
    txn.commit()
    log.flush()


def _rest(columns: list[str]) -> list[str]:
    taken = {*STAGING_KEYS, "insert_dt", "source_id"}
    return [c for c in columns if c not in taken]


def staged_rows(txn: Txn) -> DataFrame:
    """All sources in one frame; geography is NULL where a source has none."""
    return txn.read(INSTORE.table).unionByName(txn.read(ONLINE.table), allowMissingColumns=True)


def run_nf3(store: Store, log: AuditLog, ctx: LoadContext) -> None:
    """Load the normalised layer from staging and publish it in one commit."""
    txn = store.begin()
    stamps = {"insert_dt": ctx.load_ts.isoformat(" "), "update_dt": ctx.load_ts.isoformat(" ")}
    txn.seed_defaults("nf3", stamps)
    staging = staged_rows(txn)

    def append(table: str, load: Callable[[DataFrame], DataFrame]) -> int:
        return txn.append_rows(table, load(txn.read(table)))

    def category(step: Step) -> None:
        step.rows = append("ce_category", lambda t: nf3.load_category(t, staging, ctx))

    def product(step: Step) -> None:
        parents = txn.read("ce_category")
        step.rows = append("ce_product", lambda t: nf3.load_product(t, staging, parents, ctx))

    def retailer(step: Step) -> None:
        step.rows = append("ce_retailer", lambda t: nf3.load_retailer(t, staging, ctx))

    def methods(step: Step) -> None:
        step.rows = append(
            "ce_sales_method", lambda t: nf3.load_sales_method(t, staging, ctx)
        ) + append("ce_payment_method", lambda t: nf3.load_payment_method(t, staging, ctx))

    def geo(step: Step) -> None:
        places = txn.read(INSTORE.table)
        step.rows = 0
        for level, parent in (("region", None), ("state", "region"), ("city", "state")):
            load = partial(nf3.load_place, staging=places, level=level, parent=parent, ctx=ctx)
            step.rows += append(f"ce_{level}", load)

    def customer(step: Step) -> None:
        step.rows = 0
        txn.split_open("ce_customer_scd", "is_active")
        for source in (INSTORE, ONLINE):
            result = nf3.load_customer(
                txn.read("ce_customer_scd"), txn.read(source.table), ctx
            )
            closed, opened, corrected = (
                part.count() for part in (result.closed, result.opened, result.corrected)
            )
            step.rows += closed + opened + corrected
            if closed + opened + corrected:
                txn.replace_open("ce_customer_scd", result.closed, result.still_open)
        step.message = "versions closed, opened or corrected"

    log.steps(
        ctx,
        {
            "load_category": category,
            "load_retailer": retailer,
            "load_methods": methods,
            "load_geo": geo,
            "load_customer": customer,
        },
    )
    log.steps(ctx, {"load_product": product})
    with log.step(ctx, "load_sales") as step:
        append_sales(txn, ctx, step)
    with log.step(ctx, "check_constraints"):
        constraints.enforce_nf3(txn, ctx)
    txn.commit()
    log.flush()


def append_sales(txn: Txn, ctx: LoadContext, step: Step) -> None:
    """Resolve, deduplicate and append the sales, by month. Rows are numbered by their
    place in staging and written once as they come; only if some have no id or time, or
    a known or repeated key, the others are numbered and written again from there. If
    digests say beforehand that all are known, none is written. The step reports the rows appended,
    and those that were left out."""
    target = txn.read("ce_sales")
    start = keys.max_id(target, "sale_id")
    placed = keys.assign_placed([txn.read(s.table) for s in (INSTORE, ONLINE)], "sale_id", start)
    staging = placed[0].unionByName(placed[1], allowMissingColumns=True)
    # The natural key holds the sale time, so only sales of the batch's own time
    # range can be known already; the folders of other months are not read.
    low, high = staged_rows(txn).agg(F.min("invoice_ts"), F.max("invoice_ts")).first()
    near = target.filter(F.col("invoice_ts").between(ntz(low), ntz(high)))
    if low and "yyyymm" in target.columns:
        near = near.filter(fact.in_months(low, high))
    resolved = nf3.resolve_sales(
        staging,
        txn.read("ce_customer_scd"),
        txn.read("ce_product"),
        txn.read("ce_retailer"),
        txn.read("ce_city"),
        txn.read("ce_sales_method"),
        txn.read("ce_payment_method"),
        ctx,
    )

    def observed() -> tuple[DataFrame, Observation]:
        seen = Observation()
        no_sale = F.col("sale_src_id").isNull() | F.col("invoice_ts").isNull()
        counted = resolved.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(no_sale).alias("bad"))
        return nf3.sales_rows(counted, ctx, "sale_id"), seen

    folders, stored, fresh = [], None, None
    natural = schemas.BUSINESS_KEY["ce_sales"]
    if not near.dropna(subset=natural).isEmpty():
        rows, seen = observed()
        known = known_digests(near, rows, natural)[0]
        n, bad = Txn._seen(seen), Txn._seen(seen, "bad")
        if known == n - bad:  # a batch that was loaded before
            fresh = rows.limit(0)
    if fresh is None:
        rows, seen = observed()
        folders, step.rows = txn.place_months("ce_sales", rows)
        n, bad = Txn._seen(seen), Txn._seen(seen, "bad")
        stored = txn.read_folders("ce_sales", folders)
        fresh = nf3.new_sales(near, stored)
    if bad or fresh is not stored:  # the numbers have gaps
        fresh = materialise(keys.stamp_slots(fresh.drop("sale_id", "yyyymm")), "sales", CODEC)
        txn.withdraw(folders)
        step.rows = txn.append_months("ce_sales", keys.assign_stamped(fresh, "sale_id", start))
    step.message = f"read={n}, without id or time={bad}, known or merged={n - bad - step.rows}"


def run_dims(store: Store, log: AuditLog, ctx: LoadContext) -> dict[str, tuple[int, int]]:
    """Bring every dimension up to the normalised layer; returns (inserted,
    updated) per dimension."""
    txn = store.begin()
    txn.seed_defaults("star")
    read = txn.read
    loads: dict[str, Callable[[DataFrame], MergeResult]] = {
        "dim_product": lambda t: dims.load_product(
            t, read("ce_product"), read("ce_category")
        ),
        "dim_retailer": lambda t: dims.load_retailer(t, read("ce_retailer")),
        "dim_sales_method": lambda t: dims.load_method(
            t, read("ce_sales_method"), "sales_method"
        ),
        "dim_payment_method": lambda t: dims.load_method(
            t, read("ce_payment_method"), "payment_method"
        ),
        "dim_geography": lambda t: dims.load_geography(
            t, read("ce_city"), read("ce_state"), read("ce_region")
        ),
    }
    done: dict[str, tuple[int, int]] = {}

    def upsert(table: str, step: Step) -> None:
        result = loads[table](read(table))
        inserted, updated = done[table] = result.counts()
        step.merged(inserted, updated, table)
        if inserted + updated:
            txn.replace(table, result.table)

    def customer(step: Step) -> None:
        done["dim_customer"] = mirror_customer(txn)
        step.merged(*done["dim_customer"], "dim_customer")

    steps = {f"load_{t}": partial(upsert, t) for t in loads}
    log.steps(ctx, {**steps, "load_dim_customer": customer})
    txn.append(
        "dim_date",
        calendar.ensure_dates(
            read("dim_date"), dims.version_dates(read("ce_customer_scd")), "d"
        ),
    )
    log.log(ctx, "load_dimensions", 0, "all dimensions loaded")
    txn.commit()
    log.flush()
    return done


def mirror_customer(txn: Txn) -> tuple[int, int]:
    """Bring the customer dimension up to the customer versions; rows inserted and
    updated. Rows of versions that were closed before stay in their folders, unless
    such a version was changed after all."""
    table = "dim_customer"
    txn.split_open(table, "is_current")
    parts = [txn.read_part(table, open=o).withColumn("was_open", F.lit(o)) for o in (True, False)]
    result = dims.load_customer(parts[0].unionByName(parts[1]), txn.read("ce_customer_scd"))
    inserted, updated = result.counts()
    if not result.updated.filter("NOT was_open").isEmpty():
        txn.replace(table, result.table.drop("was_open"))
        txn.split_open(table, "is_current")
    elif inserted + updated:
        fresh = result.table.filter("coalesce(was_open, true)").drop("was_open")
        txn.replace_open(table, fresh.filter("NOT is_current"), fresh.filter("is_current"))
    return inserted, updated


def extend_calendar(store: Store, log: AuditLog, ctx: LoadContext) -> None:
    """Calendar rows for the whole sales range."""
    txn = store.begin()
    with log.step(ctx, "build_calendar") as step:
        bounds = calendar.fact_range(txn.read("ce_sales"), ctx.load_dt)
        step.rows = txn.append_rows("dim_date", calendar.extend(txn.read("dim_date"), bounds))
    txn.commit()
    log.flush()


def refresh_fact(
    store: Store,
    log: AuditLog,
    ctx: LoadContext,
    first: date | None = None,
    last: date | None = None,
) -> None:
    """Reload the fact's window (three newest months unless given), empty its
    months first and drop older ones."""
    txn = store.begin()
    sales = txn.read("ce_sales")
    if first is None and last is None:
        first, last = fact.window_of(max(txn.months("ce_sales"), default=None), ctx.load_dt)
    fact.check_window(first, last)
    with log.step(ctx, "refresh_fact") as step:
        lazy = fact.dimension_maps(
            {t: txn.read(t) for t in schemas.NF3}, {t: txn.read(t) for t in schemas.STAR}
        )
        written = together(*[partial(materialise, m, f"map-{n}") for n, m in lazy.items()])
        maps = dict(zip(lazy, written, strict=True))
        rows = fact.refresh(
            sales, maps, txn.read("dim_geography"), txn.read("dim_customer"), first, last
        )
        low, high = first.year * 100 + first.month, last.year * 100 + last.month
        step.rows = txn.replace_months("fct_sales", rows, low, high)
        txn.drop_months_before("fct_sales", low)
        step.message = f"{first}..{last}"
    txn.commit()
    log.flush()


def customer_history(store: Store, n: int = 20) -> DataFrame:
    """First versions by customer and start."""
    return scd2.history(store.read("dim_customer"), "customer_src_id", "start_date_key", n)


def newest_month(store: Store) -> DataFrame:
    """Newest fact month, from the fact's own folders."""
    return store.read("fct_sales").agg(F.max("yyyymm").alias("yyyymm"))
