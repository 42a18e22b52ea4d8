"""Raw extracts: reading, cleaning into staging rows, rejects."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas
from starloom.context import LoadContext
from starloom.functions import clean


@dataclass(frozen=True)
class SourceSpec:
    """One source: its lineage tags, staging table and raw columns."""

    system: str
    entity: str
    table: str
    raw_columns: tuple[str, ...]

    @property
    def has_geography(self) -> bool:
        return "city_id" in self.raw_columns


# The two sources, in load order.
INSTORE = SourceSpec(
    "SA_INSTORE", "SRC_INSTORE", "src_instore_sales", tuple(schemas.RAW_INSTORE)
)
ONLINE = SourceSpec("SA_ONLINE", "SRC_ONLINE", "src_online_sales", tuple(schemas.RAW_ONLINE))
SOURCES = (INSTORE, ONLINE)

_LONG = (
    "retailer_id",
    "region_id",
    "state_id",
    "city_id",
    "product_id",
    "product_category_id",
    "customer_id",
)
_INT = ("units_sold", "sales_method_id", "payment_method_id")
_AMOUNT = {"price_per_unit": (12, 2), "total_sales": (14, 2), "operating_profit": (14, 2)}


def read_raw(spark: SparkSession, path, spec: SourceSpec, sep: str = ",") -> DataFrame:
    """CSV with a header, every column text. An empty field reads as NULL."""
    ddl = ", ".join(f"`{c}` string" for c in spec.raw_columns)
    return spark.read.schema(ddl).option("header", True).option("sep", sep).csv(path)


#: Rows of a compressed text file, which one task reads whole.
TEXT_ROWS = 100_000


def convert(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a frame in another file format, one part file per task. Text is compressed,
    in files of :data:`TEXT_ROWS` rows at most, so that many tasks can read it."""
    writer = df.write.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("compression", "gzip")
        writer = writer.option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", TEXT_ROWS)
    writer.save(path)


def _reader(column: str, c: Column) -> Column:
    if column in _LONG:
        return clean.to_long(c)
    if column in _INT:
        return clean.to_int(c)
    if column in _AMOUNT:
        return clean.to_decimal(c, *_AMOUNT[column])
    if column == "operating_margin":
        return clean.percent_to_fraction(c)
    if column == "invoice_date":
        return clean.to_ts(c)
    return c


def _staging_name(column: str) -> str:
    return {"index": "source_id", "invoice_date": "invoice_ts"}.get(column, column)


def tag_lineage(df: DataFrame, spec: SourceSpec) -> DataFrame:
    return df.withColumns(
        {"source_system": F.lit(spec.system), "source_entity": F.lit(spec.entity)}
    )


def _typed(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """Typed columns plus ``bad_columns``, the raw columns that could not be
    read. A row without a source id is bad as well.

    Cells and their faults stand in one projection: a field that is used twice there
    is read once, in a method of its own, while one method that reads them all would
    be too long for the JVM to compile (8,000 bytes of bytecode). Filters on
    ``bad_columns`` stop at the generator, where they would otherwise move below the
    projection and read every field again.
    """
    numbers = {*_LONG, *_INT, *_AMOUNT, "operating_margin", "invoice_date"}
    converted = sorted(numbers & {*spec.raw_columns})
    cells = {c: _reader(c, F.col(c)) for c in spec.raw_columns}
    faults = [F.when(cells[c].isNull() & (F.trim(F.col(c)) != ""), F.lit(c)) for c in converted]
    faults.append(F.when(F.col("index").isNull(), F.lit("index")))
    rows = raw.select(
        *[cell.alias(_staging_name(c)) for c, cell in cells.items()],
        F.concat_ws(",", *faults).alias("_faults"),
    )
    marked = rows.withColumn("bad_columns", F.explode(F.array("_faults"))).drop("_faults")
    return tag_lineage(marked, spec)


def marked_rows(raw: DataFrame, spec: SourceSpec, ctx: LoadContext) -> DataFrame:
    """Every row typed, tagged and stamped, with its ``bad_columns``: empty for those of
    :func:`clean_rows`, the columns that could not be read for those of :func:`rejects`."""
    stamped = _typed(raw, spec).withColumns({"insert_dt": ctx.load_ts_col, "update_dt": ctx.load_ts_col})
    return stamped.select(*schemas.names(schemas.STAGING[spec.table]), "bad_columns")


def clean_rows(raw: DataFrame, spec: SourceSpec, ctx: LoadContext) -> DataFrame:
    """Staging rows: typed, tagged and stamped. Rows with unreadable values are
    left out; :func:`rejects` returns exactly those."""
    return marked_rows(raw, spec, ctx).filter("bad_columns = ''").drop("bad_columns")


def rejects(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """Raw rows with unreadable values, and which columns those were."""
    return (
        _typed(raw, spec)
        .filter("bad_columns <> ''")
        .select("source_system", "source_entity", "source_id", "bad_columns")
    )


def lost_points(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """Integer fields whose text holds a decimal point, which cleaning drops."""
    columns = [c for c in spec.raw_columns if c in (*_LONG, *_INT)]
    marks = [F.when(clean.loses_point(F.col(c)), F.lit(c)) for c in columns]
    return (
        raw.select(F.col("index").alias("source_id"), F.concat_ws(",", *marks).alias("columns"))
        .filter("columns <> ''")
    )
