"""Surrogate keys and unknown members."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

_SLOT_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def max_id(table: DataFrame, id_col: str) -> int:
    """Largest key handed out so far; 0 for a table with only default members."""
    row = table.agg(F.max(id_col).alias("m")).first()
    return max(row["m"] or 0, 0)


def key_text(keys: list[str]) -> Column:
    """One text per key row, with NULL told apart from blank."""
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("<null>")) for k in keys])


def assign(
    df: DataFrame, keys: list[str], id_col: str, start: int = 0, digits: int = 3
) -> DataFrame:
    """Dense keys ``start+1 ..`` for rows that are unique on ``keys``.

    The order is (leading ``digits`` of the key's digest, keys). A digest spreads
    unique keys evenly, so numbering runs inside 16^digits equal buckets and only
    the bucket totals (at most 16^digits rows) meet in one window. Being a
    function of the keys alone, the result is the same on any re-run.
    """
    slot = F.substring(F.md5(key_text(keys)), 1, digits)
    bucketed = df.withColumn("_slot", slot)
    totals = bucketed.groupBy("_slot").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    in_slot = F.row_number().over(W.partitionBy("_slot").orderBy(*keys))
    return (
        bucketed.withColumn("_pos", in_slot)
        .join(F.broadcast(offsets), "_slot")  # <= 16^digits rows
        .withColumn(id_col, F.lit(start) + F.col("_offset") + F.col("_pos"))
        .drop("_slot", "_pos", "_offset")
    )


def stamp_slots(df: DataFrame) -> DataFrame:
    """Mark each row with (task, row number); write the result before using
    :func:`assign_stamped` on it."""
    return df.withColumn("_slot", F.monotonically_increasing_id())


def assign_stamped(stamped: DataFrame, id_col: str, start: int = 0) -> DataFrame:
    """Dense keys for a *written* frame from :func:`stamp_slots`, with no shuffle
    of its rows: each task's rows follow those of the tasks before it. Only the
    per-task totals are gathered, one row per task of the writing stage."""
    task = F.shiftright("_slot", _SLOT_BITS)
    totals = stamped.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    pos = F.col("_slot").bitwiseAND((1 << _SLOT_BITS) - 1) + 1
    return (
        stamped.withColumn("_task", task)
        .join(F.broadcast(offsets), "_task")  # one row per task
        .withColumn(id_col, F.lit(start) + F.col("_offset") + pos)
        .drop("_slot", "_task", "_offset")
    )


def assign_placed(frames: list[DataFrame], id_col: str, start: int = 0) -> list[DataFrame]:
    """Dense keys for the rows of *written* frames, each one read of files: a row's number
    follows from its file and its place there, so nothing is written or shuffled for it.
    Only the rows of each file are counted, one row per file. A frame of no files has
    no rows."""
    placed = []
    for df in frames:
        try:
            at = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
            placed.append(df.select("*", *at))
        except AnalysisException:
            placed.append(df.select("*", F.lit("").alias("_file"), F.lit(0).cast("bigint").alias("_row")))
    files = reduce(DataFrame.unionAll, [p.select("_file") for p in placed])
    totals = files.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)
    first = F.lit(start) + 1 + F.coalesce(F.sum("_n").over(before), F.lit(0))
    offsets = F.broadcast(totals.select("_file", first.alias("_first")))  # one row per file
    return [
        p.join(offsets, "_file").withColumn(id_col, F.col("_first") + F.col("_row")).drop("_file", "_row", "_first")
        for p in placed
    ]


def ensure_default_member(table: DataFrame, member: dict, id_col: str) -> DataFrame:
    """``table`` with its unknown member, added only when no row has that key."""
    if not table.filter(F.col(id_col) == member[id_col]).isEmpty():
        return table
    row = table.sparkSession.range(1).select(
        *[F.lit(member.get(f.name)).cast(f.dataType).alias(f.name) for f in table.schema]
    )
    return table.unionByName(row)
