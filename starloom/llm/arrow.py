"""Row functions over Arrow batches, the shape most operators here share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows taken out of a batch at once; bounds what a task holds as Python objects.
SLICE = 256
#: Rows of a batch that goes to a Python worker.
ROWS = 1024
_ROWS_SETTING, _SPARKS_OWN = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
#: Rows collected before a batch goes back to Spark.
FLUSH = 65_536


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def in_batches(df: DataFrame, run: Callable, ddl: str) -> DataFrame:
    """``mapInArrow`` with batches of at most ``ROWS`` rows, for the rest of a session
    that has kept Spark's own number: the JVM and the Python worker each hold a batch
    of long texts several times over."""
    conf = df.sparkSession.conf
    if conf.get(_ROWS_SETTING) == _SPARKS_OWN:
        conf.set(_ROWS_SETTING, str(ROWS))
    return df.mapInArrow(run, ddl)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_rows(df: DataFrame, setup: Callable[[], Callable], ddl: str) -> DataFrame:
    """One output row for each row. ``setup`` runs once per task and gives the
    function that takes the columns of a row and returns the output tuple."""
    schema = arrow_schema(ddl)

    def run(batches):
        each = setup()
        for part in slices(batches):
            made = [each(*row) for row in zip(*(c.to_pylist() for c in part.columns))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(zip(*made), schema)], schema=schema
            )

    return in_batches(df, run, ddl)


def flat_map_rows(df: DataFrame, setup: Callable[[], Callable], ddl: str) -> DataFrame:
    """Any number of output rows for each row: the function returns an iterable
    of tuples. Given ``None`` for a row it may return what it has kept back."""
    schema = arrow_schema(ddl)

    def pack(made):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(zip(*made), schema)], schema=schema
        )

    def run(batches):
        each, made = setup(), []
        for part in slices(batches):
            for row in zip(*(c.to_pylist() for c in part.columns)):
                made.extend(each(*row))
                if len(made) >= FLUSH:
                    yield pack(made)
                    made = []
        if made:
            yield pack(made)

    return in_batches(df, run, ddl)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
