"""Log of load steps. It is written outside the snapshot a run publishes, so the
line of a failed step stays when the run's tables do not."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas
from starloom.context import LoadContext, together


@dataclass
class Step:
    """What a running step reports: rows affected and a message."""

    name: str
    rows: int | None = None
    message: str = "ok"

    def merged(self, inserted: int, updated: int, label: str = "") -> None:
        """Report both halves of an upsert."""
        self.rows = inserted + updated
        self.message = f"{label}{': ' if label else ''}ins={inserted}, upd={updated}"


class AuditLog:
    """Append-only log table under ``path``; one writer at a time.

    Lines of successful steps are kept until :meth:`flush`, which every run
    calls at its end; an error line is written at once.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._last: int | None = None
        self._pending: list[tuple] = []

    def rows(self) -> DataFrame:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(conf).exists(path):
            return self.spark.createDataFrame([], schemas.struct(schemas.ETL_LOG))
        return self.spark.read.schema(schemas.ETL_LOG).parquet(self.path)

    def log(self, ctx: LoadContext, step: str, rows: int | None, message: str) -> None:
        """Add one line; a missing row count is logged as 0."""
        if self._last is None:
            self._last = self.rows().agg(F.coalesce(F.max("log_id"), F.lit(0))).first()[0]
        self._last += 1
        self._pending.append((self._last, ctx.load_ts, step, rows or 0, message))

    def flush(self) -> None:
        """Write the pending lines as one file."""
        if self._pending:
            frame = self.spark.createDataFrame(self._pending, schemas.struct(schemas.ETL_LOG))
            frame.coalesce(1).write.mode("append").parquet(self.path)
            self._pending = []

    def latest(self, n: int, step: str | None = None) -> DataFrame:
        """Newest ``n`` lines, of one step or of all."""
        rows = self.rows()
        if step is not None:
            rows = rows.filter(F.col("procedure_name") == step)
        return rows.orderBy(F.desc("log_id")).limit(n)

    def clear(self) -> None:
        """Empty the log."""
        self._pending, self._last = [], None
        empty = self.spark.createDataFrame([], schemas.struct(schemas.ETL_LOG))
        empty.write.mode("overwrite").parquet(self.path)

    @contextmanager
    def step(self, ctx: LoadContext, name: str) -> Iterator[Step]:
        """Log the outcome of a block. An error is logged and raised again."""
        report = Step(name)
        try:
            yield report
        except Exception as problem:
            self.failed(ctx, name, problem)
            raise
        self.log(ctx, name, report.rows, report.message)

    def failed(self, ctx: LoadContext, name: str, problem: Exception) -> None:
        self.log(ctx, name, 0, f"ERROR: {problem}")
        self.flush()

    def steps(self, ctx: LoadContext, work: dict[str, Callable[[Step], None]]) -> None:
        """Run independent steps at the same time and log them in their order."""

        def run(name: str) -> tuple[Step, Exception | None]:
            report = Step(name)
            try:
                work[name](report)
            except Exception as problem:
                return report, problem
            return report, None

        outcomes = together(*[partial(run, name) for name in work])
        for report, problem in outcomes:
            if problem is None:
                self.log(ctx, report.name, report.rows, report.message)
        problems = [(report, problem) for report, problem in outcomes if problem is not None]
        for report, problem in problems:
            self.failed(ctx, report.name, problem)
        if problems:
            raise problems[0][1]
