"""Load parameters and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import ntz

OPEN_END = date(9999, 12, 31)
UNKNOWN_START = date(1900, 1, 1)
#: Tasks per core that write an intermediate table.
WAVES = 4
#: Compression of long tables that are kept: a fifth shorter than Spark's own.
CODEC = "zstd"


@dataclass(frozen=True)
class LoadContext:
    """Everything a load step needs that is not data.

    ``load_dt``/``load_ts`` are the only clock: no operator reads the wall
    clock, so a step gives the same rows whenever it is re-run.
    ``first_version_start`` is the validity start of the first version of a
    customer; ``None`` means "starts on the load date", which leaves every
    earlier sale without a valid version.
    """

    load_dt: date
    load_ts: datetime
    margin_threshold: Decimal = Decimal("0.30")
    unknown: int = -1
    first_version_start: date | None = UNKNOWN_START

    @classmethod
    def on(cls, day: date, **kw) -> "LoadContext":
        return cls(load_dt=day, load_ts=datetime(day.year, day.month, day.day), **kw)

    @property
    def load_ts_col(self):
        return ntz(self.load_ts)

    @property
    def load_dt_col(self):
        return F.lit(self.load_dt)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in
    ``spark.checkpoint.dir``. Only a session on one machine that names none (a
    local test run) gets a fresh folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named is None:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        named = tempfile.mkdtemp(prefix="starloom-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def together(*tasks: Callable[[], object]) -> list:
    """Run independent driver-side steps at the same time, so that their small
    jobs share the cluster; results in the given order. The first error is
    raised after all have ended."""
    with ThreadPoolExecutor(max_workers=max(len(tasks), 1)) as pool:
        running = [pool.submit(task) for task in tasks]
    return [r.result() for r in running]


def at_most_waves(df: DataFrame, waves: int = WAVES) -> DataFrame:
    """``df`` in so few partitions that its tasks fill the cores ``waves`` times over.
    Nothing is shuffled for that: a task takes several partitions one after the other,
    and a frame of very many small ones is written as fewer files. Under dynamic
    allocation, where the number of cores says little, the partitions stay."""
    context = df.sparkSession.sparkContext
    if context.getConf().get("spark.dynamicAllocation.enabled", "false") == "true":
        return df
    return df.coalesce(waves * context.defaultParallelism)


def materialise(df: DataFrame, label: str = "stage", codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back, compressed by ``codec``
    (Spark's own choice unless named).

    Used where one frame feeds several outputs (count it, key it, publish it).
    A written table survives the loss of any executor, and a stage that is
    re-run reads the same rows again.
    """
    path = scratch_path(df.sparkSession, label)
    at_most_waves(df).write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
