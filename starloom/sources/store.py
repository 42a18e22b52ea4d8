"""Tables on a shared file system, published by manifest.

A table is a list of parquet folders; a manifest version names the folders of
every table. Writers only ever add new folders, and a commit is one small
manifest file, so readers see a whole load or none of it and a table is never
overwritten while it is being read. An append adds a folder instead of
rewriting the table, and dropping expired months is a manifest edit.
One writer at a time; a second one fails on the manifest version it tries to
take.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom import schemas
from starloom.context import CODEC, together
from starloom.functions.dates import month_no
from starloom.operators.dedup import keep_first_stored
from starloom.operators.keys import ensure_default_member

MONTH = "yyyymm"


@dataclass(frozen=True)
class Folder:
    """One parquet folder of a table; ``month`` is set for month-partitioned ones,
    ``open`` for the rows of a version table that later runs may still change."""

    table: str
    path: str
    month: int | None = None
    open: bool = False


_MANIFEST = "table string, path string, month int, open boolean"


class Store:
    """Snapshot store under ``root``; ``tables`` maps a table to its DDL."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, str] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = dict(tables or schemas.TABLES)

    @property
    def _manifest_dir(self) -> str:
        return f"{self.root}/_manifest"

    def snapshot(self) -> tuple[int, list[Folder]]:
        """Newest committed version and its folders (metadata-sized). Only the
        names of older manifests are listed; a damaged line is an error."""
        newest = max(self._versions(), default=0)
        if not newest:
            return 0, []
        manifest = self.spark.read.schema(_MANIFEST).option("mode", "FAILFAST")
        rows = manifest.json(f"{self._manifest_dir}/version={newest}").filter("table is not null").collect()
        return newest, [Folder(r["table"], r["path"], r["month"], bool(r["open"])) for r in rows]

    def _versions(self) -> list[int]:
        """Committed versions: those whose writer has ended well. The folder that a
        failed commit leaves behind is not one, and the next commit replaces it."""
        return self._numbers(f"{self._manifest_dir}/version=*", "/_SUCCESS")

    def _numbers(self, pattern: str, inside: str = "") -> list[int]:
        """The numbers in the names of folders ``name=number`` (that hold a file)."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(pattern + inside)
        found = [s.getPath() for s in path.getFileSystem(conf).globStatus(path) or []]
        return [int((p.getParent() if inside else p).getName().split("=")[1]) for p in found]

    def branch(self, root: str) -> "Store":
        """A store of its own that starts from this one's tables, without copying."""
        other = Store(self.spark, root, self.tables)
        txn = Txn(other, 0, self.snapshot()[1])
        txn.commit()
        return other

    def read(self, table: str) -> DataFrame:
        return self._frame(table, self.snapshot()[1])

    def begin(self) -> "Txn":
        return Txn(self, *self.snapshot())

    def _frame(self, table: str, folders: list[Folder]) -> DataFrame:
        ddl = self.tables[table]
        mine = [f for f in folders if f.table == table]
        plain = [f.path for f in mine if f.month is None]
        frames = []
        if plain:
            frames.append(self.spark.read.schema(ddl).parquet(*plain))
        for base in sorted({f.path for f in mine if f.month is not None}):
            months = [f"{base}/{MONTH}={f.month}" for f in mine if f.path == base]
            frames.append(
                self.spark.read.schema(f"{ddl}, {MONTH} int")
                .option("basePath", base)
                .parquet(*months)
            )
        if not frames:
            return self.spark.createDataFrame([], schemas.struct(ddl))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


class Txn:
    """Staged changes; later steps of a run read what earlier ones staged."""

    def __init__(self, store: Store, version: int, folders: list[Folder]):
        self.store = store
        self.spark = store.spark
        self.version = version
        self.folders = list(folders)
        self.before = frozenset(folders)
        self.lock = threading.Lock()  # steps of a run stage their tables from threads

    def read(self, table: str) -> DataFrame:
        return self.store._frame(table, self.folders)

    def added(self, table: str) -> DataFrame:
        """The rows that this transaction has put into a table."""
        return self.store._frame(table, [f for f in self.folders if f not in self.before])

    def _new_path(self, table: str) -> str:
        return f"{self.store.root}/{table}/{self.version + 1:06d}-{uuid.uuid4().hex[:12]}"

    def _write(self, table: str, df: DataFrame) -> tuple[str, int]:
        """Path and number of the rows written, counted by the write itself."""
        path, seen = self._new_path(table), Observation()
        wanted = schemas.struct(self.store.tables[table])
        shaped = df.select(*[F.col(f.name).cast(f.dataType) for f in wanted])
        shaped.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path, compression=CODEC)
        return path, self._seen(seen)

    @staticmethod
    def _seen(seen: Observation, what: str = "n") -> int:
        """Rows that a write has counted; a write whose plan the optimizer found to
        be empty leaves no figure."""
        try:
            return seen.get[what]
        except Py4JJavaError:
            return 0

    def _stage(self, out: Callable[[Folder], bool], into: list[Folder]) -> None:
        """Take folders out of the table list and add new ones, in one step."""
        with self.lock:
            self.folders = [f for f in self.folders if not out(f)] + into

    def append_rows(self, table: str, df: DataFrame) -> int:
        """Add rows as one more folder, none if there are no rows; their number."""
        path, n = self._write(table, df)
        if n:
            self._stage(lambda f: False, [Folder(table, path)])
        return n

    def append(self, table: str, df: DataFrame) -> DataFrame:
        """Add rows as one more folder; returns the rows as written."""
        path, n = self._write(table, df)
        if n:
            self._stage(lambda f: False, [Folder(table, path)])
        return self.spark.read.schema(self.store.tables[table]).parquet(path)

    def replace_rows(self, table: str, df: DataFrame) -> int:
        """Make ``df`` the whole table; the number of its rows."""
        path, n = self._write(table, df)
        self._stage(lambda f: f.table == table, [Folder(table, path)])
        return n

    def replace_unique(self, table: str, df: DataFrame, keys: list[str], order: list) -> tuple[int, int]:
        """Make the rows of ``df`` that are the first of their key the whole table; the
        number of rows in ``df`` and of those kept. Rows are written as they come; where
        keys repeat, the table is written once more from there without the later rows."""
        path, n = self._write(table, df)
        return n, self._unique(table, path, n, keys, order)

    def _unique(self, table: str, path: str, n: int, keys: list[str], order: list) -> int:
        """Make the first rows of each key in a folder the whole table; their number."""
        stored = self.spark.read.schema(self.store.tables[table]).parquet(path)
        once = keep_first_stored(stored, keys, order)
        if once is not stored:
            return self.replace_rows(table, once)
        self._stage(lambda f: f.table == table, [Folder(table, path)])
        return n

    def replace_unique_marked(
        self, table: str, marked: DataFrame, fault: str, faulty: str, keys: list[str], order: list
    ) -> tuple[int, int, int]:
        """:meth:`replace_unique` of the rows whose text ``fault`` is empty; the others are
        added to the table ``faulty``. The number of rows in ``marked``, of those kept and
        of those at fault. ``marked`` has the columns of both tables and is read once: each
        task writes its rows to one folder or the other."""
        path, seen = self._new_path(table), Observation()
        wanted = {f.name: f.dataType for t in (table, faulty) for f in schemas.struct(self.store.tables[t])}
        bad = F.coalesce(F.col(fault) != "", F.lit(False))
        shaped = marked.select(*[F.col(c).cast(kind) for c, kind in wanted.items()], bad.alias("at_fault"))
        counted = shaped.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if("at_fault").alias("bad"))
        counted.write.partitionBy("at_fault").parquet(path, compression=CODEC)
        n, n_bad = self._seen(seen), self._seen(seen, "bad")
        if n_bad:
            self._stage(lambda f: False, [Folder(faulty, f"{path}/at_fault=true")])
        if n == n_bad:
            return n, self.replace_rows(table, marked.limit(0)), n_bad
        return n, self._unique(table, f"{path}/at_fault=false", n - n_bad, keys, order), n_bad

    def replace(self, table: str, df: DataFrame) -> DataFrame:
        """Make ``df`` the whole table."""
        self.replace_rows(table, df)
        return self.read(table)

    def read_part(self, table: str, open: bool) -> DataFrame:
        """The rows of a version table that may still change, or those that won't."""
        return self.store._frame(table, [f for f in self.folders if f.open == open])

    def split_open(self, table: str, flag: str) -> None:
        """Bring a version table into two kinds of folders: open ones for the rows
        where ``flag`` holds, others for the rest. Nothing to do for a table that
        :meth:`replace_open` has written."""
        settled = self.read_part(table, open=False)
        if settled.filter(flag).isEmpty():
            return
        rows = self.read(table)
        (closed, n), (still, m) = (self._write(table, rows.filter(c)) for c in (f"NOT {flag}", flag))
        into = [Folder(table, closed)] * bool(n) + [Folder(table, still, open=True)] * bool(m)
        self._stage(lambda f: f.table == table, into)

    def replace_open(self, table: str, closed: DataFrame, still_open: DataFrame) -> None:
        """Replace the open rows of a version table, and add those that were closed
        to the others, whose folders stay as they are."""
        (gone, n), (still, m) = (self._write(table, rows) for rows in (closed, still_open))
        into = [Folder(table, gone)] * bool(n) + [Folder(table, still, open=True)] * bool(m)
        self._stage(lambda f: f.table == table and f.open, into)

    def _write_months(self, path: str, shaped: DataFrame, even: bool = True) -> tuple[list[int], int]:
        """Months and number of the rows written, a folder for each month."""
        seen = Observation()
        rows = shaped.observe(seen, F.count(F.lit(1)).alias("n"))
        # Rebalancing gives even files and cuts an outsized month into several.
        rows = rows.hint("rebalance", MONTH) if even else rows
        rows.write.partitionBy(MONTH).parquet(path, compression=CODEC)
        return sorted(self.store._numbers(f"{path}/{MONTH}=*")), self._seen(seen)

    def append_months(self, table: str, df: DataFrame, ts: str = "invoice_ts") -> int:
        """Add rows, a folder for each month; their number."""
        return self.place_months(table, df, ts)[1]

    def place_months(self, table: str, df: DataFrame, ts: str = "invoice_ts") -> tuple[list[Folder], int]:
        """Add rows, a folder for each month; the folders and the number of rows. Rows are
        written from where they are: a task writes a file for every month it has rows of,
        and nothing is shuffled for that."""
        path = self._new_path(table)
        wanted = schemas.struct(f"{self.store.tables[table]}, {MONTH} int")
        keyed = df.withColumn(MONTH, month_no(F.col(ts)))
        shaped = keyed.select(*[F.col(f.name).cast(f.dataType) for f in wanted])
        months, n = self._write_months(path, shaped, even=False)
        folders = [Folder(table, path, m) for m in months]
        self._stage(lambda f: False, folders)
        return folders, n

    def withdraw(self, folders: list[Folder]) -> None:
        """Take back folders of this transaction."""
        gone = set(folders)
        self._stage(lambda f: f in gone, [])

    def read_folders(self, table: str, folders: list[Folder]) -> DataFrame:
        """The rows of some folders of a table."""
        return self.store._frame(table, folders)

    def replace_months(
        self, table: str, df: DataFrame, first: int, last: int, ts: str = "invoice_ts"
    ) -> int:
        """Replace the months ``first..last`` of a month-partitioned table by ``df``; the
        number of its rows. A month without new rows ends empty, other months stay as
        they are without being rewritten."""
        path = self._new_path(table)
        ddl = f"{self.store.tables[table]}, {MONTH} int"
        wanted = schemas.struct(ddl)
        keyed = df.withColumn(MONTH, month_no(F.col(ts)))
        shaped = keyed.select(*[F.col(f.name).cast(f.dataType) for f in wanted])
        months, n = self._write_months(path, shaped)
        self._stage(
            lambda f: f.table == table and f.month is not None and first <= f.month <= last,
            [Folder(table, path, m) for m in months],
        )
        return n

    def months(self, table: str) -> list[int]:
        return sorted({f.month for f in self.folders if f.table == table and f.month is not None})

    def drop_months_before(self, table: str, first: int) -> list[int]:
        """Forget months older than ``first``; returns them."""
        old = [m for m in self.months(table) if m < first]
        self._stage(lambda f: f.table == table and f.month in old, [])
        return old

    def stored(self) -> set[str]:
        """Tables that have folders."""
        return {f.table for f in self.folders}

    def drop(self, *tables: str) -> None:
        self._stage(lambda f: f.table in tables, [])

    def drop_layer(self, layer: str) -> None:
        self.drop(*schemas.LAYERS[layer])

    def reset_layer(self, layer: str) -> None:
        """Empty every table of a layer but keep the unknown members."""
        for table in schemas.LAYERS[layer]:
            member = schemas.DEFAULT_MEMBERS.get(table)
            if member is None:
                self.drop(table)
                continue
            id_col = schemas.SURROGATE[table]
            self.replace(table, self.read(table).filter(F.col(id_col) == member[id_col]))

    def seed_defaults(self, layer: str, stamps: dict | None = None) -> None:
        """Add missing unknown members."""

        def seed(table: str) -> None:
            member = {**schemas.DEFAULT_MEMBERS[table], **(stamps or {})}
            id_col = schemas.SURROGATE[table]
            have = self.read(table)
            if table in self.stored():
                if not have.filter(F.col(id_col) == member[id_col]).isEmpty():
                    return
            self.append(table, ensure_default_member(have.limit(0), member, id_col))

        seeded = [t for t in schemas.LAYERS[layer] if t in schemas.DEFAULT_MEMBERS]
        together(*[partial(seed, t) for t in seeded])

    def commit(self) -> int:
        """Publish the staged state as the next version."""
        rows = [(f.table, f.path, f.month, f.open) for f in self.folders] or [(None, None, None, None)]
        frame = self.spark.createDataFrame(rows, _MANIFEST)
        target = f"{self.store._manifest_dir}/version={self.version + 1}"
        taken = self.version + 1 in self.store._versions()
        frame.coalesce(1).write.mode("errorifexists" if taken else "overwrite").json(target)
        self.version += 1
        return self.version
