"""Partitioned tables with manifest commits (SNK-02..05, SNK-12): by date, or by
the hash of a key.

A table is a folder of commits; a commit holds the partition folders that it
wrote, and a manifest names the folders that make up the table from then on. A
commit that touches seven days writes seven days and names all other folders as
they are: nothing that it does not touch is read or copied. A manifest is complete
before a pointer row makes it current, and no folder is ever written twice, so a
job that dies leaves the last table in place, and a task that runs again after
the loss of its executor is settled by Spark's own committer.

Layout under ``<base>/<name>``::

    data/commit=<id>/<partition column>=<value>/part-*.parquet
    manifests/<id>/part-*.parquet        (partition_value, path), a row a folder

A table has as many manifest rows as partitions (days), read on the driver; the
data are read by tasks alone. A partition value may have several folders: an
insert into an old day adds one and leaves the others.
"""

from __future__ import annotations

import datetime as dt
import re
import urllib.parse
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.operators.sinks import LOADED_AT, assert_unique_keys, typed_lit, upsert
from dayledger.session import scratch_path

MANIFEST = "partition_value string, path string"
POINTER = "manifest string, committed_at timestamp, note string"
#: How Spark names the folder of NULL partition values.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Folder:
    """A partition folder of the current table."""

    value: str | None
    path: str


class PartitionedTable:
    """A table partitioned by the date column ``column``."""

    kind = "date"

    def __init__(self, spark: SparkSession, name: str, column: str, base: str | None = None):
        self.spark, self.name, self.column = spark, name, column
        self.root = f"{(base or scratch_path(spark, 'tables')).rstrip('/')}/{name}"

    # -- reading ---------------------------------------------------------------

    def _pointers(self) -> list[dict]:
        """Commits, the current one last: manifest and note."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_pointers")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):  # a storage fault raises
            return []
        rows = self.spark.read.schema(POINTER).parquet(f"{self.root}/_pointers")
        return rows.orderBy("committed_at", "manifest").select("manifest", "note").toArrow().to_pylist()

    def notes(self) -> set[str]:
        """The notes of all commits: a writer that notes its batch id knows which
        batches the table has, since note and table become current in one row."""
        return {p["note"] for p in self._pointers() if p["note"] is not None}

    def _named(self, manifest: str) -> list[Folder]:
        rows = self.spark.read.schema(MANIFEST).parquet(manifest).toArrow().to_pylist()
        return sorted((Folder(r["partition_value"], r["path"]) for r in rows), key=lambda f: (f.value is not None, f.value or "", f.path))

    def folders(self) -> list[Folder] | None:
        """The folders of the current table; ``None`` if it was never committed."""
        pointers = self._pointers()
        return self._named(pointers[-1]["manifest"]) if pointers else None

    def _read(self, folders: list[Folder], schema) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("basePath", f"{self.root}/data")
                .parquet(*[f.path for f in folders]).select(*schema.names))

    def _schema(self, folders: list[Folder]):
        """Of the newest folder: columns added later are NULL in older ones."""
        newest = max(folders, key=lambda f: re.search(r"commit=([^/]+)", f.path)[1])
        found = self.spark.read.option("basePath", f"{self.root}/data").parquet(newest.path).drop("commit")
        return found.withColumn(self.column, F.col(self.column).cast(self.kind)).schema

    def read(self) -> DataFrame | None:
        """The current table; its scan is pruned by predicates on the date column."""
        folders = self.folders()
        return self._read(folders, self._schema(folders)) if folders else None

    # -- writing ---------------------------------------------------------------

    def _write(self, rows: DataFrame) -> list[Folder]:
        """Write rows as the folders of a new commit. Rebalancing gives a day few
        files and splits a day that holds most of the rows."""
        commit = f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/data/commit={commit}"
        rows.hint("rebalance", self.column).write.mode("errorifexists").partitionBy(self.column).parquet(path)
        store = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        files = store.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(store) if s.isDirectory()]
        found = []
        for name in names:
            if name.startswith(f"{self.column}="):
                value = urllib.parse.unquote(name.partition("=")[2])
                found.append(Folder(None if value == NULL_FOLDER else value, f"{path}/{name}"))
        return found

    def _commit(self, folders: list[Folder], retain: int | None, note: str | None = None) -> str:
        manifest = f"{self.root}/manifests/{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        rows = self.spark.createDataFrame([(f.value, f.path) for f in folders], MANIFEST)
        rows.coalesce(1).write.mode("errorifexists").parquet(manifest)
        self.spark.createDataFrame([(manifest, dt.datetime.now(dt.UTC), note)], POINTER).coalesce(1).write.mode("append").parquet(f"{self.root}/_pointers")
        if retain is not None:
            self.expire(retain)
        return manifest

    def replace_all(self, rows: DataFrame, retain: int | None = None) -> list[Folder]:
        """A full rebuild: only the rows given make up the table. Returns what was written."""
        new = self._write(rows)
        self._commit(new, retain)
        return new

    def replace_partitions(self, rows: DataFrame, touched, retain: int | None = None, note: str | None = None) -> list[Folder]:
        """The folders whose value ``touched`` accepts go, the rows come in; all
        other folders stay by name. Returns what was written."""
        kept = [f for f in self.folders() or [] if not touched(f.value)]
        new = self._write(rows)
        self._commit(kept + new, retain, note)
        return new

    def window_cutoff(self, window_col: str, days: int):
        """``max(window_col) - days`` from the folders of the last date alone
        (an earlier one where that holds no value). Returns (value, type)."""
        folders = self.folders() or []
        if not folders:
            return None, None
        schema = self._schema(folders)
        for value in sorted({f.value for f in folders if f.value is not None}, reverse=True):
            last = self._read([f for f in folders if f.value == value], schema)
            cut = last.agg((F.max(window_col) - F.expr(f"INTERVAL {int(days)} DAYS")).cast(schema[window_col].dataType).alias("c")).first().c
            if cut is not None:
                return cut, schema[window_col].dataType
        return None, schema[window_col].dataType

    def replace_window(self, batch_since, window_col: str, days: int, day_of=None, retain: int | None = None) -> list[Folder]:
        """SNK-05: rows from ``max(window_col) - days`` on go and the batch comes
        in. ``batch_since(cutoff)`` gives the batch from the cutoff's value on (``None``:
        all of it, there is no table yet); ``day_of`` maps that value to its date
        where the partition column is not ``window_col`` itself. Only folders
        from that date on are read and written anew; the rows of that first date
        before the cutoff move along. Batch rows of older dates are added to them."""
        cut, kind = self.window_cutoff(window_col, days)
        if cut is None:
            return self.replace_all(batch_since(None), retain)
        first = str(day_of(cut) if day_of else cut)
        touched = lambda value: value is not None and value >= first
        folders = self.folders()
        at: Column = typed_lit(cut, kind)
        batch = batch_since(cut)
        old = self._read([f for f in folders if touched(f.value)], self._schema(folders))
        kept = old.where((F.col(window_col) < at) | F.col(window_col).isNull())
        return self.replace_partitions(kept.unionByName(batch, allowMissingColumns=True), touched, retain)

    def replace_rows(self, batch: DataFrame, gone: Column, first: dt.date, retain: int | None = None) -> list[Folder]:
        """SNK-04: rows for which ``gone`` is true go, the batch comes in; rows for which
        it is NULL stay. ``gone`` must be false before the date ``first``, so that
        only folders from that date on are read and written anew."""
        folders = self.folders() or []
        touched = lambda value: value is not None and value >= str(first)
        old = [f for f in folders if touched(f.value)]
        if old:
            kept = self._read(old, self._schema(folders)).where(~F.coalesce(gone, F.lit(False)))
            batch = kept.unionByName(batch, allowMissingColumns=True)
        return self.replace_partitions(batch, touched, retain)

    def expire(self, retain: int) -> int:
        """Remove folders that none of the last ``retain`` manifests names; an explicit decision, never part of a plain commit.
        Readers of an expired manifest lose their files. Returns folders removed."""
        if retain < 1:
            raise ValueError("the current table must be retained")
        pointers = self._pointers()
        named = {f.path for p in pointers[-retain:] for f in self._named(p["manifest"])}
        files_of = lambda p: p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        data, gone = path(f"{self.root}/data"), 0
        for commit in files_of(data).listStatus(data):
            for folder in files_of(data).listStatus(commit.getPath()):
                where = f"{self.root}/data/{commit.getPath().getName()}/{folder.getPath().getName()}"
                if folder.isDirectory() and where not in named:
                    files_of(data).delete(folder.getPath(), True)
                    gone += 1
        return gone


class BucketedTable(PartitionedTable):
    """A keyed table dealt into ``buckets`` folders by the hash of its key (SNK-02,
    SNK-03). An upsert reads and writes the buckets that its batch meets; all
    others stay by name. The number of buckets is the table's for good: choose it
    so that a bucket is a few hundred MB at the size to come."""

    kind = "int"
    BUCKET = "_bucket"

    def __init__(self, spark: SparkSession, name: str, keys, buckets: int = 64, base: str | None = None):
        super().__init__(spark, name, self.BUCKET, base)
        self.keys, self.buckets = list(keys), buckets

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(self.BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def read(self) -> DataFrame | None:
        found = super().read()
        return None if found is None else found.drop(self.BUCKET)

    def replace_all(self, rows: DataFrame, retain: int | None = None) -> list[Folder]:
        return super().replace_all(self._dealt(rows), retain)

    def upsert(self, batch: DataFrame, check_batch: bool = True, retain: int | None = None, note: str | None = None) -> list[Folder]:
        """Rows of the batch replace the target's of equal key, or are added. A batch
        of nothing but keys adds the absent ones, in new folders beside the old
        ones. ``batch`` is read several times: give a written one. Keys must not be NULL."""
        if check_batch:
            assert_unique_keys(batch, self.keys)
        folders = self.folders() or []
        dealt = self._dealt(batch)
        met = {str(r[self.BUCKET]) for r in dealt.select(self.BUCKET).distinct().toArrow().to_pylist()}  # at most ``buckets``
        touched = lambda value: value in met
        old = [f for f in folders if touched(f.value)]
        if not old:
            return self.replace_partitions(dealt, touched, retain, note)
        current = self._read(old, self._schema(folders))
        if all(c in self.keys or c == LOADED_AT for c in batch.columns):
            fresh = dealt.join(current.select(*self.keys), self.keys, "left_anti")
            return self.replace_partitions(fresh, lambda value: False, retain, note)
        return self.replace_partitions(upsert(current, dealt, self.keys, check_batch=False), touched, retain, note)
