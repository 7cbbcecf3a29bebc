"""Sinks and table maintenance (SNK-01..SNK-10, SNK-12).

Every operator is ``(target, batch, ...) -> DataFrame``: the *next* state of
the target, computed lazily. Committing that state is a separate step
(``commit_snapshot``) that writes a new snapshot directory and records it in
a small pointer table — a path that is being read is never overwritten, so a
job that dies mid-write leaves the previous snapshot current, and a re-run is
idempotent.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.session import scratch_path

LOADED_AT = "_loaded_at"


class DuplicateKeyError(ValueError):
    """A batch meets the same key twice; an upsert would be ambiguous."""


def as_utc(at: dt.datetime) -> dt.datetime:
    """A naive datetime given to the library means UTC (never the process zone)."""
    return at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)


def stamp_loaded(df: DataFrame, at: dt.datetime | Column, column: str = LOADED_AT) -> DataFrame:
    """SNK-07: add the load timestamp (an instant; a naive datetime is UTC);
    refuse a source that already has the column."""
    if column in df.columns:
        raise ValueError(f"cannot stamp the load time: the source has its own column {column!r}")
    value = at if isinstance(at, Column) else F.lit(as_utc(at))
    return df.withColumn(column, value.cast("timestamp"))


def duplicate_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys met more than once in ``batch`` (DQ-02 on the batch), with counts."""
    return batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def assert_unique_keys(batch: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key repeats in the batch (a distributed check; only one row
    of evidence reaches the driver)."""
    dup = duplicate_keys(batch, keys).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"batch repeats key {dup[0].asDict()}")


def full_refresh(target: DataFrame | None, batch: DataFrame, batch_is_empty: bool | None = None,
                 truncate_on_empty: bool = False) -> DataFrame:
    """SNK-01 + SNK-08: the batch replaces the target, so upstream deletes
    propagate. An empty read leaves the target alone unless asked."""
    if target is not None and not truncate_on_empty:
        empty = batch.isEmpty() if batch_is_empty is None else batch_is_empty
        if empty:
            return target
    return batch


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str],
           check_batch: bool = True) -> DataFrame:
    """SNK-02 / SNK-03: keyed upsert.

    Non-key columns (and ``_loaded_at``) of matching target rows are replaced by
    the batch row; when every column is part of the key, a batch row is only
    inserted if absent (the target row, with its original load time, stays).
    Both sides shuffle once on the key (sort-merge or, when Spark's own size
    check allows, broadcast of the batch).
    """
    keys = list(keys)
    if check_batch:
        assert_unique_keys(batch, keys)
    payload = [c for c in batch.columns if c not in keys and c != LOADED_AT]
    if not payload:
        fresh = batch.join(target.select(*keys), keys, "left_anti")
        return target.unionByName(fresh, allowMissingColumns=True)
    kept = target.join(batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def replace_window(target: DataFrame, batch: DataFrame, predicate: Column | None) -> DataFrame:
    """SNK-04: keyless idempotent load. Delete exactly the window the batch was
    read with (same predicate, same bounds), then insert. Rows for which the
    predicate is NULL are kept, as ``DELETE ... WHERE`` keeps them. A full read
    (no predicate) replaces everything."""
    if predicate is None:
        return batch
    kept = target.where(~F.coalesce(predicate, F.lit(False)))
    return kept.unionByName(batch, allowMissingColumns=True)


def typed_lit(value, dtype) -> Column:
    """A literal of a collected value with its column's type. Naive wall-clock
    values (timestamp_ntz) go through their text, so no session or process
    zone can shift them."""
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value).cast(dtype)


def window_cutoff(target: DataFrame, batch: DataFrame, window_col: str, days: int):
    """``coalesce(max(target) - days, min(batch))`` as one typed scalar (a
    single aggregate row reaches the driver). Returns (value, type)."""
    shifted = target.agg((F.max(window_col) - F.expr(f"INTERVAL {int(days)} DAYS")).alias("c"))
    dtype = shifted.schema["c"].dataType
    cut = shifted.first().c
    if cut is None:
        first = batch.agg(F.min(window_col).cast(dtype).alias("c")).first()
        cut = first.c
    return cut, dtype


def window_replace(target: DataFrame, batch: DataFrame, window_col: str, days: int,
                   restrict_batch: bool = False) -> DataFrame:
    """SNK-05: replace the trailing ``days`` window of the target.

    ``cutoff = max(target.window_col) - days`` (the batch minimum on an empty
    target); target rows at or after the cutoff go, the whole batch comes in
    (a model that reads more than its window filters its own source, or asks
    for ``restrict_batch``). Rows that vanished upstream inside the window
    disappear; partitions outside it are kept (this is *not* a dynamic
    partition overwrite). The cutoff is one scalar used as a literal in plain
    comparisons, which reach the scan of either side.
    """
    cut_value, dtype = window_cutoff(target, batch, window_col, days)
    cut = typed_lit(cut_value, dtype)
    kept = target if cut_value is None else target.where(
        (F.col(window_col) < cut) | F.col(window_col).isNull())
    fresh = batch.where(F.col(window_col) >= cut) if restrict_batch and cut_value is not None else batch
    return kept.unionByName(fresh, allowMissingColumns=True)


def evolve(target: DataFrame, batch: DataFrame,
           bookkeeping: Sequence[str] = (LOADED_AT,)) -> tuple[DataFrame, list[str], list[str]]:
    """SNK-06: schema growth. New source columns are added (NULL for old rows);
    columns the source dropped stay in the target and are no longer written.
    Returns ``(unioned, added, dropped)``."""
    tcols, bcols = set(target.columns), set(batch.columns)
    added = [c for c in batch.columns if c not in tcols]
    dropped = [c for c in target.columns if c not in bcols and c not in set(bookkeeping)]
    return target.unionByName(batch, allowMissingColumns=True), added, dropped


def observed_watermark(batch: DataFrame, expr: Column) -> DataFrame:
    """SNK-09: one-row frame with the highest watermark of the loaded batch."""
    return batch.agg(F.max(expr).alias("observed_watermark"))


def next_watermark(load_type: str, last_watermark: dt.datetime | None,
                   observed: dt.datetime | None, extracted_at: dt.datetime) -> dt.datetime | None:
    """SNK-10: the position to record after a load (``None`` = leave unchanged).

    * full refresh: the run time;
    * incremental with rows: the observed maximum;
    * first run without any position (empty, or all NULL): the source clock,
      so the table does not full-load forever;
    * nothing new: unchanged.
    """
    if load_type == "FULL_REFRESH":
        return extracted_at
    if observed is not None:
        return observed
    if last_watermark is None:
        return extracted_at
    return None


def commit_snapshot(df: DataFrame, name: str, base: str | None = None,
                    partition_by: Sequence[str] = ()) -> str:
    """SNK-12: write ``df`` as a new snapshot directory, then append a pointer
    row. Readers use ``current_snapshot``; the old snapshot is never touched
    while it may be read. Returns the new path."""
    spark = df.sparkSession
    root = (base or scratch_path(spark, "tables")).rstrip("/")
    path = f"{root}/{name}/snapshot={dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    pointer = spark.createDataFrame(
        [(name, path, dt.datetime.now(dt.UTC))],  # an instant, whatever the process zone
        "table_name string, path string, committed_at timestamp")
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/_pointers")
    return path


def current_snapshot(spark: SparkSession, name: str, base: str | None = None) -> DataFrame | None:
    """The latest committed snapshot of ``name`` (``None`` if never committed)."""
    root = (base or scratch_path(spark, "tables")).rstrip("/")
    try:
        ptr = spark.read.parquet(f"{root}/_pointers")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise  # a storage fault must not look like a first run
        return None  # no pointer table yet
    row = (ptr.where(F.col("table_name") == name)
           .agg(F.max_by("path", "committed_at").alias("path")).first())
    if row is None or row.path is None:
        return None
    return spark.read.parquet(row.path)


def materialize(df: DataFrame, name: str, base: str | None = None,
                partition_by: Sequence[str] = ()) -> DataFrame:
    """SNK-12 ``materialized='table'``: write, then read back (cuts lineage in
    the shared checkpoint folder; survives executor loss)."""
    path = commit_snapshot(df, name, base, partition_by)
    return df.sparkSession.read.parquet(path)
