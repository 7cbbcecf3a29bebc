"""One landing run of a target (SRC-01..08, SRC-13, SNK-01..04, SNK-09..11).

A run reads the target's stored position, reads the source from there, writes
the batch once, merges it and stores the new position:

1. the window starts at the position less the wider of the run's overlap and the
   target's lookback (no bound on a first run) and ends at an inclusive bound;
2. the batch is written to the shared folder by one job, which also takes the
   highest position, the number of rows and of rows without a key by
   ``DataFrame.observe``: no second pass over the source or the batch;
3. keyed targets upsert the buckets that the batch meets; targets without a key
   delete the window that was read and insert; a full refresh replaces the table
   unless it read nothing;
4. the control table gets the position only now. If anything before fails, it
   gets the error and keeps the position, so that the next run reads the same
   window again; the batch's merge is idempotent.

The control table is a stored snapshot, a row a target. Two runs at one time on
one target are not supported (as with the reference); runs of different targets
must hand their control rows to one writer.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dayledger.operators import sinks as K
from dayledger.operators import watermarks as WM
from dayledger.operators.partitioned import BucketedTable, PartitionedTable
from dayledger.session import scratch_path
from dayledger.sources import landing as L

FULL_REFRESH, INCREMENTAL = "FULL_REFRESH", "INCREMENTAL"
#: Partition column of landed tables without a key: the date of their position.
LANDED_DAY = "_landed_day"


class KeyMissing(ValueError):
    """The batch holds rows without a key."""


@dataclass(frozen=True)
class Target:
    """A table to land. ``watermark_col`` with ``fallback_col`` is its position;
    ``lookback_days`` re-reads rows that a source back-dates; ``cohort_key`` limits
    it to given members."""

    source_system: str
    schema_name: str
    table_name: str
    load_type: str = INCREMENTAL
    watermark_col: str | None = None
    fallback_col: str | None = None
    keys: Sequence[str] = ()
    lookback_days: int | None = None
    exclude: Sequence[str] = ()
    cohort_key: str | None = None
    truncate_on_empty: bool = False
    buckets: int = 64

    @property
    def key(self) -> tuple[str, str, str]:
        return self.source_system, self.schema_name, self.table_name

    @property
    def label(self) -> str:
        return ".".join(self.key)

    def __post_init__(self):
        if self.load_type == INCREMENTAL and not self.watermark_col:
            raise ValueError(f"{self.label}: an incremental target needs a position column")


@dataclass(frozen=True)
class Landed:
    """What a run did: rows of the batch, the position stored, folders written."""

    label: str
    ok: bool
    rows: int = 0
    position: dt.datetime | None = None
    folders: int = 0
    error: str | None = None


class Landing:
    """Landed tables and their control table under ``base``."""

    def __init__(self, spark: SparkSession, base: str | None = None):
        self.spark, self.base = spark, (base or scratch_path(spark, "landing")).rstrip("/")

    def control(self) -> DataFrame:
        """The stored control table; empty before the first run."""
        found = K.current_snapshot(self.spark, "control", self.base)
        return WM.empty_control(self.spark) if found is None else found

    def position(self, target: Target) -> dt.datetime | None:
        """The stored position as a UTC wall clock (whatever zones are set)."""
        mine = F.lit(True)
        for name, value in zip(WM.KEY, target.key, strict=True):
            mine = mine & (F.col(name) == value)
        row = self.control().where(mine).select(F.unix_micros("watermark_value").alias("at")).first()
        return None if row is None or row["at"] is None else dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=row["at"])

    def _table(self, target: Target) -> PartitionedTable:
        if target.keys and target.load_type == INCREMENTAL:
            return BucketedTable(self.spark, target.label, target.keys, target.buckets, self.base)
        return PartitionedTable(self.spark, target.label, LANDED_DAY, self.base)

    def table(self, target: Target) -> DataFrame | None:
        """The landed rows of a target (``None`` before its first load)."""
        found = self._table(target).read()
        return None if found is None else found.drop(LANDED_DAY)

    def _batch(self, target: Target, source: DataFrame, members: DataFrame | None, window: L.Window | None) -> DataFrame:
        position = [c for c in (target.watermark_col, target.fallback_col) if c]
        rows = L.exclude_columns(source, target.exclude, target.keys, position) if target.exclude else source
        if target.cohort_key:
            if members is None:
                raise ValueError(f"{target.label}: its members are not given")
            rows = L.cohort_filter(rows, members, target.cohort_key, members.columns[0])
        return rows if window is None else L.read_incremental(rows, window)

    def run(self, target: Target, source: DataFrame, at: dt.datetime, overlap: dt.timedelta | None = None,
            upper: dt.datetime | None = None, members: DataFrame | None = None) -> Landed:
        """Land what is new in ``source`` (a frame over the source table) at the
        clock ``at`` of the source. Raises after a failure is recorded."""
        try:
            return self._run(target, source, at, overlap, upper, members)
        except Exception as error:
            told = f"{type(error).__name__}: {error}".splitlines()[0][:500]
            K.commit_snapshot(WM.record_failure(self.control(), target.key, told, at), "control", self.base)
            raise

    def _run(self, target, source, at, overlap, upper, members) -> Landed:
        known = self.position(target)
        window, position = None, F.lit(None).cast("timestamp_ntz")
        if target.load_type == INCREMENTAL:
            position = L.watermark_expr(target.watermark_col, target.fallback_col)
            window = L.plan_window(known, position, L.lookback(overlap, target.lookback_days), upper)
        batch = K.stamp_loaded(self._batch(target, source, members, window), at)
        no_key = F.lit(False)
        for c in target.keys:
            no_key = no_key | F.col(c).isNull()
        seen = Observation()
        watched = batch.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(no_key).alias("no_key"),
                                F.max(position.cast("timestamp_ntz")).alias("position"))
        path = f"{self.base}/_batches/{target.label}/{uuid.uuid4().hex}"
        watched.write.parquet(path)
        found = seen.get
        if found["no_key"]:
            raise KeyMissing(f"{target.label}: {found['no_key']} of {found['rows']} rows have no key")
        landed = self.spark.read.schema(batch.schema).parquet(path)
        folders = self._merge(target, landed, window, position, found["rows"])
        moved = K.next_watermark(target.load_type, known, found["position"], at)
        stored = known if moved is None else moved
        control = WM.record_success(self.control(), target.key, stored, found["rows"], at)
        K.commit_snapshot(control, "control", self.base)
        return Landed(target.label, True, found["rows"], stored, folders)

    def _merge(self, target: Target, landed: DataFrame, window, position, rows: int) -> int:
        table = self._table(target)
        if isinstance(table, BucketedTable):
            return len(table.upsert(landed)) if rows else 0
        dated = landed.withColumn(LANDED_DAY, F.to_date(position) if window is not None else F.lit(None).cast("date"))
        if window is None or window.is_full_read:
            # a full refresh that read nothing leaves the table alone unless asked
            if window is None and not rows and not target.truncate_on_empty and table.folders():
                return 0
            return len(table.replace_all(dated))
        return len(table.replace_rows(dated, window.predicate, window.lower.date()))

    def run_all(self, jobs: Iterable[tuple[Target, DataFrame]], at: dt.datetime, fail_fast: bool = False, **options) -> list[Landed]:
        """One run a target, in turn. A broken target does not stop the others
        unless asked; its error is in its control row and in the result."""
        done = []
        for target, source in jobs:
            try:
                done.append(self.run(target, source, at, **options))
            except Exception as error:  # noqa: BLE001 - recorded; the next target is independent
                if fail_fast:
                    raise
                done.append(Landed(target.label, False, error=f"{type(error).__name__}: {error}".splitlines()[0][:500]))
        return done
