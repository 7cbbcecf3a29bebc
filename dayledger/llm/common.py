"""Small helpers of the training-data operators: table access, scratch tables
in the shared folder, and arrow batches inside tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.session import scratch_path


#: Bytes of one Arrow batch. Spark's own bound (64 MB) is held several times over by
#: each running task, in the JVM's buffers and in its worker.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20)


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes for the plans of this session, where the user
    has set no bound (long texts fill 64 MB with a few rows)."""
    if spark.conf.get(BATCH_SETTING, str(64 << 20)) == str(64 << 20):
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table (the scan is pruned to them)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def new_path(spark: SparkSession, what: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    return scratch_path(spark, "llm", f"{what}-{uuid.uuid4().hex[:16]}")


#: Spark drops an execution's shuffle files when it ends, not when the driver
#: happens to collect its garbage.
DROP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, what: str, **options: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: cuts the lineage
    so that a lost executor costs a read, and several consumers share the work.
    The shuffle files of the write go with its end."""
    spark = df.sparkSession
    path = new_path(spark, what)
    before = spark.conf.get(DROP_SETTING, "false")
    spark.conf.set(DROP_SETTING, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(DROP_SETTING, before)
    return spark.read.schema(df.schema).parquet(path)


def most_frequent(counts: DataFrame, n: str, entries: int) -> DataFrame:
    """The rows of a written table of counts that are among the most frequent:
    as many whole sixteenths of a power of two as hold at most ``entries`` rows
    together. One small aggregate finds the level; no task sorts or holds more
    than its own rows."""
    level = F.floor(F.log2(n) * 16)
    sizes = counts.where(F.col(n) > 0).groupBy(level.alias("level")).agg(F.count("*").alias("rows")).orderBy(F.desc("level")).toArrow().to_pylist()
    least, held = None, 0
    for row in sizes:  # at most 1,024 levels
        held += row["rows"]
        if held > entries:
            break
        least = row["level"]
    return counts.where(level >= least) if least is not None else counts.limit(0)


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """The batches cut into runs of whole rows of about ``max_bytes`` of text
    (a longer text stands alone), with the text column as large_string and
    nulls as empty text."""
    import numpy as np

    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string()).fill_null("")
        ends = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
        at = 0
        while at < len(col):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + max_bytes, side="right")) - 1)
            yield batch.slice(at, to - at), col.slice(at, to - at)
            at = to


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch from named columns in the schema's order."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def worker_cache(key: str, make):
    """An object kept for the life of a Python worker (it outlives tasks); made
    on first use. Holds only what can be made again."""
    import sys
    import types

    home = sys.modules.setdefault("_dayledger_worker", types.ModuleType("_dayledger_worker"))
    if key not in home.__dict__:
        home.__dict__[key] = make()
    return home.__dict__[key]


def fresh_worker() -> None:
    """Drop what earlier operators keep in this worker, which outlives its tasks,
    and hand the memory back to the system. For tasks that need room; the caches
    are made again where they are used."""
    import ctypes
    import gc
    import sys

    home = sys.modules.get("_dayledger_worker")
    kept = [k for k in vars(home) if not k.startswith("__")] if home else []
    for key in kept:
        delattr(home, key)
    if kept:
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library: it keeps what it keeps
            pass
