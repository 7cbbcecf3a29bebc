"""Structured Streaming forms of the late-data operators (STR-01..STR-04).

* STR-01  late arrivals: ``withWatermark(event time, lookback)`` — state for a
          day is kept until the watermark passes it by the lookback (30 days).
* STR-02  the daily local-day aggregate recomputed while late rows arrive:
          ``window(ts, '1 day', '1 day', '15 hours')`` (15:00 UTC = local
          midnight) in update mode.
* STR-03  idempotent landing: ``foreachBatch`` writes each micro-batch under
          its batch id (a replayed batch overwrites its own folder) and the
          checkpoint commits the position only after the write.
* STR-04  duplicate payload collapse keeping multiplicity (a grouped count
          with a watermark, not ``dropDuplicates``, which would lose it).

Runs use ``trigger(availableNow=True)``; checkpoints and outputs live under the
shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayledger.functions.timeutil import BUSINESS_ZONE, instant_to_naive, naive_to_instant
from dayledger.operators.partitioned import BucketedTable
from dayledger.session import scratch_path

LOCAL_DAY_OFFSET = "15 hours"  # local midnight in UTC for a UTC+9 zone
DEFAULT_LATENESS = "30 days"


def table_stream(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None, event_time: str | None = "ts",
                 glob: str | None = None) -> DataFrame:
    """A file stream over one driver table (new files are new micro-batches;
    ``glob`` admits several arrival files such as ``events*.parquet``).
    A naive ``event_time`` column (UTC wall clock) is turned into an instant,
    which is what watermarks require."""
    # a glob names the table, so it may be one file or a folder of part files
    path = f"{sf_dir.rstrip('/')}/{glob or f'[{name[0]}]{name[1:]}.parquet'}"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.parquet(path)
    if event_time and dict(df.dtypes).get(event_time) == "timestamp_ntz":
        df = df.withColumn(event_time, naive_to_instant(event_time))
    return df


def daily_local_aggregate(stream: DataFrame, ts_col: str = "ts", key_cols: Sequence[str] = ("event_type",),
                          value_col: str = "value", lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """STR-01/02: per local day and key: count and decimal sum, updated as late
    rows arrive within the lateness bound."""
    w = F.window(ts_col, "1 day", "1 day", LOCAL_DAY_OFFSET)
    return (stream.withWatermark(ts_col, lateness)
            .groupBy(w.alias("day_window"), *key_cols)
            .agg(F.count(F.lit(1)).alias("n_samples"),
                 F.sum(F.col(value_col).cast("decimal(18,2)")).alias("value_sum")))


def payload_multiplicity(stream: DataFrame, payload: Sequence[str], ts_col: str,
                         lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """STR-04: distinct payload with its multiplicity (state per payload,
    evicted once the watermark passes its event time)."""
    return (stream.withWatermark(ts_col, lateness).groupBy(*payload)
            .agg(F.count(F.lit(1)).alias("source_row_count")))


def _batch_writer(out: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch id, overwritten on replay -> idempotent.
        (batch.withColumn("_batch_id", F.lit(batch_id))
         .write.mode("overwrite").parquet(f"{out}/_batch_id={batch_id}"))
    return write


def run_available_now(agg: DataFrame, name: str, base: str | None = None,
                      output_mode: str = "update", report: dict | None = None) -> str:
    """STR-03: run a streaming aggregate to completion over what is available,
    writing every micro-batch through ``foreachBatch``. Returns the output path;
    with the same ``base`` a later run goes on where this one ended. ``report``
    gets ``rows_behind_watermark``: how many late rows this run left out."""
    spark = agg.sparkSession
    root = (base or scratch_path(spark, "streams", f"{name}-{uuid.uuid4().hex[:10]}")).rstrip("/")
    out = f"{root}/batches"
    _run(agg, _batch_writer(out), root, output_mode, report)
    return out


def _run(agg: DataFrame, write, root: str, output_mode: str, report: dict | None) -> None:
    """Run a query over what is available. Progress is read at every batch, since
    Spark keeps the last hundred records only."""
    late: dict[int, int] = {}
    query = []

    def note_progress() -> None:
        for p in query[0].recentProgress if query else []:
            late[p.batchId] = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)

    def each(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        note_progress()

    query.append(agg.writeStream.outputMode(output_mode).foreachBatch(each).option("checkpointLocation", f"{root}/checkpoint")
                 .trigger(availableNow=True).start())
    query[0].awaitTermination()
    note_progress()
    if report is not None:
        report["rows_behind_watermark"] = sum(late.values())


def run_into_table(agg: DataFrame, keys: Sequence[str], name: str, base: str | None = None, buckets: int = 16,
                   report: dict | None = None, retain: int | None = 2) -> BucketedTable:
    """STR-03 exactly once: every micro-batch of an update-mode aggregate is upserted
    into a bucketed table whose commit notes the batch id. A batch that is replayed
    after a failure is found among the notes and merged no second time (it is run to
    nowhere, for the query's own state to move on); readers see the table after whole batches. Reading costs the
    table, not the batches ever written; ``retain`` commits stay readable.

    The ledger holds a row a batch (compact it with the checkpoint's own log)."""
    spark = agg.sparkSession
    root = (base or scratch_path(spark, "streams", f"{name}-{uuid.uuid4().hex[:10]}")).rstrip("/")
    table = BucketedTable(spark, name, keys, buckets, root)
    done = table.notes()

    def write(batch: DataFrame, batch_id: int) -> None:
        if str(batch_id) in done:
            batch.write.format("noop").mode("overwrite").save()
            return
        rows = batch.persist()  # read for the buckets, the keys and the write
        try:
            table.upsert(rows, retain=retain, note=str(batch_id))
        finally:
            rows.unpersist()
        done.add(str(batch_id))

    _run(agg, write, root, "update", report)
    return table


def daily_table(spark: SparkSession, sf_dir: str, lateness: str = DEFAULT_LATENESS, max_files_per_trigger: int | None = None,
                base: str | None = None, report: dict | None = None) -> DataFrame:
    """STR-02/03 into a table: a row a local day and event type, upserted as late
    rows arrive."""
    agg = daily_local_aggregate(table_stream(spark, sf_dir, "events", max_files_per_trigger), lateness=lateness)
    flat = agg.select(F.col("day_window.start").alias("window_start"), "event_type", "n_samples", "value_sum")
    found = run_into_table(flat, ["window_start", "event_type"], "daily", base, report=report).read()
    return found.select(instant_to_naive("window_start").alias("window_start"),
                        F.to_date(instant_to_naive("window_start", BUSINESS_ZONE)).alias("local_date"),
                        "event_type", "n_samples", F.col("value_sum").cast("double").alias("value_sum"))


def latest_per_key(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """Fold the update-mode batches: the row of the latest batch per key."""
    df = spark.read.parquet(out)
    w = Window.partitionBy(*keys).orderBy(F.col("_batch_id").desc())
    return (df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1")
            .drop("__rn", "_batch_id"))


def streamed_daily_aggregate(spark: SparkSession, sf_dir: str, lateness: str = DEFAULT_LATENESS,
                             max_files_per_trigger: int | None = None, base: str | None = None,
                             report: dict | None = None) -> DataFrame:
    """STR-02 end to end over the events table: local day start, type, count,
    sum — equal to the batch aggregate once all rows have arrived."""
    agg = daily_local_aggregate(table_stream(spark, sf_dir, "events", max_files_per_trigger), lateness=lateness)
    out = run_available_now(agg, "daily", base, report=report)
    res = latest_per_key(spark, out, ["day_window", "event_type"])
    return res.select(instant_to_naive("day_window.start").alias("window_start"),
                      F.to_date(instant_to_naive("day_window.start", BUSINESS_ZONE)).alias("local_date"),
                      "event_type", "n_samples", F.col("value_sum").cast("double").alias("value_sum"))


def streamed_payload_multiplicity(spark: SparkSession, sf_dir: str, lateness: str = DEFAULT_LATENESS,
                                  max_files_per_trigger: int | None = None, base: str | None = None,
                                  report: dict | None = None) -> DataFrame:
    """STR-04 end to end: (user, event time, type, rounded value) payload
    multiplicity from the event stream."""
    s = table_stream(spark, sf_dir, "events", max_files_per_trigger).select(
        "user_id", "ts", "event_type", F.round("value").cast("bigint").alias("value_rounded"))
    payload = ["user_id", "ts", "event_type", "value_rounded"]
    out = run_available_now(payload_multiplicity(s, payload, "ts", lateness), "multiplicity", base, report=report)
    return latest_per_key(spark, out, payload).withColumn("ts", instant_to_naive("ts"))
