"""The landing control table (SRC-13, SNK-11): one row per target keyed by
(source_system, schema_name, table_name)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.operators.sinks import as_utc, upsert

KEY = ("source_system", "schema_name", "table_name")
SCHEMA = ("source_system string, schema_name string, table_name string, "
          "watermark_value timestamp, last_status string, last_error string, "
          "row_count bigint, updated_at timestamp")


def empty_control(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def _row(spark: SparkSession, values: tuple) -> DataFrame:
    vals = tuple(as_utc(v) if isinstance(v, dt.datetime) else v for v in values)
    return spark.createDataFrame([vals], SCHEMA)


def record_success(control: DataFrame, target: tuple[str, str, str],
                   watermark: dt.datetime | None, row_count: int | None,
                   at: dt.datetime) -> DataFrame:
    """Upsert a SUCCESS row: new position, error cleared, row count, time."""
    batch = _row(control.sparkSession, (*target, watermark, "SUCCESS", None, row_count, at))
    return upsert(control, batch, KEY, check_batch=False)


def record_failure(control: DataFrame, target: tuple[str, str, str], error: str,
                   at: dt.datetime) -> DataFrame:
    """Mark FAILED with the error and bump ``updated_at``; the position and row
    count stay (NULL on a first run), so the next run resumes from the last
    good position instead of looking like a first run."""
    spark = control.sparkSession
    fresh = _row(spark, (*target, None, "FAILED", error, None, at))
    match = (F.col("source_system") == target[0]) & (F.col("schema_name") == target[1]) & (
        F.col("table_name") == target[2])
    existing = control.where(match)
    updated = existing.select(*KEY, "watermark_value", F.lit("FAILED").alias("last_status"),
                              F.lit(error).alias("last_error"), "row_count",
                              F.lit(as_utc(at)).cast("timestamp").alias("updated_at"))
    inserted = fresh.join(existing.select(*KEY), list(KEY), "left_anti")
    return control.where(~match).unionByName(updated).unionByName(inserted)


def last_watermark(control: DataFrame, target: tuple[str, str, str]) -> dt.datetime | None:
    """Position lookup; deliberately ignores the status (a failed run must not
    turn the next run into a full reload)."""
    row = (control.where((F.col("source_system") == target[0])
                         & (F.col("schema_name") == target[1])
                         & (F.col("table_name") == target[2]))
           .select("watermark_value").first())
    return None if row is None else row.watermark_value
