"""Seeds, inline relations and generated calendars (SRC-10..SRC-12)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.functions.timeutil import date_series


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC-10: CSV seed with declared column types (never inferred); a value
    that does not fit its type fails the read. CSV cannot tell an empty string
    from NULL: an empty field, quoted or not, reads as NULL (which is why data
    lands as Parquet, never through CSV)."""
    return (spark.read.schema(schema).option("header", True)
            .option("mode", "FAILFAST").csv(path))


def values_df(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """SRC-11: an inline VALUES relation. Only for lists fixed by a model
    definition (dependency lists, code tables) — never for data."""
    return spark.createDataFrame(list(rows), schema)


def date_spine(spark: SparkSession, lo: dt.date | str, hi: dt.date | str,
               column: str = "date_day") -> DataFrame:
    """SRC-12: one row per day in ``[lo, hi]`` from ``explode(sequence)``; empty if
    ``lo > hi``. Size is bounded by the date span, not by the data volume."""
    one = spark.range(1).select(F.to_date(F.lit(str(lo))).alias("lo"),
                                F.to_date(F.lit(str(hi))).alias("hi"))
    return one.select(F.explode(date_series("lo", "hi")).alias(column))


def date_spine_between(bounds: DataFrame, lo: str, hi: str, column: str = "date_day") -> DataFrame:
    """SRC-12 with bounds taken from a (one-row) DataFrame, e.g. min/max dates
    of a table — no ``collect`` needed."""
    return bounds.select(F.explode(date_series(lo, hi)).alias(column))
