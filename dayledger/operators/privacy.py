"""Privacy table jobs (PII-01..PII-04)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.functions.jsonfn import json_strip_keys
from dayledger.functions.keys import hmac_sha256_hex


def drop_identifiers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PII-01: drop identifier columns, tolerating absent ones, then verify none
    is left (the DQ-21 check on the schema)."""
    out = df.drop(*[c for c in columns if c in df.columns])
    left = prohibited_columns_present(out, columns)
    if left:
        raise AssertionError(f"prohibited columns still present: {left}")
    return out


def prohibited_columns_present(df: DataFrame, banned: Sequence[str]) -> list[str]:
    """DQ-21: prohibited columns that are present (case-insensitive)."""
    low = {c.lower() for c in banned}
    return [c for c in df.columns if c.lower() in low]


def purge_outside_cohort(df: DataFrame, members: DataFrame, key: str,
                         member_key: str | None = None) -> DataFrame:
    """PII-02: keep only rows of users in the cohort mapper (left semi join);
    rows with a NULL user key are purged too."""
    mk = member_key or key
    m = members.select(F.col(mk).alias("__m")).where(F.col("__m").isNotNull())
    return df.join(m, F.col(key) == F.col("__m"), "left_semi")


def strip_payload_keys(df: DataFrame, payload_col: str, keys: Sequence[str]) -> DataFrame:
    """PII-03: remove keys from JSON objects in place; non-objects untouched."""
    return df.withColumn(payload_col, json_strip_keys(payload_col, keys))


def pseudonymize(df: DataFrame, column: str, secret: str, out_col: str | None = None) -> DataFrame:
    """PII-04: keyed HMAC-SHA256 pseudonym of an identifier (hex)."""
    return df.withColumn(out_col or column, hmac_sha256_hex(column, secret))
