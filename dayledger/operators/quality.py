"""Data-quality operators (DQ-01..DQ-09): each returns the *violating* rows,
so an empty result is a pass. All are distributed filters, anti joins or
aggregates; only ``enforce`` performs an action, and it brings at most a
handful of evidence rows to the driver."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.functions.jsonfn import json_keys


class CheckFailed(AssertionError):
    pass


def _scope(df: DataFrame, where: str | Column | None) -> DataFrame:
    return df if where is None else df.where(where)


def not_null(df: DataFrame, column: str, where: str | Column | None = None) -> DataFrame:
    """DQ-01."""
    return _scope(df, where).where(F.col(column).isNull())


def unique(df: DataFrame, columns: Sequence[str] | str, where: str | Column | None = None
           ) -> DataFrame:
    """DQ-02 ``unique`` / ``unique_combination_of_columns``: keys met more than
    once, with their count. Partial aggregation keeps a hot key cheap."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    scoped = _scope(df, where)
    if len(cols) == 1:
        scoped = scoped.where(F.col(cols[0]).isNotNull())
    return (scoped.groupBy(*cols).agg(F.count(F.lit(1)).cast("bigint").alias("n_records"))
            .where(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: Sequence, where=None) -> DataFrame:
    """DQ-03: values outside the list; NULL passes."""
    return _scope(df, where).where(~F.col(column).isin(list(values)))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str,
                  where=None) -> DataFrame:
    """DQ-04: non-NULL child keys without a parent row (anti join on non-null
    keys; never the null-aware ``NOT IN``)."""
    keys = parent.select(F.col(parent_column).alias("__parent_key")).where(
        F.col("__parent_key").isNotNull())
    child = _scope(df, where).where(F.col(column).isNotNull())
    return child.join(keys, F.col(column) == F.col("__parent_key"), "left_anti")


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None,
                   inclusive: bool = True, where=None) -> DataFrame:
    """DQ-05: rows outside ``[min, max]`` (NULL passes)."""
    c = F.col(column)
    ok = F.lit(True)
    if min_value is not None:
        ok = ok & ((c >= min_value) if inclusive else (c > min_value))
    if max_value is not None:
        ok = ok & ((c <= max_value) if inclusive else (c < max_value))
    return _scope(df, where).where(~ok)


def expression_is_true(df: DataFrame, expression: str | Column, where=None) -> DataFrame:
    """DQ-06: rows where the expression is false (a NULL result passes, as
    ``WHERE NOT (expr)`` does)."""
    e = F.expr(expression) if isinstance(expression, str) else expression
    return _scope(df, where).where(~e)


def null_rate_below(df: DataFrame, column: str, max_rate: float, where=None) -> DataFrame:
    """DQ-07: one row (n, nulls, rate) when the NULL share is at or above the
    limit; an empty relation yields no row. One global aggregate."""
    agg = _scope(df, where).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.count_if(F.col(column).isNull()).cast("bigint").alias("n_null"))
    rate = (F.col("n_null") / F.col("n_rows")).cast("double")
    return (agg.where(F.col("n_rows") > 0).withColumn("null_rate", rate)
            .where(F.col("null_rate") >= F.lit(max_rate)))


def json_key_drift(df: DataFrame, payload_col: str, allowlist: Sequence[str], where=None
                   ) -> DataFrame:
    """DQ-08: top-level keys outside the allow-list, with the rows carrying
    each. Only objects are inspected (arrays and scalars have no keys)."""
    keys = _scope(df, where).select(F.explode(json_keys(payload_col)).alias("json_key"))
    allowed = list(allowlist)
    unknown = keys.where(~F.col("json_key").isin(allowed)) if allowed else keys
    return unknown.groupBy("json_key").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


def freshness(df: DataFrame, loaded_at_col: str, as_of: dt.datetime, warn_after_hours: float,
              error_after_hours: float) -> DataFrame:
    """DQ-09: one row when ``max(loaded_at)`` is older than the warn limit,
    with the age in hours and the severity reached."""
    age = (F.unix_micros(F.lit(as_of).cast("timestamp"))
           - F.unix_micros(F.col("latest_loaded_at").cast("timestamp"))) / 3.6e9
    out = df.agg(F.max(loaded_at_col).alias("latest_loaded_at")).withColumn("age_hours", age)
    sev = (F.when(F.col("latest_loaded_at").isNull() | (F.col("age_hours") > error_after_hours),
                  "error").when(F.col("age_hours") > warn_after_hours, "warn"))
    return out.withColumn("severity", sev).where(F.col("severity").isNotNull())


def enforce(violations: DataFrame, name: str, severity: str = "error", evidence: int = 5
            ) -> list:
    """Run a check: raise on ``error`` severity when any row violates; return
    up to ``evidence`` rows either way."""
    rows = violations.limit(evidence).collect()
    if rows and severity == "error":
        raise CheckFailed(f"{name}: {len(rows)}+ violating rows, e.g. {rows[0].asDict()}")
    return rows


def require_rows(df: DataFrame, name: str) -> None:
    """A metric or model with zero rows is a failure, not a vacuous pass."""
    if df.isEmpty():
        raise CheckFailed(f"{name}: relation is empty")
