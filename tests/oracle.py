"""Local twin of the driver's correctness gate: run a registered Spark query
and its DuckDB oracle on the same parquet files, compare row count, column
names and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb
import pandas as pd

from dayledger.sources.tables import TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _canon(v, digits: int):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v.is_integer() and abs(v) < 2**53:
            return str(int(v))
        return repr(v) if digits is None else repr(round(v, digits))
    if isinstance(v, decimal.Decimal):
        return _canon(float(v), digits)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        ts = pd.Timestamp(v)
        if ts == ts.normalize():
            return ts.date().isoformat()
        return ts.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _canon(v.item(), digits)
    return str(v)


def canon_rows(pdf: pd.DataFrame, digits: int = 6) -> list[tuple]:
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pdf[cols].notna(), None)
    return sorted(tuple(_canon(v, digits) for v in row) for row in pdf.itertuples(index=False))


def digest(rows: list[tuple]) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update(repr(r).encode())
    return h.hexdigest()


def compare(spark_df, sql: str, sf_dir: str, digits: int | None = 6) -> dict:
    left = spark_df.toPandas()
    right = duck(sf_dir).execute(sql).fetchdf()
    out = {"rows_spark": len(left), "rows_oracle": len(right),
           "columns_match": sorted(left.columns) == sorted(right.columns)}
    if not out["columns_match"]:
        out["columns_spark"] = sorted(left.columns)
        out["columns_oracle"] = sorted(right.columns)
        out["match"] = False
        return out
    lr, rr = canon_rows(left, digits), canon_rows(right, digits)
    out["match"] = lr == rr
    if not out["match"]:
        ls, rs = set(lr), set(rr)
        out["only_spark"] = sorted(ls - rs)[:3]
        out["only_oracle"] = sorted(rs - ls)[:3]
    return out
