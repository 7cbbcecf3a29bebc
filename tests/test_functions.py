"""Scalar helpers and their traps."""

from __future__ import annotations

import datetime as dt
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from dayledger.functions import jsonfn as J
from dayledger.functions import keys as K
from dayledger.functions import timeutil as tu


def one(spark, expr, **cols):
    """Evaluate a Column expression over a one-row frame of literals."""
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(
        f"{k} {_t(v)}" for k, v in cols.items())) if cols else spark.range(1)
    return df.select(expr.alias("r")).first().r


def _t(v):
    if isinstance(v, dt.datetime):
        return "timestamp_ntz"
    if isinstance(v, dt.date):
        return "date"
    if isinstance(v, int):
        return "bigint"
    if isinstance(v, float):
        return "double"
    return "string"


def test_local_date_changes_after_15_utc(spark):
    assert one(spark, tu.local_date("ts"), ts=dt.datetime(2024, 1, 1, 14, 59, 59)) == dt.date(2024, 1, 1)
    assert one(spark, tu.local_date("ts"), ts=dt.datetime(2024, 1, 1, 15, 0, 0)) == dt.date(2024, 1, 2)
    assert one(spark, tu.local_date("ts"), ts=dt.datetime(2024, 1, 1, 23, 59, 59)) == dt.date(2024, 1, 2)


@pytest.mark.parametrize("a,b,months", [
    (dt.date(2024, 2, 29), dt.date(2024, 1, 31), 0),   # month end trap
    (dt.date(2024, 3, 31), dt.date(2024, 2, 29), 1),
    (dt.date(2024, 3, 30), dt.date(2024, 1, 31), 1),
    (dt.date(2024, 1, 31), dt.date(2024, 1, 31), 0),
    (dt.date(2025, 1, 15), dt.date(2024, 1, 15), 12),
    (dt.date(2024, 1, 14), dt.date(2024, 3, 15), -2),  # negative: minus age(b, a)
    (dt.date(2024, 1, 31), dt.date(2024, 2, 29), 0),
])
def test_whole_months_matches_age(spark, a, b, months):
    assert one(spark, tu.whole_months("a", "b"), a=a, b=b) == months


def test_whole_months_against_duckdb_age(spark):
    import duckdb
    import random
    rnd = random.Random(7)
    base = dt.date(2020, 1, 1)
    pairs = [(base + dt.timedelta(days=rnd.randrange(2000)), base + dt.timedelta(days=rnd.randrange(2000)))
             for _ in range(3000)]
    df = spark.createDataFrame(pairs, "a date, b date")
    got = [r.m for r in df.select(tu.whole_months("a", "b").alias("m")).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE p (i INT, a DATE, b DATE)")
    con.executemany("INSERT INTO p VALUES (?, ?, ?)", [(i, a, b) for i, (a, b) in enumerate(pairs)])
    want = [r[0] for r in con.execute(
        "SELECT CAST(extract(year FROM age(a, b)) * 12 + extract(month FROM age(a, b)) AS INT) "
        "FROM p ORDER BY i").fetchall()]
    assert got == want


def test_parse_ymd_raises_on_garbage(spark):
    assert one(spark, tu.parse_ymd("s"), s="20240131") == dt.date(2024, 1, 31)
    with pytest.raises(Exception):
        one(spark, tu.parse_ymd("s"), s="2024-01-31x")


def test_date_series_is_empty_when_reversed(spark):
    assert one(spark, F.size(tu.date_series("a", "b")), a=dt.date(2024, 1, 3), b=dt.date(2024, 1, 1)) == 0
    assert one(spark, F.size(tu.date_series("a", "b")), a=dt.date(2024, 1, 1), b=dt.date(2024, 1, 3)) == 3


@pytest.mark.parametrize("birth,year", [("520101", 1952), ("100101", 2010), ("bad", None),
                                        ("1001011", None)])
def test_birth_year_century_pivot(spark, birth, year):
    assert one(spark, tu.birth_year_from_yymmdd("b", 2026), b=birth) == year


def test_age_uses_mid_year_anchor(spark):
    v = one(spark, tu.age_years("d", "y"), d=dt.date(2024, 7, 1), y=1990)
    assert float(v) == pytest.approx(round(12419 / 365.25, 2))
    assert one(spark, tu.age_band("d", "y"), d=dt.date(2024, 7, 1), y=1990) == 30
    assert one(spark, tu.age_years("d", F.lit(None).cast("int")), d=dt.date(2024, 7, 1)) is None


def test_epoch_seconds(spark):
    v = one(spark, tu.epoch_seconds("b", "a"), a=dt.datetime(2024, 1, 1, 0, 0, 0),
            b=dt.datetime(2024, 1, 1, 1, 30, 0, 500000))
    assert float(v) == 5400.5


def test_naive_instant_round_trip_is_session_independent(spark):
    ts = dt.datetime(2024, 1, 1, 23, 59, 58, 123456)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Seoul"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            back = one(spark, tu.instant_to_naive(tu.naive_to_instant("ts")), ts=ts)
            assert back == ts
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_hmac_equals_python(spark):
    secret = "s3cr3t-key"
    for value in ["abc", "0f0e-uuid-like", "x" * 200]:
        want = hmac.new(secret.encode(), value.encode(), hashlib.sha256).hexdigest()
        assert one(spark, K.hmac_sha256_hex("v", secret), v=value) == want
    long_secret = "k" * 100   # longer than the block: hashed first
    want = hmac.new(long_secret.encode(), b"abc", hashlib.sha256).hexdigest()
    assert one(spark, K.hmac_sha256_hex("v", long_secret), v="abc") == want


def test_event_key_skips_null_and_surrogate_key_does_not(spark):
    a = one(spark, K.event_key(F.lit("1"), F.lit(None).cast("string")))
    assert a == hashlib.md5(b"1").hexdigest()
    s_null = one(spark, K.surrogate_key(F.lit("1"), F.lit(None).cast("string")))
    s_empty = one(spark, K.surrogate_key(F.lit("1"), F.lit("")))
    assert s_null != s_empty
    assert s_null == hashlib.md5(("1-" + K.SURROGATE_NULL_TOKEN).encode()).hexdigest()


def test_json_helpers(spark):
    obj = '{"a": {"b": [1, 2]}, "error": null, "c": "x"}'
    assert one(spark, J.json_has_key("p", "error"), p=obj) is True
    assert one(spark, J.json_has_key("p", "zzz"), p=obj) is False
    assert one(spark, J.json_has_key("p", "error"), p='["error"]') is True
    assert one(spark, J.json_has_key(F.lit(None).cast("string"), "error")) is None
    assert sorted(one(spark, J.json_keys("p"), p=obj)) == ["a", "c", "error"]
    assert one(spark, J.json_keys("p"), p="[1,2]") is None
    assert one(spark, J.json_type("p"), p=obj) == "object"
    assert one(spark, J.json_type("p"), p="[1]") == "array"
    assert one(spark, J.json_type("p"), p='"s"') == "string"
    assert one(spark, J.json_text("p", "a", "b"), p=obj) == "[1,2]"
    assert one(spark, J.json_text("p", "c"), p=obj) == "x"
    stripped = one(spark, J.json_strip_keys("p", ["c", "error"]), p=obj)
    import json
    assert json.loads(stripped) == {"a": {"b": [1, 2]}}
    assert one(spark, J.json_strip_keys("p", ["c"]), p="[1, 2]") == "[1, 2]"
