"""Model helpers without a driver-table binding."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dayledger.operators import staging as S
from dayledger.plans import dims as D


def test_bmi_and_band_cutoffs(spark):
    rows = [(1, 50.0, 170.0), (2, 60.0, 170.0), (3, 70.0, 170.0), (4, 80.0, 170.0), (5, None, 170.0),
            (6, 66.47, 170.0)]   # 23.0 exactly -> overweight (the cut-off is "< 23" for normal)
    df = spark.createDataFrame(rows, "id int, w double, h double")
    got = {r.id: (r.bmi, r.band) for r in df.select(
        "id", D.bmi(F.col("w"), F.col("h")).cast("double").alias("bmi"),
        D.bmi_band(F.col("w"), F.col("h")).alias("band")).collect()}
    assert got[1] == (17.3, "underweight")
    assert got[2] == (20.76, "normal")
    assert got[3] == (24.22, "overweight")
    assert got[4] == (27.68, "obese")
    assert got[5] == (None, None)
    assert got[6][1] == "overweight"


def test_zero_as_missing_and_open_interval(spark):
    df = spark.createDataFrame([(1, 0.0, "A", None), (2, 61.5, "A", dt.datetime(2024, 1, 1)),
                                (3, 70.0, "B", None)], "id int, w double, site string, unlinked timestamp")
    got = {r.id: (r.w, r.ok) for r in df.select(
        "id", S.zero_as_missing("w").alias("w"), S.open_interval("site", ["A"], "unlinked").alias("ok")
    ).collect()}
    assert got == {1: (None, True), 2: (61.5, False), 3: (70.0, False)}


def test_count_streams_is_zero_to_n(spark):
    df = spark.createDataFrame([(1, None, None), (2, 5, None), (3, 5, 6)], "id int, a int, b int")
    assert [r.n for r in df.orderBy("id").select(S.count_streams("a", "b").alias("n")).collect()] == [0, 1, 2]


def test_code_labels(spark):
    df = spark.createDataFrame([("D1",), ("D2",), ("X",)], "code string")
    got = {r.code: r.label for r in D.code_label(df, "code", [("D1", "Watch"), ("D2", "Band")]).collect()}
    assert got == {"D1": "Watch", "D2": "Band", "X": None}


def test_calendar_attributes(spark):
    bounds = spark.createDataFrame([(dt.date(2024, 12, 29), dt.date(2025, 1, 6))], "lo date, hi date")
    cal = {r.date_day: r for r in D.dim_date(bounds).collect()}
    assert len(cal) == 9
    r = cal[dt.date(2024, 12, 30)]                  # Monday, ISO week 1 of 2025
    assert (r.iso_day_of_week, r.iso_week_num, r.week_start_date) == (1, 1, dt.date(2024, 12, 30))
    assert cal[dt.date(2024, 12, 29)].day_name == "Sunday" and cal[dt.date(2024, 12, 29)].is_weekend
    assert cal[dt.date(2025, 1, 1)].month_name == "January" and cal[dt.date(2025, 1, 1)].quarter_num == 1


def test_interval_stream_is_dated_from_its_start(spark, tmp_path):
    from dayledger.plans import wearable as W
    root = tmp_path / "sf"
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 1), 1, "signup", 0.0, "{}")],
                          "event_id long, ts timestamp_ntz, user_id long, event_type string, "
                          "value double, props string").write.parquet(str(root / "events.parquet"))
    spark.createDataFrame([(1, "C#1", 1, 1.0, "X")], "c_custkey long, c_name string, c_nationkey int, "
                          "c_acctbal double, c_mktsegment string").write.parquet(str(root / "customer.parquet"))
    spark.createDataFrame([(1, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"
                          ).write.parquet(str(root / "nation.parquet"))
    spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string").write.parquet(str(root / "region.parquet"))
    # starts 23:00 local (14:00 UTC) on 2024-01-01, ends 07:00 local the next day
    spark.createDataFrame([(10, 1, "F", 1.0, dt.datetime(2024, 1, 1, 14), "1-URGENT"),
                           (11, 1, "O", 1.0, dt.datetime(2024, 1, 1, 15), "1-URGENT")],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(str(root / "orders.parquet"))
    spark.createDataFrame([(10, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "F", dt.datetime(2024, 1, 1, 22)),
                           (11, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", dt.datetime(2024, 1, 3, 0))],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                          "l_linestatus string, l_shipdate timestamp_ntz").write.parquet(str(root / "lineitem.parquet"))
    rows = {x.wear_date: (x.n_samples, None if x.duration_hours is None else float(x.duration_hours))
            for x in W.wearable_day(spark, str(root)).where("stream_code = 'delivery'").collect()}
    # order 10: 23:00 local on 01-01 -> 07:00 on 01-02, dated 01-01 with 8 hours;
    # order 11: starts 00:00 local on 01-02 and is still open: a sample, no duration
    assert rows == {dt.date(2024, 1, 1): (1, 8.0), dt.date(2024, 1, 2): (1, None)}
