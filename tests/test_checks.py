"""Reconciliation, fingerprints and ordered aggregates on hand-made frames."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dayledger.operators import reconcile as R
from dayledger.operators import staging as S
from dayledger.operators.setops import symmetric_difference
from dayledger.plans import checks as C
from dayledger.plans import facts as FT


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_reconcile_compares_any_legs_and_measures(spark):
    raw = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 5.0), (None, 1.0), (4, None)], "k int, v double")
    day = spark.createDataFrame([(1, 2, 6.0), (2, 2, 5.0), (None, 1, 1.0), (3, 1, 9.0), (4, 1, None)], "k int, n long, s double")
    found = R.reconcile({"raw": raw, "day": day}, ["k"], {
        "n": ("count", {"raw": F.lit(1), "day": F.col("n")}), "s": ("sum", {"raw": F.col("v"), "day": F.col("s")}),
        "top": ("max", {"raw": F.col("v")})})
    assert found.columns == ["k", "n_raw", "n_day", "s_raw", "s_day", "top_raw"]
    assert rows(found) == [(2, 1, 2, 5.0, 5.0, 5.0), (3, None, 1, None, 9.0, None)]


def test_reconcile_totals_without_keys(spark):
    a, b = spark.range(5), spark.range(6)
    one = {"n": ("count", {"a": F.lit(1), "b": F.lit(1)})}
    assert rows(R.reconcile({"a": a, "b": b}, [], one)) == [(5, 6)]
    assert rows(R.reconcile({"a": a, "b": a}, [], one)) == []


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_fingerprints_find_what_a_symmetric_difference_finds(spark, buckets):
    rng = random.Random(buckets)
    base = [(rng.randrange(40), rng.choice([None, "a", "b"]), rng.choice([None, 1.5])) for _ in range(300)]
    other = base[5:] + base[100:103] + [(None, None, None), (1, None, 1.5), (None, "a", 1.5)]
    rng.shuffle(other)
    cols = "k int, t string, v double"
    left, right = spark.createDataFrame(base, cols), spark.createDataFrame(other, cols)
    got = R.multiset_differences(left, right, ["k", "t", "v"], buckets, "side")
    assert rows(got) == rows(symmetric_difference(left, right, "side"))
    assert rows(R.multiset_differences(left, left.orderBy("v"), ["k", "t", "v"], buckets)) == []


def test_nulls_in_different_columns_are_no_copies(spark):
    a = spark.createDataFrame([(1, None)], "x int, y int")
    b = spark.createDataFrame([(None, 1)], "x int, y int")
    assert len(rows(R.multiset_differences(a, b, ["x", "y"]))) == 2


D = dt.date
T = dt.datetime
SOURCES = ["dim_user", "app_event", "coaching_event"]
CANDIDATES = [
    (1, "m", D(2024, 1, 2), T(2024, 1, 2, 5), "app_event"), (1, "m", D(2024, 1, 2), T(2024, 1, 2, 4), "coaching_event"),
    (2, "m", D(2024, 1, 3), T(2024, 1, 3), "app_event"), (2, "m", D(2024, 1, 2), None, "dim_user"), (2, "m", D(2024, 1, 2), T(2024, 1, 2), "app_event"),
    (3, "m", None, T(2020, 1, 1), "app_event"), (3, "m", D(1969, 12, 31), T(1969, 12, 31, 23, 59, 59, 999999), "app_event"),
    (4, "m", D(2024, 1, 1), T(2024, 1, 1, 1), "coaching_event"), (4, "m", D(2024, 1, 1), T(2024, 1, 1, 1), "app_event"),
    (5, "m", D(1, 1, 1), T(1, 1, 1), "app_event"), (5, "n", D(9999, 12, 31), T(9999, 12, 31, 23, 59, 59, 999999), "app_event"), (6, "m", None, None, "dim_user")]


def test_the_first_row_is_one_row(spark):
    """A NULL time on the first day wins, with its own source; ties go by source."""
    df = spark.createDataFrame(CANDIDATES, "user_id int, milestone_code string, occurred_date date, occurred_at timestamp_ntz, source_relation string")
    got = rows(S.first_row_in_time(df, ["user_id", "milestone_code"], "occurred_date", "occurred_at", "source_relation", SOURCES))
    order = [F.col("occurred_date").asc(), F.col("occurred_at").asc_nulls_first(),
             F.array_position(F.array(*map(F.lit, SOURCES)), F.col("source_relation")).asc()]
    window = S.first_occurrence(df.where("occurred_date is not null"), ["user_id", "milestone_code"], order)
    assert got == rows(window.select("user_id", "milestone_code", "occurred_date", "occurred_at", "source_relation"))
    assert got[1] == (2, "m", D(2024, 1, 2), None, "dim_user")
    plan = S.first_row_in_time(df, ["user_id"], "occurred_date", "occurred_at", "source_relation", SOURCES)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Window" not in plan


def test_precision_comes_from_the_row_that_was_taken(spark):
    df = spark.createDataFrame(CANDIDATES, "user_id int, milestone_code string, occurred_date date, occurred_at timestamp_ntz, source_relation string")
    got = {(r.user_id, r.milestone_code): (r.occurred_at, r.temporal_precision) for r in FT.first_milestones(df).collect()}
    assert got[2, "m"] == (None, "DATE") and got[4, "m"] == (T(2024, 1, 1, 1), "TIMESTAMP")
    assert rows(C.precision_contradicted(FT.first_milestones(df))) == []


def test_an_unknown_source_is_refused(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), None, "other")], "k int, d date, t timestamp_ntz, s string")
    with pytest.raises(Exception, match="unknown code: other"):
        S.first_row_in_time(df, ["k"], "d", "t", "s", SOURCES).collect()


def test_a_doubled_and_a_lost_signature_are_both_returned(spark):
    raw = spark.createDataFrame([(1, 1, T(2024, 1, 1), 5.0, 9.0, 0.1, 0.2), (1, 1, T(2024, 1, 1), 4.0, 8.0, 0.1, 0.3), (2, 1, T(2024, 1, 2), 7.0, None, 0.1, None)],
                                "user_lifelog_sn long, slot int, measured_dt timestamp_ntz, quantity double, extended_price double, discount double, tax double")
    parents = spark.createDataFrame([(1,), (2,)], "user_lifelog_sn long")
    right = [(1, T(2024, 1, 1), "quantity", 5.0), (1, T(2024, 1, 1), "extended_price", 9.0), (1, T(2024, 1, 1), "discount", 0.1),
             (1, T(2024, 1, 1), "tax", 0.2), (1, T(2024, 1, 1), "tax", 0.3), (2, T(2024, 1, 2), "quantity", 7.0), (2, T(2024, 1, 2), "discount", 0.1)]
    frame = lambda r: spark.createDataFrame(r, "user_lifelog_sn long, measured_at timestamp_ntz, metric_code string, metric_value double")
    assert rows(C.signature_differences(frame(right), raw, parents)) == []
    assert rows(C.signature_differences(frame(right[1:] + right[-1:]), raw, parents)) == [(1, T(2024, 1, 1), "quantity", 5.0), (2, T(2024, 1, 2), "discount", 0.1)]


def test_pinned_users_both_ways(spark):
    f = lambda *x: spark.createDataFrame([(i,) for i in x], "user_id long")
    assert rows(C.unmapped_and_pinned(f(1, 2, 3), f(1), f(2, 9))) == [(3, True, False), (9, False, True)]
