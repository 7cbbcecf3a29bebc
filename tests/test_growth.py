"""What moves between tasks at size: plans with no broadcast, as large tables have them."""

from __future__ import annotations

import datetime as dt
import re

import pytest

import __spark_entry__ as E
from dayledger.plans import checks as C
from dayledger.plans import fact_panel as FP
from dayledger.plans import facts as FT
from dayledger.sources import tables as T_
from tests.conftest import SF_SMALL

T = dt.datetime


@pytest.fixture()
def shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rates_move_wide_and_without_names(shuffled):
    """F1 to F4: the tall rows with their names never lie below an exchange."""
    plan = FT.staged_readings(shuffled, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_lifelog_sn" in plan
    for line in plan.split("\n"):
        assert "Exchange" not in line or "metric_code" not in line, line


def test_records_are_counted_in_one_narrow_row_a_serial_and_day(shuffled):
    plan = _plan(FP.serial_rows(shuffled, SF_SMALL))
    assert "channel_code" not in plan and "Aggregate [user_lifelog_sn" in plan


def test_totals_of_rows_with_and_without_a_channel(spark):
    rows = [(1, dt.date(2024, 1, 1), 2, None), (1, dt.date(2024, 1, 1), 3, None), (1, dt.date(2024, 1, 2), None, 4)]
    got = FP.daily_totals(spark.createDataFrame(rows, "user_id long, ymd_date date, raw_meal_records int, raw_manual_measurements int")).orderBy("ymd_date").collect()
    assert [(r.raw_meal_records, r.raw_manual_measurements) for r in got] == [(5, None), (None, 4)]


def _source(spark):
    rows = [(1, 1, T(2024, 1, 1), 5.0, 9.0, 0.1, 0.2), (1, 1, T(2024, 1, 1), 4.0, 8.0, 0.1, 0.3), (1, None, T(2024, 1, 1), None, 1.0, 0.1, None),
            (2, 1, T(2024, 1, 2), 7.0, None, None, None), (None, 1, None, 1.0, 2.0, 0.2, 0.2)]
    return spark.createDataFrame(rows, "user_lifelog_sn long, slot int, measured_dt timestamp_ntz, quantity double, extended_price double, discount double, tax double")


def test_counts_are_those_of_the_staged_readings(spark, monkeypatch):
    monkeypatch.setattr(FT.B, "readings_source", lambda *_: _source(spark))
    staged, counted = {}, {}
    for r in FT.staged_readings(spark, "").collect():
        staged[r.user_lifelog_sn, r.measured_at] = staged.get((r.user_lifelog_sn, r.measured_at), 0) + 1
    for r in FT.staged_reading_counts(spark, "").collect():
        counted[r.user_lifelog_sn, r.measured_at] = counted.get((r.user_lifelog_sn, r.measured_at), 0) + r.n_readings
    assert staged == counted == {(1, T(2024, 1, 1)): 6, (2, T(2024, 1, 2)): 1, (None, None): 4}


@pytest.mark.parametrize("name", ["dq19_readings_attributed", "dq19_damaged"])
def test_readings_meet_their_parents_before_they_are_unpivoted(shuffled, name):
    """F6, F7."""
    lines = _plan(E.queries()[name](shuffled, SF_SMALL)).split("\n")
    generates = [i for i, x in enumerate(lines) if "Generate inline" in x]
    joins = [i for i, x in enumerate(lines) if "Join LeftAnti" in x]
    assert len(generates) == len(joins) == 2 and all(g < j for g, j in zip(generates, joins, strict=True))


def test_staging_what_is_unattributed_equals_the_unattributed_of_what_is_staged(spark, monkeypatch):
    monkeypatch.setattr(FT.B, "readings_source", lambda *_: _source(spark))
    parents = spark.createDataFrame([(2,), (None,)], "user_lifelog_sn long")
    before = C.unattributed(FT.staged_readings(spark, ""), parents, "user_lifelog_sn")
    after = FT.staged_readings(spark, "", C.unattributed(_source(spark), parents, "user_lifelog_sn"))
    key = lambda f: sorted(map(repr, f.select(*before.columns).collect()))
    assert key(before) == key(after) and len(key(after)) == 10


def test_signatures_are_attributed_in_the_narrow_forms(shuffled):
    """F8, F10: raw rows of other serials go first, and no tall row meets a join."""
    lines = _plan(FT.measurement_fact(shuffled, SF_SMALL)).split("\n")
    joins = [i for i, x in enumerate(lines) if "Join Inner" in x]
    window = next(i for i, x in enumerate(lines) if "Window" in x)
    assert any("Join LeftSemi" in x for x in lines[window:joins[1]])
    assert not any("metric_code" in x for x in lines[joins[0]:joins[1]] if "Union" in x or "Join" in x)


@pytest.mark.parametrize("name, keys", [("fct11_wearable_day_pivot", ("o_orderkey", "l_orderkey", "user_id")), ("stg07_sleep_stages", ("o_orderkey", "l_orderkey")),
                                        ("met05_population_risk_monthly", ("o_orderkey", "l_orderkey")), ("chart6_mean_rank", ("o_orderkey", "l_orderkey"))])
def test_tasks_grow_with_the_rows(shuffled, monkeypatch, name, keys):
    """a task's rows are bounded, whatever the session's number of
    partitions, and the rows are those of the plan that Spark made alone."""
    rows = lambda: sorted(map(repr, E.queries()[name](shuffled, SF_SMALL).collect()))
    before = rows()
    monkeypatch.setattr(T_, "ROWS_PER_TASK", 20)
    plan = E.queries()[name](shuffled, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.split("\n") if "REPARTITION_BY_NUM" in x]
    for key in keys:
        n = [int(m) for x in dealt for m in re.findall(rf"hashpartitioning\({key}#.*?, (\d+)\)", x)]
        assert n and min(n) > int(shuffled.conf.get("spark.sql.shuffle.partitions"))
    assert rows() == before
