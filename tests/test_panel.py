"""Dense panel semantics on a hand-made fixture (synthetic values only).

Events (UTC wall clock):
  user 1: view 01-03, error 01-04, signup 01-05, purchase 01-06 (60), click 01-07,
          purchase 01-08 (10)
  user 2: signup 2024-01-04 15:30 UTC  -> local 01-05; no app events
  user 3: view 01-06, never signs up   -> not in the cohort
  user 4: signup 01-10, view 01-10, click 01-12
Frontiers (load complete = local date of the oldest dependency success - 1):
  view 01-09, click 01-11, purchase 01-07, signup 01-09, error NULL (a
  dependency never loaded); panel through 01-12.
"""

from __future__ import annotations

import datetime as dt

import pytest

from dayledger.plans import dims as D
from dayledger.plans import load_status as LS
from dayledger.plans import panel as P


def _ts(day, hour=2, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("panel_sf")
    ev = [(1, _ts(3), 1, "view", 5.0), (2, _ts(4), 1, "error", 1.0), (3, _ts(5), 1, "signup", 0.0),
          (4, _ts(6), 1, "purchase", 60.0), (5, _ts(7), 1, "click", 2.0),
          (6, _ts(8), 1, "purchase", 10.0), (7, _ts(4, 15, 30), 2, "signup", 0.0),
          (8, _ts(6), 3, "view", 1.0), (9, _ts(10), 4, "signup", 0.0), (10, _ts(10, 3), 4, "view", 1.0),
          (11, _ts(12), 4, "click", 1.0)]
    spark.createDataFrame([(*e, '{"k": 1}') for e in ev],
                          "event_id long, ts timestamp_ntz, user_id long, event_type string, "
                          "value double, props string").write.parquet(str(root / "events.parquet"))
    spark.createDataFrame([(i, f"Customer#{i}", 1, 10.0, "BUILDING") for i in (1, 2, 3, 4)],
                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                          "c_mktsegment string").write.parquet(str(root / "customer.parquet"))
    spark.createDataFrame([(1, "NATION_1", 0)], "n_nationkey int, n_name string, n_regionkey int"
                          ).write.parquet(str(root / "nation.parquet"))
    spark.createDataFrame([(0, "REGION_0")], "r_regionkey int, r_name string"
                          ).write.parquet(str(root / "region.parquet"))
    return str(root)


@pytest.fixture(scope="module")
def panel(spark, sf):
    return {(r.user_id, r.ymd_date.day): r for r in P.user_day(spark, sf).collect()}


def test_cohort_and_local_join_date(spark, sf):
    users = {r.user_id: r.joined_date for r in D.dim_user(spark, sf).collect()}
    assert users == {1: dt.date(2024, 1, 5), 2: dt.date(2024, 1, 5), 4: dt.date(2024, 1, 10)}


def test_load_status(spark, sf):
    st = {r.channel_code: r for r in LS.channel_load_status(spark, sf).collect()}
    assert st["view"].load_complete_through_date == dt.date(2024, 1, 9)
    assert st["click"].load_complete_through_date == dt.date(2024, 1, 11)
    assert st["purchase"].load_complete_through_date == dt.date(2024, 1, 7)
    assert st["error"].all_dependencies_successful is False
    assert st["error"].load_complete_through_date is None
    assert st["error"].dependency_count == 2 and st["error"].successful_dependency_count == 1
    assert st["click"].observed_event_through_date == dt.date(2024, 1, 12)


def test_spine_bounds(panel):
    days = {}
    for (u, d) in panel:
        days.setdefault(u, []).append(d)
    assert {u: (min(v), max(v), len(v)) for u, v in days.items()} == {
        1: (3, 12, 10), 2: (5, 12, 8), 4: (10, 12, 3)}


def test_activity_before_joining(panel):
    r = panel[(1, 3)]
    assert r.view_events == 1 and r.view_state == "OBSERVED_ACTIVITY"
    assert r.days_since_joined == -2 and r.months_since_joined == 0


def test_app_states(panel):
    assert (panel[(1, 4)].view_events, panel[(1, 4)].view_state) == (0, "OBSERVED_ZERO")
    assert (panel[(1, 10)].view_events, panel[(1, 10)].view_state) == (None, "NOT_LOADED")
    assert panel[(1, 4)].did_view is False and panel[(1, 3)].did_view is True
    # user 2 never used the app and has no registration: unknown, not zero
    r = panel[(2, 6)]
    assert (r.view_events, r.view_state, r.did_view) == (None, "ELIGIBILITY_UNKNOWN", None)


def test_program_states(panel):
    assert (panel[(1, 4)].purchases_delivered, panel[(1, 4)].purchase_state) == (None, "NOT_YET_ELIGIBLE")
    r = panel[(1, 6)]
    assert (r.purchases_delivered, r.purchases_completed, r.purchase_state) == (1, 1, "OBSERVED_ACTIVITY")
    r = panel[(1, 7)]
    assert (r.purchases_delivered, r.purchases_completed, r.purchase_state) == (0, 0, "OBSERVED_ZERO")
    r = panel[(1, 8)]   # observed beyond the load frontier still counts as observed
    assert (r.purchases_delivered, r.purchases_completed, r.purchase_state) == (1, 0, "OBSERVED_ACTIVITY")


def test_passive_and_enrolled_states(panel):
    assert (panel[(1, 4)].error_events, panel[(1, 4)].error_state) == (1, "OBSERVED_ACTIVITY")
    assert (panel[(1, 5)].error_events, panel[(1, 5)].error_state) == (None, "NOT_LOADED")
    assert panel[(1, 4)].had_passive_collection is True and panel[(1, 5)].had_passive_collection is None
    assert panel[(1, 4)].signup_state == "NOT_YET_ELIGIBLE"
    assert (panel[(1, 6)].signup_events, panel[(1, 6)].signup_state) == (0, "OBSERVED_ZERO")
    assert panel[(1, 10)].signup_state == "NOT_LOADED"


def test_month_panel(spark, sf):
    m = {r.user_id: r for r in P.user_month(P.user_day(spark, sf), D.dim_user(spark, sf)).collect()}
    r = m[1]
    assert r.panel_days == 10 and r.is_left_partial_month and r.is_right_censored
    assert r.view_observed_days == 7          # 01-03 observed + 01-04..01-09 zero
    assert r.purchases_delivered == 2 and r.purchases_completed == 1
    assert r.cohort_month_index == 0 and r.month_end_date == dt.date(2024, 1, 31)
    assert r.app_engaged_days == 2            # view 01-03, click 01-07
