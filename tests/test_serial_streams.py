"""Streams with a real parent, and the panel over all facts, on hand-made rows."""

from __future__ import annotations

import datetime as dt
import random


from dayledger.plans import fact_panel as FP
from dayledger.plans import panel as P
from dayledger.plans import serial_streams as SS

T = dt.datetime


def _samples(spark, rows):
    return spark.createDataFrame(rows, "user_lifelog_sn long, measured_at timestamp_ntz, type_code string, sample_value decimal(18,2)")


def test_serials_meet_their_user_after_the_day_is_summed(spark):
    """Two devices of a user, a copy, a value that is missing, a serial without parent,
    and a serial with a third of all samples."""
    rng = random.Random(4)
    rows = [(1, T(2024, 1, 1, 1), "hr", 10), (1, T(2024, 1, 1, 1), "hr", 10), (2, T(2024, 1, 1, 2), "hr", 40), (2, T(2024, 1, 1, 3), "hr", None),
            (9, T(2024, 1, 1, 2), "hr", 99), (1, T(2024, 1, 1, 15), "hr", 1), (3, None, "hr", 5)]
    rows += [(7, T(2024, 1, 1, 0, i % 60, i // 60), "hr", rng.randrange(50)) for i in range(2000)]
    from decimal import Decimal
    rows = [(a, b, c, None if v is None else Decimal(v)) for a, b, c, v in rows]
    parent = spark.createDataFrame([(1, 100), (2, 100), (3, 100), (7, 200), (8, None)], "user_lifelog_sn long, user_id long")
    got = {(r.user_id, r.wear_date.day): r for r in SS.user_days(SS.serial_days(SS.collapsed(_samples(spark, rows))), parent).collect()}
    assert set(got) == {(100, 1), (100, 2), (200, 1)}
    one = got[100, 1]
    assert (one.n_samples, one.value_sum, one.value_min, one.value_max, one.n_devices) == (4, 60, 10, 40, 2)
    assert float(one.value_mean) == 20.0  # of the three samples with a value
    assert got[100, 2].n_samples == 1 and got[200, 1].n_samples == 2000
    assert got[200, 1].value_sum == sum(v for s, _, _, v in rows if s == 7)


def test_interactions_extend_eligibility_and_engage_nobody(spark):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    rows = [(1, days[0], "share_interaction", None, 2, 0, None, None), (1, days[1], "app_login", None, 3, 0, None, None),
            (1, days[1], "wearable", "click", 5, 0, None, None), (1, days[1], "wearable", "view", 2, 2, None, None),
            (1, days[2], "wearable", "view", 1, 0, None, None), (1, days[2], "irs_score", "7", 4, 1, None, None), (1, days[2], "irs_score", "8", 1, 0, None, None),
            (1, days[0], "coaching", None, 3, 2, None, None), (1, days[2], "integrated_analysis", None, 1, 0, "x", 55)]
    kinds = "user_id long, ymd_date date, channel_code string, item string, n_rows long, n_flagged long, signature_code string, signature_event_id long"
    daily = FP.daily_values(spark.createDataFrame(rows, kinds))
    users = spark.createDataFrame([(1, days[1], None, 1980), (2, days[1], None, None)], "user_id long, joined_date date, app_registered_date date, birth_year int")
    bounds = P.user_bounds(daily, users, FP.CHANNELS)
    status = spark.createDataFrame([(c.code, days[2] if c.code != "meal" else None, days[2]) for c in FP.CHANNELS],
                                   "channel_code string, load_complete_through_date date, observed_event_through_date date")
    panel = P.dense_panel(daily, bounds, status, FP.CHANNELS, tuple(FP.CARRIED_COLUMNS))
    got = {(r.user_id, r.ymd_date.day): r for r in panel.collect()}
    assert set(got) == {(1, 1), (1, 2), (1, 3), (2, 2), (2, 3)}
    a, b, c = (got[1, d] for d in (1, 2, 3))
    # the interaction of the first day proves the account: no login is a zero from there on
    assert (a.share_interaction_events, a.app_login_events, a.app_login_state, a.did_app_login) == (2, 0, P.OBSERVED_ZERO, False)
    assert (b.app_login_events, b.app_login_state) == (3, P.OBSERVED_ACTIVITY)
    # streams: flagged ones count; a day whose streams measured nothing is an observed 0
    assert (b.wearable_streams_active, c.wearable_streams_active, c.wearable_state) == (1, 0, P.OBSERVED_ACTIVITY)
    assert a.wearable_streams_active is None and a.wearable_state == P.ELIGIBILITY_UNKNOWN and a.meal_state == P.NOT_LOADED
    # items are counted once, whatever their rows
    assert (c.diseases_scored, c.diseases_with_irs_score) == (2, 1)
    assert (a.routines_delivered, a.routines_completed) == (3, 2)
    assert (c.signature_code, c.signature_event_id, c.intg_analysis_rows) == ("x", 55, 1) and b.signature_code is None
    assert got[2, 2].app_login_state == P.ELIGIBILITY_UNKNOWN and got[2, 2].irs_score_state == P.OBSERVED_ZERO
    assert got[1, 1].irs_score_state == P.NOT_YET_ELIGIBLE and float(a.age_at_activity) == 43.5
    month = {r.user_id: r for r in FP.user_month(panel, users).collect()}
    assert month[1].app_engaged_days == 1 and month[1].share_interaction_activity_days == 1


def test_records_are_counted_by_serial_before_they_meet_their_user(spark):
    """The plan of the long form aggregates below the join with the parent."""
    plan = FP.serial_rows(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join Inner")
    assert plan.index("Aggregate", join) > join and "user_lifelog_sn" in plan[plan.index("Aggregate", join):]


def test_replayed_days():
    assert len(FP.CHANNELS) == 11 and len(FP.DEPENDENCIES) == 22
    assert {c.code for c in FP.CHANNELS} == {d[0] for d in FP.DEPENDENCIES}
    assert sum(not c.engages for c in FP.CHANNELS) == 1


def test_variant_paths(spark):
    from dayledger.operators import staging as S
    df = spark.createDataFrame([(1, '{"a": {"b": "x", "n": 3}, "c": "y"}'), (2, '{"a": {"b": null}}'), (3, "no json"), (4, None), (5, "[1, 2]")], "id int, p string")
    got = [tuple(r) for r in S.flatten_variant(df, "p", {"b": "$.a.b", "n": "$.a.n", "c": "$.c"}, ["id"]).orderBy("id").collect()]
    assert got == [(1, "x", "3", "y"), (2, None, None, None), (3, None, None, None), (4, None, None, None), (5, None, None, None)]
