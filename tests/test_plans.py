"""Plan shape: filters reach the Parquet scan, projections prune columns, no
cartesian products, the panel spine is a Generate (no range join), the cohort
guard of the panel sees pre-aggregated rows."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _plan(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(plan):
    out = []
    for line in plan.split("\n"):
        if "FileScan" in line or "Scan parquet" in line:
            table = re.search(r"/([a-z]+)\.parquet", line)
            pf = re.search(r"PushedFilters: \[(.*?)\]", line)
            rs = re.search(r"ReadSchema: struct<(.*?)>", line)
            out.append((table.group(1) if table else "?", pf.group(1) if pf else "",
                        rs.group(1) if rs else ""))
    return out


def test_landing_window_is_pushed_to_the_scan(spark):
    scans = _scans(_plan(spark, "snk04_replace_window"))
    assert any("GreaterThan(ts" in pf and "LessThanOrEqual(ts" in pf for _, pf, _ in scans)
    for _, _, rs in scans:           # event_id and props are never read
        assert "event_id" not in rs and "props" not in rs


@pytest.mark.parametrize("name", ["pnl01_user_day", "fct08_measurement", "met04_measurement_participation_weekly",
                                  "int02_wearable_day", "fct12_channel_load_status"])
def test_no_cartesian_product_and_pruned_scans(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    for table, _, rs in _scans(plan):
        if table in ("lineitem", "events", "orders"):
            assert rs.count(":") < 7, (table, rs)   # never the whole wide row


def test_panel_spine_is_a_generate_and_channels_share_one_filter(spark):
    from dayledger.plans import panel as P
    plan = _plan(spark, "pnl01_user_day")
    assert "Generate explode" in plan
    # the daily aggregate is read from its checkpoint, not recomputed per consumer
    assert "Scan ExistingRDD" in plan
    rows = P.channel_rows(spark, SF_SMALL)
    daily_plan = P.daily_counts(rows)._jdf.queryExecution().executedPlan().toString()
    assert "In(event_type, [click,error,purchase,signup,view]" in daily_plan
    assert "partial_sum" in daily_plan


@pytest.mark.parametrize("name", ["pnl01_user_day", "snk05_window_replace", "met07_scoring_coverage_monthly",
                                  "fct12_channel_load_status", "dq13_facts_reconcile_to_staging"])
def test_no_cross_or_nested_loop_joins(spark, name):
    # one-row frames (frontiers, cutoffs, cohort size) are scalars, never joined
    plan = _plan(spark, name)
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
