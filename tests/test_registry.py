"""Every registered query against its DuckDB oracle on the smallest driver
tables (the driver repeats this at sf0.01), plus the entry contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle import compare

QUERIES = E.queries()
ORACLES = E.oracle_sql()


def test_every_query_is_named_and_documented():
    from dayledger.plans.registry import REGISTRY
    assert len(QUERIES) >= 50
    for name, q in REGISTRY.items():
        assert q.doc.strip(), name
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    res = compare(QUERIES[name](spark, SF_SMALL), ORACLES[name], SF_SMALL)
    assert res["columns_match"], res
    assert res["rows_spark"] == res["rows_oracle"], res
    assert res["match"], res


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.schema == E.entry(spark).schema


@pytest.mark.parametrize("name", ["snk02_upsert", "snk04_replace_window", "snk11_control_updates",
                                  "dq09_source_freshness", "pnl01_user_day", "fct12_channel_load_status",
                                  "str02_streamed_daily_aggregate", "fct06_coaching_event",
                                  "int01_collapsed_samples", "snk05_window_replace", "dtl05_two_hop_attribution"])
def test_results_do_not_depend_on_the_session_time_zone(spark, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        res = compare(QUERIES[name](spark, SF_SMALL), ORACLES[name], SF_SMALL)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert res["match"], res
