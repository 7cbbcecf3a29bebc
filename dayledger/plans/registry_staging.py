"""Registered queries of the app's staging, the observation streams and the
remaining charts."""

from __future__ import annotations

from dayledger.plans import app_staging as A
from dayledger.plans import metrics as M
from dayledger.plans.oracle_sql import KST, with_ctes
from dayledger.plans.registry import REGISTRY, register

_MAPPED = "CASE WHEN {0} % 10 <> 0 AND EXISTS (SELECT 1 FROM customer m WHERE m.c_custkey = {0}) THEN {0} END AS user_id"


@register("stg10_action_log", with_ctes(["ev"], f"""
SELECT event_id AS action_log_no, event_id % 12 AS action_no, ts AS action_at, event_date AS action_date, {_MAPPED.format('user_id')}
FROM ev WHERE event_type = 'click'"""))
def _actions(spark, sf):
    """STG-10: app actions, key translation, local date."""
    return A.action_log(spark, sf)


@register("stg11_mapper", with_ctes(["dim_user"], """
SELECT c_custkey + 700000 AS app_user_no, 'USER' AS map_kind, c_custkey AS mapped_user, c_mktsegment AS site_code
FROM customer WHERE c_custkey % 10 <> 0 AND c_custkey IN (SELECT user_id FROM dim_user)"""))
def _mapper(spark, sf):
    """STG-11: the external mapper, cohort users only."""
    return A.mapper(spark, sf)


@register("stg12_search_log", with_ctes(["ev"], f"""
SELECT event_id AS search_no, ts AS search_at, event_date AS search_date, {_MAPPED.format('user_id')} FROM ev WHERE event_type = 'purchase'"""))
def _searches(spark, sf):
    """STG-12: searches, key translation, local date, no text."""
    return A.search_log(spark, sf)


@register("stg13_share_links", f"""
SELECT o_orderkey AS share_no, o_orderpriority AS share_type, o_orderdate AS share_created_at, CAST(o_orderdate {KST} AS DATE) AS share_created_date,
       {_MAPPED.format('o_custkey')} FROM orders""")
def _links(spark, sf):
    """STG-13: share links, key translation, local date."""
    return A.share_links(spark, sf)


@register("stg14_share_log", f"""
SELECT l_orderkey AS share_no, l_linenumber AS share_log_no, l_partkey + 700000 AS to_user_no, l_shipdate AS interaction_at,
       CAST(l_shipdate {KST} AS DATE) AS interaction_date, {_MAPPED.format('l_suppkey')} FROM lineitem""")
def _share_log(spark, sf):
    """STG-14: interactions with links, the actor translated (JON-05)."""
    return A.share_log(spark, sf)


@register("stg15_accounts", f"""
SELECT c_custkey + 700000 AS app_user_no, CASE WHEN c_custkey % 3 = 0 THEN DATE '2023-12-01' + CAST(c_custkey % 60 AS INTEGER) END AS app_registered_date,
       c_mktsegment AS account_kind, {_MAPPED.format('c_custkey')} FROM customer""")
def _accounts(spark, sf):
    """STG-15: app accounts, key translation, registration date."""
    return A.accounts(spark, sf)


@register("stg16_login_log", with_ctes(["ev"], f"""
SELECT ts AS login_at, event_date AS login_date, {_MAPPED.format('user_id')} FROM ev WHERE event_type = 'view'"""))
def _logins(spark, sf):
    """STG-16: the keyless login log."""
    return A.login_log(spark, sf)


@register("stg17_birth_years", f"""
SELECT CASE WHEN c_custkey % 10 <> 0 THEN 1930 + (c_custkey * 7) % 65 END AS birth_year, {_MAPPED.format('c_custkey')} FROM customer""")
def _births(spark, sf):
    """STG-17 / FN-16: birth years from six-digit text by the century rule."""
    return A.personal_info(spark, sf)


@register("stg18_current_sites", """
SELECT c_custkey AS user_id, c_nationkey AS site_key, c_mktsegment AS link_kind FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND NOT coalesce(c_acctbal < 0, false)""")
def _sites(spark, sf):
    """STG-18 / PRJ-05: open links to an allowed kind of site."""
    return A.current_sites(spark, sf)


@register("fct03_search_event", with_ctes(["ev", "dim_user"], """
SELECT md5(concat_ws('|', CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR), strftime(ts, '%Y-%m-%d %H:%M:%S.%f'))) AS search_event_key,
       event_id AS search_no, user_id, ts AS search_at, event_date AS search_date
FROM ev WHERE event_type = 'purchase' AND user_id % 10 <> 0 AND user_id IN (SELECT c_custkey FROM customer) AND user_id IN (SELECT user_id FROM dim_user)"""))
def _search_fact(spark, sf):
    """FCT-03: searches of cohort users."""
    return A.search_event(spark, sf)


def _key(*parts: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce({p}, '_dbt_utils_surrogate_key_null_')" for p in parts) + ")"


_TIME = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"
_ACTIVITY = """activity AS (SELECT l_orderkey AS sn, date_trunc('month', l_shipdate) AS started_at,
  date_trunc('month', l_shipdate) + INTERVAL (CAST(floor(l_quantity / 10) AS INTEGER) * 100) MINUTE AS ended_at, l_returnflag AS code,
  CAST(CAST(floor(l_quantity / 10) AS INTEGER) * 40 AS DECIMAL(18,2)) AS kcal, CAST(CAST(floor(l_quantity / 10) AS INTEGER) * 1.5 AS DECIMAL(18,2)) AS distance,
  COUNT(*) AS n FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY ALL)"""
_AKEY = _key("CAST(sn AS VARCHAR)", _TIME.format("started_at"), _TIME.format("ended_at"), "code", "CAST(kcal AS VARCHAR)", "CAST(distance AS VARCHAR)")


@register("stg04_activity", f"""WITH {_ACTIVITY}
SELECT {_AKEY} AS source_observation_id, sn AS user_lifelog_sn, started_at, ended_at, code AS activity_code,
       CAST(kcal AS DOUBLE) AS kcal, CAST(distance AS DOUBLE) AS distance, n AS source_row_count FROM activity""")
def _activity(spark, sf):
    """STG-04: activity intervals, collapsed with multiplicity and key."""
    return A.observations(A.activity_source(spark, sf), A.ACTIVITY, "started_at")


@register("dtl01_activity_facts", with_ctes(["dim_user"], f"""
SELECT {_AKEY} AS source_observation_id, o.o_custkey AS user_id, sn AS user_lifelog_sn, started_at, ended_at, CAST(started_at {KST} AS DATE) AS ymd_date,
       code AS activity_code, CAST(kcal AS DOUBLE) AS kcal, CAST(distance AS DOUBLE) AS distance,
       CAST(epoch(ended_at - started_at) AS DOUBLE) AS duration_seconds, n AS source_row_count
FROM activity JOIN orders o ON o.o_orderkey = sn WHERE o.o_custkey IN (SELECT user_id FROM dim_user)""", [_ACTIVITY]))
def _activity_fact(spark, sf):
    """DTL-01: activities of cohort users with kcal, distance and seconds."""
    return A.activity_fact(spark, sf)


_SPO2 = """spo2 AS (SELECT user_id AS sn, date_trunc('day', ts) AS measured_at, CAST(90 + event_id % 3 AS DECIMAL(18,2)) AS v, COUNT(*) AS n
  FROM events WHERE event_type = 'signup' AND ts IS NOT NULL GROUP BY ALL)"""
_OKEY = _key("CAST(sn AS VARCHAR)", _TIME.format("measured_at"), "CAST(v AS VARCHAR)")


@register("stg05_spo2", f"""WITH {_SPO2}
SELECT {_OKEY} AS source_observation_id, sn AS user_lifelog_sn, measured_at, CAST(v AS DOUBLE) AS spo2_value, n AS source_row_count FROM spo2""")
def _spo2(spark, sf):
    """STG-05: oxygen samples; equal samples collapse and keep their number."""
    return A.observations(A.spo2_source(spark, sf), A.SPO2, "measured_at")


@register("dtl03_spo2_facts", with_ctes(["dim_user"], f"""
SELECT {_OKEY} AS source_observation_id, sn AS user_id, measured_at, CAST(measured_at {KST} AS DATE) AS ymd_date, CAST(v AS DOUBLE) AS spo2_value, n AS source_row_count
FROM spo2 WHERE sn IN (SELECT user_id FROM dim_user)""", [_SPO2]))
def _spo2_fact(spark, sf):
    """DTL-03: oxygen samples of cohort users."""
    return A.spo2_fact(spark, sf)


@register("stg06_sleep", f"""
SELECT {_key("CAST(o_orderkey AS VARCHAR)", "CAST(o_orderkey AS VARCHAR)", _TIME.format("s"), _TIME.format("s + INTERVAL 8 HOUR"))} AS source_observation_id,
       o_orderkey AS user_lifelog_sn, o_orderkey AS sleep_sn, s AS started_at, s + INTERVAL 8 HOUR AS ended_at, COUNT(*) AS source_row_count
FROM (SELECT o_orderkey, o_orderdate + INTERVAL 14 HOUR AS s FROM orders WHERE o_orderdate IS NOT NULL) GROUP BY o_orderkey, s""")
def _sleep(spark, sf):
    """STG-06: sleep sessions."""
    return A.observations(A.sleep_source(spark, sf), A.SLEEP, "started_at")


@register("stg07_sleep_stages", f"""
SELECT {_key("CAST(k AS VARCHAR)", "f", _TIME.format("s"), _TIME.format("s + INTERVAL 30 MINUTE"))} AS source_observation_id,
       k AS sleep_sn, f AS stage_code, s AS started_at, s + INTERVAL 30 MINUTE AS ended_at, COUNT(*) AS source_row_count
FROM (SELECT l_orderkey AS k, l_returnflag AS f, o_orderdate + INTERVAL 14 HOUR + INTERVAL (l_linenumber * 30) MINUTE AS s
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderdate IS NOT NULL) GROUP BY k, f, s""")
def _stages(spark, sf):
    """STG-07: sleep-stage intervals; lines that repeat a stage keep their number."""
    return A.observations(A.stage_source(spark, sf), A.STAGE, "started_at")


# ---- charts: one series each, with the chart's row limit (100 for bars, 10,000 for lines)

def _chart(name: str, metric: str, x: str, y: str, how: str, limit: int, doc: str) -> None:
    fold = {"sum": "SUM", "avg": "AVG"}[how]
    sql = f"SELECT {x}, {fold}({y}) AS {how}_{y} FROM ({REGISTRY[metric].sql}) m GROUP BY {x} ORDER BY {x} LIMIT {limit}"
    source = {"met04_measurement_participation_weekly": M.measurement_participation_weekly, "met03_coaching_adherence_by_domain": M.coaching_adherence_by_domain,
              "met07_scoring_coverage_monthly": M.scoring_coverage_monthly, "met05_population_risk_monthly": M.population_risk_monthly,
              "met06_high_risk_load_monthly": M.high_risk_load_monthly}[metric]
    register(name, sql, doc)(lambda spark, sf: M.chart_series(source(spark, sf), x, y, how, limit))


_chart("chart2_weekly_participation", "met04_measurement_participation_weekly", "week_start_date", "measuring_users", "sum", 100,
       "CHT-02: measuring users by week, a bar chart of the first 100 weeks.")
_chart("chart4_adherence_by_domain", "met03_coaching_adherence_by_domain", "domain", "adherence_pct", "avg", 100, "CHT-04: adherence by domain.")
_chart("chart5_scoring_coverage", "met07_scoring_coverage_monthly", "month_start_date", "coverage_pct", "avg", 10_000, "CHT-05: scoring coverage by month.")
_chart("chart6_mean_rank", "met05_population_risk_monthly", "month_start_date", "mean_irs_plus", "avg", 10_000, "CHT-06: mean rank by month.")
_chart("chart7_high_risk_load", "met06_high_risk_load_monthly", "month_start_date", "avg_high_risk_diseases", "avg", 10_000, "CHT-07: high-risk items a user by month.")
