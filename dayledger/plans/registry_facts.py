"""Registered queries of the panel over all facts, with their oracle SQL.

The SQL keeps the panel long (a row a user, day and channel) to the end and pivots
last; the Spark plan aggregates into columns first. Constants of the model stand
in both, written out here once more.
"""

from __future__ import annotations

from dayledger.plans import fact_panel as FP
from dayledger.plans.dims import dim_user
from dayledger.plans.oracle_sql import KST, age, age_band, with_ctes
from dayledger.plans.registry import register

# (channel, eligibility, value, second value)
_CH = [("app_login", "app", "app_login_events", None), ("app_action", "app", "app_actions", None),
       ("app_search", "app", "app_search_events", None), ("share_created", "app", "share_links_created", None),
       ("share_interaction", "app", "share_interaction_events", None),
       ("coaching", "program", "routines_delivered", "routines_completed"),
       ("measurement", "passive", "manual_measurements", None), ("meal", "passive", "meal_records", None),
       ("wearable", "passive", "wearable_streams_active", None),
       ("integrated_analysis", "enrolled", "intg_analysis_rows", None),
       ("irs_score", "enrolled", "diseases_scored", "diseases_with_irs_score")]
_ENGAGING = ("app_login_events", "app_actions", "app_search_events", "share_links_created")

# (channel, system, schema, table, mode, time of the last load)
_EV, _ALL, _SHIP = "(SELECT MAX(ts) FROM events WHERE event_type = '{}')", "(SELECT MAX(ts) FROM events)", "(SELECT replay FROM shipped)"
_DEPS = [("app_login", "events_view", True, _EV.format("view")), ("app_action", "events_click", True, _EV.format("click")),
         ("app_search", "events_purchase", False, _EV.format("purchase")), ("share_created", "orders", False, _ALL),
         ("share_interaction", "lineitem", False, _ALL), ("coaching", "orders", False, _ALL), ("measurement", "orders", False, _ALL),
         *[("measurement", t, True, _SHIP) for t in ("quantity", "extended_price", "discount", "tax")],
         ("measurement", "customer", False, _ALL), ("meal", "orders", False, _ALL), ("meal", "meal", True, _SHIP),
         ("wearable", "customer", False, _ALL), *[("wearable", f"events_{t}", True, _EV.format(t)) for t in ("click", "view", "purchase", "error", "signup")],
         ("integrated_analysis", "events_props", True, "(SELECT MAX(ts) FROM events WHERE props IS NOT NULL)"),
         ("irs_score", "lineitem_scores", True, _SHIP)]


def _replay(day: str) -> str:
    return f"(DATE '2023-11-10' + CAST(floor((({day}) - DATE '1995-01-01') / 30.0) AS INTEGER))"


def _part(code: str, source: str, user: str, day: str, item: str = "NULL", flag: str = "false", where: str = "true") -> str:
    return (f"SELECT {user} AS user_id, {day} AS ymd, '{code}' AS ch, CAST({item} AS VARCHAR) AS item, {flag} AS flag, "
            f"CAST(NULL AS VARCHAR) AS sig, CAST(NULL AS BIGINT) AS sig_event FROM {source} WHERE {where}")


_LI = "lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey AND o.o_custkey IS NOT NULL"
_SHIPPED = _replay(f"CAST(l.l_shipdate {KST} AS DATE)")
_OBSERVED = "observed AS (" + "\nUNION ALL ".join([
    *[_part(code, "ev", "user_id", "event_date", where=f"event_type = '{t}' AND ts IS NOT NULL")
      for t, code in (("view", "app_login"), ("click", "app_action"), ("purchase", "app_search"))],
    _part("wearable", "ev", "user_id", "event_date", "event_type", "event_type = 'signup' OR value IS NOT NULL",
          "event_type IN ('click', 'view', 'purchase', 'error', 'signup') AND ts IS NOT NULL"),
    _part("share_created", "deliveries", "user_id", _replay(f"CAST(delivered_at {KST} AS DATE)")),
    _part("coaching", "deliveries", "user_id", _replay("ymd_date"), flag="completed_at IS NOT NULL"),
    _part("share_interaction", _LI, "o.o_custkey", _SHIPPED),
    _part("meal", _LI, "o.o_custkey", _SHIPPED, where="l.l_returnflag IS DISTINCT FROM 'R'"),
    _part("irs_score", _LI, "o.o_custkey", _replay("CAST(l.l_shipdate AS DATE)"), "l.l_partkey", "l.l_quantity IS NOT NULL", "l.l_partkey IS NOT NULL"),
    _part("measurement", "readings r JOIN orders o ON o.o_orderkey = r.user_lifelog_sn AND o.o_custkey IS NOT NULL", "o.o_custkey",
          _replay(f"CAST(r.measured_at {KST} AS DATE)")),
    f"""SELECT user_id, event_date, 'integrated_analysis', NULL, false, json_extract_string(props, '$.k'), event_id
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_date ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn
      FROM ev WHERE NOT list_contains(json_keys(props), 'error')) t WHERE rn = 1"""]) + ")"
_FACTS = [
    _OBSERVED,
    """obs AS (SELECT user_id, ymd, ch,
  CASE ch WHEN 'wearable' THEN COUNT(DISTINCT item) FILTER (WHERE flag) WHEN 'irs_score' THEN COUNT(DISTINCT item) ELSE COUNT(*) END AS v,
  CASE ch WHEN 'irs_score' THEN COUNT(DISTINCT item) FILTER (WHERE flag) ELSE COUNT(*) FILTER (WHERE flag) END AS w,
  MAX(sig) AS sig, MAX(sig_event) AS sig_event
FROM observed WHERE ymd IS NOT NULL AND user_id IN (SELECT user_id FROM dim_user) GROUP BY user_id, ymd, ch)""",
    f"shipped AS (SELECT CAST({_replay('CAST(MAX(l_shipdate) AS DATE)')} AS TIMESTAMP) AS replay FROM lineitem)",
    "needs AS (" + " UNION ALL ".join(f"SELECT '{c}' AS ch, '{t}' AS target, {str(inc).lower()} AS incremental, {at} AS loaded_at" for c, t, inc, at in _DEPS) + ")",
    f"""load AS (SELECT c.ch AS channel_code,
  (SELECT COUNT(*) FROM needs n WHERE n.ch = c.ch) AS dependency_count,
  (SELECT COUNT(loaded_at) FROM needs n WHERE n.ch = c.ch) AS successful_dependency_count,
  NOT EXISTS (SELECT 1 FROM needs n WHERE n.ch = c.ch AND n.loaded_at IS NULL) AS all_dependencies_successful,
  (SELECT MIN(loaded_at) FROM needs n WHERE n.ch = c.ch) AS oldest_recorded_success_at,
  (SELECT MAX(loaded_at) FROM needs n WHERE n.ch = c.ch) AS latest_recorded_success_at,
  (SELECT CASE WHEN COUNT(*) = COUNT(loaded_at) THEN CAST(MIN(loaded_at) {KST} AS DATE) - 1 END FROM needs n WHERE n.ch = c.ch) AS load_complete_through_date,
  (SELECT MAX(ymd) FROM obs WHERE obs.ch = c.ch) AS observed_event_through_date,
  EXISTS (SELECT 1 FROM needs n WHERE n.ch = c.ch AND n.incremental) AS has_empty_incremental_run_blind_spot,
  'TARGET_SUCCESS_ONLY' AS completion_evidence_kind
FROM (SELECT DISTINCT ch FROM needs) c)""",
    "kinds AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{k}')" for c, k, _, _ in _CH) + ") k(ch, kind))",
    """since AS (SELECT u.user_id, k.ch, k.kind, CASE k.kind
    WHEN 'app' THEN least(u.app_registered_date, (SELECT MIN(o.ymd) FROM obs o JOIN kinds a USING (ch) WHERE a.kind = 'app' AND o.user_id = u.user_id))
    WHEN 'program' THEN least(u.joined_date, (SELECT MIN(o.ymd) FROM obs o WHERE o.ch = k.ch AND o.user_id = u.user_id))
    WHEN 'enrolled' THEN u.joined_date END AS first_day
  FROM dim_user u, kinds k)""",
    """days AS (SELECT u.user_id, u.birth_year, u.joined_date, CAST(unnest(generate_series(
    least(u.joined_date, (SELECT MIN(ymd) FROM obs o WHERE o.user_id = u.user_id)),
    (SELECT MAX(greatest(load_complete_through_date, observed_event_through_date)) FROM load), INTERVAL 1 DAY)) AS DATE) AS ymd FROM dim_user u)""",
    """cells AS (SELECT d.user_id, d.ymd, s.ch, o.sig, o.sig_event, l.load_complete_through_date AS through_date, s.first_day, o.v IS NOT NULL AS seen,
    CASE WHEN o.v IS NOT NULL THEN o.v WHEN s.kind <> 'passive' AND d.ymd <= l.load_complete_through_date AND d.ymd >= s.first_day THEN 0 END AS v,
    CASE WHEN o.v IS NOT NULL THEN o.w WHEN s.kind <> 'passive' AND d.ymd <= l.load_complete_through_date AND d.ymd >= s.first_day THEN 0 END AS w,
    CASE WHEN o.v IS NOT NULL THEN 'OBSERVED_ACTIVITY'
         WHEN coalesce(d.ymd > l.load_complete_through_date, true) THEN 'NOT_LOADED'
         WHEN s.kind = 'passive' OR (s.kind = 'app' AND s.first_day IS NULL) THEN 'ELIGIBILITY_UNKNOWN'
         WHEN d.ymd < s.first_day THEN 'NOT_YET_ELIGIBLE' ELSE 'OBSERVED_ZERO' END AS state
  FROM days d JOIN since s USING (user_id) JOIN load l ON l.channel_code = s.ch
  LEFT JOIN obs o ON o.user_id = d.user_id AND o.ymd = d.ymd AND o.ch = s.ch)""",
]


def _panel_sql() -> str:
    cols = []
    for code, _, value, second in _CH:
        cols.append(f"MAX(c.v) FILTER (WHERE c.ch = '{code}') AS {value}")
        if second:
            cols.append(f"MAX(c.w) FILTER (WHERE c.ch = '{code}') AS {second}")
        cols.append(f"MAX(c.state) FILTER (WHERE c.ch = '{code}') AS {code}_state")
        cols.append(f"MAX(c.through_date) FILTER (WHERE c.ch = '{code}') AS {code}_through")
    months = "extract(year FROM age(d.ymd, d.joined_date)) * 12 + extract(month FROM age(d.ymd, d.joined_date))"
    return f"""fact_panel AS (SELECT d.user_id, d.ymd AS ymd_date,
  {age('d.ymd', 'd.birth_year')} AS age_at_activity, {age_band('d.ymd', 'd.birth_year')} AS age_band_5y,
  d.ymd - d.joined_date AS days_since_joined, CAST({months} AS BIGINT) AS months_since_joined,
  MAX(c.sig) AS signature_code, MAX(c.sig_event) AS signature_event_id,
  CASE WHEN bool_or(c.seen AND c.ch = 'app_login') THEN true
       WHEN bool_or(c.ch = 'app_login' AND c.v = 0) THEN false END AS did_app_login,
  CASE WHEN bool_or(c.seen AND c.ch = 'wearable') THEN true END AS had_passive_collection,
  {', '.join(cols)}
FROM days d JOIN cells c ON c.user_id = d.user_id AND c.ymd = d.ymd
GROUP BY d.user_id, d.ymd, d.birth_year, d.joined_date)"""


_NEEDED = ["dim_user", "deliveries", "readings"]
_PANEL = [*_FACTS, _panel_sql()]


@register("fct12_fact_load_status", with_ctes(_NEEDED, "SELECT * FROM load", _FACTS))
def _load_status(spark, sf):
    """FCT-12 over all facts: eleven channels, twenty-two dependencies."""
    return FP.load_status(spark, sf)


@register("pnl01_fact_panel", with_ctes(_NEEDED, "SELECT * FROM fact_panel", _PANEL))
def _panel(spark, sf):
    """PNL-01 over all facts: counts, streams active, distinct items and carried
    columns in one long form; a channel that extends eligibility only."""
    return FP.user_day(spark, sf)


@register("pnl02_fact_panel_wide", with_ctes(_NEEDED, """
SELECT p.*, u.segment, u.site_name, u.cohort_group, isodow(p.ymd_date) AS iso_day_of_week,
       p.ymd_date - CAST(isodow(p.ymd_date) - 1 AS INTEGER) AS week_start_date,
       make_date(year(p.ymd_date), month(p.ymd_date), 1) AS month_start_date, strftime(p.ymd_date, '%Y-%m') AS year_month
FROM fact_panel p JOIN dim_user u USING (user_id)""", _PANEL))
def _wide(spark, sf):
    """PNL-02 over all facts: user and calendar attributes in place."""
    from dayledger.plans import panel as P
    return P.user_day_wide(FP.user_day(spark, sf), dim_user(spark, sf))


def _month_sql() -> str:
    """From flags a day, summed for the month."""
    sums = []
    for code, kind, value, second in _CH:
        if kind != "passive":
            sums.append(f"SUM(CAST({code}_state IN ('OBSERVED_ACTIVITY', 'OBSERVED_ZERO') AS BIGINT)) AS {code}_observed_days")
        sums += [f"SUM({value}) AS {value}", f"SUM(CAST(coalesce({value} > 0, false) AS BIGINT)) AS {code}_activity_days"]
        if second:
            sums.append(f"SUM({second}) AS {second}")
    engaged = " OR ".join(f"coalesce({v} > 0, false)" for v in _ENGAGING)
    return f"""
SELECT t.*, ending AS month_end_date,
  (year(month_start_date) - year(joined)) * 12 + month(month_start_date) - month(joined) AS cohort_month_index,
  panel_start_date <> month_start_date AS is_left_partial_month, panel_end_date <> ending AS is_right_censored,
  panel_days < ending - month_start_date + 1 AS is_partial_month,
  CAST(NULL AS BIGINT) AS remote_care_qualifying_days, 'HYPOTHESIS_UNDEFINED' AS remote_care_qualifying_day_status
FROM (SELECT x.* EXCLUDE (joined), x.joined, last_day(x.month_start_date) AS ending FROM (
  SELECT p.user_id, make_date(year(ymd_date), month(ymd_date), 1) AS month_start_date, any_value(u.joined_date) AS joined,
         MIN(ymd_date) AS panel_start_date, MAX(ymd_date) AS panel_end_date, COUNT(*) AS panel_days, {', '.join(sums)},
         SUM(CAST({engaged} AS BIGINT)) AS app_engaged_days
  FROM fact_panel p JOIN dim_user u ON u.user_id = p.user_id GROUP BY 1, 2) x) t"""


@register("pnl03_fact_month", with_ctes(_NEEDED, _month_sql().replace("SELECT t.*,", "SELECT t.* EXCLUDE (joined, ending),"), _PANEL))
def _month(spark, sf):
    """PNL-03 over all facts: interactions with a user's links engage nobody."""
    return FP.user_month(FP.user_day(spark, sf), dim_user(spark, sf))
