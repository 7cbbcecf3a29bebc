"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder reads the driver tables of ``sf_dir`` in full and returns a lazy
DataFrame whose columns are normalised at the edge (integers as bigint,
decimals and floats as double) so both engines compare cleanly.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.plans import dims as D
from dayledger.plans import facts as FT
from dayledger.plans import load_status as LS
from dayledger.plans import metrics as M
from dayledger.plans import panel as P
from dayledger.plans import wearable as W
from dayledger.plans.oracle_sql import KST, age, age_band, with_ctes


def edge(df: DataFrame) -> DataFrame:
    """Normalise output types: integral -> bigint, decimal/float -> double."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        elif isinstance(t, (T.DecimalType, T.FloatType)):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, doc: str = ""):
    def deco(fn):
        REGISTRY[name] = Query(name, lambda spark, sf: edge(fn(spark, sf)), sql, doc or fn.__doc__ or "")
        return fn
    return deco


# --------------------------------------------------------------------------- metrics

@register("met01_app_engagement_daily", with_ctes(["fact_ev"], """
SELECT event_date AS action_date, COUNT(DISTINCT user_id) AS active_users, COUNT(*) AS actions
FROM fact_ev WHERE event_type = 'click' GROUP BY event_date"""))
def _met01(spark, sf):
    """MET-01: daily distinct active users and actions (cohort, local day)."""
    return M.app_engagement_daily(spark, sf)


_ADH = "CAST(((2000 * {a} + {b}) // (2 * {b})) AS DOUBLE) / 10"
# Exact half-up rounding of a non-negative integer ratio s / n to d decimals
# (DuckDB's ROUND on a double can land on the other side of a .5 boundary).
_RATIO = "CAST(((2 * {scale} * ({s}) + ({n})) // (2 * ({n}))) AS DOUBLE) / {scale}"

@register("met02_coaching_adherence_daily", with_ctes(["coaching"], f"""
SELECT ymd_date, COUNT(*) AS activities_delivered,
       COUNT(*) FILTER (WHERE is_completed) AS activities_completed,
       {_ADH.format(a="COUNT(*) FILTER (WHERE is_completed)", b="COUNT(*)")} AS adherence_pct
FROM coaching GROUP BY ymd_date"""))
def _met02(spark, sf):
    """MET-02: coaching adherence % per day."""
    return M.coaching_adherence_daily(spark, sf)


@register("met03_coaching_adherence_by_domain", with_ctes(["coaching"], f"""
SELECT domain, COUNT(*) AS activities_delivered,
       COUNT(*) FILTER (WHERE is_completed) AS activities_completed,
       {_ADH.format(a="COUNT(*) FILTER (WHERE is_completed)", b="COUNT(*)")} AS adherence_pct
FROM coaching GROUP BY domain"""))
def _met03(spark, sf):
    """MET-03: adherence % by domain."""
    return M.coaching_adherence_by_domain(spark, sf)


@register("met04_measurement_participation_weekly", with_ctes(["measurement"], """
SELECT CAST(date_trunc('week', measured_date) AS DATE) AS week_start_date,
       COUNT(DISTINCT user_id) AS measuring_users, COUNT(*) AS readings
FROM measurement GROUP BY 1"""))
def _met04(spark, sf):
    """MET-04: weekly measuring users and readings."""
    return M.measurement_participation_weekly(spark, sf)


@register("met05_population_risk_monthly", with_ctes(["disease_day"], f"""
SELECT CAST(date_trunc('month', ymd_date) AS DATE) AS month_start_date,
       COUNT(DISTINCT user_id) AS users_scored,
       {_RATIO.format(scale=100, s="SUM(irsp_score)", n="COUNT(irsp_score)")} AS mean_irs_plus,
       {_RATIO.format(scale=100, s="SUM(irs_score)", n="COUNT(irs_score)")} AS mean_irs
FROM disease_day WHERE is_in_catalog AND irsp_score IS NOT NULL GROUP BY 1"""))
def _met05(spark, sf):
    """MET-05: monthly mean rank over catalogue items."""
    return M.population_risk_monthly(spark, sf)


@register("met06_high_risk_load_monthly", with_ctes(["disease_day"], f"""
SELECT month_start_date, COUNT(*) AS users_scored,
       {_RATIO.format(scale=100, s="SUM(high_risk_diseases)", n="COUNT(*)")} AS avg_high_risk_diseases,
       MAX(high_risk_diseases) AS max_high_risk_diseases
FROM (SELECT CAST(date_trunc('month', ymd_date) AS DATE) AS month_start_date, user_id,
             COUNT(DISTINCT disease_id) FILTER (WHERE irs_score >= 80) AS high_risk_diseases
      FROM disease_day WHERE is_in_catalog AND irs_score IS NOT NULL GROUP BY 1, 2) t
GROUP BY month_start_date"""))
def _met06(spark, sf):
    """MET-06: monthly average / max distinct high-risk items per user."""
    return M.high_risk_load_monthly(spark, sf)


@register("met07_scoring_coverage_monthly", with_ctes(["disease_day"], f"""
SELECT d.month_start_date, (SELECT COUNT(*) FROM dim_user) AS cohort_size, d.users_scored,
       {_ADH.format(a="d.users_scored", b="(SELECT COUNT(*) FROM dim_user)")} AS coverage_pct
FROM (SELECT CAST(date_trunc('month', ymd_date) AS DATE) AS month_start_date,
             COUNT(DISTINCT user_id) AS users_scored FROM disease_day GROUP BY 1) d"""))
def _met07(spark, sf):
    """MET-07: scoring coverage % (scalar subquery denominator)."""
    return M.scoring_coverage_monthly(spark, sf)


# --------------------------------------------------------------------------- dimensions

@register("dim02_calendar", with_ctes(["ev"], """
SELECT d AS date_day, year(d) AS year_num, quarter(d) AS quarter_num, month(d) AS month_num,
       day(d) AS day_of_month, isodow(d) AS iso_day_of_week, week(d) AS iso_week_num,
       CAST(date_trunc('month', d) AS DATE) AS month_start_date,
       CAST(date_trunc('week', d) AS DATE) AS week_start_date,
       strftime(d, '%Y-%m') AS year_month, strftime(d, '%B') AS month_name,
       strftime(d, '%A') AS day_name, isodow(d) >= 6 AS is_weekend
FROM (SELECT CAST(unnest(generate_series(MIN(event_date), MAX(event_date), INTERVAL 1 DAY)) AS DATE) AS d
      FROM ev) s"""))
def _dim02(spark, sf):
    """DIM-02: calendar over the event date span, 12 attributes."""
    return D.event_calendar(spark, sf)


@register("dim06_user", with_ctes(["dim_user"], "SELECT * FROM dim_user"))
def _dim06(spark, sf):
    """DIM-06: cohort user dimension (SCD1)."""
    return D.dim_user(spark, sf)


@register("dim07_bridge_user_site", with_ctes(["dim_user"], """
SELECT u.user_id, n.n_nationkey AS site_key, n.n_name AS site_name, r.r_name AS region_name,
       'KR' AS country_code
FROM dim_user u JOIN nation n ON n.n_nationkey = u.site_key
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey"""))
def _dim07(spark, sf):
    """DIM-07: user -> current site bridge."""
    return D.bridge_user_site(spark, sf)


# --------------------------------------------------------------------------- facts

@register("fct02_view_event", with_ctes(["fact_ev"], """
SELECT md5(concat_ws('|', CAST(user_id AS VARCHAR), strftime(ts, '%Y-%m-%d %H:%M:%S.%f'))) AS event_key,
       event_id, user_id, ts AS event_at, event_date, value
FROM fact_ev WHERE event_type = 'view'"""))
def _fct02(spark, sf):
    """FCT-02: channel event fact with md5 event key, cohort guard, local date."""
    return FT.app_event_fact(spark, sf, "view")


@register("fct06_coaching_event", with_ctes(["coaching"], "SELECT * FROM coaching"))
def _fct06(spark, sf):
    """FCT-06: deliveries with completion flag and latency minutes."""
    return FT.coaching_event(spark, sf)


@register("fct08_measurement", with_ctes(["measurement"], "SELECT * FROM measurement"))
def _fct08(spark, sf):
    """FCT-08: tall readings attributed through the parent, cohort-guarded."""
    return FT.measurement_fact(spark, sf)


@register("fct09_user_disease_day", with_ctes(["disease_day"], "SELECT * FROM disease_day"))
def _fct09(spark, sf):
    """FCT-09: user x day x item scores with catalogue flag."""
    return FT.user_disease_day(spark, sf)


MILESTONES_SQL = """
SELECT user_id, milestone_code, occurred_date, occurred_at, source_relation,
       CASE source_relation WHEN 'dim_user' THEN 'DATE' ELSE 'TIMESTAMP' END AS temporal_precision
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, milestone_code ORDER BY occurred_date, occurred_at NULLS FIRST, rank) AS nth
      FROM (SELECT user_id, 'cohort_enrolled' AS milestone_code, joined_date AS occurred_date,
                   CAST(NULL AS TIMESTAMP) AS occurred_at, 'dim_user' AS source_relation, 1 AS rank FROM dim_user
            UNION ALL SELECT user_id, 'first_' || event_type, event_date, ts, 'app_event', 2 FROM fact_ev
            WHERE event_type IN ('view', 'click', 'purchase', 'error', 'signup')
            UNION ALL SELECT user_id, 'first_delivery', ymd_date, delivered_at, 'coaching_event', 3 FROM coaching) c
      WHERE occurred_date IS NOT NULL) f
WHERE nth = 1"""


@register("fct13_milestones", with_ctes(["fact_ev", "coaching"], MILESTONES_SQL))
def _fct13(spark, sf):
    """FCT-13: first occurrence per user x milestone code."""
    return FT.milestones(spark, sf)


# --------------------------------------------------------------------------- wearable

_SAMPLES = f"""samples AS (SELECT user_id AS user_lifelog_sn, ts AS measured_at,
  event_type AS type_code, CAST(value AS DECIMAL(18,2)) AS sample_value FROM events)"""
_COLLAPSED = """collapsed AS (SELECT user_lifelog_sn, measured_at, type_code, sample_value,
  COUNT(*) AS source_row_count FROM samples WHERE type_code = 'error' AND measured_at IS NOT NULL
  GROUP BY ALL)"""
_SKEY = ("md5(coalesce(CAST(user_lifelog_sn AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' || "
         "coalesce(strftime(measured_at, '%Y-%m-%d %H:%M:%S.%f'), '_dbt_utils_surrogate_key_null_') || '-' || "
         "coalesce(type_code, '_dbt_utils_surrogate_key_null_') || '-' || "
         "coalesce(CAST(sample_value AS VARCHAR), '_dbt_utils_surrogate_key_null_'))")


def _day_sql() -> str:
    streams = []
    for code, value, kcal in (("click", True, False), ("view", True, False),
                              ("purchase", False, True), ("signup", False, False)):
        mean = _RATIO.format(scale=1000000, s="SUM(CAST(round(s.sample_value * 100) AS BIGINT))",
                             n="100 * COUNT(s.sample_value)")
        v = (f"SUM(s.sample_value) AS value_sum, {mean} AS value_mean, "
             "MIN(s.sample_value) AS value_min, MAX(s.sample_value) AS value_max"
             if value else "NULL AS value_sum, NULL AS value_mean, NULL AS value_min, NULL AS value_max")
        k = ("SUM(s.sample_value) AS kcal_sum" if kcal else "NULL AS kcal_sum") + \
            ", NULL AS distance_sum, NULL AS duration_hours"
        streams.append(
            f"SELECT s.user_lifelog_sn AS user_id, CAST(s.measured_at {KST} AS DATE) AS wear_date, '{code}' AS stream_code, "
            f"COUNT(*) AS n_samples, {v}, {k} FROM samples s "
            f"WHERE s.user_lifelog_sn IS NOT NULL AND s.type_code = '{code}' AND s.measured_at IS NOT NULL GROUP BY 1, 2")
    streams.append(
        f"SELECT c.user_lifelog_sn AS user_id, CAST(c.measured_at {KST} AS DATE) AS wear_date, 'error' AS stream_code, "
        "SUM(c.source_row_count) AS n_samples, SUM(c.sample_value * c.source_row_count) AS value_sum, "
        + _RATIO.format(scale=1000000,
                        s="SUM(CAST(round(c.sample_value * 100) AS BIGINT) * c.source_row_count)",
                        n="100 * NULLIF(SUM(c.source_row_count), 0)") + " AS value_mean, "
        "MIN(c.sample_value) AS value_min, MAX(c.sample_value) AS value_max, NULL AS kcal_sum, "
        "NULL AS distance_sum, NULL AS duration_hours "
        "FROM collapsed c WHERE c.user_lifelog_sn IS NOT NULL GROUP BY 1, 2")
    # interval stream, dated from its start; duration in hours
    streams.append(
        f"SELECT d.user_id, CAST(d.delivered_at {KST} AS DATE) AS wear_date, 'delivery' AS stream_code, "
        "COUNT(*) AS n_samples, NULL AS value_sum, NULL AS value_mean, NULL AS value_min, NULL AS value_max, "
        "NULL AS kcal_sum, NULL AS distance_sum, SUM(epoch(d.completed_at - d.delivered_at) / 3600.0) "
        "AS duration_hours FROM (SELECT o.o_custkey AS user_id, o.o_orderdate AS delivered_at, "
        "CASE WHEN o.o_orderstatus = 'F' THEN ls.last_ship END AS completed_at FROM orders o "
        "LEFT JOIN (SELECT l_orderkey, MAX(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) ls "
        "ON ls.l_orderkey = o.o_orderkey) d "
        "WHERE d.user_id IS NOT NULL AND d.delivered_at IS NOT NULL GROUP BY 1, 2")
    body = "\nUNION ALL ".join(streams)
    return (f"wday AS (SELECT user_id, wear_date, stream_code, CAST(n_samples AS BIGINT) AS n_samples, "
            f"CAST(value_sum AS DOUBLE) AS value_sum, CAST(value_mean AS DOUBLE) AS value_mean, "
            f"CAST(value_min AS DOUBLE) AS value_min, CAST(value_max AS DOUBLE) AS value_max, "
            f"CAST(kcal_sum AS DOUBLE) AS kcal_sum, CAST(distance_sum AS DOUBLE) AS distance_sum, "
            f"CAST(duration_hours AS DOUBLE) AS duration_hours FROM ({body}) x)")


_WDAY = _day_sql()


@register("int01_collapsed_samples", with_ctes(["ev"], f"""
SELECT {_SKEY} AS source_observation_id, user_lifelog_sn, measured_at, type_code,
       CAST(sample_value AS DOUBLE) AS sample_value, source_row_count FROM collapsed""",
                                               [_SAMPLES, _COLLAPSED]))
def _int01(spark, sf):
    """INT-01: distinct payload + multiplicity + surrogate key (once)."""
    return W.collapsed_stream(spark, sf)


@register("int02_wearable_day", with_ctes(["dim_user"], "SELECT * FROM wday",
                                          [_SAMPLES, _COLLAPSED, _WDAY]))
def _int02(spark, sf):
    """INT-02: (user, local day, stream) daily aggregate, heart-rate-style
    stream weighted by multiplicity."""
    return W.wearable_day(spark, sf)


def _pivot_sql() -> str:
    cols = []
    for code, value, kcal in (("click", True, False), ("view", True, False),
                              ("purchase", False, True), ("signup", False, False),
                              ("error", True, False), ("delivery", False, False)):
        cols.append(f"MAX(n_samples) FILTER (WHERE stream_code = '{code}') AS {code}_samples")
        if code == "delivery":
            cols.append("MAX(duration_hours) FILTER (WHERE stream_code = 'delivery') AS delivery_hours")
        if value:
            for m in ("sum", "mean", "min", "max"):
                cols.append(f"MAX(value_{m}) FILTER (WHERE stream_code = '{code}') AS {code}_{m}")
        if kcal:
            cols.append(f"MAX(kcal_sum) FILTER (WHERE stream_code = '{code}') AS {code}_kcal")
    return "SELECT user_id, wear_date AS ymd_date, " + ", ".join(cols) + " FROM wday WHERE user_id IN (SELECT user_id FROM cohort) GROUP BY 1, 2"


@register("fct11_wearable_day_pivot", with_ctes(["dim_user"], _pivot_sql(),
                                                [_SAMPLES, _COLLAPSED, _WDAY]))
def _fct11(spark, sf):
    """FCT-11: sparse daily pivot of the stream aggregate."""
    return W.wearable_pivot(W.wearable_day(spark, sf), FT.cohort_ids(spark, sf))


@register("dtl02_detail_fact", with_ctes(["dim_user"], f"""
SELECT {_SKEY} AS source_observation_id, u.user_id, measured_at,
       CAST(measured_at {KST} AS DATE) AS ymd_date, type_code,
       CAST(sample_value AS DOUBLE) AS sample_value, source_row_count
FROM collapsed c JOIN dim_user u ON u.user_id = c.user_lifelog_sn""", [_SAMPLES, _COLLAPSED]))
def _dtl02(spark, sf):
    """DTL-02: source-grain detail fact of the collapsed stream."""
    return W.detail_fact(spark, sf)


# --------------------------------------------------------------------------- load status & panels

_DEPS_VALUES = ", ".join("('" + "', '".join(d) + "')" for d in LS.DEPENDENCIES)
_STATUS = [
    "ctl AS (SELECT 'events' AS source_system, 'public' AS schema_name, "
    "'events_' || event_type AS table_name, 'SUCCESS' AS last_status, MAX(ts) AS updated_at "
    "FROM events GROUP BY event_type UNION ALL SELECT s, 'public', t, 'SUCCESS', "
    "(SELECT MAX(ts) FROM events) FROM (VALUES ('crm', 'customer'), ('sales', 'orders')) v(s, t))",
    f"deps AS (SELECT * FROM (VALUES {_DEPS_VALUES}) d(channel_code, source_system, schema_name, "
    "table_name, load_mode))",
    "frontiers AS (SELECT event_type AS channel_code, MAX(event_date) AS observed_event_through_date "
    "FROM fact_ev GROUP BY 1)",
    "status AS (SELECT r.channel_code, r.dependency_count, r.successful_dependency_count, "
    "r.all_dependencies_successful, r.oldest_recorded_success_at, r.latest_recorded_success_at, "
    f"CASE WHEN r.all_dependencies_successful THEN CAST(r.oldest_recorded_success_at {KST} AS DATE) - 1 "
    "END AS load_complete_through_date, o.observed_event_through_date, "
    "r.has_empty_incremental_run_blind_spot, 'TARGET_SUCCESS_ONLY' AS completion_evidence_kind "
    "FROM (SELECT channel_code, COUNT(*) AS dependency_count, "
    "COUNT(*) FILTER (WHERE last_status = 'SUCCESS') AS successful_dependency_count, "
    "bool_and(last_status = 'SUCCESS' AND updated_at IS NOT NULL) AS all_dependencies_successful, "
    "MIN(updated_at) AS oldest_recorded_success_at, MAX(updated_at) AS latest_recorded_success_at, "
    "bool_or(load_mode = 'INCREMENTAL') AS has_empty_incremental_run_blind_spot "
    "FROM deps LEFT JOIN ctl USING (source_system, schema_name, table_name) GROUP BY channel_code) r "
    "LEFT JOIN frontiers o USING (channel_code))",
]


@register("fct12_channel_load_status", with_ctes(["fact_ev"], "SELECT * FROM status", _STATUS))
def _fct12(spark, sf):
    """FCT-12: channel load status from dependencies, control table and facts."""
    return LS.channel_load_status(spark, sf)


def _panel_ctes() -> list[str]:
    chans = P.CHANNELS
    front = ", ".join(
        [f"MAX(load_complete_through_date) FILTER (WHERE channel_code = '{c.code}') AS {c.code}_through"
         for c in chans]
        + ["MAX(greatest(load_complete_through_date, observed_event_through_date)) AS panel_through"])
    codes = ", ".join(f"'{c.code}'" for c in chans)
    app = ", ".join(f"'{c.code}'" for c in chans if c.kind == P.APP)
    daily = []
    for c in chans:
        daily.append(f"SUM(CASE WHEN channel_code = '{c.code}' THEN 1 END) AS raw_{c.value_col}")
        if c.done_col:
            daily.append(f"SUM(CASE WHEN channel_code = '{c.code}' THEN CAST(is_done AS INTEGER) END) "
                         f"AS raw_{c.done_col}")
    prog = [c for c in chans if c.kind == P.PROGRAM]
    firsts = ", ".join(["MIN(ymd_date) AS first_activity_date",
                        f"MIN(ymd_date) FILTER (WHERE channel_code IN ({app})) AS first_app_event_date"]
                       + [f"MIN(ymd_date) FILTER (WHERE channel_code = '{c.code}') AS first_{c.code}_date"
                          for c in prog])
    elig = ", ".join(
        ["least(u.app_registered_date, f.first_app_event_date) AS app_eligible_from_date",
         "u.joined_date AS enrolled_eligible_from_date",
         "least(u.joined_date, coalesce(f.first_activity_date, u.joined_date)) AS spine_from"]
        + [f"least(u.joined_date, f.first_{c.code}_date) AS {c.code}_eligible_from_date" for c in prog])
    sel = ["r.user_id", "r.ymd_date",
           f"{age('r.ymd_date', 'r.birth_year')} AS age_at_activity", f"{age_band('r.ymd_date', 'r.birth_year')} AS age_band_5y",
           "r.ymd_date - r.joined_date AS days_since_joined",
           "CAST(extract(year FROM age(r.ymd_date, r.joined_date)) * 12 "
           "+ extract(month FROM age(r.ymd_date, r.joined_date)) AS BIGINT) AS months_since_joined"]
    elig_of = {P.APP: "app_eligible_from_date", P.ENROLLED: "enrolled_eligible_from_date"}
    for c in chans:
        thr, raw = f"r.{c.code}_through", f"r.raw_{c.value_col}"
        if c.kind == P.PASSIVE:
            sel.append(f"{raw} AS {c.value_col}")
            sel.append(f"CASE WHEN {raw} IS NOT NULL THEN 'OBSERVED_ACTIVITY' WHEN {thr} IS NULL OR "
                       f"r.ymd_date > {thr} THEN 'NOT_LOADED' ELSE 'ELIGIBILITY_UNKNOWN' END AS {c.code}_state")
            continue
        e = "r." + elig_of.get(c.kind, f"{c.code}_eligible_from_date")
        sel.append(f"CASE WHEN {raw} IS NOT NULL THEN {raw} WHEN r.ymd_date <= {thr} AND r.ymd_date >= {e} "
                   f"THEN 0 END AS {c.value_col}")
        if c.done_col:
            sel.append(f"CASE WHEN {raw} IS NOT NULL THEN r.raw_{c.done_col} WHEN r.ymd_date <= {thr} "
                       f"AND r.ymd_date >= {e} THEN 0 END AS {c.done_col}")
        unknown = f"WHEN {e} IS NULL THEN 'ELIGIBILITY_UNKNOWN' " if c.kind == P.APP else ""
        sel.append(f"CASE WHEN {raw} IS NOT NULL THEN 'OBSERVED_ACTIVITY' WHEN {thr} IS NULL OR "
                   f"r.ymd_date > {thr} THEN 'NOT_LOADED' {unknown}WHEN r.ymd_date < {e} THEN "
                   f"'NOT_YET_ELIGIBLE' ELSE 'OBSERVED_ZERO' END AS {c.code}_state")
    first_app = next(c for c in chans if c.kind == P.APP)
    passive = next(c for c in chans if c.kind == P.PASSIVE)
    sel.append(f"CASE WHEN r.raw_{first_app.value_col} IS NOT NULL THEN true WHEN r.ymd_date <= "
               f"r.{first_app.code}_through AND r.ymd_date >= r.app_eligible_from_date THEN false END "
               f"AS did_{first_app.code}")
    sel.append(f"CASE WHEN r.raw_{passive.value_col} IS NOT NULL THEN true END AS had_passive_collection")
    sel += [f"r.{c.code}_through" for c in chans]
    return _STATUS + [
        f"front AS (SELECT {front} FROM status)",
        f"prows AS (SELECT user_id, event_date AS ymd_date, event_type AS channel_code, "
        f"CASE WHEN event_type IN ({', '.join(repr(c.code) for c in prog)}) THEN value >= "
        f"{P.COMPLETED_MIN_VALUE} ELSE false END AS is_done FROM fact_ev WHERE event_type IN ({codes}))",
        f"daily AS (SELECT user_id, ymd_date, {', '.join(daily)} FROM prows GROUP BY 1, 2)",
        f"firsts AS (SELECT user_id, {firsts} FROM prows GROUP BY 1)",
        f"bounds AS (SELECT u.user_id, u.joined_date, u.app_registered_date, u.birth_year, {elig} "
        "FROM dim_user u LEFT JOIN firsts f USING (user_id))",
        "cal AS (SELECT CAST(unnest(generate_series(DATE '1970-01-01', DATE '2060-12-31', "
        "INTERVAL 1 DAY)) AS DATE) AS date_day)",
        "spine AS (SELECT b.user_id, d.date_day AS ymd_date FROM bounds b CROSS JOIN front f "
        "JOIN cal d ON d.date_day BETWEEN b.spine_from AND f.panel_through)",
        "raw AS (SELECT sp.user_id, sp.ymd_date, b.* EXCLUDE (user_id), f.*, dl.* EXCLUDE (user_id, ymd_date) "
        "FROM spine sp JOIN bounds b USING (user_id) CROSS JOIN front f "
        "LEFT JOIN daily dl USING (user_id, ymd_date))",
        f"panel AS (SELECT {', '.join(sel)} FROM raw r)",
    ]


_PANEL = _panel_ctes()


@register("pnl01_user_day", with_ctes(["fact_ev"], "SELECT * FROM panel", _PANEL))
def _pnl01(spark, sf):
    """PNL-01: dense user x day panel with values, states and frontiers."""
    return P.user_day(spark, sf)


@register("pnl02_user_day_wide", with_ctes(["fact_ev"], """
SELECT p.*, u.segment, u.site_name, u.cohort_group, isodow(p.ymd_date) AS iso_day_of_week,
       CAST(date_trunc('week', p.ymd_date) AS DATE) AS week_start_date,
       CAST(date_trunc('month', p.ymd_date) AS DATE) AS month_start_date,
       strftime(p.ymd_date, '%Y-%m') AS year_month
FROM panel p LEFT JOIN dim_user u USING (user_id)""", _PANEL))
def _pnl02(spark, sf):
    """PNL-02: panel plus user and calendar attributes."""
    return P.user_day_wide(P.user_day(spark, sf), D.dim_user(spark, sf))


def _month_sql() -> str:
    aggs = ["MIN(ymd_date) AS panel_start_date", "MAX(ymd_date) AS panel_end_date",
            "COUNT(*) AS panel_days"]
    for c in P.CHANNELS:
        if c.kind != P.PASSIVE:
            aggs.append(f"COUNT(*) FILTER (WHERE {c.code}_state IN ('OBSERVED_ACTIVITY', 'OBSERVED_ZERO')) "
                        f"AS {c.code}_observed_days")
        aggs.append(f"CAST(SUM({c.value_col}) AS BIGINT) AS {c.value_col}")
        aggs.append(f"COUNT(*) FILTER (WHERE coalesce({c.value_col}, 0) > 0) AS {c.code}_activity_days")
        if c.done_col:
            aggs.append(f"CAST(SUM({c.done_col}) AS BIGINT) AS {c.done_col}")
    eng = " OR ".join(f"coalesce({c.value_col}, 0) > 0" for c in P.CHANNELS if c.kind == P.APP)
    aggs.append(f"COUNT(*) FILTER (WHERE {eng}) AS app_engaged_days")
    mend = "CAST(m.month_start_date + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE)"
    jm = "CAST(date_trunc('month', u.joined_date) AS DATE)"
    return f"""
SELECT m.*, {mend} AS month_end_date,
  CAST(extract(year FROM age(m.month_start_date, {jm})) * 12
       + extract(month FROM age(m.month_start_date, {jm})) AS BIGINT) AS cohort_month_index,
  m.panel_start_date > m.month_start_date AS is_left_partial_month,
  m.panel_end_date < {mend} AS is_right_censored,
  (m.panel_start_date > m.month_start_date OR m.panel_end_date < {mend}) AS is_partial_month,
  CAST(NULL AS BIGINT) AS remote_care_qualifying_days,
  'HYPOTHESIS_UNDEFINED' AS remote_care_qualifying_day_status
FROM (SELECT user_id, CAST(date_trunc('month', ymd_date) AS DATE) AS month_start_date, {', '.join(aggs)}
      FROM panel GROUP BY 1, 2) m JOIN dim_user u USING (user_id)"""


@register("pnl03_user_month", with_ctes(["fact_ev"], _month_sql(), _PANEL))
def _pnl03(spark, sf):
    """PNL-03: user x month panel with observed-day denominators and flags."""
    return P.user_month(P.user_day(spark, sf), D.dim_user(spark, sf))


# Second-wave registrations (generic operators) live in their own module.
from dayledger.plans import registry_ops as _ops  # noqa: E402,F401
from dayledger.plans import registry_facts as _facts  # noqa: E402,F401
from dayledger.plans import registry_landing as _landing  # noqa: E402,F401
from dayledger.plans import registry_checks as _checks  # noqa: E402,F401
from dayledger.plans import registry_streams as _streams  # noqa: E402,F401
from dayledger.plans import registry_staging as _staging  # noqa: E402,F401
