"""The checks on damaged frames: each entry damages a model's frame by a rule and
returns the rows that its check finds; the SQL states which rows these are."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayledger.operators import quality as Q
from dayledger.plans import bindings as B
from dayledger.plans import checks as C
from dayledger.plans import facts as FT
from dayledger.plans import panel as P
from dayledger.plans import wearable as W
from dayledger.plans.dims import dim_user
from dayledger.plans.oracle_sql import KST, with_ctes
from dayledger.plans.registry import _COLLAPSED, _PANEL, _SAMPLES, _WDAY, MILESTONES_SQL, register
from dayledger.sources.tables import read_table

_STREAMS = [_SAMPLES, _COLLAPSED, _WDAY]


def _hit(column: str, n: int):
    return F.col(column) % n == 0


def _parents(spark, sf):
    return (B.lifelog_parent(spark, sf).where(F.col("user_id").isNotNull()).join(FT.cohort_ids(spark, sf), "user_id", "left_semi"))


@register("dq04_damaged", """
SELECT o_orderkey, o_custkey + 1000000000 AS o_custkey FROM orders WHERE o_orderkey % 97 = 0 AND o_custkey IS NOT NULL""")
def _dq04(spark, sf):
    """DQ-04 on orders of which every 97th names a customer that isn't there."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    child = o.withColumn("o_custkey", F.when(_hit("o_orderkey", 97), F.col("o_custkey") + 1_000_000_000).otherwise(F.col("o_custkey")))
    return Q.relationships(child, "o_custkey", read_table(spark, sf, "customer", ["c_custkey"]), "c_custkey")


@register("dq08_damaged", """
SELECT 'yy' AS json_key, COUNT(*) AS n_rows FROM events WHERE event_id % 51 = 0 HAVING COUNT(*) > 0
UNION ALL SELECT 'zz', COUNT(*) FROM events WHERE event_id % 50 = 0 AND event_id % 51 <> 0 HAVING COUNT(*) > 0""")
def _dq08(spark, sf):
    """DQ-08 on payloads with keys outside the list."""
    e = read_table(spark, sf, "events", ["event_id", "props"])
    props = F.when(_hit("event_id", 51), '{"yy": 3}').when(_hit("event_id", 50), '{"k": 1, "zz": 2}').otherwise(F.col("props"))
    return Q.json_key_drift(e.withColumn("props", props), "props", ["k"])


@register("dq10_damaged", with_ctes(["dim_user"], """
SELECT user_id, CASE WHEN user_id % 7 = 0 OR site_key IS NULL THEN 0 ELSE 2 END AS n_sites
FROM dim_user WHERE user_id % 7 = 0 OR site_key IS NULL OR site_key = 3"""))
def _dq10(spark, sf):
    """DQ-10 with users without a site and a site that is there twice."""
    u = dim_user(spark, sf).withColumn("site_key", F.when(~_hit("user_id", 7), F.col("site_key")))
    sites = B.sites(spark, sf)
    return C.one_site_per_user(u, sites.union(sites.where("site_key = 3")))


@register("dq12_damaged", with_ctes(["dim_user"], f"""
SELECT r.user_id, r.wear_date, n_raw, n_collapsed, n_day + CASE WHEN r.user_id % 11 = 0 THEN 1 ELSE 0 END AS n_day,
       sum_raw, sum_collapsed, sum_day, min_raw, min_collapsed, min_day, max_raw, max_collapsed,
       CASE WHEN r.user_id % 13 <> 0 THEN max_day END AS max_day
FROM (SELECT user_lifelog_sn AS user_id, CAST(measured_at {KST} AS DATE) AS wear_date, COUNT(*) AS n_raw, CAST(SUM(sample_value) AS DOUBLE) AS sum_raw,
             CAST(MIN(sample_value) AS DOUBLE) AS min_raw, CAST(MAX(sample_value) AS DOUBLE) AS max_raw
      FROM samples WHERE type_code = 'error' AND measured_at IS NOT NULL GROUP BY 1, 2) r
JOIN (SELECT user_lifelog_sn AS user_id, CAST(measured_at {KST} AS DATE) AS wear_date, SUM(m) AS n_collapsed, CAST(SUM(sample_value * m) AS DOUBLE) AS sum_collapsed,
             CAST(MIN(sample_value) AS DOUBLE) AS min_collapsed, CAST(MAX(sample_value) AS DOUBLE) AS max_collapsed
      FROM (SELECT *, source_row_count + CASE WHEN user_lifelog_sn % 17 = 0 THEN 1 ELSE 0 END AS m FROM collapsed) GROUP BY 1, 2) c USING (user_id, wear_date)
JOIN (SELECT user_id, wear_date, n_samples AS n_day, value_sum AS sum_day, value_min AS min_day, value_max AS max_day
      FROM wday WHERE stream_code = 'error') d USING (user_id, wear_date)
WHERE r.user_id % 11 = 0 OR r.user_id % 17 = 0 OR (r.user_id % 13 = 0 AND max_raw IS NOT NULL)""", _STREAMS))
def _dq12(spark, sf):
    """DQ-12 (number, sum, mean, least, greatest) with days that count one too many,
    days that lost their greatest value and collapsed samples that count twice."""
    day = W.wearable_day(spark, sf).where(F.col("stream_code") == W.WEIGHTED_STREAM)
    day = day.withColumn("n_samples", F.col("n_samples") + _hit("user_id", 11).cast("int")).withColumn(
        "value_max", F.when(~_hit("user_id", 13), F.col("value_max")))
    collapsed = W.collapsed_stream(spark, sf).withColumn("source_row_count", F.col("source_row_count") + _hit("user_lifelog_sn", 17).cast("int"))
    return C.stream_days(W.raw_samples(spark, sf, W.WEIGHTED_STREAM), collapsed, day).drop("mean_raw", "mean_day")


@register("dq13_damaged", with_ctes(["coaching", "measurement"], """
SELECT 'coaching' AS channel_code, COUNT(*) AS staged_rows, COUNT(*) FILTER (WHERE activity_row_id % 13 <> 0) AS fact_rows
FROM coaching HAVING COUNT(*) <> COUNT(*) FILTER (WHERE activity_row_id % 13 <> 0)
UNION ALL SELECT 'measurement', COUNT(*), COUNT(*) FILTER (WHERE user_lifelog_sn % 29 <> 0)
FROM measurement HAVING COUNT(*) <> COUNT(*) FILTER (WHERE user_lifelog_sn % 29 <> 0)"""))
def _dq13(spark, sf):
    """DQ-13 with facts that lost rows of their staging."""
    cohort = FT.cohort_ids(spark, sf)
    deliveries = B.deliveries(spark, sf).join(cohort, "user_id", "left_semi")
    readings = FT.staged_readings(spark, sf).join(_parents(spark, sf).select("user_lifelog_sn"), "user_lifelog_sn", "left_semi")
    return C.staged_and_fact_rows({
        "coaching": (deliveries, FT.coaching_event(spark, sf).where(~_hit("activity_row_id", 13))),
        "measurement": (readings, FT.measurement_fact(spark, sf).where(~_hit("user_lifelog_sn", 29)))})


@register("dq14_damaged", """
SELECT COUNT(*) AS landing_rows, SUM(CASE WHEN user_id % 9 = 0 AND user_id % 10 <> 0 THEN 2 ELSE 1 END) AS staging_rows,
       COUNT(*) FILTER (WHERE user_id % 10 = 0) AS unmapped_rows
FROM events WHERE user_id IN (SELECT c_custkey FROM customer)""")
def _dq14(spark, sf):
    """DQ-14 with a mapper that lacks users and has others twice."""
    c = read_table(spark, sf, "customer", ["c_custkey"])
    e = read_table(spark, sf, "events", ["event_id", "user_id"]).join(c, F.col("user_id") == F.col("c_custkey"), "left_semi")
    mapper = c.where(~_hit("c_custkey", 10))
    return C.staging_keeps_rows(e, mapper.union(mapper.where(_hit("c_custkey", 9))), "user_id", "c_custkey")


@register("dq15_damaged", "SELECT COUNT(*) AS error_rows FROM events WHERE event_id % 20 = 0 HAVING COUNT(*) > 3")
def _dq15(spark, sf):
    """DQ-15 with error payloads above the bound."""
    e = read_table(spark, sf, "events", ["event_id", "props"])
    return C.error_payloads(e.withColumn("props", F.when(_hit("event_id", 20), '{"error": "late", "k": 1}').otherwise(F.col("props"))), "props", 3)


@register("dq17_damaged", with_ctes(["deliveries", "dim_user"], """
SELECT DISTINCT user_id, 'coaching' AS src FROM deliveries WHERE user_id NOT IN (SELECT user_id FROM dim_user)
UNION ALL SELECT DISTINCT user_id, 'share' FROM deliveries WHERE user_id % 2 = 0 AND user_id NOT IN (SELECT user_id FROM dim_user)"""))
def _dq17(spark, sf):
    """DQ-17 with facts that nobody guarded."""
    d = B.deliveries(spark, sf)
    return C.outside_cohort({"coaching": d, "share": d.where(_hit("user_id", 2)), "app": FT.guarded_events(spark, sf)}, FT.cohort_ids(spark, sf))


@register("dq18_damaged", with_ctes(["measurement"], """
SELECT user_lifelog_sn, measured_at, metric_code, metric_value FROM measurement
WHERE (metric_code = 'discount' AND user_lifelog_sn % 31 = 0) OR (metric_code = 'tax' AND user_lifelog_sn % 37 = 0)"""))
def _dq18(spark, sf):
    """DQ-18 with a fact that lost some signatures and holds others twice."""
    m = FT.measurement_fact(spark, sf)
    lost, twice = (F.col("metric_code") == "discount") & _hit("user_lifelog_sn", 31), (F.col("metric_code") == "tax") & _hit("user_lifelog_sn", 37)
    return C.signature_differences(m.where(~lost).union(m.where(twice)), B.readings_source(spark, sf), _parents(spark, sf))


@register("dq19_damaged", with_ctes(["readings"], "SELECT * FROM readings WHERE user_lifelog_sn % 17 = 0"))
def _dq19(spark, sf):
    """DQ-19 with parents that are missing."""
    parents = B.lifelog_parent(spark, sf).where(F.col("user_id").isNotNull() & ~_hit("user_lifelog_sn", 17))
    return FT.staged_readings(spark, sf, C.unattributed(B.readings_source(spark, sf), parents, "user_lifelog_sn"))


@register("dq20_damaged", with_ctes(["fact_ev", "coaching"], f"""
SELECT user_id, milestone_code, occurred_date, CAST(NULL AS TIMESTAMP) AS occurred_at, source_relation, temporal_precision
FROM ({MILESTONES_SQL}) m WHERE user_id % 5 = 0 AND temporal_precision = 'TIMESTAMP'"""))
def _dq20(spark, sf):
    """DQ-20 with milestones that lost their time."""
    m = FT.milestones(spark, sf)
    return C.precision_contradicted(m.withColumn("occurred_at", F.when(~_hit("user_id", 5), F.col("occurred_at"))))


@register("dq23_damaged", with_ctes(["dim_user"], """
SELECT * FROM (SELECT u.user_id, u.user_id % 8 = 0 OR NOT u.is_mapped AS is_unmapped, u.user_id % 12 = 0 AS is_pinned FROM dim_user u) t
WHERE is_unmapped <> is_pinned"""))
def _dq23(spark, sf):
    """DQ-23 with a pinned set as parameter and accounts that are missing."""
    cohort = FT.cohort_ids(spark, sf)
    accounts = read_table(spark, sf, "customer", ["c_custkey"]).select(F.col("c_custkey").alias("user_id")).where(~_hit("user_id", 8))
    return C.unmapped_and_pinned(cohort, accounts, cohort.where(_hit("user_id", 12)))


@register("dq24_damaged", with_ctes(["fact_ev"], """
SELECT user_id, ymd_date, 'view' AS channel_code, 'OBSERVED_ZERO' AS state, view_events AS value FROM panel WHERE user_id % 3 = 0 AND view_events > 0
UNION ALL SELECT user_id, ymd_date, 'click', click_state, NULL FROM panel WHERE user_id % 4 = 0 AND click_state IN ('OBSERVED_ACTIVITY', 'OBSERVED_ZERO')
UNION ALL SELECT user_id, ymd_date, 'error', error_state, 0 FROM panel WHERE user_id % 5 = 0 AND error_state NOT IN ('OBSERVED_ACTIVITY', 'OBSERVED_ZERO')""", _PANEL))
def _dq24(spark, sf):
    """DQ-24 with states that deny a value, values that are missing and zeros made up."""
    p = P.user_day(spark, sf)
    p = (p.withColumn("view_state", F.when(_hit("user_id", 3) & (F.col("view_events") > 0), P.OBSERVED_ZERO).otherwise(F.col("view_state")))
         .withColumn("click_events", F.when(~_hit("user_id", 4), F.col("click_events")))
         .withColumn("error_events", F.when(_hit("user_id", 5), F.coalesce("error_events", F.lit(0))).otherwise(F.col("error_events"))))
    return C.state_contradictions(p, P.CHANNELS)


@register("dq25_damaged", with_ctes(["fact_ev"], """
SELECT event_type AS channel_code, COUNT(*) AS fact_total, NULLIF(COUNT(*) FILTER (WHERE day(event_date) <> 15), 0) AS panel_total
FROM fact_ev WHERE event_type IN ('view', 'click', 'purchase', 'error', 'signup') GROUP BY 1 HAVING COUNT(*) FILTER (WHERE day(event_date) = 15) > 0"""))
def _dq25(spark, sf):
    """DQ-25 with a panel that lost a day."""
    p = P.user_day(spark, sf).where(F.dayofmonth("ymd_date") != 15)
    facts = FT.guarded_events(spark, sf).where(F.col("event_type").isin([c.code for c in P.CHANNELS])).select(
        F.col("event_type").alias("channel_code"), F.lit(1).alias("n"))
    return C.lost_activity(p, facts, P.CHANNELS)


@register("dq26_damaged", with_ctes(["dim_user"], """
SELECT user_id, wear_date AS ymd_date, n_samples FROM wday WHERE stream_code = 'click' AND user_id % 4 = 0 AND user_id IN (SELECT user_id FROM dim_user)""", _STREAMS))
def _dq26(spark, sf):
    """DQ-26 with a pivot whose guard lost part of the cohort."""
    day, cohort = W.wearable_day(spark, sf), FT.cohort_ids(spark, sf)
    return C.pivot_differences(day, W.wearable_pivot(day, cohort.where(~_hit("user_id", 4))), cohort, "click")


@register("dq27_damaged", with_ctes(["dim_user"], """
SELECT COUNT(*) AS raw_rows, COUNT(*) FILTER (WHERE user_lifelog_sn % 6 <> 0) AS collapsed_rows, COUNT(*) AS day_rows,
       COUNT(*) FILTER (WHERE user_lifelog_sn IN (SELECT user_id FROM dim_user)) AS raw_cohort_rows,
       COUNT(*) FILTER (WHERE user_lifelog_sn IN (SELECT user_id FROM dim_user) AND user_lifelog_sn % 5 <> 0) AS detail_rows
FROM samples WHERE type_code = 'error' AND measured_at IS NOT NULL AND user_lifelog_sn IS NOT NULL""", _STREAMS))
def _dq27(spark, sf):
    """DQ-27 with collapsed samples and detail facts that were lost."""
    raw = W.raw_samples(spark, sf, W.WEIGHTED_STREAM).where(F.col("measured_at").isNotNull() & F.col("user_lifelog_sn").isNotNull())
    day = W.wearable_day(spark, sf).where(F.col("stream_code") == W.WEIGHTED_STREAM)
    return C.multiplicity_totals(raw, W.collapsed_stream(spark, sf).where(~_hit("user_lifelog_sn", 6)), day,
                                 W.detail_fact(spark, sf).where(~_hit("user_id", 5)), FT.cohort_ids(spark, sf))


@register("dq28_damaged", with_ctes(["dim_user"], """
SELECT user_lifelog_sn, measured_at, type_code FROM collapsed WHERE user_lifelog_sn % 9 = 0 OR user_lifelog_sn IS NULL""", _STREAMS))
def _dq28(spark, sf):
    """DQ-28 with parents that are missing."""
    parents = W.stream_parents(spark, sf).where(~_hit("user_lifelog_sn", 9))
    return C.unattributed(W.collapsed_stream(spark, sf), parents, "user_lifelog_sn").select("user_lifelog_sn", "measured_at", "type_code")
