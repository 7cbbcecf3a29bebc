"""Registered queries of streams with a real parent, share interactions and
nested payloads."""

from __future__ import annotations

from dayledger.plans import serial_streams as SS
from dayledger.plans.oracle_sql import KST, with_ctes
from dayledger.plans.registry import REGISTRY, register

_SERIAL = "serials AS (SELECT user_id * 4 + event_id % 4 AS sn, ts, event_type, CAST(value AS DECIMAL(18,2)) AS v FROM events)"
_OWNER = "owner AS (SELECT c_custkey * 4 + d AS sn, c_custkey AS user_id FROM customer, (VALUES (0), (1), (2)) x(d))"
_KEY = ("md5(coalesce(CAST(sn AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' || "
        "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '-' || coalesce(event_type, '_dbt_utils_surrogate_key_null_') || '-' || "
        "coalesce(CAST(v AS VARCHAR), '_dbt_utils_surrogate_key_null_'))")


@register("int02_device_day", f"""WITH {_SERIAL}, {_OWNER}
SELECT o.user_id, CAST(s.ts {KST} AS DATE) AS wear_date, s.event_type AS stream_code, COUNT(*) AS n_samples,
       CAST(SUM(v) AS DOUBLE) AS value_sum,
       CAST((2 * 1000000 * SUM(CAST(round(v * 100) AS BIGINT)) + 100 * COUNT(v)) // (2 * 100 * COUNT(v)) AS DOUBLE) / 1000000 AS value_mean,
       CAST(MIN(v) AS DOUBLE) AS value_min, CAST(MAX(v) AS DOUBLE) AS value_max, COUNT(DISTINCT s.sn) AS n_devices
FROM serials s JOIN owner o USING (sn) WHERE s.ts IS NOT NULL GROUP BY 1, 2, 3""")
def _day(spark, sf):
    """INT-02 through a real parent: serials are no users, every fourth has no parent."""
    return SS.wearable_day(spark, sf)


@register("dtl02_device_detail", with_ctes(["dim_user"], f"""
SELECT {_KEY} AS source_observation_id, sn AS user_lifelog_sn, user_id, ts AS measured_at, CAST(ts {KST} AS DATE) AS ymd_date,
       event_type AS type_code, CAST(v AS DOUBLE) AS sample_value, COUNT(*) AS source_row_count
FROM serials JOIN owner USING (sn) WHERE ts IS NOT NULL AND user_id IN (SELECT user_id FROM dim_user)
GROUP BY sn, user_id, ts, event_type, v""", [_SERIAL, _OWNER]))
def _detail(spark, sf):
    """DTL-02 through a real parent: samples of the cohort's devices at source grain."""
    return SS.detail_fact(spark, sf)


@register("dq28_serials_without_parent", f"""WITH {_SERIAL}
SELECT sn AS user_lifelog_sn, COUNT(*) AS n_samples FROM serials
WHERE sn % 4 = 3 OR NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = sn // 4) GROUP BY sn HAVING sn IS NOT NULL""")
def _lost(spark, sf):
    """DQ-28 by serial: samples that no parent gives to a user."""
    return SS.without_parent(spark, sf)


_SHARES = f"""shares AS (SELECT l.l_orderkey AS share_no, l.l_linenumber AS share_log_no,
  CAST(CASE WHEN l.l_returnflag = 'R' THEN l.l_suppkey ELSE o.o_custkey END AS BIGINT) AS user_id, l.l_shipdate AS interaction_at,
  CAST(l.l_shipdate {KST} AS DATE) AS interaction_date, o.o_custkey AS owner
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)"""


@register("fct05_share_interaction_event", with_ctes(["dim_user"], """
SELECT s.* EXCLUDE (owner) FROM shares s WHERE s.user_id IN (SELECT user_id FROM dim_user)""", [_SHARES]))
def _shares(spark, sf):
    """FCT-05: share interactions of actors in the cohort, a child bound to its link."""
    return SS.share_interactions(spark, sf)


@register("dq22_share_actor_consistent", with_ctes(["dim_user"], """
SELECT share_log_no, share_no, user_id AS interaction_actor_user_id, owner AS link_actor_user_id FROM shares
WHERE user_id IN (SELECT user_id FROM dim_user) AND owner IN (SELECT user_id FROM dim_user) AND user_id IS DISTINCT FROM owner""", [_SHARES]))
def _actors(spark, sf):
    """DQ-22: interactions whose actor is not their link's (null-safe)."""
    return SS.actor_mismatches(SS.share_interactions(spark, sf), REGISTRY["fct04_share_link"].build(spark, sf))


def _signature_sql() -> str:
    cols = []
    for i, t in enumerate(("disease", "lifestyle", "potential")):
        cols += [f"'{t[0].upper()}' || (event_id % {i + 3}) AS signature_{t}_type_code", f"'{t} ' || (event_id % {i + 3}) AS signature_{t}_type_label"]
    cols += ["CASE WHEN event_id % 7 <> 0 THEN 'S' || (event_id % 6) END AS signature_segment_type_code",
             "CASE WHEN event_id % 7 <> 0 THEN 'segment ' || (event_id % 6) END AS signature_segment_type_label"]
    return ", ".join(cols)


@register("stg22_analysis_payloads", with_ctes(["ev"], f"""
SELECT user_id, event_date AS ymd_date, event_id, event_type AS risk_kind, 'signature of ' || event_type AS signature_description, {_signature_sql()}
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_date ORDER BY ts DESC NULLS FIRST, event_id DESC) AS nth
      FROM ev WHERE event_id % 20 <> 0) t WHERE nth = 1"""))
def _payloads(spark, sf):
    """STG-22/23, PRJ-06: one VARIANT parse a row for 1 + 9 allow-listed fields of
    nested payloads; error payloads go before the day's last row wins."""
    return SS.analysis_day(SS.analysis_payloads(spark, sf))


@register("dq15_error_payloads", "SELECT COUNT(*) AS error_rows FROM events WHERE event_id % 20 = 0 HAVING COUNT(*) > 0")
def _errors(spark, sf):
    """DQ-15 / AGG-12 on the nested payloads: error payloads above the bound."""
    from dayledger.plans import checks as C
    return C.error_payloads(SS.analysis_payloads(spark, sf), "payload")


@register("pii03_strip_user_name", """
SELECT event_id, event_id % 20 <> 0 AS had_name, false AS has_name, event_id % 20 = 0 AS is_error FROM events""")
def _strip(spark, sf):
    """PII-03 on payloads that hold the key: it is gone after, the rest stays."""
    from pyspark.sql import functions as F

    from dayledger.functions.jsonfn import json_has_key, json_strip_keys
    p = SS.analysis_payloads(spark, sf)
    stripped = p.withColumn("clean", json_strip_keys("payload", ["user_name"]))
    return stripped.select("event_id", json_has_key("payload", "user_name").alias("had_name"), json_has_key("clean", "user_name").alias("has_name"),
                           (F.col("clean").contains("no answer")).alias("is_error"))


@register("str03_streamed_table", REGISTRY["str02_streamed_daily_aggregate"].sql)
def _stream_table(spark, sf):
    """STR-03: micro-batches upserted into a bucketed table whose commits note the
    batch, so that a replayed batch is merged once."""
    from dayledger import streaming as STR
    return STR.daily_table(spark, sf)
