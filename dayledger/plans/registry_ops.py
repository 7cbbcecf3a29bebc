"""Registered queries for the generic operators: staging, joins, sinks, set
operations, data-quality checks and privacy jobs, each bound to the driver
tables and each with a DuckDB oracle where SQL can express it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dayledger.functions import timeutil as tu
from dayledger.functions.jsonfn import json_text
from dayledger.operators import privacy as PV
from dayledger.operators import quality as Q
from dayledger.operators import sinks as K
from dayledger.operators import staging as S
from dayledger.operators.setops import symmetric_difference
from dayledger.plans import bindings as B
from dayledger.plans import checks as C
from dayledger.plans import facts as FT
from dayledger.plans import panel as P
from dayledger.plans import wearable as W
from dayledger.plans.dims import dim_user
from dayledger.plans.oracle_sql import KST, with_ctes
from dayledger.plans.registry import _PANEL, _WDAY, _COLLAPSED, _SAMPLES, MILESTONES_SQL, register
from dayledger.sources import landing as L
from dayledger.sources.tables import read_table

# ----------------------------------------------------------------------------- staging


@register("agg08_payload_multiplicity", """
SELECT user_id, event_type, CAST(ROUND(value) AS BIGINT) AS value_rounded, COUNT(*) AS n_rows
FROM events GROUP BY ALL""")
def _agg08(spark, sf):
    """AGG-08: duplicate collapse keeping multiplicity (NULLs group together)."""
    e = read_table(spark, sf, "events", ["user_id", "event_type", "value"])
    payload = e.select("user_id", "event_type", F.round("value").cast("bigint").alias("value_rounded"))
    return S.collapse_duplicates(payload, ["user_id", "event_type", "value_rounded"], "n_rows")


@register("win01_last_event_per_user_day", f"""
SELECT event_id, ts, user_id, event_type, value, props, event_date FROM (
  SELECT *, CAST(ts {KST} AS DATE) AS event_date,
         ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts {KST} AS DATE)
                            ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn
  FROM events) t WHERE rn = 1""")
def _win01(spark, sf):
    """WIN-01: last row wins per (user, local day), event id as tie-break."""
    return S.last_row_wins(B.events(spark, sf), ["user_id", "event_date"], "ts", ["event_id"])


@register("stg02_readings", with_ctes(["readings"], "SELECT * FROM readings"))
def _stg02(spark, sf):
    """STG-02: wide readings -> tall (code, value, unit) with exact dedupe,
    deterministic DISTINCT ON pick and NULL drop."""
    return FT.staged_readings(spark, sf)


@register("stg22_props_flatten_last_per_day", f"""
SELECT user_id, event_date, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k_text, event_id
FROM (SELECT *, CAST(ts {KST} AS DATE) AS event_date,
             ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts {KST} AS DATE)
                                ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn
      FROM events WHERE NOT list_contains(json_keys(props), 'error')) t
WHERE rn = 1""")
def _stg22(spark, sf):
    """STG-22: drop error payloads, last row wins per (user, day), then only
    the allow-listed JSON path leaves the payload."""
    e = S.drop_error_payloads(B.events(spark, sf), "props")
    last = S.last_row_wins(e, ["user_id", "event_date"], "ts", ["event_id"])
    return last.select("user_id", "event_date", json_text("props", "k").alias("k_text"), "event_id")


@register("agg14_event_types_per_user", """
SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS event_types
FROM (SELECT DISTINCT user_id, event_type FROM events) t GROUP BY user_id""")
def _agg14(spark, sf):
    """AGG-14: ordered string aggregate of the distinct types per user (bounded
    by the number of types, never by a user's row count)."""
    e = read_table(spark, sf, "events", ["user_id", "event_type"])
    return e.groupBy("user_id").agg(
        F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("event_types"))


# ----------------------------------------------------------------------------- joins


@register("jon04_translate_key", """
SELECT o.o_orderkey, o.o_custkey, c.c_mktsegment AS mapped_segment, c.c_nationkey AS mapped_site
FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') c
  ON o.o_custkey = c.c_custkey""")
def _jon04(spark, sf):
    """JON-04/05: key translation, filter inside the right side of a left join."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"])
    return S.translate_key(o, c, [("o_custkey", "c_custkey")],
                           {"c_mktsegment": "mapped_segment", "c_nationkey": "mapped_site"},
                           F.col("c_mktsegment") == "BUILDING")


@register("jon11_customers_without_events", """
SELECT c_custkey, c_name, c_mktsegment FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)""")
def _jon11(spark, sf):
    """JON-11: anti join on a non-null key."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    e = read_table(spark, sf, "events", ["user_id"]).where(F.col("user_id").isNotNull())
    return c.join(e, c.c_custkey == e.user_id, "left_anti")


@register("jon07_activity_full_outer", """
SELECT user_id, e.n_events, o.n_orders
FROM (SELECT user_id, COUNT(*) AS n_events FROM events GROUP BY 1) e
FULL OUTER JOIN (SELECT o_custkey AS user_id, COUNT(*) AS n_orders FROM orders GROUP BY 1) o
USING (user_id)""")
def _jon07(spark, sf):
    """JON-07: full outer join with USING semantics (keys coalesced)."""
    e = read_table(spark, sf, "events", ["user_id"]).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"))
    o = (read_table(spark, sf, "orders", ["o_custkey"]).groupBy(F.col("o_custkey").alias("user_id"))
         .agg(F.count(F.lit(1)).alias("n_orders")))
    return e.join(o, "user_id", "full")


@register("jon10_orders_of_cohort", with_ctes(["dim_user"], """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_custkey IN (SELECT user_id FROM dim_user)"""))
def _jon10(spark, sf):
    """JON-10 / SRC-08 / PII-02: semi join to the cohort (IN subquery)."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    return PV.purge_outside_cohort(o, dim_user(spark, sf), "o_custkey", "user_id")


# ----------------------------------------------------------------------------- sinks

_LOAD1, _LOAD2 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)


@register("snk02_upsert", """
WITH t AS (SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS _loaded_at FROM events
           WHERE ts < TIMESTAMP '2024-01-20'),
     b AS (SELECT event_id, ts, user_id, event_type, value * 2 AS value, props,
                  TIMESTAMP '2024-02-02 00:00:00' AS _loaded_at FROM events
           WHERE ts >= TIMESTAMP '2024-01-15')
SELECT * FROM t WHERE event_id NOT IN (SELECT event_id FROM b) UNION ALL SELECT * FROM b""")
def _snk02(spark, sf):
    """SNK-02: keyed upsert; overlapping re-delivered rows replace the target's."""
    e = read_table(spark, sf, "events")
    target = K.stamp_loaded(e.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")), _LOAD1)
    batch = K.stamp_loaded(e.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
                           .withColumn("value", F.col("value") * 2), _LOAD2)
    return K.upsert(target, batch, ["event_id"]).withColumn(
        "_loaded_at", tu.instant_to_naive("_loaded_at"))


@register("snk03_insert_if_absent", f"""
WITH t AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-10'),
     b AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-10')
SELECT * FROM t UNION ALL
SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.user_id = b.user_id
                                  AND t.event_type = b.event_type)""")
def _snk03(spark, sf):
    """SNK-03: every column is key -> insert only the absent rows."""
    e = read_table(spark, sf, "events", ["user_id", "event_type", "ts"])
    cut = F.lit("2024-01-10").cast("timestamp_ntz")
    t = e.where(F.col("ts") < cut).select("user_id", "event_type").distinct()
    b = e.where(F.col("ts") >= cut).select("user_id", "event_type").distinct()
    return K.upsert(t, b, ["user_id", "event_type"], check_batch=False)


@register("snk04_replace_window", """
WITH t AS (SELECT ts, user_id, event_type, value FROM events WHERE ts <= TIMESTAMP '2024-01-20'),
     b AS (SELECT ts, user_id, event_type, value FROM events
           WHERE ts > TIMESTAMP '2024-01-15' AND ts <= TIMESTAMP '2024-01-25')
SELECT * FROM t WHERE NOT coalesce(ts > TIMESTAMP '2024-01-15' AND ts <= TIMESTAMP '2024-01-25', false)
UNION ALL SELECT * FROM b""")
def _snk04(spark, sf):
    """SNK-04 with SRC-02/05/06: keyless re-read of a window (last position
    minus a 5-day lookback, inclusive upper bound) then delete-and-insert of
    exactly that window; replaying it twice gives the same table."""
    e = read_table(spark, sf, "events", ["ts", "user_id", "event_type", "value"])
    target = e.where(F.col("ts") <= F.lit("2024-01-20").cast("timestamp_ntz"))
    win = L.plan_window(dt.datetime(2024, 1, 20), F.col("ts"),
                        L.lookback(dt.timedelta(minutes=5), 5), dt.datetime(2024, 1, 25))
    batch = L.read_incremental(e, win)
    once = K.replace_window(target, batch, win.predicate)
    return K.replace_window(once, batch, win.predicate)


@register("snk05_window_replace", with_ctes(["dim_user"], """
SELECT * FROM wday_old WHERE wear_date < (SELECT MAX(wear_date) - 7 FROM wday_old)
UNION ALL SELECT * FROM wday WHERE wear_date >= (SELECT MAX(wear_date) - 7 FROM wday_old)""",
    [_SAMPLES, _COLLAPSED, _WDAY,
     _WDAY.replace("wday AS", "wday_old AS").replace("FROM samples s", "FROM old_samples s")
     .replace("FROM collapsed c", "FROM old_collapsed c")]
    ).replace("collapsed AS (", "old_samples AS (SELECT * FROM samples WHERE measured_at < "
              "TIMESTAMP '2024-01-25'),\nold_collapsed AS (SELECT user_lifelog_sn, measured_at, "
              "type_code, sample_value, COUNT(*) AS source_row_count FROM old_samples WHERE "
              "type_code = 'error' AND measured_at IS NOT NULL GROUP BY ALL),\ncollapsed AS (", 1))
def _snk05(spark, sf):
    """SNK-05 on INT-02: the snapshot built from arrivals before 2024-01-25 is
    window-replaced (7 trailing days) with a fresh computation."""
    old = W.wearable_day(spark, sf, before="2024-01-25")
    fresh = W.wearable_day(spark, sf)
    return W.wearable_day_incremental(old, fresh, days=7)


@register("snk06_schema_evolution", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def _snk06(spark, sf):
    """SNK-06: a source that grew a column lands into the older schema."""
    o = read_table(spark, sf, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    old = o.where(F.col("o_orderdate") < cut).drop("o_orderpriority")
    new = o.where(F.col("o_orderdate") >= cut)
    merged, added, dropped = K.evolve(old, new)
    assert added == ["o_orderpriority"] and dropped == []
    return merged


# ----------------------------------------------------------------------------- set operations

@register("set02_ambiguous_slot_rows", with_ctes(["amounts"], """
(SELECT user_lifelog_sn, slot, quantity, extended_price FROM readings_src
 EXCEPT ALL SELECT user_lifelog_sn, slot, quantity, extended_price FROM amounts)
UNION ALL
(SELECT user_lifelog_sn, slot, quantity, extended_price FROM amounts
 EXCEPT ALL SELECT user_lifelog_sn, slot, quantity, extended_price FROM readings_src)"""))
def _set02(spark, sf):
    """SET-02: multiset symmetric difference between the raw slots and the
    deterministic DISTINCT ON pick = the readings the pick set aside."""
    src = B.readings_source(spark, sf)
    order = [F.col(c).desc_nulls_last() for c in
             ("quantity", "extended_price", "measured_dt", "discount", "tax")]
    picked = S.distinct_on(src.select("user_lifelog_sn", "slot", "measured_dt", "quantity",
                                      "extended_price", "discount", "tax"),
                           ["user_lifelog_sn", "slot"], order)
    cols = ["user_lifelog_sn", "slot", "quantity", "extended_price"]
    return symmetric_difference(src.select(*cols), picked.select(*cols))


# ----------------------------------------------------------------------------- quality

@register("dq02_reading_slot_unique", """
SELECT l_orderkey AS user_lifelog_sn, l_linenumber AS slot, COUNT(*) AS n_records
FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def _dq02(spark, sf):
    """DQ-02: grain violations (unique_combination_of_columns)."""
    return Q.unique(B.readings_source(spark, sf), ["user_lifelog_sn", "slot"])


@register("dq03_event_type_accepted", """
SELECT * FROM events WHERE event_type NOT IN ('view', 'click', 'purchase', 'signup')""")
def _dq03(spark, sf):
    """DQ-03: accepted values (NULL passes)."""
    return Q.accepted_values(read_table(spark, sf, "events"), "event_type",
                             ["view", "click", "purchase", "signup"])


@register("dq04_orders_customer_fk", """
SELECT o.* FROM orders o WHERE o.o_custkey IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)""")
def _dq04(spark, sf):
    """DQ-04: relationships (orphan child keys)."""
    return Q.relationships(read_table(spark, sf, "orders"), "o_custkey",
                           read_table(spark, sf, "customer"), "c_custkey")


@register("dq05_quantity_range", """
SELECT * FROM lineitem WHERE NOT (l_quantity >= 1 AND l_quantity <= 49)""")
def _dq05(spark, sf):
    """DQ-05: accepted range."""
    return Q.accepted_range(read_table(spark, sf, "lineitem"), "l_quantity", 1, 49)


@register("dq06_discount_not_above_tax", """
SELECT * FROM lineitem WHERE NOT (l_discount <= l_tax + 0.05)""")
def _dq06(spark, sf):
    """DQ-06: expression_is_true (NULL result passes)."""
    return Q.expression_is_true(read_table(spark, sf, "lineitem"), "l_discount <= l_tax + 0.05")


@register("dq07_completion_null_rate", with_ctes(["coaching"], """
SELECT n_rows, n_null, CAST(n_null AS DOUBLE) / n_rows AS null_rate FROM (
  SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE completed_at IS NULL) AS n_null FROM coaching)
WHERE n_rows > 0 AND CAST(n_null AS DOUBLE) / n_rows >= 0.5"""))
def _dq07(spark, sf):
    """DQ-07: null_rate_below(0.5) on the completion time."""
    return Q.null_rate_below(FT.coaching_event(spark, sf), "completed_at", 0.5)


@register("dq08_props_key_drift", """
SELECT json_key, COUNT(*) AS n_rows FROM (SELECT unnest(json_keys(props)) AS json_key FROM events)
WHERE json_key NOT IN ('k') GROUP BY json_key""")
def _dq08(spark, sf):
    """DQ-08: top-level JSON keys outside the allow-list, with row counts."""
    return Q.json_key_drift(read_table(spark, sf, "events", ["props"]), "props", ["k"])


@register("dq10_one_site_per_user", with_ctes(["dim_user"], """
SELECT u.user_id, COUNT(n.n_nationkey) AS n_sites FROM dim_user u
LEFT JOIN nation n ON n.n_nationkey = u.site_key GROUP BY u.user_id HAVING COUNT(n.n_nationkey) <> 1"""))
def _dq10(spark, sf):
    """DQ-10: exactly one current site per cohort user (HAVING)."""
    u = dim_user(spark, sf).select("user_id", "site_key")
    s = B.sites(spark, sf).select("site_key", F.col("site_key").alias("__site"))
    return (u.join(s, "site_key", "left").groupBy("user_id")
            .agg(F.count("__site").alias("n_sites")).where(F.col("n_sites") != 1))


@register("dq12_stream_totals_reconcile", with_ctes(["dim_user"], f"""
SELECT * FROM (
  SELECT coalesce(r.user_id, c.user_id, d.user_id) AS user_id,
         coalesce(r.wear_date, c.wear_date, d.wear_date) AS wear_date,
         r.n_raw, c.n_collapsed, d.n_day
  FROM (SELECT s.user_lifelog_sn AS user_id, CAST(s.measured_at {KST} AS DATE) AS wear_date,
               COUNT(*) AS n_raw FROM samples s
        WHERE s.type_code = 'error' AND s.measured_at IS NOT NULL GROUP BY 1, 2) r
  FULL OUTER JOIN (SELECT c.user_lifelog_sn AS user_id, CAST(c.measured_at {KST} AS DATE) AS wear_date,
               SUM(c.source_row_count) AS n_collapsed FROM collapsed c GROUP BY 1, 2) c
    ON c.user_id = r.user_id AND c.wear_date = r.wear_date
  FULL OUTER JOIN (SELECT user_id, wear_date, n_samples AS n_day FROM wday
                   WHERE stream_code = 'error') d
    ON d.user_id = coalesce(r.user_id, c.user_id) AND d.wear_date = coalesce(r.wear_date, c.wear_date)
) x WHERE n_raw IS DISTINCT FROM n_collapsed OR n_raw IS DISTINCT FROM n_day""",
    [_SAMPLES, _COLLAPSED, _WDAY]))
def _dq12(spark, sf):
    """DQ-12: raw = deduped multiplicity = day aggregate, per user-day (3-way
    full outer join, null-safe row comparison)."""
    raw = (W.raw_samples(spark, sf, W.WEIGHTED_STREAM).where(F.col("measured_at").isNotNull())
           .groupBy(F.col("user_lifelog_sn").alias("user_id"),
                    tu.local_date("measured_at").alias("wear_date"))
           .agg(F.count(F.lit(1)).alias("n_raw")))
    col = (W.collapsed_stream(spark, sf)
           .groupBy(F.col("user_lifelog_sn").alias("user_id"),
                    tu.local_date("measured_at").alias("wear_date"))
           .agg(F.sum("source_row_count").alias("n_collapsed")))
    day = (W.wearable_day(spark, sf).where(F.col("stream_code") == W.WEIGHTED_STREAM)
           .select("user_id", "wear_date", F.col("n_samples").alias("n_day")))
    j = raw.join(col, ["user_id", "wear_date"], "full").join(day, ["user_id", "wear_date"], "full")
    a = F.struct("n_raw")
    return j.where(~a.eqNullSafe(F.struct(F.col("n_collapsed").alias("n_raw")))
                   | ~a.eqNullSafe(F.struct(F.col("n_day").alias("n_raw"))))


@register("dq16_ambiguous_slots", """
SELECT l_orderkey AS user_lifelog_sn, l_linenumber AS slot,
       COUNT(DISTINCT (l_quantity, l_extendedprice)) AS n_payloads
FROM lineitem GROUP BY 1, 2 HAVING COUNT(DISTINCT (l_quantity, l_extendedprice)) > 1""")
def _dq16(spark, sf):
    """DQ-16: slots carrying more than one distinct payload (row-value count
    distinct: a struct keeps rows whose fields are NULL)."""
    src = B.readings_source(spark, sf)
    return (src.groupBy("user_lifelog_sn", "slot")
            .agg(F.countDistinct(F.struct("quantity", "extended_price")).alias("n_payloads"))
            .where(F.col("n_payloads") > 1))


@register("dq19_readings_attributed", with_ctes(["readings"], """
SELECT r.* FROM readings r WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_orderkey = r.user_lifelog_sn AND o.o_custkey IS NOT NULL)"""))
def _dq19(spark, sf):
    """DQ-19: every staged reading has a parent with a user. Staging works within a
    serial, so the wide rows meet the parents before they are staged."""
    parent = B.lifelog_parent(spark, sf).where(F.col("user_id").isNotNull())
    lost = C.unattributed(B.readings_source(spark, sf), parent, "user_lifelog_sn")
    return FT.staged_readings(spark, sf, lost)


def _dq24_sql() -> str:
    parts = []
    for c in P.CHANNELS:
        st, v = f"{c.code}_state", c.value_col
        parts.append(
            f"SELECT user_id, ymd_date, '{c.code}' AS channel_code, {st} AS state, {v} AS value FROM panel "
            f"WHERE ({st} = 'OBSERVED_ACTIVITY' AND {v} IS NULL) OR ({st} = 'OBSERVED_ZERO' AND "
            f"({v} IS NULL OR {v} <> 0)) OR ({st} IN ('NOT_LOADED', 'NOT_YET_ELIGIBLE', "
            f"'ELIGIBILITY_UNKNOWN') AND {v} IS NOT NULL)")
    return "\nUNION ALL ".join(parts)


@register("dq24_states_match_values", with_ctes(["fact_ev"], _dq24_sql(), _PANEL))
def _dq24(spark, sf):
    """DQ-24: per channel, the state agrees with the value (observed -> value,
    zero -> 0, not loaded / not eligible / unknown -> NULL)."""
    panel = P.user_day(spark, sf)
    parts = []
    for c in P.CHANNELS:
        st, v = F.col(f"{c.code}_state"), F.col(c.value_col)
        bad = (((st == P.OBSERVED_ACTIVITY) & v.isNull())
               | ((st == P.OBSERVED_ZERO) & (v.isNull() | (v != 0)))
               | (st.isin(P.NOT_LOADED, P.NOT_YET_ELIGIBLE, P.ELIGIBILITY_UNKNOWN) & v.isNotNull()))
        parts.append(panel.where(bad).select("user_id", "ymd_date", F.lit(c.code).alias("channel_code"),
                                             st.alias("state"), v.alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("dq25_panel_keeps_activity", with_ctes(["fact_ev"], """
SELECT f.channel_code, f.fact_total, p.panel_total FROM
 (SELECT event_type AS channel_code, COUNT(*) AS fact_total FROM fact_ev
  WHERE event_type IN ('view', 'click', 'purchase', 'error', 'signup') GROUP BY 1) f
FULL OUTER JOIN (""" + " UNION ALL ".join(
    f"SELECT '{c.code}' AS channel_code, SUM({c.value_col}) AS panel_total FROM panel"
    for c in P.CHANNELS) + """) p USING (channel_code)
WHERE f.fact_total IS DISTINCT FROM p.panel_total""", _PANEL))
def _dq25(spark, sf):
    """DQ-25: channel totals in the panel equal the fact totals (nothing lost
    by the spine)."""
    panel = P.user_day(spark, sf)
    totals = panel.agg(*[F.sum(c.value_col).alias(c.code) for c in P.CHANNELS])
    stack = ", ".join(f"'{c.code}', `{c.code}`" for c in P.CHANNELS)
    ptot = totals.selectExpr(f"stack({len(P.CHANNELS)}, {stack}) AS (channel_code, panel_total)")
    ftot = (FT.guarded_events(spark, sf).where(F.col("event_type").isin([c.code for c in P.CHANNELS]))
            .groupBy(F.col("event_type").alias("channel_code"))
            .agg(F.count(F.lit(1)).alias("fact_total")))
    j = ftot.join(ptot, "channel_code", "full")
    return j.where(~F.col("fact_total").eqNullSafe(F.col("panel_total"))).select(
        "channel_code", "fact_total", "panel_total")


@register("dq26_pivot_reconciles", with_ctes(["dim_user"], """
(SELECT user_id, wear_date AS ymd_date, n_samples FROM wday WHERE stream_code = 'click' AND user_id IN (SELECT user_id FROM dim_user)
 EXCEPT ALL SELECT user_id, ymd_date, click_samples FROM piv WHERE click_samples IS NOT NULL)
UNION ALL
(SELECT user_id, ymd_date, click_samples FROM piv WHERE click_samples IS NOT NULL
 EXCEPT ALL SELECT user_id, wear_date, n_samples FROM wday WHERE stream_code = 'click' AND user_id IN (SELECT user_id FROM dim_user))""",
    [_SAMPLES, _COLLAPSED, _WDAY,
     "piv AS (SELECT user_id, wear_date AS ymd_date, MAX(n_samples) FILTER "
     "(WHERE stream_code = 'click') AS click_samples FROM wday JOIN cohort USING (user_id) GROUP BY 1, 2)"]))
def _dq26(spark, sf):
    """DQ-26: FCT-11 as built (with the cohort's guard) equals the stream aggregate
    of the cohort's days (symmetric difference)."""
    day, cohort = W.wearable_day(spark, sf), FT.cohort_ids(spark, sf)
    return C.pivot_differences(day, W.wearable_pivot(day, cohort), cohort, "click")


# ----------------------------------------------------------------------------- privacy

@register("pii01_drop_identifiers", "SELECT * EXCLUDE (c_name) FROM customer")
def _pii01(spark, sf):
    """PII-01: drop identifier columns (absent ones tolerated), verified."""
    return PV.drop_identifiers(read_table(spark, sf, "customer"), ["c_name", "c_phone", "c_address"])


@register("pii03_strip_payload_keys", """
SELECT event_id, CAST(json_merge_patch(props, '{"user_name": null}') AS VARCHAR) AS props FROM events""")
def _pii03(spark, sf):
    """PII-03: strip a key from JSON objects (absent key: object re-serialised)."""
    e = read_table(spark, sf, "events", ["event_id", "props"])
    return PV.strip_payload_keys(e, "props", ["user_name"])


_PII_SECRET = "dayledger-demo-secret"


def _hmac_sql(value_sql: str, secret: str) -> str:
    from dayledger.functions.keys import _hmac_pads
    ipad, opad = _hmac_pads(secret)
    return (f"sha256(unhex('{opad.hex()}') || unhex(sha256(unhex('{ipad.hex()}') || "
            f"encode({value_sql}))))")


@register("pii04_pseudonymized_users", with_ctes(["dim_user"], f"""
SELECT user_id, joined_date, {_hmac_sql("CAST(user_id AS VARCHAR)", _PII_SECRET)} AS user_key
FROM dim_user"""))
def _pii04(spark, sf):
    """PII-04 / FN-20: keyed HMAC-SHA256 pseudonyms of the cohort user ids
    (two sha2 calls on precomputed pads, no UDF)."""
    u = dim_user(spark, sf).select("user_id", "joined_date")
    return PV.pseudonymize(u, "user_id", _PII_SECRET, "user_key")


# ----------------------------------------------------------------------------- functions

@register("fn06_months_since_first_order", """
SELECT o.o_orderkey, o.o_custkey, CAST(o.o_orderdate AS DATE) - f.first_date AS days_since_first,
  CAST(extract(year FROM age(CAST(o.o_orderdate AS DATE), f.first_date)) * 12
       + extract(month FROM age(CAST(o.o_orderdate AS DATE), f.first_date)) AS BIGINT)
       AS months_since_first,
  CAST(extract(year FROM age(f.first_date, CAST(o.o_orderdate AS DATE))) * 12
       + extract(month FROM age(f.first_date, CAST(o.o_orderdate AS DATE))) AS BIGINT)
       AS months_until_first,
  CAST(CAST(o.o_orderdate AS DATE) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS one_month_on
FROM orders o JOIN (SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS first_date
                    FROM orders GROUP BY 1) f USING (o_custkey)""")
def _fn06(spark, sf):
    """FN-06/07: whole-month and day differences (both signs) on many date pairs."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]).withColumn(
        "d", F.to_date("o_orderdate"))
    first = o.groupBy("o_custkey").agg(F.min("d").alias("first_date"))
    j = o.join(first, "o_custkey", "inner")
    return j.select("o_orderkey", "o_custkey",
                    tu.days_between("d", "first_date").alias("days_since_first"),
                    tu.whole_months("d", "first_date").alias("months_since_first"),
                    tu.whole_months("first_date", "d").alias("months_until_first"),
                    F.date_sub(F.add_months("d", 1), 1).alias("one_month_on"))


# ----------------------------------------------------------------------------- streaming

from dayledger import streaming as STR  # noqa: E402


@register("str02_streamed_daily_aggregate", f"""
SELECT date_trunc('day', ts {KST}) - INTERVAL 9 HOUR AS window_start,
       CAST(ts {KST} AS DATE) AS local_date, event_type, COUNT(*) AS n_samples,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum
FROM events GROUP BY ALL""")
def _str02(spark, sf):
    """STR-01/02/03: event stream, 30-day watermark, local-day windows in
    update mode, idempotent foreachBatch sink, availableNow run."""
    return STR.streamed_daily_aggregate(spark, sf)


@register("str04_streamed_payload_multiplicity", """
SELECT user_id, ts, event_type, CAST(ROUND(value) AS BIGINT) AS value_rounded,
       COUNT(*) AS source_row_count FROM events GROUP BY ALL""")
def _str04(spark, sf):
    """STR-04: streaming duplicate collapse keeping multiplicity."""
    return STR.streamed_payload_multiplicity(spark, sf)


# ----------------------------------------------------------------------------- more facts & dims

from dayledger.plans import dims as D  # noqa: E402
from dayledger.plans import load_status as LS  # noqa: E402
from dayledger.plans import metrics as M  # noqa: E402
from dayledger.plans.registry import _ADH  # noqa: E402


@register("fct01_app_action", with_ctes(["fact_ev"], """
SELECT md5(concat_ws('|', CAST(user_id AS VARCHAR), strftime(ts, '%Y-%m-%d %H:%M:%S.%f'))) AS event_key,
       event_id, user_id, ts AS event_at, event_date, value
FROM fact_ev WHERE event_type = 'click'"""))
def _fct01(spark, sf):
    """FCT-01: app action fact (cohort guard, local date, event key)."""
    return FT.app_event_fact(spark, sf, "click")


@register("fct04_share_link", with_ctes(["dim_user"], f"""
SELECT o.o_orderkey AS share_no, o.o_custkey AS user_id, o.o_orderpriority AS share_type,
       o.o_orderdate AS share_created_at, CAST(o.o_orderdate {KST} AS DATE) AS share_created_date
FROM orders o WHERE o.o_custkey IN (SELECT user_id FROM dim_user)"""))
def _fct04(spark, sf):
    """FCT-04 / PRJ-02: share links of cohort users; a semi join keeps the
    left columns only (the dimension key is unique)."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate"])
    links = o.select(F.col("o_orderkey").alias("share_no"), F.col("o_custkey").alias("user_id"),
                     F.col("o_orderpriority").alias("share_type"),
                     F.col("o_orderdate").alias("share_created_at"),
                     tu.local_date("o_orderdate").alias("share_created_date"))
    return links.join(FT.cohort_ids(spark, sf), "user_id", "left_semi")


@register("met08_share_denominators", with_ctes(["dim_user"], f"""
WITH_LINKS AS (SELECT 1)
SELECT month_start_date, links_created, links_interacted, interaction_events FROM (
  SELECT coalesce(l.m, i.m) AS month_start_date, coalesce(l.links_created, 0) AS links_created,
         coalesce(i.links_interacted, 0) AS links_interacted,
         coalesce(i.interaction_events, 0) AS interaction_events
  FROM (SELECT CAST(date_trunc('month', CAST(o_orderdate {KST} AS DATE)) AS DATE) AS m,
               COUNT(*) AS links_created FROM orders
        WHERE o_custkey IN (SELECT user_id FROM dim_user) GROUP BY 1) l
  FULL OUTER JOIN (
        SELECT CAST(date_trunc('month', CAST(li.l_shipdate {KST} AS DATE)) AS DATE) AS m,
               COUNT(DISTINCT li.l_orderkey) AS links_interacted, COUNT(*) AS interaction_events
        FROM lineitem li JOIN orders o ON o.o_orderkey = li.l_orderkey
        WHERE o.o_custkey IN (SELECT user_id FROM dim_user) GROUP BY 1) i
  ON l.m = i.m) t""".replace("WITH_LINKS AS (SELECT 1)\n", "")))
def _met08(spark, sf):
    """FCT-05: three separate share denominators per month — links created,
    distinct links interacted with, interaction events (never one ratio)."""
    links = _fct04(spark, sf)
    created = links.groupBy(tu.trunc_date("month", "share_created_date").alias("month_start_date")).agg(
        F.count(F.lit(1)).alias("links_created"))
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_shipdate"])
    inter = li.join(links.select(F.col("share_no").alias("l_orderkey")), "l_orderkey", "left_semi")
    used = inter.groupBy(tu.trunc_date("month", tu.local_date("l_shipdate")).alias("month_start_date")).agg(
        F.countDistinct("l_orderkey").alias("links_interacted"),
        F.count(F.lit(1)).alias("interaction_events"))
    j = created.join(used, "month_start_date", "full")
    return j.select("month_start_date", F.coalesce("links_created", F.lit(0)).alias("links_created"),
                    F.coalesce("links_interacted", F.lit(0)).alias("links_interacted"),
                    F.coalesce("interaction_events", F.lit(0)).alias("interaction_events"))


@register("fct10_user_analysis_day", with_ctes(["dim_user"], f"""
SELECT t.user_id, t.event_date AS ymd_date, t.k_text AS signature_code FROM (
  SELECT *, CAST(ts {KST} AS DATE) AS event_date,
         json_extract_string(props, '$.k') AS k_text,
         ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts {KST} AS DATE)
                            ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn
  FROM events WHERE NOT list_contains(json_keys(props), 'error')) t
JOIN dim_user u ON u.user_id = t.user_id WHERE t.rn = 1"""))
def _fct10(spark, sf):
    """FCT-10: user x analysis-day signature (STG-22 output, cohort guard)."""
    s = _stg22(spark, sf)
    return s.join(FT.cohort_ids(spark, sf), "user_id", "inner").select(
        "user_id", F.col("event_date").alias("ymd_date"), F.col("k_text").alias("signature_code"))


@register("dim01_item_catalogue", """
SELECT p_partkey AS action_no, p_type AS action_category, p_brand AS action_type,
       p_name AS description FROM part""")
def _dim01(spark, sf):
    """DIM-01: catalogue dimension (explicit projection and rename)."""
    p = read_table(spark, sf, "part", ["p_partkey", "p_type", "p_brand", "p_name"])
    return p.select(F.col("p_partkey").alias("action_no"), F.col("p_type").alias("action_category"),
                    F.col("p_brand").alias("action_type"), F.col("p_name").alias("description"))


@register("dim03_site", """
SELECT n.n_nationkey AS site_key, n.n_name AS site_name, r.r_name AS region_name, 'KR' AS country_code
FROM nation n LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def _dim03(spark, sf):
    """DIM-03: deployment sites with a constant country column."""
    return D.dim_site(spark, sf)


_PRIORITY_LABELS = (("1-URGENT", "Urgent"), ("2-HIGH", "High"), ("3-MEDIUM", "Medium"),
                    ("4-NOT SPECIFIED", "Not specified"), ("5-LOW", "Low"))


@register("dim04_code_labels", "SELECT code, CASE " + " ".join(
    f"WHEN code = '{c}' THEN '{lbl}'" for c, lbl in _PRIORITY_LABELS)
    + " END AS label FROM (SELECT DISTINCT o_orderpriority AS code FROM orders) t")
def _dim04(spark, sf):
    """DIM-04: code-table slice with an English label CASE ladder."""
    codes = read_table(spark, sf, "orders", ["o_orderpriority"]).select(
        F.col("o_orderpriority").alias("code")).distinct()
    return D.code_label(codes, "code", _PRIORITY_LABELS)


@register("dim05_catalogue", "SELECT p_partkey AS disease_id, p_name AS disease_name FROM part")
def _dim05(spark, sf):
    """DIM-05: item catalogue (dim_disease shape)."""
    return B.catalogue(spark, sf)


@register("cht01_active_users_series", with_ctes(["fact_ev"], """
SELECT action_date, SUM(active_users) AS sum_active_users FROM (
  SELECT event_date AS action_date, COUNT(DISTINCT user_id) AS active_users FROM fact_ev
  WHERE event_type = 'click' GROUP BY 1) t GROUP BY 1 ORDER BY 1 LIMIT 10000"""))
def _cht01(spark, sf):
    """CHT-01 / SRT-02: chart series SUM(active_users) by day with the row limit."""
    return M.chart_series(M.app_engagement_daily(spark, sf), "action_date", "active_users", "sum", 10000)


@register("cht02_adherence_series", with_ctes(["coaching"], f"""
SELECT ymd_date, AVG(adherence_pct) AS avg_adherence_pct FROM (
  SELECT ymd_date, {_ADH.format(a="COUNT(*) FILTER (WHERE is_completed)", b="COUNT(*)")} AS adherence_pct
  FROM coaching GROUP BY 1) t GROUP BY 1 ORDER BY 1 LIMIT 10000"""))
def _cht02(spark, sf):
    """CHT-02 / SRT-02: AVG(adherence) by day, ordered, 10 000-row chart limit."""
    return M.chart_series(M.coaching_adherence_daily(spark, sf), "ymd_date", "adherence_pct", "avg",
                          10000)


# ----------------------------------------------------------------------------- more checks

def _combine_counts(parts):
    """Put one-row counts side by side without a join: tag each count with its
    group and name, union them, and fold with one aggregate per group."""
    tagged = [df.select(F.lit(g).alias("channel_code"), F.lit(n).alias("__name"),
                        F.col(df.columns[0]).cast("bigint").alias("__n")) for g, n, df in parts]
    u = tagged[0]
    for t in tagged[1:]:
        u = u.unionByName(t)
    names = list(dict.fromkeys(n for _, n, _ in parts))
    return u.groupBy("channel_code").agg(*[F.max(F.when(F.col("__name") == n, F.col("__n"))).alias(n)
                                           for n in names])


@register("dq13_facts_reconcile_to_staging", with_ctes(["coaching", "measurement"], """
SELECT * FROM (
  SELECT 'coaching' AS channel_code,
         (SELECT COUNT(*) FROM deliveries WHERE user_id IN (SELECT user_id FROM dim_user)) AS staged_rows,
         (SELECT COUNT(*) FROM coaching) AS fact_rows
  UNION ALL
  SELECT 'measurement',
         (SELECT COUNT(*) FROM readings r JOIN orders o ON o.o_orderkey = r.user_lifelog_sn
          WHERE o.o_custkey IN (SELECT user_id FROM dim_user)),
         (SELECT COUNT(*) FROM measurement)) t
WHERE staged_rows IS DISTINCT FROM fact_rows"""))
def _dq13(spark, sf):
    """DQ-13: staged rows of cohort users = fact rows, per channel."""
    cohort = FT.cohort_ids(spark, sf)
    staged_c = B.deliveries(spark, sf).join(cohort, "user_id", "left_semi").agg(
        F.count(F.lit(1)).alias("staged_rows"))
    fact_c = FT.coaching_event(spark, sf).agg(F.count(F.lit(1)).alias("fact_rows"))
    parent = B.lifelog_parent(spark, sf).join(cohort, "user_id", "left_semi").select("user_lifelog_sn")
    staged_m = FT.staged_readings(spark, sf).join(parent, "user_lifelog_sn", "left_semi").agg(
        F.count(F.lit(1)).alias("staged_rows"))
    fact_m = FT.measurement_fact(spark, sf).agg(F.count(F.lit(1)).alias("fact_rows"))
    both = _combine_counts([("coaching", "staged_rows", staged_c), ("coaching", "fact_rows", fact_c),
                            ("measurement", "staged_rows", staged_m), ("measurement", "fact_rows", fact_m)])
    return both.where(~F.col("staged_rows").eqNullSafe(F.col("fact_rows"))).select(
        "channel_code", "staged_rows", "fact_rows")


@register("dq17_non_cohort_users_absent", with_ctes(["coaching", "measurement", "fact_ev"], """
SELECT DISTINCT user_id, src FROM (
  SELECT user_id, 'coaching' AS src FROM coaching UNION ALL
  SELECT user_id, 'measurement' FROM measurement UNION ALL
  SELECT user_id, 'app' FROM fact_ev) f
WHERE NOT EXISTS (SELECT 1 FROM dim_user u WHERE u.user_id = f.user_id)"""))
def _dq17(spark, sf):
    """DQ-17: users outside the cohort (mapper-only) never leak into facts."""
    cohort = FT.cohort_ids(spark, sf)
    facts = (FT.coaching_event(spark, sf).select("user_id", F.lit("coaching").alias("src"))
             .unionByName(FT.measurement_fact(spark, sf).select("user_id", F.lit("measurement").alias("src")))
             .unionByName(FT.guarded_events(spark, sf).select("user_id", F.lit("app").alias("src"))))
    return facts.join(cohort, "user_id", "left_anti").distinct()


@register("dq20_milestone_precision", with_ctes(["fact_ev", "coaching"], f"""
SELECT * FROM ({MILESTONES_SQL}) m
WHERE (temporal_precision = 'DATE') = (occurred_at IS NOT NULL)"""))
def _dq20(spark, sf):
    """DQ-20: DATE milestones carry no timestamp and TIMESTAMP ones do."""
    m = FT.milestones(spark, sf)
    return m.where(((F.col("temporal_precision") == "DATE") & F.col("occurred_at").isNotNull())
                   | ((F.col("temporal_precision") == "TIMESTAMP") & F.col("occurred_at").isNull()))


@register("dq23_unmapped_cohort_users", with_ctes(["dim_user"], """
SELECT coalesce(a.user_id, k.user_id) AS user_id, a.user_id IS NOT NULL AS is_unmapped,
       k.user_id IS NOT NULL AS is_pinned
FROM (SELECT u.user_id FROM dim_user u WHERE NOT EXISTS
        (SELECT 1 FROM customer c WHERE c.c_custkey = u.user_id)) a
FULL OUTER JOIN (SELECT CAST(NULL AS BIGINT) AS user_id WHERE false) k ON k.user_id = a.user_id"""))
def _dq23(spark, sf):
    """DQ-23: cohort users without an account mapping must equal a pinned set,
    in both directions (full outer join). The pinned set is a parameter; it is
    empty for the driver's tables."""
    cohort = FT.cohort_ids(spark, sf)
    acct = read_table(spark, sf, "customer", ["c_custkey"]).select(F.col("c_custkey").alias("user_id"))
    unmapped = cohort.join(acct, "user_id", "left_anti").withColumn("__a", F.lit(True))
    pinned = spark.createDataFrame([], "user_id bigint").withColumn("__k", F.lit(True))
    j = unmapped.join(pinned, "user_id", "full")
    bad = j.where(F.col("__a").isNull() | F.col("__k").isNull())
    return bad.select("user_id", F.col("__a").isNotNull().alias("is_unmapped"),
                      F.col("__k").isNotNull().alias("is_pinned"))


@register("dq27_multiplicity_totals", with_ctes(["dim_user"], """
SELECT * FROM (
  SELECT (SELECT COUNT(*) FROM samples s
          WHERE s.type_code = 'error' AND s.measured_at IS NOT NULL) AS raw_rows,
         (SELECT SUM(c.source_row_count) FROM collapsed c) AS collapsed_rows,
         (SELECT SUM(n_samples) FROM wday WHERE stream_code = 'error') AS day_rows,
         (SELECT COUNT(*) FROM samples s JOIN dim_user u ON u.user_id = s.user_lifelog_sn
          WHERE s.type_code = 'error' AND s.measured_at IS NOT NULL) AS raw_cohort_rows,
         (SELECT SUM(c.source_row_count) FROM collapsed c JOIN dim_user u ON u.user_id = c.user_lifelog_sn) AS detail_rows) t
WHERE raw_rows IS DISTINCT FROM collapsed_rows OR raw_rows IS DISTINCT FROM day_rows OR raw_cohort_rows IS DISTINCT FROM detail_rows""",
    [_SAMPLES, _COLLAPSED, _WDAY]))
def _dq27(spark, sf):
    """DQ-27: total multiplicity survives raw -> collapsed -> daily, and of the
    cohort's samples raw -> detail fact."""
    raw = W.raw_samples(spark, sf, W.WEIGHTED_STREAM).where(F.col("measured_at").isNotNull())
    day = W.wearable_day(spark, sf).where(F.col("stream_code") == W.WEIGHTED_STREAM)
    return C.multiplicity_totals(raw, W.collapsed_stream(spark, sf), day, W.detail_fact(spark, sf), FT.cohort_ids(spark, sf))


@register("dq28_observations_attributed", """
SELECT user_id AS user_lifelog_sn, ts AS measured_at, event_type AS type_code
FROM events WHERE event_type = 'error' AND ts IS NOT NULL AND user_id IS NULL
GROUP BY ALL""")
def _dq28(spark, sf):
    """DQ-28: collapsed observations without a user: whose serial the lifelog's
    parent does not know (the stand-in's parent is the serial itself)."""
    collapsed = W.collapsed_stream(spark, sf)
    parents = W.stream_parents(spark, sf)
    return C.unattributed(collapsed, parents, "user_lifelog_sn").select("user_lifelog_sn", "measured_at", "type_code")


@register("dtl05_two_hop_attribution", with_ctes(["dim_user"], """
SELECT l.l_orderkey AS session_sn, l.l_linenumber AS stage_no, o.o_custkey AS user_id,
       o.o_orderdate AS session_start_at, l.l_shipdate AS stage_end_at,
       CAST(epoch(l.l_shipdate - o.o_orderdate) AS DOUBLE) AS duration_seconds
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN dim_user u ON u.user_id = o.o_custkey"""))
def _dtl05(spark, sf):
    """DTL-05 / JON-03: stage rows attributed through their session to the
    user (two hops), with the duration in seconds (FN-09)."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    hop1 = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    hop2 = hop1.join(dim_user(spark, sf).select(F.col("user_id").alias("o_custkey")), "o_custkey", "inner")
    return hop2.select(F.col("l_orderkey").alias("session_sn"), F.col("l_linenumber").alias("stage_no"),
                       F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("session_start_at"),
                       F.col("l_shipdate").alias("stage_end_at"),
                       tu.epoch_seconds("l_shipdate", "o_orderdate").alias("duration_seconds"))


@register("int01_incremental_vs_full", with_ctes(["ev"], """
SELECT (SELECT COUNT(*) FROM collapsed) AS full_rows,
       (SELECT COUNT(*) FROM ((SELECT * FROM inc EXCEPT ALL SELECT * FROM collapsed)
                              UNION ALL (SELECT * FROM collapsed EXCEPT ALL SELECT * FROM inc)) d)
       AS differing_rows""", [_SAMPLES, _COLLAPSED,
    "old AS (SELECT user_lifelog_sn, measured_at, type_code, sample_value, COUNT(*) AS source_row_count "
    "FROM samples WHERE type_code = 'error' AND measured_at IS NOT NULL "
    "AND measured_at < TIMESTAMP '2024-01-25' GROUP BY ALL)",
    "cut AS (SELECT MAX(measured_at) - INTERVAL 7 DAY AS c FROM old)",
    "inc AS (SELECT * FROM old WHERE NOT coalesce(measured_at >= (SELECT c FROM cut), false) "
    "UNION ALL SELECT * FROM collapsed WHERE measured_at >= (SELECT c FROM cut))"]))
def _int01_inc(spark, sf):
    """INT-01 incremental = full rebuild: the snapshot built from arrivals
    before 2024-01-25, window-replaced with the last 7 days of event time,
    against the full collapse: the full row count and the size of the
    multiset symmetric difference (0 when they agree)."""
    old = W.collapsed_stream(spark, sf, before="2024-01-25")
    raw = W.raw_samples(spark, sf, W.WEIGHTED_STREAM)
    inc = W.collapsed_incremental(old, raw, days=7)
    full = W.collapsed_stream(spark, sf)
    diff = symmetric_difference(inc.drop("source_observation_id"), full.drop("source_observation_id"))
    return _combine_counts([("int01", "full_rows", full.agg(F.count(F.lit(1)))),
                            ("int01", "differing_rows", diff.agg(F.count(F.lit(1))))]).drop("channel_code")


@register("src13_control_table", f"""
SELECT 'events' AS source_system, 'public' AS schema_name, 'events_' || event_type AS table_name,
       MAX(ts) AS watermark_value, 'SUCCESS' AS last_status, CAST(NULL AS VARCHAR) AS last_error,
       COUNT(*) AS row_count, MAX(ts) AS updated_at FROM events GROUP BY event_type
UNION ALL SELECT s, 'public', t, m, 'SUCCESS', NULL, NULL, m
FROM (VALUES ('crm', 'customer'), ('sales', 'orders')) v(s, t), (SELECT MAX(ts) AS m FROM events) x""")
def _src13(spark, sf):
    """SRC-13 / SNK-09..11: the control table a replay of the event stream
    records (observed positions, row counts, full-refresh run time)."""
    return LS.control_from_landing(spark, sf)


# ----------------------------------------------------------------------------- landing & table maintenance

from dayledger.operators import watermarks as WMK  # noqa: E402

_PRE_1998 = "o_orderdate < TIMESTAMP '1998-01-01'"


@register("snk01_full_refresh", "SELECT * FROM orders WHERE o_orderstatus <> 'P'")
def _snk01(spark, sf):
    """SNK-01: a full refresh replaces the target, so rows deleted upstream
    (here: the pending orders) disappear from it."""
    o = read_table(spark, sf, "orders")
    target = o.where(F.expr(_PRE_1998))
    batch = o.where(F.col("o_orderstatus") != "P")
    return K.full_refresh(target, batch, batch_is_empty=False)


@register("snk08_empty_refresh_keeps_target", f"SELECT * FROM orders WHERE {_PRE_1998}")
def _snk08(spark, sf):
    """SNK-08: a full refresh that read nothing leaves the target untouched
    (unless truncate_on_empty is asked for)."""
    o = read_table(spark, sf, "orders")
    target = o.where(F.expr(_PRE_1998))
    batch = o.where(F.col("o_orderdate") > F.lit("2100-01-01").cast("timestamp_ntz"))
    return K.full_refresh(target, batch)


@register("src07_exclude_columns", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def _src07(spark, sf):
    """SRC-07: column exclusion with guards (key kept, unknown names refused);
    pruning then keeps the excluded columns out of the scan."""
    c = read_table(spark, sf, "customer")
    return L.exclude_columns(c, ["c_name", "c_acctbal"], keys=["c_custkey"])


_SOURCE_TYPES = {"o_orderkey": "bigint", "o_custkey": "integer", "o_orderstatus": "character(1)",
                 "o_totalprice": "numeric(12,2)", "o_orderdate": "date",
                 "o_orderpriority": "order_priority_enum"}


@register("src09_landing_types", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
       rtrim(o_orderstatus) AS o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders""")
def _src09(spark, sf):
    """SRC-09: landing type mapping (numeric(p,s) kept, CHAR trimmed, unknown
    enum -> text)."""
    return L.land_columns(read_table(spark, sf, "orders"), _SOURCE_TYPES)


_AT = dt.datetime(2024, 2, 1)


@register("snk11_control_updates", """
WITH ctl AS (
  SELECT 'events' AS source_system, 'public' AS schema_name, 'events_' || event_type AS table_name,
         MAX(ts) AS watermark_value, 'SUCCESS' AS last_status, CAST(NULL AS VARCHAR) AS last_error,
         COUNT(*) AS row_count, MAX(ts) AS updated_at FROM events GROUP BY event_type
  UNION ALL SELECT s, 'public', t, m, 'SUCCESS', NULL, NULL, m
  FROM (VALUES ('crm', 'customer'), ('sales', 'orders')) v(s, t), (SELECT MAX(ts) AS m FROM events) x)
SELECT source_system, schema_name, table_name, watermark_value,
       CASE WHEN table_name = 'events_error' THEN 'FAILED' ELSE last_status END AS last_status,
       CASE WHEN table_name = 'events_error' THEN 'timeout' ELSE last_error END AS last_error,
       row_count,
       CASE WHEN table_name = 'events_error' THEN TIMESTAMP '2024-02-01' ELSE updated_at END AS updated_at
FROM ctl WHERE table_name <> 'events_view'
UNION ALL SELECT 'events', 'public', 'events_view', TIMESTAMP '2024-02-01', 'SUCCESS', NULL, 0,
                 TIMESTAMP '2024-02-01'
UNION ALL SELECT 'ops', 'public', 'error_catalog', NULL, 'FAILED', 'missing', NULL, TIMESTAMP '2024-02-01'""")
def _snk11(spark, sf):
    """SNK-11: control-row upserts on the replayed control table: a failure
    keeps the position and bumps the time, a success moves it, a first-run
    failure inserts a row without position."""
    ctl = LS.control_from_landing(spark, sf).select(
        "source_system", "schema_name", "table_name", "watermark_value", "last_status", "last_error",
        "row_count", F.col("updated_at"))
    ctl = ctl.withColumn("watermark_value", tu.naive_to_instant("watermark_value")).withColumn(
        "updated_at", tu.naive_to_instant("updated_at"))
    ctl = WMK.record_failure(ctl, ("events", "public", "events_error"), "timeout", _AT)
    ctl = WMK.record_success(ctl, ("events", "public", "events_view"), _AT, 0, _AT)
    ctl = WMK.record_failure(ctl, ("ops", "public", "error_catalog"), "missing", _AT)
    return ctl.select(*[tu.instant_to_naive(c).alias(c) if t == "timestamp" else F.col(c)
                        for c, t in ctl.dtypes])


@register("snk12_materialized_dim_user", with_ctes(["dim_user"], "SELECT * FROM dim_user"))
def _snk12(spark, sf):
    """SNK-12: materialise a model as a table — a new snapshot directory under
    the shared checkpoint folder, pointer appended, then read back (lineage
    cut; survives executor loss)."""
    return K.materialize(dim_user(spark, sf), "dim_user")


@register("dq09_source_freshness", """
SELECT latest_loaded_at, ROUND(age_hours, 6) AS age_hours, CASE WHEN latest_loaded_at IS NULL OR age_hours > 48 THEN 'error'
       WHEN age_hours > 24 THEN 'warn' END AS severity
FROM (SELECT MAX(ts) AS latest_loaded_at,
             (epoch(TIMESTAMP '2024-02-02 00:00:00') - epoch(MAX(ts))) / 3600.0 AS age_hours FROM events) t
WHERE latest_loaded_at IS NULL OR age_hours > 24""")
def _dq09(spark, sf):
    """DQ-09: source freshness on max(_loaded_at) of the control table
    against an as-of time (warn after 24 h, error after 48 h)."""
    ctl = LS.control_from_landing(spark, sf).withColumn("updated_at", tu.naive_to_instant("updated_at"))
    out = Q.freshness(ctl, "updated_at", dt.datetime(2024, 2, 2), 24, 48)
    return out.withColumn("latest_loaded_at", tu.instant_to_naive("latest_loaded_at")).withColumn(
        "age_hours", F.round("age_hours", 6))


@register("dq11_ambiguous_band", with_ctes(["readings"], """
SELECT * FROM readings WHERE metric_code = 'quantity' AND metric_value >= 25 AND metric_value <= 26"""))
def _dq11(spark, sf):
    """DQ-11 / PRJ-11: readings inside a closed ambiguous band (violations)."""
    r = FT.staged_readings(spark, sf)
    return r.where((F.col("metric_code") == "quantity") & F.col("metric_value").between(25, 26))


@register("dq14_staging_reconciles", """
SELECT * FROM (
  SELECT (SELECT COUNT(*) FROM events) AS landing_rows,
         (SELECT COUNT(*) FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id) AS staging_rows,
         (SELECT COUNT(*) FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
          WHERE c.c_custkey IS NULL) AS unmapped_rows) t
WHERE landing_rows IS DISTINCT FROM staging_rows OR unmapped_rows > 0""")
def _dq14(spark, sf):
    """DQ-14: key translation keeps every landing row (no fan-out, no loss)
    and leaves none unmapped."""
    e = read_table(spark, sf, "events", ["event_id", "user_id"])
    c = read_table(spark, sf, "customer", ["c_custkey"])
    staged = S.translate_key(e, c, [("user_id", "c_custkey")], {"c_custkey": "mapped_user"})
    landing = e.agg(F.count(F.lit(1)).alias("landing_rows"))
    st = staged.agg(F.count(F.lit(1)).alias("staging_rows"),
                    F.count_if(F.col("mapped_user").isNull()).alias("unmapped_rows"))
    j = _combine_counts([("events", "landing_rows", landing),
                         ("events", "staging_rows", st.select("staging_rows")),
                         ("events", "unmapped_rows", st.select("unmapped_rows"))]).drop("channel_code")
    return j.where(~F.col("landing_rows").eqNullSafe(F.col("staging_rows")) | (F.col("unmapped_rows") > 0))


@register("dq15_error_payloads_bounded", """
SELECT COUNT(*) AS error_rows FROM events WHERE list_contains(json_keys(props), 'error')
HAVING COUNT(*) > 0""")
def _dq15(spark, sf):
    """DQ-15 / AGG-12: error payload count, reported only above the bound
    (HAVING without GROUP BY)."""
    from dayledger.functions.jsonfn import json_has_key
    e = read_table(spark, sf, "events", ["props"])
    return e.agg(F.count_if(json_has_key("props", "error")).alias("error_rows")).where("error_rows > 0")


# ----------------------------------------------------------------------------- staging models

@register("stg03_lifelog_parent", """
SELECT o_orderkey AS user_lifelog_sn, o_custkey AS user_id, o_orderpriority AS measure_device_type
FROM orders WHERE o_custkey IS NOT NULL""")
def _stg03(spark, sf):
    """STG-03 / PRJ-13: the lifelog parent (the only place a user id appears),
    explicit projection, parent filter ``user_id IS NOT NULL``."""
    return B.lifelog_parent(spark, sf).where(F.col("user_id").isNotNull())


def _meal_records(spark, sf):
    """STG-01 shape: records with a nullable soft-delete flag (a returned line
    counts as deleted; an unknown flag is NULL)."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag"])
    flag = F.when(F.col("l_returnflag") == "R", F.lit(True)).when(F.col("l_returnflag") == "A", F.lit(False))
    return li.select(F.col("l_orderkey").alias("user_lifelog_sn"), F.col("l_linenumber").alias("record_no"),
                     F.col("l_shipdate").alias("recorded_at"), flag.alias("is_deleted"))


@register("fct07_meal_event", with_ctes(["dim_user"], f"""
SELECT md5(concat_ws('|', CAST(o.o_custkey AS VARCHAR), strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S.%f'),
                      CAST(l.l_linenumber AS VARCHAR))) AS meal_event_key,
       o.o_custkey AS user_id, l.l_orderkey AS user_lifelog_sn, l.l_linenumber AS record_no,
       l.l_shipdate AS recorded_at, CAST(l.l_shipdate {KST} AS DATE) AS recorded_date
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN dim_user u ON u.user_id = o.o_custkey
WHERE (CASE WHEN l.l_returnflag = 'R' THEN true WHEN l.l_returnflag = 'A' THEN false END) IS NOT TRUE"""))
def _fct07(spark, sf):
    """STG-01 + FCT-07: records attributed through the parent, soft-delete
    filter ``is_deleted IS NOT TRUE`` (NULL kept), local date, md5 event key,
    cohort guard."""
    from dayledger.functions.keys import event_key, key_text
    m = _meal_records(spark, sf).where(S.keep_unless_deleted("is_deleted"))
    parent = (B.lifelog_parent(spark, sf).where(F.col("user_id").isNotNull())
              .join(FT.cohort_ids(spark, sf), "user_id", "left_semi"))
    j = m.join(parent.select("user_lifelog_sn", "user_id"), "user_lifelog_sn", "inner")
    key = event_key(F.col("user_id").cast("string"), key_text("recorded_at", j.schema["recorded_at"].dataType),
                    F.col("record_no").cast("string"))
    return j.select(key.alias("meal_event_key"), "user_id", "user_lifelog_sn", "record_no", "recorded_at",
                    tu.local_date("recorded_at").alias("recorded_date"))


@register("stg20_text_dates", """
SELECT o_orderkey, strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d')::DATE AS ymd_date FROM orders""")
def _stg20(spark, sf):
    """STG-20/21 / FN-02: 'YYYYMMDD' source text parsed strictly to DATE (a
    malformed value fails the job under ANSI mode instead of becoming NULL).
    The stand-in text column is the order date rendered as source text."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    text = o.select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("ymd"))
    return text.select("o_orderkey", tu.parse_ymd("ymd").alias("ymd_date"))


@register("dq18_measurement_signatures", with_ctes(["measurement"], """
(SELECT user_lifelog_sn, measured_at, metric_code, metric_value FROM measurement
 EXCEPT ALL
 SELECT r.user_lifelog_sn, r.measured_at, r.metric_code, r.metric_value FROM readings r
 JOIN orders o ON o.o_orderkey = r.user_lifelog_sn WHERE o.o_custkey IN (SELECT user_id FROM dim_user))
UNION ALL
(SELECT r.user_lifelog_sn, r.measured_at, r.metric_code, r.metric_value FROM readings r
 JOIN orders o ON o.o_orderkey = r.user_lifelog_sn WHERE o.o_custkey IN (SELECT user_id FROM dim_user)
 EXCEPT ALL
 SELECT user_lifelog_sn, measured_at, metric_code, metric_value FROM measurement)"""))
def _dq18(spark, sf):
    """DQ-18 / SET-02: the measurement fact preserves every observation signature
    that the raw table holds (by multiset fingerprints; the raw side is read anew,
    not through the staging model)."""
    parent = (B.lifelog_parent(spark, sf).where(F.col("user_id").isNotNull())
              .join(FT.cohort_ids(spark, sf), "user_id", "left_semi"))
    return C.signature_differences(FT.measurement_fact(spark, sf), B.readings_source(spark, sf), parent)


# ----------------------------------------------------------------------------- more detail facts

@register("dtl06_click_sample_facts", with_ctes(["dim_user"], f"""
SELECT md5(coalesce(CAST(user_lifelog_sn AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
           coalesce(strftime(measured_at, '%Y-%m-%d %H:%M:%S.%f'), '_dbt_utils_surrogate_key_null_') || '-' ||
           coalesce(type_code, '_dbt_utils_surrogate_key_null_') || '-' ||
           coalesce(CAST(sample_value AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS source_observation_id,
       u.user_id, measured_at, CAST(measured_at {KST} AS DATE) AS ymd_date, type_code,
       CAST(sample_value AS DOUBLE) AS sample_value, source_row_count
FROM (SELECT user_lifelog_sn, measured_at, type_code, sample_value, COUNT(*) AS source_row_count
      FROM samples WHERE type_code = 'click' AND measured_at IS NOT NULL GROUP BY ALL) c
JOIN dim_user u ON u.user_id = c.user_lifelog_sn""", [_SAMPLES]))
def _dtl06(spark, sf):
    """STG-08 + DTL-06: a second point stream collapsed with multiplicity and
    surrogate key, attributed to cohort users."""
    return W.detail_fact(spark, sf, "click")


@register("dtl04_session_facts", with_ctes(["deliveries", "dim_user"], f"""
SELECT d.activity_row_id AS session_sn, d.user_id, d.delivered_at AS started_at,
       d.completed_at AS ended_at, CAST(d.delivered_at {KST} AS DATE) AS ymd_date,
       CAST(epoch(d.completed_at - d.delivered_at) AS DOUBLE) AS duration_seconds
FROM deliveries d JOIN dim_user u ON u.user_id = d.user_id"""))
def _dtl04(spark, sf):
    """DTL-04: interval facts attributed to cohort users, dated from the start
    (an overnight interval counts on the day it began), duration in seconds
    (open intervals: NULL)."""
    d = B.deliveries(spark, sf).join(FT.cohort_ids(spark, sf), "user_id", "left_semi")
    return d.select(F.col("activity_row_id").alias("session_sn"), "user_id",
                    F.col("delivered_at").alias("started_at"), F.col("completed_at").alias("ended_at"),
                    tu.local_date("delivered_at").alias("ymd_date"),
                    tu.epoch_seconds("completed_at", "delivered_at").alias("duration_seconds"))


@register("stg24_cohort_population", with_ctes(["cohort"], """
SELECT c.user_id, c.joined_date, a.c_mktsegment AS segment, NULLIF(a.c_acctbal, 0) AS balance
FROM cohort c LEFT JOIN customer a ON a.c_custkey = c.user_id"""))
def _stg24(spark, sf):
    """STG-24 / PRJ-03: the cohort population with a zero measure read as
    missing (``nullif(x, 0)``), never as an observed zero."""
    c = B.cohort_source(spark, sf)
    a = read_table(spark, sf, "customer", ["c_custkey", "c_mktsegment", "c_acctbal"]).select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"), "c_acctbal")
    return c.join(a, "user_id", "left").select("user_id", "joined_date", "segment",
                                              S.zero_as_missing("c_acctbal").alias("balance"))
