"""DuckDB oracle SQL for the registered queries.

Written independently from the Spark code, straight from the model
definitions (ANSI SQL + DuckDB date arithmetic; local dates via
``+ INTERVAL 9 HOUR``, equal to the zone rule for every date since 1988).
Shared relations are CTE fragments composed per query.
"""

from __future__ import annotations

KST = "+ INTERVAL 9 HOUR"



def age(day: str, birth_year: str) -> str:
    """Age in years to two digits, half up, in whole numbers (from 1 July of the year)."""
    days = f"({day} - make_date(CAST({birth_year} AS BIGINT), 7, 1))"
    return f"CASE WHEN {birth_year} IS NOT NULL THEN CAST((2 * 10000 * {days} + 36525) // (2 * 36525) AS DOUBLE) / 100 END"


def age_band(day: str, birth_year: str) -> str:
    days = f"({day} - make_date(CAST({birth_year} AS BIGINT), 7, 1))"
    return f"CASE WHEN {birth_year} IS NOT NULL THEN CAST({days} * 100 // (36525 * 5) * 5 AS BIGINT) END"


CTE = {
    "ev": f"ev AS (SELECT event_id, ts, user_id, event_type, value, props, "
          f"CAST(ts {KST} AS DATE) AS event_date FROM events)",
    "cohort": "cohort AS (SELECT user_id, MIN(event_date) AS joined_date FROM ev "
              "WHERE event_type = 'signup' GROUP BY user_id)",
    "dim_user": "dim_user AS (SELECT c.user_id, c.joined_date, a.c_custkey IS NOT NULL AS is_mapped, "
                "a.c_mktsegment AS segment, "
                "a.c_acctbal AS acctbal, a.c_nationkey AS site_key, n.n_name AS site_name, "
                "a.birth_year, a.app_registered_date, a.w AS weight_kg, a.h AS height_cm, "
                # exact half-up rounding of w / (h / 100)^2 to two digits
                "CAST((2 * 1000000 * a.w::BIGINT + a.h::BIGINT * a.h::BIGINT) // (2 * a.h::BIGINT * a.h::BIGINT) AS DOUBLE) / 100 AS bmi, "
                "CASE WHEN a.w IS NULL THEN NULL WHEN a.w * 10000 < 18.5 * a.h * a.h THEN 'underweight' "
                "WHEN a.w * 10000 < 23 * a.h * a.h THEN 'normal' WHEN a.w * 10000 < 25 * a.h * a.h THEN 'overweight' ELSE 'obese' END AS bmi_band, "
                "'participant' AS cohort_group "
                "FROM cohort c LEFT JOIN (SELECT *, CASE WHEN c_custkey % 10 <> 0 THEN 1930 + (c_custkey * 7) % 65 END AS birth_year, "
                "CASE WHEN c_custkey % 3 = 0 THEN DATE '2023-12-01' + CAST(c_custkey % 60 AS INTEGER) END AS app_registered_date, "
                "CASE WHEN c_custkey % 17 <> 0 THEN CAST(45 + (c_custkey * 13) % 60 AS DOUBLE) END AS w, "
                "CAST(150 + (c_custkey * 11) % 40 AS DOUBLE) AS h FROM customer) a ON a.c_custkey = c.user_id "
                "LEFT JOIN nation n ON n.n_nationkey = a.c_nationkey)",
    "fact_ev": "fact_ev AS (SELECT e.* FROM ev e JOIN dim_user u ON u.user_id = e.user_id)",
    "deliveries": "deliveries AS (SELECT o.o_orderkey AS activity_row_id, o.o_custkey AS user_id, "
                  "CAST(o.o_orderdate AS DATE) AS ymd_date, o.o_orderpriority AS domain, "
                  "o.o_orderdate AS delivered_at, "
                  "CASE WHEN o.o_orderstatus = 'F' THEN ls.last_ship END AS completed_at "
                  "FROM orders o LEFT JOIN (SELECT l_orderkey, MAX(l_shipdate) AS last_ship "
                  "FROM lineitem GROUP BY l_orderkey) ls ON ls.l_orderkey = o.o_orderkey)",
    "coaching": "coaching AS (SELECT d.activity_row_id, d.user_id, d.ymd_date, d.domain, "
                "d.delivered_at, d.completed_at, d.completed_at IS NOT NULL AS is_completed, "
                "CASE WHEN d.completed_at IS NOT NULL AND d.delivered_at IS NOT NULL THEN "
                "CAST(epoch(d.completed_at - d.delivered_at) / 60 AS DECIMAL(12,2)) END "
                "AS response_latency_minutes "
                "FROM deliveries d JOIN dim_user u ON u.user_id = d.user_id)",
    "readings_src": "readings_src AS (SELECT l_orderkey AS user_lifelog_sn, l_linenumber AS slot, "
                    "l_shipdate AS measured_dt, l_quantity AS quantity, "
                    "l_extendedprice AS extended_price, l_discount AS discount, l_tax AS tax "
                    "FROM lineitem)",
    "amounts": "amounts AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "
               "user_lifelog_sn, slot ORDER BY quantity DESC NULLS LAST, "
               "extended_price DESC NULLS LAST, measured_dt DESC NULLS LAST, "
               "discount DESC NULLS LAST, tax DESC NULLS LAST) AS rn FROM "
               "(SELECT DISTINCT * FROM readings_src)) WHERE rn = 1)",
    "readings": "readings AS ("
                "SELECT 'amounts' AS source_stream, user_lifelog_sn, measured_dt AS measured_at, "
                "'quantity' AS metric_code, CAST(quantity AS DOUBLE) AS metric_value, "
                "'units' AS metric_unit FROM amounts WHERE quantity IS NOT NULL "
                "UNION ALL SELECT 'amounts', user_lifelog_sn, measured_dt, 'extended_price', "
                "CAST(extended_price AS DOUBLE), 'usd' FROM amounts WHERE extended_price IS NOT NULL "
                "UNION ALL SELECT 'rates', user_lifelog_sn, measured_dt, 'discount', discount, "
                "'ratio' FROM readings_src WHERE discount IS NOT NULL GROUP BY ALL "
                "UNION ALL SELECT 'rates', user_lifelog_sn, measured_dt, 'tax', tax, 'ratio' "
                "FROM readings_src WHERE tax IS NOT NULL GROUP BY ALL)",
    "measurement": "measurement AS (SELECT r.source_stream, r.user_lifelog_sn, o.o_custkey AS user_id, "
                   f"r.measured_at, CAST(r.measured_at {KST} AS DATE) AS measured_date, "
                   "r.metric_code, r.metric_value, r.metric_unit, "
                   "o.o_orderpriority AS measure_device_type "
                   "FROM readings r JOIN orders o ON o.o_orderkey = r.user_lifelog_sn "
                   "JOIN dim_user u ON u.user_id = o.o_custkey WHERE o.o_custkey IS NOT NULL)",
    "scores": "scores AS (SELECT o.o_custkey AS user_id, CAST(l.l_shipdate AS DATE) AS ymd_date, "
              "l.l_partkey AS disease_id, CAST(l.l_quantity * 2 AS INTEGER) AS irs_score, "
              "NULLIF(CAST(ROUND(l.l_discount * 1000) AS INTEGER), 0) AS irsp_score "
              "FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)",
    "disease_day": "disease_day AS (SELECT s.user_id, s.ymd_date, s.disease_id, "
                   "c.p_partkey IS NOT NULL AS is_in_catalog, s.irs_score, s.irsp_score, "
                   f"{age('s.ymd_date', 'u.birth_year')} AS age_at_activity, {age_band('s.ymd_date', 'u.birth_year')} AS age_band_5y "
                   "FROM scores s JOIN dim_user u ON u.user_id = s.user_id "
                   "LEFT JOIN (SELECT p_partkey FROM part) c "
                   "ON c.p_partkey = s.disease_id)",
}

ORDER = ["ev", "cohort", "dim_user", "fact_ev", "deliveries", "coaching", "readings_src",
         "amounts", "readings", "measurement", "scores", "disease_day"]


def with_ctes(names: list[str], body: str, extra: list[str] | None = None) -> str:
    """Compose ``WITH`` + the named fragments (in dependency order) + body."""
    wanted = set(names)
    deps = {"cohort": {"ev"}, "dim_user": {"cohort"}, "fact_ev": {"ev", "dim_user"},
            "coaching": {"deliveries", "dim_user"}, "amounts": {"readings_src"},
            "readings": {"amounts", "readings_src"}, "measurement": {"readings", "dim_user"},
            "disease_day": {"scores", "dim_user"}}
    changed = True
    while changed:
        changed = False
        for n in list(wanted):
            for d in deps.get(n, ()):
                if d not in wanted:
                    wanted.add(d)
                    changed = True
    parts = [CTE[n] for n in ORDER if n in wanted] + list(extra or [])
    return "WITH " + ",\n".join(parts) + "\n" + body
