"""Metrics and chart queries (MET-01..MET-07, CHT-01..CHT-07).

Thin aggregates over the facts. Ratios keep the guarded denominator
``nullif(count, 0)`` and are rounded on decimals, then cast to double at the
edge. ``count(distinct)`` plans as partial + merge aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions import timeutil as tu
from dayledger.plans import bindings as B
from dayledger.plans import facts as FT


def _pct(num, den, scale: int = 1):
    return F.round(F.lit(100.0).cast("decimal(4,1)") * num / F.nullif(den, F.lit(0)), scale
                   ).cast("double")


def app_engagement_daily(spark: SparkSession, sf: str, event_type: str = "click") -> DataFrame:
    """MET-01: distinct active users and actions per local day (cohort only).

    Reduced to (day, user) counts before the cohort guard, so the guard join
    and the distinct count both see at most one row per user-day."""
    e = B.events(spark, sf).where(F.col("event_type") == event_type)
    per_user = e.groupBy(F.col("event_date").alias("action_date"), "user_id").agg(
        F.count(F.lit(1)).alias("n"))
    guarded = per_user.join(FT.cohort_ids(spark, sf), "user_id", "left_semi")
    return guarded.groupBy("action_date").agg(F.count(F.lit(1)).alias("active_users"),
                                              F.sum("n").alias("actions"))


def _guarded_per_user(df: DataFrame, period: list, user_col: str, aggs: list,
                      spark: SparkSession, sf: str) -> DataFrame:
    """Reduce a fact to (period, user) first, then apply the cohort guard as a
    semi join: identical to guarding the rows (the guard is a filter on the
    user) but the join sees at most one row per user and period."""
    per = df.groupBy(*period, user_col).agg(*aggs)
    cohort = FT.cohort_ids(spark, sf).withColumnRenamed("user_id", user_col)
    return per.join(cohort, user_col, "left_semi")


def _adherence(spark: SparkSession, sf: str, by: str) -> DataFrame:
    d = B.deliveries(spark, sf)
    per = _guarded_per_user(d, [by], "user_id", [
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("completed_at").isNotNull()).alias("n_done")], spark, sf)
    g = per.groupBy(by).agg(F.sum("n").alias("activities_delivered"),
                            F.sum("n_done").alias("activities_completed"))
    return g.withColumn("adherence_pct", _pct(F.col("activities_completed"),
                                              F.col("activities_delivered")))


def coaching_adherence_daily(spark: SparkSession, sf: str) -> DataFrame:
    """MET-02: completed / delivered per day; every delivery (withdrawn ones
    too) stays in the denominator. Same as aggregating FCT-06, computed from
    per-user-day partials."""
    return _adherence(spark, sf, "ymd_date")


def coaching_adherence_by_domain(spark: SparkSession, sf: str) -> DataFrame:
    """MET-03: the same ratio by domain."""
    return _adherence(spark, sf, "domain")


def measurement_participation_weekly(spark: SparkSession, sf: str) -> DataFrame:
    """MET-04: measuring users and readings per Monday week.

    Readings are counted per (serial, week) before attribution, so the parent
    join and the cohort guard see one row per serial-week, not per reading."""
    r = FT.staged_readings(spark, sf)
    per_sn = r.groupBy("user_lifelog_sn", tu.trunc_date("week", tu.local_date("measured_at"))
                       .alias("week_start_date")).agg(F.count(F.lit(1)).alias("n"))
    parent = (B.lifelog_parent(spark, sf).where(F.col("user_id").isNotNull())
              .join(FT.cohort_ids(spark, sf), "user_id", "left_semi")
              .select("user_lifelog_sn", "user_id"))
    per_user = (per_sn.join(parent, "user_lifelog_sn", "inner")
                .groupBy("week_start_date", "user_id").agg(F.sum("n").alias("n")))
    return per_user.groupBy("week_start_date").agg(
        F.count(F.lit(1)).alias("measuring_users"), F.sum("n").alias("readings"))


def _in_catalogue_scores(spark: SparkSession, sf: str) -> DataFrame:
    s = B.scores_source(spark, sf)
    cat = B.catalogue(spark, sf).select("disease_id")
    return s.join(cat, "disease_id", "left_semi").withColumn(
        "month_start_date", tu.trunc_date("month", "ymd_date"))


def population_risk_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """MET-05: monthly mean rank over catalogue items (a trend of ranks, never
    summed into a residual). Means are exact decimal sum / count of the
    per-user partials."""
    s = _in_catalogue_scores(spark, sf).where(F.col("irsp_score").isNotNull())
    per = _guarded_per_user(s, ["month_start_date"], "user_id", [
        F.sum("irsp_score").alias("s_plus"), F.count("irsp_score").alias("n_plus"),
        F.sum("irs_score").alias("s_irs"), F.count("irs_score").alias("n_irs")], spark, sf)

    def mean(sum_col, n_col):
        return F.round(F.sum(sum_col).cast("decimal(38,0)") / F.nullif(F.sum(n_col), F.lit(0)), 2
                       ).cast("double")

    return per.groupBy("month_start_date").agg(
        F.count(F.lit(1)).alias("users_scored"),
        mean("s_plus", "n_plus").alias("mean_irs_plus"), mean("s_irs", "n_irs").alias("mean_irs"))


def high_risk_load_monthly(spark: SparkSession, sf: str, threshold: int = 80) -> DataFrame:
    """MET-06: per user-month the number of *distinct* items at or above the
    threshold, then the monthly average and maximum (two-level aggregate)."""
    s = _in_catalogue_scores(spark, sf).where(F.col("irs_score").isNotNull())
    per_user = _guarded_per_user(s, ["month_start_date"], "user_id", [
        F.countDistinct(F.when(F.col("irs_score") >= threshold, F.col("disease_id")))
        .alias("high_risk_diseases")], spark, sf)
    return per_user.groupBy("month_start_date").agg(
        F.count(F.lit(1)).alias("users_scored"),
        F.round(F.avg(F.col("high_risk_diseases").cast("decimal(20,0)")), 2).cast("double")
        .alias("avg_high_risk_diseases"),
        F.max("high_risk_diseases").alias("max_high_risk_diseases"))


def scoring_coverage_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """MET-07: users scored per month over the current cohort size. The cohort
    size is an uncorrelated scalar subquery: one count, used as a literal."""
    s = B.scores_source(spark, sf).withColumn("month_start_date", tu.trunc_date("month", "ymd_date"))
    per_user = _guarded_per_user(s, ["month_start_date"], "user_id", [F.count(F.lit(1)).alias("n")],
                                 spark, sf)
    scored = per_user.groupBy("month_start_date").agg(F.count(F.lit(1)).alias("users_scored"))
    size = F.lit(FT.cohort_ids(spark, sf).count()).cast("bigint")
    return scored.select("month_start_date", size.alias("cohort_size"), "users_scored",
                         _pct(F.col("users_scored"), size).alias("coverage_pct"))


def chart_series(df: DataFrame, x: str, y: str, how: str, limit: int) -> DataFrame:
    """CHT-*: one chart series, ``SUM``/``AVG`` of one column by x, ordered by
    x with the chart's row limit (the limit is the feature here: 10,000 for line
    charts, and always the caller's choice)."""
    fn = {"sum": F.sum, "avg": F.avg, "max": F.max}[how]
    return (df.groupBy(x).agg(fn(y).alias(f"{how}_{y}")).orderBy(x).limit(limit))
