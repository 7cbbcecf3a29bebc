"""Staging of the app's logs: the app's own user number becomes the cohort's
user through a mapper (STG-10..16), and the facts on top (FCT-03).

The mapper's filter stands inside the right side of the left join, so a log
row of an unknown or unmapped account stays with a NULL user: staging loses
nothing, facts guard by the cohort.

Binding: the app numbers a customer by its key plus 700,000; the logs are events by
type (view = login, click = action, purchase = search), links and interactions
are orders and their lines. Every tenth customer was never mapped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions import timeutil as tu
from dayledger.functions.keys import event_key, key_text
from dayledger.operators import staging as S
from dayledger.plans import bindings as B
from dayledger.plans.dims import cohort_ids
from dayledger.sources.tables import dealt, read_table

APP_OFFSET = 700_000


def mapper_source(spark: SparkSession, sf: str) -> DataFrame:
    """The external mapper as it lands: app number, kind of mapping, user."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_mktsegment"])
    return c.where(F.col("c_custkey") % 10 != 0).select(
        (F.col("c_custkey") + APP_OFFSET).alias("app_user_no"), F.lit("USER").alias("map_kind"), F.col("c_custkey").alias("mapped_user"),
        F.col("c_mktsegment").alias("site_code"))


def mapper(spark: SparkSession, sf: str) -> DataFrame:
    """STG-11: the mapper of the cohort's users."""
    m = mapper_source(spark, sf)
    return m.join(cohort_ids(spark, sf).select(F.col("user_id").alias("mapped_user")), "mapped_user", "left_semi").select(*m.columns)


def translated(log: DataFrame, spark: SparkSession, sf: str, number: str = "app_user_no") -> DataFrame:
    """The log with ``user_id`` (NULL where the mapper doesn't know the number)."""
    return S.translate_key(log, mapper_source(spark, sf), [(number, "app_user_no")], {"mapped_user": "user_id"}, F.col("map_kind") == "USER")


def _event_log(spark: SparkSession, sf: str, kind: str, *columns: Column) -> DataFrame:
    e = B.events(spark, sf).where(F.col("event_type") == kind)
    return e.select((F.col("user_id") + APP_OFFSET).alias("app_user_no"), *columns)


def action_log(spark: SparkSession, sf: str) -> DataFrame:
    """STG-10: app actions with their action number and local date."""
    log = _event_log(spark, sf, "click", F.col("event_id").alias("action_log_no"), (F.col("event_id") % 12).alias("action_no"),
                     F.col("ts").alias("action_at"), F.col("event_date").alias("action_date"))
    return translated(log, spark, sf).drop("app_user_no")


def search_log(spark: SparkSession, sf: str) -> DataFrame:
    """STG-12: searches with local date; the text that was searched for stays behind."""
    log = _event_log(spark, sf, "purchase", F.col("event_id").alias("search_no"), F.col("ts").alias("search_at"), F.col("event_date").alias("search_date"))
    return translated(log, spark, sf).drop("app_user_no")


def login_log(spark: SparkSession, sf: str) -> DataFrame:
    """STG-16: logins, a log without a key of its own: equal rows stay apart."""
    log = _event_log(spark, sf, "view", F.col("ts").alias("login_at"), F.col("event_date").alias("login_date"))
    return translated(log, spark, sf).drop("app_user_no")


def share_links(spark: SparkSession, sf: str) -> DataFrame:
    """STG-13: share links with local date; the maker is translated."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate"])
    log = o.select((F.col("o_custkey") + APP_OFFSET).alias("app_user_no"), F.col("o_orderkey").alias("share_no"), F.col("o_orderpriority").alias("share_type"),
                   F.col("o_orderdate").alias("share_created_at"), tu.local_date("o_orderdate").alias("share_created_date"))
    return translated(log, spark, sf).drop("app_user_no")


def share_log(spark: SparkSession, sf: str) -> DataFrame:
    """STG-14: interactions with links; the actor is the number the row came from
    (``from_user_no``), the receiver stays a number."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate"])
    log = li.select((F.col("l_suppkey") + APP_OFFSET).alias("from_user_no"), F.col("l_orderkey").alias("share_no"), F.col("l_linenumber").alias("share_log_no"),
                    (F.col("l_partkey") + APP_OFFSET).alias("to_user_no"), F.col("l_shipdate").alias("interaction_at"), tu.local_date("l_shipdate").alias("interaction_date"))
    return translated(log, spark, sf, "from_user_no").drop("from_user_no")


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    """STG-15: app accounts with their registration date."""
    a = B.accounts(spark, sf)
    log = a.select((F.col("user_id") + APP_OFFSET).alias("app_user_no"), "app_registered_date", F.col("segment").alias("account_kind"))
    return translated(log, spark, sf)


def personal_info(spark: SparkSession, sf: str, as_of: int = 2024) -> DataFrame:
    """STG-17: the birth year by the century rule; the birth text stays behind."""
    a = B.accounts(spark, sf)
    log = a.select((F.col("user_id") + APP_OFFSET).alias("app_user_no"), tu.birth_year_from_yymmdd("birth_text", as_of).alias("birth_year"))
    return translated(log, spark, sf).drop("app_user_no")


def current_sites(spark: SparkSession, sf: str, kinds=("BUILDING", "MACHINERY")) -> DataFrame:
    """STG-18: users linked to an allowed kind of site by a link that is still open
    (PRJ-05). Links close for customers with a debt."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal"])
    closed = F.when(F.col("c_acctbal") < 0, F.lit("2024-01-01").cast("date"))
    link = c.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("site_key"), F.col("c_mktsegment").alias("link_kind"), closed.alias("unlinked_on"))
    return link.where(S.open_interval("link_kind", kinds, "unlinked_on")).select("user_id", "site_key", "link_kind")


def search_event(spark: SparkSession, sf: str) -> DataFrame:
    """FCT-03: searches of cohort users, with a key of user, number and time."""
    s = search_log(spark, sf).join(cohort_ids(spark, sf), "user_id", "left_semi")
    key = event_key(F.col("user_id").cast("string"), F.col("search_no").cast("string"), key_text("search_at", s.schema["search_at"].dataType))
    return s.select(key.alias("search_event_key"), "search_no", "user_id", "search_at", "search_date")


# ---- observations ---------------------------------------------------------------

ACTIVITY = ["user_lifelog_sn", "started_at", "ended_at", "activity_code", "kcal", "distance"]
SPO2 = ["user_lifelog_sn", "measured_at", "spo2_value"]
SLEEP = ["user_lifelog_sn", "sleep_sn", "started_at", "ended_at"]
STAGE = ["sleep_sn", "stage_code", "started_at", "ended_at"]


def activity_source(spark: SparkSession, sf: str) -> DataFrame:
    """Activity intervals (binding: an order line is ten minutes a unit from the
    start of its ship month, kcal and distance in coarse steps, so that lines repeat)."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_shipdate", "l_quantity", "l_returnflag"])
    start = F.date_trunc("month", "l_shipdate").cast("timestamp_ntz")
    steps = F.floor(F.col("l_quantity") / 10).cast("int")
    return li.select(F.col("l_orderkey").alias("user_lifelog_sn"), start.alias("started_at"),
                     (start + F.make_dt_interval(mins=steps * 100)).alias("ended_at"), F.col("l_returnflag").alias("activity_code"),
                     (steps * 40).cast("decimal(18,2)").alias("kcal"), (steps * 1.5).cast("decimal(18,2)").alias("distance"))


def spo2_source(spark: SparkSession, sf: str) -> DataFrame:
    """Oxygen samples (binding: sign-ups by the hour, value 90 to 99)."""
    e = B.events(spark, sf).where(F.col("event_type") == "signup")
    return e.select(F.col("user_id").alias("user_lifelog_sn"), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("measured_at"),
                    (90 + F.col("event_id") % 3).cast("decimal(18,2)").alias("spo2_value"))


def sleep_source(spark: SparkSession, sf: str) -> DataFrame:
    """Sleep sessions (binding: an order, eight hours from its date on)."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    start = F.col("o_orderdate") + F.expr("INTERVAL 14 HOURS")
    return o.select(F.col("o_orderkey").alias("user_lifelog_sn"), F.col("o_orderkey").alias("sleep_sn"), start.alias("started_at"),
                    (start + F.expr("INTERVAL 8 HOURS")).alias("ended_at"))


def stage_source(spark: SparkSession, sf: str) -> DataFrame:
    """Sleep stages (binding: an order line; the stage is its mode of return, half
    an hour from its line number on; lines repeat)."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    start = F.col("o_orderdate") + F.make_dt_interval(hours=F.lit(14), mins=F.col("l_linenumber").cast("int") * 30)
    li, o = dealt(spark, sf, "lineitem", (li, "l_orderkey"), (o, "o_orderkey"))
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(F.col("l_orderkey").alias("sleep_sn"), F.col("l_returnflag").alias("stage_code"), start.alias("started_at"),
                    (start + F.expr("INTERVAL 30 MINUTES")).alias("ended_at"))


def observations(raw: DataFrame, payload: list[str], needed: str) -> DataFrame:
    """STG-04..07: distinct payloads with their number and a key over the payload;
    rows without the needed time are left out."""
    return S.collapse_duplicates(raw.where(F.col(needed).isNotNull()), payload, key_col="source_observation_id")


def _owners(spark: SparkSession, sf: str) -> DataFrame:
    """Serials of cohort users; the parent is guarded before anything meets it."""
    parent = B.lifelog_parent(spark, sf).where(F.col("user_id").isNotNull()).select("user_lifelog_sn", "user_id")
    return parent.join(cohort_ids(spark, sf), "user_id", "left_semi")


def activity_fact(spark: SparkSession, sf: str) -> DataFrame:
    """DTL-01: activities of cohort users with payload, duration and local date."""
    rows = observations(activity_source(spark, sf), ACTIVITY, "started_at").join(_owners(spark, sf), "user_lifelog_sn")
    return rows.select("source_observation_id", "user_id", "user_lifelog_sn", "started_at", "ended_at", tu.local_date("started_at").alias("ymd_date"),
                       "activity_code", "kcal", "distance", tu.epoch_seconds("ended_at", "started_at").alias("duration_seconds"), "source_row_count")


def spo2_fact(spark: SparkSession, sf: str) -> DataFrame:
    """DTL-03: oxygen samples of cohort users at source grain."""
    rows = observations(spo2_source(spark, sf), SPO2, "measured_at")
    users = cohort_ids(spark, sf).select(F.col("user_id").alias("user_lifelog_sn"))
    return rows.join(users, "user_lifelog_sn", "left_semi").select(
        "source_observation_id", F.col("user_lifelog_sn").alias("user_id"), "measured_at", tu.local_date("measured_at").alias("ymd_date"), "spo2_value", "source_row_count")
