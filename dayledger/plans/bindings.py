"""Stand-in inputs: the driver's tables reshaped into the source shapes the
models read. These functions only rename, project and attribute columns;
every model step (dedupe, attribution, guards, aggregation, panels, states)
runs in the model modules on whatever rows arrive here.

Binding (fixed for this repository, see README):

=====================  ==================================================
model input            driver table
=====================  ==================================================
app event channels     ``events`` (one channel per ``event_type``)
cohort population      customers with an enrolment event (``signup``);
                       joined date = local date of the first one
app account            ``customer`` (segment, balance, nation as site; birth,
                       registration and body measures by rule from its key)
deployment site        ``nation`` + ``region``
coaching deliveries    ``orders`` (priority = domain, status F = done,
                       completion time = last ship date of the order)
lifelog parent         ``orders`` (order key = lifelog serial, customer)
discrete readings      ``lineitem`` (quantity / price / discount / tax)
score history          ``lineitem`` x ``orders``: part = item, quantity
                       and discount as 1-100 scores
item catalogue         ``part``
JSON payloads          ``events.props``
=====================  ==================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions.timeutil import local_date
from dayledger.sources.tables import dealt, read_table

ENROLMENT_EVENT = "signup"


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Raw app events with the local event date. The files are listed anew at
    every call (a frame's listing is fixed when it is made), so a later build in
    one session sees files that arrived meanwhile; identical subtrees of one
    plan still share their exchanges, since Spark compares them by path."""
    e = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    return e.withColumn("event_date", local_date("ts"))


def cohort_source(spark: SparkSession, sf: str) -> DataFrame:
    """Cohort population (user_master shape): one row per enrolled user."""
    e = events(spark, sf)
    return (e.where(F.col("event_type") == ENROLMENT_EVENT)
            .groupBy("user_id").agg(F.min("event_date").alias("joined_date")))


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    """App account / CRM attributes.

    The driver has no birth dates, registrations or body measures; the binding
    makes them up from the customer number by fixed rules, so that ages, bands and
    body-mass figures have values: birth as 'YYMMDD' text (every tenth unknown),
    registration (every third customer), weight (0 = never measured) and height."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal"])
    n = F.col("c_custkey").cast("bigint")
    birth = F.when(n % 10 == 0, "unknown").otherwise(F.concat((30 + (n * 7) % 65).cast("string"), F.lit("0615")))
    registered = F.when(n % 3 == 0, F.date_add(F.lit("2023-12-01").cast("date"), (n % 60).cast("int")))
    return c.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("site_key"),
                    F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("acctbal"),
                    birth.alias("birth_text"), registered.alias("app_registered_date"),
                    F.when(n % 17 == 0, 0).otherwise(45 + (n * 13) % 60).cast("double").alias("weight_kg"),
                    (150 + (n * 11) % 40).cast("double").alias("height_cm"))


def sites(spark: SparkSession, sf: str) -> DataFrame:
    """Deployment sites: nation with its region."""
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf, "region", ["r_regionkey", "r_name"])
    return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
            .select(F.col("n_nationkey").alias("site_key"), F.col("n_name").alias("site_name"),
                    F.col("r_name").alias("region_name")))


def deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Coaching deliveries: one row per order."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus",
                                         "o_orderdate", "o_orderpriority"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_shipdate"])
    o, li = dealt(spark, sf, "lineitem", (o, "o_orderkey"), (li, "l_orderkey"))
    last_ship = li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    j = o.join(last_ship, o.o_orderkey == last_ship.l_orderkey, "left")
    return j.select(
        F.col("o_orderkey").alias("activity_row_id"), F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("ymd_date"), F.col("o_orderpriority").alias("domain"),
        F.col("o_orderdate").alias("delivered_at"),
        F.when(F.col("o_orderstatus") == "F", F.col("last_ship")).alias("completed_at"))


def lifelog_parent(spark: SparkSession, sf: str) -> DataFrame:
    """Lifelog parent: the only place the user id appears."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    return o.select(F.col("o_orderkey").alias("user_lifelog_sn"), F.col("o_custkey").alias("user_id"),
                    F.col("o_orderpriority").alias("measure_device_type"))


def readings_source(spark: SparkSession, sf: str) -> DataFrame:
    """Wide discrete readings (several metrics per row, no key)."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate",
                                            "l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return li.select(F.col("l_orderkey").alias("user_lifelog_sn"),
                     F.col("l_linenumber").alias("slot"), F.col("l_shipdate").alias("measured_dt"),
                     F.col("l_quantity").alias("quantity"),
                     F.col("l_extendedprice").alias("extended_price"),
                     F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))


def scores_source(spark: SparkSession, sf: str) -> DataFrame:
    """Score history: (user, day, item, scores 1-100 or NULL)."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_shipdate",
                                            "l_quantity", "l_discount"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    li, o = dealt(spark, sf, "lineitem", (li, "l_orderkey"), (o, "o_orderkey"))
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        F.col("o_custkey").alias("user_id"), F.to_date("l_shipdate").alias("ymd_date"),
        F.col("l_partkey").alias("disease_id"),
        (F.col("l_quantity") * 2).cast("int").alias("irs_score"),
        F.nullif(F.round(F.col("l_discount") * 1000).cast("int"), F.lit(0)).alias("irsp_score"))


def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Item catalogue (dim_disease shape)."""
    p = read_table(spark, sf, "part", ["p_partkey", "p_name"])
    return p.select(F.col("p_partkey").alias("disease_id"), F.col("p_name").alias("disease_name"))
