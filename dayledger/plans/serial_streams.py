"""Streams of devices whose user only the parent knows (INT-01/02, DTL-02 with a
real parent).

Samples carry a device serial. They are collapsed and aggregated by (serial, day,
stream) while they know nothing else: partial counts take a serial with a third of
all samples apart before the shuffle, and what meets the parent is one row a
serial, day and stream. The join with the parent then moves few rows, and a
second aggregate puts a user's devices together. Serials without a parent are
left out here and found by the check of attribution (DQ-28).

Binding: an event's device is serial = 4 * user + event number mod 4; customers
have the devices 0 to 2, so every fourth event comes from a serial that no parent
knows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions import timeutil as tu
from dayledger.operators import staging as S
from dayledger.plans import bindings as B
from dayledger.plans import wearable as W
from dayledger.plans.dims import cohort_ids
from dayledger.sources.tables import read_table

DEVICES = 4
SUM_TYPE = "decimal(38,6)"


def samples(spark: SparkSession, sf: str) -> DataFrame:
    """Raw device samples: serial, event time, stream, value."""
    serial = F.col("user_id") * DEVICES + F.col("event_id") % DEVICES
    return B.events(spark, sf).select(
        serial.cast("bigint").alias("user_lifelog_sn"), F.col("ts").alias("measured_at"), F.col("event_type").alias("type_code"),
        F.col("value").cast(W.VALUE_TYPE).alias("sample_value"))


def parents(spark: SparkSession, sf: str) -> DataFrame:
    """The lifelog's parent: one row a serial, the only place that knows the user."""
    c = read_table(spark, sf, "customer", ["c_custkey"])
    device = F.explode(F.sequence(F.lit(0), F.lit(DEVICES - 2)))
    return c.select(F.col("c_custkey").alias("user_id"), device.alias("device")).select(
        (F.col("user_id") * DEVICES + F.col("device")).cast("bigint").alias("user_lifelog_sn"), "user_id")


def collapsed(raw: DataFrame) -> DataFrame:
    """INT-01 on serials: distinct payloads with their number."""
    return W.collapse_samples(raw)


def serial_days(collapsed_samples: DataFrame) -> DataFrame:
    """Sums that add up further: a row a (serial, local day, stream)."""
    v, n = F.col("sample_value").cast(SUM_TYPE), F.col("source_row_count")
    return collapsed_samples.groupBy("user_lifelog_sn", tu.local_date("measured_at").alias("wear_date"), F.col("type_code").alias("stream_code")).agg(
        F.sum(n).alias("n_samples"), F.sum(F.when(v.isNotNull(), n)).alias("n_values"), F.sum((v * n).cast(SUM_TYPE)).alias("value_sum"),
        F.min(v).alias("value_min"), F.max(v).alias("value_max"))


def user_days(days: DataFrame, parent: DataFrame) -> DataFrame:
    """INT-02: the serials' days given to their users; NULL measures where no
    sample of the day has a value."""
    known = parent.where(F.col("user_id").isNotNull()).select("user_lifelog_sn", "user_id")
    total = F.sum("value_sum")
    return (days.join(known, "user_lifelog_sn").groupBy("user_id", "wear_date", "stream_code")
            .agg(F.sum("n_samples").alias("n_samples"), total.cast(SUM_TYPE).alias("value_sum"),
                 (total / F.nullif(F.sum("n_values"), F.lit(0))).cast(f"decimal(38,{W.MEAN_SCALE})").alias("value_mean"),
                 F.min("value_min").alias("value_min"), F.max("value_max").alias("value_max"), F.countDistinct("user_lifelog_sn").alias("n_devices")))


def wearable_day(spark: SparkSession, sf: str) -> DataFrame:
    """INT-02 through a real parent, all streams."""
    return user_days(serial_days(collapsed(samples(spark, sf))), parents(spark, sf))


def detail_fact(spark: SparkSession, sf: str) -> DataFrame:
    """DTL-02 through a real parent: source-grain rows of cohort users. The parent
    is guarded first, so the samples meet only serials of the cohort."""
    known = parents(spark, sf).join(cohort_ids(spark, sf), "user_id", "left_semi")
    rows = collapsed(samples(spark, sf)).join(known, "user_lifelog_sn")
    return rows.select("source_observation_id", "user_lifelog_sn", "user_id", "measured_at", tu.local_date("measured_at").alias("ymd_date"),
                       "type_code", F.col("sample_value").cast("double").alias("sample_value"), "source_row_count")


def without_parent(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-28 by serial: serials that no parent knows, with their samples."""
    known = parents(spark, sf).select("user_lifelog_sn")
    counted = samples(spark, sf).where(F.col("user_lifelog_sn").isNotNull()).groupBy("user_lifelog_sn").agg(F.count(F.lit(1)).alias("n_samples"))
    return counted.join(known, "user_lifelog_sn", "left_anti")


# ---- shared links: a child table bound to its parent --------------------------

def share_interactions(spark: SparkSession, sf: str) -> DataFrame:
    """FCT-05: interactions with shared links whose actor is in the cohort, one row
    a source row. A neutral downstream event: it proves nothing about the sender.

    Binding: an interaction is an order line, its link the order. The source names
    the actor itself: the link's owner, but for returned lines the supplier's number."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_shipdate"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    actor = F.when(F.col("l_returnflag") == "R", F.col("l_suppkey")).otherwise(F.col("o_custkey")).cast("bigint")
    rows = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("share_no"), F.col("l_linenumber").alias("share_log_no"), actor.alias("user_id"),
        F.col("l_shipdate").alias("interaction_at"), tu.local_date("l_shipdate").alias("interaction_date"))
    return rows.join(cohort_ids(spark, sf), "user_id", "left_semi")


def actor_mismatches(interactions: DataFrame, links: DataFrame) -> DataFrame:
    """DQ-22: interactions whose actor differs from their link's, NULL told apart."""
    owners = links.select("share_no", F.col("user_id").alias("link_actor_user_id"))
    found = interactions.join(owners, "share_no").where(~F.col("user_id").eqNullSafe(F.col("link_actor_user_id")))
    return found.select("share_log_no", "share_no", F.col("user_id").alias("interaction_actor_user_id"), "link_actor_user_id")


# ---- nested payloads -----------------------------------------------------------

SIGNATURE_TYPES = ("disease", "lifestyle", "potential", "segment")


def analysis_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads of the integrated analysis (binding: built from the events' own
    columns). Every twentieth is an error without fields, every seventh has no segment,
    all others name a user, which must stay behind."""
    e = B.events(spark, sf)
    two = lambda t, code: F.struct(F.concat(F.lit(t[0].upper()), code.cast("string")).alias("code"), F.concat(F.lit(f"{t} "), code.cast("string")).alias("label"))
    n = F.col("event_id")
    types = [two(t, n % (i + 3)).alias(f"{t}Type") for i, t in enumerate(SIGNATURE_TYPES[:3])]
    segment = F.when(n % 7 != 0, two("segment", n % 6)).alias("segmentType")  # to_json leaves a NULL field out
    good = F.to_json(F.struct(
        F.struct(F.col("event_type").alias("kind"), F.round("value", 2).alias("level")).alias("risk_overview"),
        F.struct(F.concat(F.lit("signature of "), "event_type").alias("description"), *types, segment).alias("user_signature_type"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("user_name")))
    payload = F.when(n % 20 == 0, F.to_json(F.struct(F.lit("no answer").alias("error"), n.alias("event")))).otherwise(good)
    return e.select("user_id", "event_date", "ts", n, payload.alias("payload"))


def analysis_day(payloads: DataFrame) -> DataFrame:
    """STG-22/23: error payloads go, the day's last row wins, and the allow-listed
    fields leave the payload, which is parsed once a row as a VARIANT and not once
    a path; everything else stays behind by omission."""
    paths = {"risk_kind": "$.risk_overview.kind", "signature_description": "$.user_signature_type.description"}
    for t in SIGNATURE_TYPES:
        for f in ("code", "label"):
            paths[f"signature_{t}_type_{f}"] = f"$.user_signature_type.{t}Type.{f}"
    last = S.last_row_wins(S.drop_error_payloads(payloads, "payload"), ["user_id", "event_date"], "ts", ["event_id"])
    return S.flatten_variant(last, "payload", paths, ["user_id", F.col("event_date").alias("ymd_date"), "event_id"])
