"""Facts (FCT-01..FCT-10, FCT-13) and the discrete-reading staging (STG-02).

Every fact carries the cohort guard: an inner join to the user dimension.
The dimension is one row per user; Spark's own size check (AQE) broadcasts it
while it is small and falls back to a shuffled join beyond the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions import timeutil as tu
from dayledger.functions.keys import event_key, key_text
from dayledger.operators import staging as S
from dayledger.operators.setops import union_all
from dayledger.plans import bindings as B
from dayledger.plans.dims import cohort_ids as _cohort_keys
from dayledger.plans.dims import dim_user

CHANNEL_EVENT_TYPES = ("view", "click", "purchase", "error", "signup")


def cohort_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _cohort_keys(spark, sf)


def guarded_events(spark: SparkSession, sf: str) -> DataFrame:
    """All app events of cohort users (one scan, one guard join). Channel facts
    are filters on this frame, so any number of channels costs one scan."""
    e = B.events(spark, sf)
    return e.join(cohort_ids(spark, sf), "user_id", "inner")


def app_event_fact(spark: SparkSession, sf: str, event_type: str,
                   guarded: DataFrame | None = None) -> DataFrame:
    """FCT-01/02: one app channel: cohort guard, local date, md5 event key over
    (user, event time) — NULL parts skipped, the time formatted explicitly."""
    g = guarded if guarded is not None else guarded_events(spark, sf)
    f = g.where(F.col("event_type") == event_type)
    return f.select(
        event_key(F.col("user_id").cast("string"), key_text("ts", f.schema["ts"].dataType)
                  ).alias("event_key"),
        "event_id", "user_id", F.col("ts").alias("event_at"),
        F.col("event_date"), "value")


def coaching_event(spark: SparkSession, sf: str) -> DataFrame:
    """FCT-06: delivery facts; non-completions and withdrawn deliveries stay.
    ``is_completed`` and the response latency in minutes (numeric(12,2))."""
    d = B.deliveries(spark, sf).join(cohort_ids(spark, sf), "user_id", "inner")
    latency = F.when(F.col("completed_at").isNotNull() & F.col("delivered_at").isNotNull(),
                     (tu.epoch_seconds("completed_at", "delivered_at") / 60).cast("decimal(12,2)"))
    return d.select("activity_row_id", "user_id", "ymd_date", "domain", "delivered_at",
                    "completed_at", F.col("completed_at").isNotNull().alias("is_completed"),
                    latency.alias("response_latency_minutes"))


def staged_readings(spark: SparkSession, sf: str, source: DataFrame | None = None) -> DataFrame:
    """STG-02: tall readings from the wide source.

    * amounts stream (quantity, extended price): the source repeats a
      (serial, slot) with different values and no ordering column, so one row
      per slot is picked deterministically by value
      (``DISTINCT ON ... ORDER BY v DESC NULLS LAST``);
    * rates stream (discount, tax): unpivot, then exact ``DISTINCT`` of the tall
      rows, so two source rows that differ only in the tax give one discount.
    NULL readings are dropped after the unpivot.

    The streams are deliberately *not* co-partitioned by the serial (which
    would save shuffles): a serial holding a third of all samples would then
    land in one task. Keyed on (serial, slot) and (serial, time), a hot serial
    spreads out. ``source``: wide rows to stage instead of all of them.
    """
    src = B.readings_source(spark, sf) if source is None else source
    return union_all([_tall_amounts(_amounts(src)), _tall_rates(_rates(src))])


#: The rates in the order of their numbers before the unpivoted form gets its names.
RATES = ("discount", "tax")


def _amounts(src: DataFrame) -> DataFrame:
    """One wide row a (serial, slot)."""
    order = [F.col(c).desc_nulls_last() for c in
             ("quantity", "extended_price", "measured_dt", "discount", "tax")]
    return S.distinct_on(src.select("user_lifelog_sn", "slot", "measured_dt", "quantity",
                                    "extended_price", "discount", "tax"),
                         ["user_lifelog_sn", "slot"], order)


def _rates(src: DataFrame) -> DataFrame:
    """The different (serial, time, rate number, value): the wide rows move once,
    by serial and time, and are unpivoted where they arrive; names come later."""
    moved = src.select("user_lifelog_sn", "measured_dt", *RATES).repartition("user_lifelog_sn", "measured_dt")
    cells = F.array(*[F.struct(F.lit(i).cast("tinyint").alias("rate"), F.col(c).cast("double").alias("metric_value")) for i, c in enumerate(RATES)])
    return (moved.select("user_lifelog_sn", "measured_dt", F.inline(cells))
            .where(F.col("metric_value").isNotNull()).distinct())


def _tall_amounts(amounts: DataFrame, *more: str) -> DataFrame:
    return S.unpivot_readings(
        amounts, [F.lit("amounts").alias("source_stream"), "user_lifelog_sn", F.col("measured_dt").alias("measured_at"), *more],
        [("quantity", "quantity", "units"), ("extended_price", "extended_price", "usd")])


def _tall_rates(rates: DataFrame, *more: str) -> DataFrame:
    name = F.element_at(F.array(*map(F.lit, RATES)), F.col("rate") + 1)
    return rates.select(F.lit("rates").alias("source_stream"), "user_lifelog_sn", F.col("measured_dt").alias("measured_at"), *more,
                        name.alias("metric_code"), "metric_value", F.lit("ratio").alias("metric_unit"))


def staged_reading_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The number of staged readings (STG-02) by serial and time, from the narrow
    forms: several rows may hold one (serial, time)."""
    src = B.readings_source(spark, sf)
    both = F.col("quantity").isNotNull().cast("int") + F.col("extended_price").isNotNull().cast("int")
    amounts = _amounts(src).select("user_lifelog_sn", F.col("measured_dt").alias("measured_at"), both.alias("n_readings"))
    rates = _rates(src).select("user_lifelog_sn", F.col("measured_dt").alias("measured_at"), F.lit(1).alias("n_readings"))
    return union_all([amounts.where("n_readings > 0"), rates])


def measurement_fact(spark: SparkSession, sf: str) -> DataFrame:
    """FCT-08: readings attributed to users through the lifelog parent, with
    device type; cohort guard; repeated slots are *not* collapsed here."""
    # Guard the (smaller) parent first. Both streams are picked within a serial, so
    # the raw rows of other serials can go before; what is left meets its parent in
    # the narrow forms, ahead of the unpivot and the names.
    parent = (B.lifelog_parent(spark, sf).where(F.col("user_id").isNotNull())
              .join(cohort_ids(spark, sf), "user_id", "left_semi"))
    src = B.readings_source(spark, sf).join(parent.select("user_lifelog_sn"), "user_lifelog_sn", "left_semi")
    own = ("user_id", "measure_device_type")
    guarded = union_all([_tall_amounts(_amounts(src).join(parent, "user_lifelog_sn"), *own),
                         _tall_rates(_rates(src).join(parent, "user_lifelog_sn"), *own)])
    return guarded.select("source_stream", "user_lifelog_sn", "user_id", "measured_at",
                          tu.local_date("measured_at").alias("measured_date"),
                          "metric_code", "metric_value", "metric_unit", "measure_device_type")


def user_disease_day(spark: SparkSession, sf: str) -> DataFrame:
    """FCT-09: user x day x item scores, in-catalogue flag, age at activity."""
    users = dim_user(spark, sf).select("user_id", "birth_year")
    cat = B.catalogue(spark, sf).select("disease_id").withColumn("__in", F.lit(True))
    s = B.scores_source(spark, sf).join(users, "user_id", "inner").join(cat, "disease_id", "left")
    return s.select("user_id", "ymd_date", "disease_id",
                    F.coalesce(F.col("__in"), F.lit(False)).alias("is_in_catalog"),
                    "irs_score", "irsp_score",
                    tu.age_years("ymd_date", "birth_year").alias("age_at_activity"),
                    tu.age_band("ymd_date", "birth_year").alias("age_band_5y"))


#: Where milestones come from, in the order that settles ties, and what they know.
MILESTONE_SOURCES = {"dim_user": "DATE", "app_event": "TIMESTAMP", "coaching_event": "TIMESTAMP"}


def milestones(spark: SparkSession, sf: str) -> DataFrame:
    """FCT-13: first real occurrence per user x milestone code, all columns of one
    row: the first date, on it the first time (none before any), then the source.

    Enrolment has only a DATE (occurred_at NULL, precision DATE); every other
    milestone carries its source timestamp. Nothing is fabricated for a missing
    stage."""
    users = dim_user(spark, sf)
    cands = [users.select("user_id", F.lit("cohort_enrolled").alias("milestone_code"),
                          F.col("joined_date").alias("occurred_date"),
                          F.lit(None).cast("timestamp_ntz").alias("occurred_at"),
                          F.lit("dim_user").alias("source_relation"))]
    # All event-type milestones come from one read of the events (one branch,
    # the code derived from the type), not one scan per type.
    e = B.events(spark, sf).where(F.col("event_type").isin(list(CHANNEL_EVENT_TYPES)))
    cands.append(e.select(
        "user_id", F.concat(F.lit("first_"), F.col("event_type")).alias("milestone_code"),
        F.col("event_date").alias("occurred_date"), F.col("ts").alias("occurred_at"),
        F.lit("app_event").alias("source_relation")))
    d = B.deliveries(spark, sf)
    cands.append(d.select("user_id", F.lit("first_delivery").alias("milestone_code"),
                          F.col("ymd_date").alias("occurred_date"),
                          F.col("delivered_at").alias("occurred_at"),
                          F.lit("coaching_event").alias("source_relation")))
    first = first_milestones(union_all(cands))
    return first.join(cohort_ids(spark, sf), "user_id", "left_semi")


def first_milestones(candidates: DataFrame) -> DataFrame:
    """The first of the candidates (user_id, milestone_code, occurred_date,
    occurred_at, source_relation) with the precision that its source has."""
    real = candidates.where(F.col("user_id").isNotNull())
    first = S.first_row_in_time(real, ["user_id", "milestone_code"], "occurred_date", "occurred_at",
                                "source_relation", list(MILESTONE_SOURCES))
    precision = F.create_map(*[F.lit(x) for pair in MILESTONE_SOURCES.items() for x in pair])
    return first.withColumn("temporal_precision", precision[F.col("source_relation")])
