"""Sampling streams: the once-only payload dedupe (INT-01), the per-day
stream aggregate (INT-02), detail facts (DTL-*) and the sparse daily pivot
(FCT-11).

Scale design: the raw stream is the largest table (millions of samples per
day at full scale). It is collapsed exactly once (``groupBy(payload)`` with
map-side partial counts, so a heavy user or a repeated payload ships one
partial row per map task); the daily aggregate then reads the collapsed form
and weights by multiplicity, and the pivot is a single hash aggregate with
``FILTER`` — no self-joins. Values are summed as decimals and cast to double
only at the edge.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions import timeutil as tu
from dayledger.operators import sinks as K
from dayledger.operators import staging as S
from dayledger.operators.setops import union_all
from dayledger.plans import bindings as B
from dayledger.plans.dims import cohort_ids
from dayledger.sources.tables import dealt

VALUE_TYPE = "decimal(18,2)"
MEAN_SCALE = 6

# Binding: which event type plays which stream role (see bindings module).
WEIGHTED_STREAM = "error"
SESSION_STREAM = "delivery"   # intervals: order time -> last shipment


@dataclass(frozen=True)
class StreamSpec:
    """One stream of the daily aggregate (the reference templates five)."""

    code: str
    value: bool = False      # value_sum / mean / min / max
    kcal: bool = False       # kcal_sum from the value column
    weighted: bool = False   # read the collapsed form, weight by multiplicity
    duration: bool = False   # an interval stream: duration_hours, dated from its start


STREAMS: tuple[StreamSpec, ...] = (
    StreamSpec("click", value=True),
    StreamSpec("view", value=True),
    StreamSpec("purchase", kcal=True),
    StreamSpec("signup"),
    StreamSpec(WEIGHTED_STREAM, value=True, weighted=True),
    StreamSpec(SESSION_STREAM, duration=True),
)

PAYLOAD = ["user_lifelog_sn", "measured_at", "type_code", "sample_value"]


def _time_bounds(e: DataFrame, before, since) -> DataFrame:
    if before is not None:
        e = e.where(F.col("ts") < F.lit(str(before)).cast("timestamp_ntz"))
    if since is not None:
        e = e.where(F.col("ts") >= F.lit(str(since)).cast("timestamp_ntz"))
    return e


def raw_samples(spark: SparkSession, sf: str, code: str, before: str | None = None,
                since: str | None = None) -> DataFrame:
    """Raw samples of one stream (stand-in: events of one type); ``before``
    replays the source as it stood at an earlier time (arrivals up to it);
    ``since`` is a lower event-time bound pushed into the scan."""
    e = _time_bounds(B.events(spark, sf).where(F.col("event_type") == code), before, since)
    return e.select(F.col("user_id").alias("user_lifelog_sn"), F.col("ts").alias("measured_at"),
                    F.col("event_type").alias("type_code"),
                    F.col("value").cast(VALUE_TYPE).alias("sample_value"))


def collapse_samples(raw: DataFrame) -> DataFrame:
    """INT-01: distinct payload + multiplicity + surrogate key; NULL event
    time dropped. Only byte-identical payloads collapse: the same slot with a
    different value stays two rows."""
    return S.collapse_duplicates(raw.where(F.col("measured_at").isNotNull()), PAYLOAD,
                                 count_col="source_row_count", key_col="source_observation_id")


def collapsed_stream(spark: SparkSession, sf: str, code: str = WEIGHTED_STREAM,
                     before: str | None = None, since: str | None = None) -> DataFrame:
    return collapse_samples(raw_samples(spark, sf, code, before, since))


def collapsed_incremental(target: DataFrame, raw: DataFrame, days: int = 30) -> DataFrame:
    """INT-01 incremental: recompute only the trailing window of event time and
    window-replace it into the previous snapshot (SNK-05)."""
    fresh = collapse_samples(raw)
    return K.window_replace(target, fresh, "measured_at", days, restrict_batch=True)


def _attributed(samples: DataFrame) -> DataFrame:
    """Samples with their user. The stand-in streams carry the user as their
    serial, so the parent is that serial itself; a sample without one belongs to
    nobody and goes, as it would in the join with the parent."""
    return samples.where(F.col("user_lifelog_sn").isNotNull()).withColumn("user_id", F.col("user_lifelog_sn"))


def stream_parents(spark: SparkSession, sf: str) -> DataFrame:
    """The parents of the stand-in streams: every serial that the events know."""
    return B.events(spark, sf).where(F.col("user_id").isNotNull()).select(F.col("user_id").alias("user_lifelog_sn")).distinct()


def _cohort(spark: SparkSession, sf: str) -> DataFrame:
    return cohort_ids(spark, sf).select(F.col("user_id").alias("user_lifelog_sn"), F.col("user_id"))


def _by_day(spark: SparkSession, sf: str, larger: str, src: DataFrame, *more: str) -> DataFrame:
    """Samples with their local day, dealt by user and day (a heavy user spreads)."""
    return dealt(spark, sf, larger, (src.withColumn("wear_date", tu.local_date("measured_at")), "user_id", "wear_date", *more))[0]


def _stream_day(spark: SparkSession, sf: str, spec: StreamSpec, before: str | None = None,
                since: str | None = None) -> DataFrame:
    if spec.weighted:
        src = collapsed_stream(spark, sf, spec.code, before, since)
        n = F.col("source_row_count")
    else:
        src = raw_samples(spark, sf, spec.code, before, since).where(F.col("measured_at").isNotNull())
        n = F.lit(1)
    src = _by_day(spark, sf, "events", _attributed(src))
    v = F.col("sample_value")
    null_dec = F.lit(None).cast("decimal(38,6)")
    if spec.weighted:
        total = F.sum(v * n)
        aggs = [F.sum(n).cast("bigint").alias("n_samples"),
                total.cast("decimal(38,6)").alias("value_sum"),
                (total / F.nullif(F.sum(n), F.lit(0))).cast(f"decimal(38,{MEAN_SCALE})").alias("value_mean"),
                F.min(v).cast("decimal(38,6)").alias("value_min"),
                F.max(v).cast("decimal(38,6)").alias("value_max")]
    else:
        aggs = [F.count(F.lit(1)).cast("bigint").alias("n_samples")]
        if spec.value:
            aggs += [F.sum(v).cast("decimal(38,6)").alias("value_sum"),
                     F.avg(v).cast(f"decimal(38,{MEAN_SCALE})").alias("value_mean"),
                     F.min(v).cast("decimal(38,6)").alias("value_min"),
                     F.max(v).cast("decimal(38,6)").alias("value_max")]
        else:
            aggs += [null_dec.alias(c) for c in ("value_sum", "value_mean", "value_min", "value_max")]
    kcal = F.sum(v).cast("decimal(38,6)") if spec.kcal else null_dec
    aggs += [kcal.alias("kcal_sum"), null_dec.alias("distance_sum"), null_dec.alias("duration_hours")]
    return (src.groupBy("user_id", "wear_date")
            .agg(*aggs).withColumn("stream_code", F.lit(spec.code)))


def session_samples(spark: SparkSession, sf: str, before: str | None = None,
                    since: str | None = None) -> DataFrame:
    """Interval samples (stand-in: deliveries, start = order time, end = the
    last shipment, NULL while open)."""
    d = B.deliveries(spark, sf).select(
        F.col("user_id").alias("user_lifelog_sn"), F.col("delivered_at").alias("measured_at"),
        F.col("completed_at").alias("ended_at"))
    if before is not None:
        d = d.where(F.col("measured_at") < F.lit(str(before)).cast("timestamp_ntz"))
    if since is not None:
        d = d.where(F.col("measured_at") >= F.lit(str(since)).cast("timestamp_ntz"))
    return d


def _session_stream_day(spark: SparkSession, sf: str, spec: StreamSpec, before: str | None = None,
                        since: str | None = None) -> DataFrame:
    """An interval stream per (user, local day of its *start*): an overnight
    interval counts on the day it began. Duration = end - start in hours
    (open intervals add nothing to the sum)."""
    src = _attributed(session_samples(spark, sf, before, since).where(F.col("measured_at").isNotNull()))
    src = _by_day(spark, sf, "orders", src)
    hours = (tu.epoch_seconds("ended_at", "measured_at") / 3600).cast("decimal(38,6)")
    null_dec = F.lit(None).cast("decimal(38,6)")
    return (src.groupBy("user_id", "wear_date")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_samples"),
                 *[null_dec.alias(c) for c in ("value_sum", "value_mean", "value_min", "value_max",
                                               "kcal_sum", "distance_sum")],
                 F.sum(hours).cast("decimal(38,6)").alias("duration_hours"))
            .withColumn("stream_code", F.lit(spec.code)))


def _plain_streams_day(spark: SparkSession, sf: str, streams: Sequence[StreamSpec],
                      before: str | None = None, since: str | None = None) -> DataFrame:
    """All unweighted streams in one scan and one aggregate keyed by
    (user, day, stream); per-stream measures are conditional aggregates, so a
    stream without a value column yields NULL measures, never 0."""
    codes = [s.code for s in streams]
    value_codes = [s.code for s in streams if s.value]
    kcal_codes = [s.code for s in streams if s.kcal]
    e = _time_bounds(B.events(spark, sf).where(F.col("event_type").isin(codes)), before, since)
    src = (e.where(F.col("ts").isNotNull())
           .select(F.col("user_id").alias("user_lifelog_sn"), F.col("ts").alias("measured_at"),
                   F.col("event_type").alias("stream_code"),
                   F.col("value").cast(VALUE_TYPE).alias("sample_value")))
    src = _by_day(spark, sf, "events", _attributed(src), "stream_code")
    v = F.col("sample_value")
    val = F.when(F.col("stream_code").isin(value_codes), v)
    kc = F.when(F.col("stream_code").isin(kcal_codes), v)
    return (src.groupBy("user_id", "wear_date", "stream_code")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_samples"),
                 F.sum(val).cast("decimal(38,6)").alias("value_sum"),
                 F.avg(val).cast(f"decimal(38,{MEAN_SCALE})").alias("value_mean"),
                 F.min(val).cast("decimal(38,6)").alias("value_min"),
                 F.max(val).cast("decimal(38,6)").alias("value_max"),
                 F.sum(kc).cast("decimal(38,6)").alias("kcal_sum"),
                 F.lit(None).cast("decimal(38,6)").alias("distance_sum"),
                 F.lit(None).cast("decimal(38,6)").alias("duration_hours")))


def wearable_day(spark: SparkSession, sf: str, streams: Sequence[StreamSpec] = STREAMS,
                 before: str | None = None, since: str | None = None) -> DataFrame:
    """INT-02: (user, local day, stream) -> n, sum, mean, min, max, kcal,
    distance, duration hours (NULL where the stream has no such measure).

    All attributed users, whether in the cohort or not: who enrols later finds
    their older days here, and the guard stands in FCT-11.
    Templated over the stream spec list: the raw streams share one scan and one
    aggregate; the weighted stream reads the collapsed form (INT-01); interval
    streams are dated from their start."""
    cols = ["user_id", "wear_date", "stream_code", "n_samples", "value_sum", "value_mean",
            "value_min", "value_max", "kcal_sum", "distance_sum", "duration_hours"]
    plain = [s for s in streams if not s.weighted and not s.duration]
    parts = [_stream_day(spark, sf, s, before, since).select(*cols) for s in streams if s.weighted]
    parts += [_session_stream_day(spark, sf, s, before, since).select(*cols)
              for s in streams if s.duration]
    if plain:
        parts.insert(0, _plain_streams_day(spark, sf, plain, before, since).select(*cols))
    return union_all(parts)


def wearable_day_incremental(target: DataFrame, fresh: DataFrame, days: int = 30) -> DataFrame:
    """INT-02 incremental: window-replace the trailing ``days`` of wear dates."""
    return K.window_replace(target, fresh, "wear_date", days, restrict_batch=True)


def _as_double(c: Column) -> Column:
    return c.cast("double")


def wearable_pivot(day: DataFrame, users: DataFrame, streams: Sequence[StreamSpec] = STREAMS) -> DataFrame:
    """FCT-11: sparse daily pivot, one row per (user, day) on which any stream
    fired; a NULL column means the stream did not fire (never zero). Only days of
    ``users`` (the cohort guard, on one row a day). One hash aggregate with
    ``max(..) FILTER (WHERE stream = s)`` per column."""
    aggs: list[Column] = []
    for s in streams:
        is_s = F.col("stream_code") == s.code
        aggs.append(F.max(F.when(is_s, F.col("n_samples"))).alias(f"{s.code}_samples"))
        if s.value or s.weighted:
            for m in ("sum", "mean", "min", "max"):
                aggs.append(_as_double(F.max(F.when(is_s, F.col(f"value_{m}")))).alias(f"{s.code}_{m}"))
        if s.kcal:
            aggs.append(_as_double(F.max(F.when(is_s, F.col("kcal_sum")))).alias(f"{s.code}_kcal"))
        if s.duration:
            aggs.append(_as_double(F.max(F.when(is_s, F.col("duration_hours")))).alias(f"{s.code}_hours"))
    return (day.groupBy("user_id", F.col("wear_date").alias("ymd_date")).agg(*aggs)
            .join(users.select("user_id"), "user_id", "left_semi"))


def detail_fact(spark: SparkSession, sf: str, code: str = WEIGHTED_STREAM) -> DataFrame:
    """DTL-02: source-grain facts of the collapsed stream, attributed to cohort
    users, with multiplicity kept."""
    c = collapsed_stream(spark, sf, code).join(_cohort(spark, sf), "user_lifelog_sn", "inner")
    return c.select("source_observation_id", "user_id", "measured_at",
                    tu.local_date("measured_at").alias("ymd_date"), "type_code",
                    F.col("sample_value").cast("double").alias("sample_value"), "source_row_count")


def to_edge(day: DataFrame) -> DataFrame:
    """Cast decimal measures to double for comparison/export."""
    return day.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c)
                        for c, t in day.dtypes])
