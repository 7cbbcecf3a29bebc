"""Channel load status (FCT-12): per channel, whether every dependency's last
load succeeded, the oldest success, the load-complete-through date (local date
of the oldest success minus one day, NULL unless all succeeded; a dependency
without a control row counts as not successful) and the observed frontier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions import timeutil as tu
from dayledger.operators.sinks import typed_lit
from dayledger.plans import bindings as B
from dayledger.plans import facts as FT
from dayledger.sources.seeds import values_df

CHANNELS = FT.CHANNEL_EVENT_TYPES

# The dependency list of each channel (a model definition).
DEPENDENCIES = (
    ("view", "events", "public", "events_view", "INCREMENTAL"),
    ("view", "crm", "public", "customer", "FULL_REFRESH"),
    ("click", "events", "public", "events_click", "INCREMENTAL"),
    ("click", "crm", "public", "customer", "FULL_REFRESH"),
    ("purchase", "events", "public", "events_purchase", "INCREMENTAL"),
    ("purchase", "sales", "public", "orders", "FULL_REFRESH"),
    ("error", "events", "public", "events_error", "INCREMENTAL"),
    ("error", "ops", "public", "error_catalog", "FULL_REFRESH"),
    ("signup", "events", "public", "events_signup", "INCREMENTAL"),
)
DEPENDENCY_SCHEMA = ("channel_code string, source_system string, schema_name string, "
                     "table_name string, load_mode string")
FULL_REFRESH_TABLES = (("crm", "public", "customer"), ("sales", "public", "orders"))


def dependencies(spark: SparkSession, rows=DEPENDENCIES) -> DataFrame:
    return values_df(spark, rows, DEPENDENCY_SCHEMA)


def control_from_landing(spark: SparkSession, sf: str) -> DataFrame:
    """The control table an incremental replay of the event stream records.

    Each event type lands as its own incremental target: position = observed
    maximum event time (SNK-09/10), status SUCCESS, row count, and the load
    finishes at that position. Full-refresh targets record the run time, i.e.
    the end of the replay (the latest event overall, one scalar taken from
    the per-type aggregate). One grouped aggregate over the events; the result
    has one row per target.
    """
    e = B.events(spark, sf)
    inc = e.groupBy("event_type").agg(F.max("ts").alias("wm"), F.count(F.lit(1)).alias("n"))
    inc_rows = inc.select(
        F.lit("events").alias("source_system"), F.lit("public").alias("schema_name"),
        F.concat(F.lit("events_"), F.col("event_type")).alias("table_name"),
        F.col("wm").alias("watermark_value"), F.lit("SUCCESS").alias("last_status"),
        F.lit(None).cast("string").alias("last_error"), F.col("n").cast("bigint").alias("row_count"),
        F.col("wm").alias("updated_at"))
    end = inc.agg(F.max("wm").alias("run_at"))
    run_at = typed_lit(end.first().run_at, end.schema["run_at"].dataType)   # one scalar
    full = values_df(spark, FULL_REFRESH_TABLES,
                     "source_system string, schema_name string, table_name string")
    full_rows = full.select(
        "source_system", "schema_name", "table_name", run_at.alias("watermark_value"),
        F.lit("SUCCESS").alias("last_status"), F.lit(None).cast("string").alias("last_error"),
        F.lit(None).cast("bigint").alias("row_count"), run_at.alias("updated_at"))
    return inc_rows.unionByName(full_rows)


def observed_frontiers(spark: SparkSession, sf: str, channels=CHANNELS) -> DataFrame:
    """Latest local date actually observed per channel (cohort facts): events
    are reduced per (user, channel) first, then guarded, then reduced again."""
    e = B.events(spark, sf).where(F.col("event_type").isin(list(channels)))
    per_user = e.groupBy("user_id", "event_type").agg(F.max("event_date").alias("last_date"))
    guarded = per_user.join(FT.cohort_ids(spark, sf), "user_id", "left_semi")
    return guarded.groupBy(F.col("event_type").alias("channel_code")).agg(
        F.max("last_date").alias("observed_event_through_date"))


def channel_load_status(spark: SparkSession, sf: str, control: DataFrame | None = None,
                        frontiers: DataFrame | None = None, deps_list=DEPENDENCIES) -> DataFrame:
    """FCT-12 over the dependency list, the control table and the facts
    (``frontiers``: precomputed ``(channel_code, observed_event_through_date)``)."""
    ctl = control if control is not None else control_from_landing(spark, sf)
    ctl = ctl.select("source_system", "schema_name", "table_name", "last_status", "updated_at")
    deps = dependencies(spark, deps_list).join(ctl, ["source_system", "schema_name", "table_name"], "left")
    ok = (F.col("last_status") == "SUCCESS") & F.col("updated_at").isNotNull()
    rolled = deps.groupBy("channel_code").agg(
        F.count(F.lit(1)).alias("dependency_count"),
        F.count_if(F.col("last_status") == "SUCCESS").alias("successful_dependency_count"),
        F.bool_and(ok).alias("all_dependencies_successful"),
        F.min("updated_at").alias("oldest_recorded_success_at"),
        F.max("updated_at").alias("latest_recorded_success_at"),
        F.bool_or(F.col("load_mode") == "INCREMENTAL").alias("has_empty_incremental_run_blind_spot"))
    through = F.when(F.col("all_dependencies_successful"),
                     F.date_sub(tu.local_date("oldest_recorded_success_at"), 1))
    obs = frontiers if frontiers is not None else observed_frontiers(spark, sf)
    out = rolled.join(obs, "channel_code", "left")
    return out.select(
        "channel_code", "dependency_count", "successful_dependency_count",
        "all_dependencies_successful", "oldest_recorded_success_at", "latest_recorded_success_at",
        through.alias("load_complete_through_date"), "observed_event_through_date",
        "has_empty_incremental_run_blind_spot",
        F.lit("TARGET_SUCCESS_ONLY").alias("completion_evidence_kind"))


def frontier_row(status: DataFrame, channels=CHANNELS) -> DataFrame:
    """One-row frame: ``<channel>_through`` per channel and ``panel_through`` =
    max over channels of greatest(load complete, observed)."""
    aggs = [F.max(F.when(F.col("channel_code") == c, F.col("load_complete_through_date")))
            .alias(f"{c}_through") for c in channels]
    aggs.append(F.max(F.greatest("load_complete_through_date", "observed_event_through_date"))
                .alias("panel_through"))
    return status.agg(*aggs)
