"""The dense panel over all facts: eleven channels of five kinds in one long form
(PNL-01..03 and FCT-12 with eleven channels and twenty-two dependencies).

Every fact becomes rows of a column a channel (from long rows: user, day, channel,
item, rows, flagged) that one aggregate sums, whatever the channel measures:

ROWS     the number of rows, and of those flagged (deliveries and completions);
ITEMS    the number of different items, and of those with a flag (scores);
STREAMS  the number of flagged items, 0 to 5 (streams that measured something):
         a day whose streams all held nothing is observed with the value 0;
CARRIED  one row a day whose own columns go along (the day's analysis).

Order of work, so that no hot key meets a join with all its rows: rows of
records that only know their serial are counted by (serial, day), scores by (serial,
day, item), before the serial meets its user; items are told apart by (user, day,
item); then everything is summed by (user, day), and the cohort's semi join
meets that aggregate.

Binding. The order history (1995-2001) lies before the cohort's events (January
2024), and a dense panel of both would hold three decades of empty days. The
panel therefore replays the orders, a month of history a day: day d becomes
2023-11-10 plus (d - 1995-01-01) div 30 days. All rows of all tables take part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions import timeutil as tu
from dayledger.functions.jsonfn import json_text
from dayledger.operators import staging as S
from dayledger.operators.setops import union_all
from dayledger.operators.sinks import typed_lit
from dayledger.plans import bindings as B
from dayledger.plans import facts as FT
from dayledger.plans import load_status as LS
from dayledger.plans import panel as P
from dayledger.plans.dims import dim_user
from dayledger.session import ensure_checkpoint_dir
from dayledger.sources.seeds import values_df
from dayledger.sources.tables import read_table

ROWS, ITEMS, STREAMS, CARRIED = "ROWS", "ITEMS", "STREAMS", "CARRIED"


@dataclass(frozen=True)
class FactChannel(P.ChannelSpec):
    """A panel channel with what its value measures."""

    measure: str = ROWS


CHANNELS: tuple[FactChannel, ...] = (
    FactChannel("app_login", P.APP, "app_login_events"),
    FactChannel("app_action", P.APP, "app_actions"),
    FactChannel("app_search", P.APP, "app_search_events"),
    FactChannel("share_created", P.APP, "share_links_created"),
    # somebody acted on the user's link: proof of an account, no activity of the user
    FactChannel("share_interaction", P.APP, "share_interaction_events", engages=False),
    FactChannel("coaching", P.PROGRAM, "routines_delivered", "routines_completed"),
    FactChannel("measurement", P.PASSIVE, "manual_measurements", collects=False),
    FactChannel("meal", P.PASSIVE, "meal_records", collects=False),
    FactChannel("wearable", P.PASSIVE, "wearable_streams_active", measure=STREAMS),
    FactChannel("integrated_analysis", P.ENROLLED, "intg_analysis_rows", measure=CARRIED),
    FactChannel("irs_score", P.ENROLLED, "diseases_scored", "diseases_with_irs_score", measure=ITEMS),
)
#: Columns that the CARRIED channel brings along, with their types.
CARRIED_COLUMNS = {"signature_code": "string", "signature_event_id": "bigint"}
#: Event types behind the three plain app channels, and the five streams of a
#: day with whether a stream needs a value to have measured something.
APP_EVENTS = {"view": "app_login", "click": "app_action", "purchase": "app_search"}
STREAM_EVENTS = {"click": True, "view": True, "purchase": True, "error": True, "signup": False}

# The dependency list of each channel (a model definition).
DEPENDENCIES = (
    ("app_login", "events", "public", "events_view", "INCREMENTAL"),
    ("app_action", "events", "public", "events_click", "INCREMENTAL"),
    ("app_search", "events", "public", "events_purchase", "FULL_REFRESH"),
    ("share_created", "sales", "public", "orders", "FULL_REFRESH"),
    ("share_interaction", "sales", "public", "lineitem", "FULL_REFRESH"),
    ("coaching", "sales", "public", "orders", "FULL_REFRESH"),
    ("measurement", "sales", "public", "orders", "FULL_REFRESH"),
    ("measurement", "sales", "readings", "quantity", "INCREMENTAL"),
    ("measurement", "sales", "readings", "extended_price", "INCREMENTAL"),
    ("measurement", "sales", "readings", "discount", "INCREMENTAL"),
    ("measurement", "sales", "readings", "tax", "INCREMENTAL"),
    ("measurement", "crm", "public", "customer", "FULL_REFRESH"),
    ("meal", "sales", "public", "orders", "FULL_REFRESH"),
    ("meal", "sales", "records", "meal", "INCREMENTAL"),
    ("wearable", "crm", "public", "customer", "FULL_REFRESH"),
    ("wearable", "events", "public", "events_click", "INCREMENTAL"),
    ("wearable", "events", "public", "events_view", "INCREMENTAL"),
    ("wearable", "events", "public", "events_purchase", "INCREMENTAL"),
    ("wearable", "events", "public", "events_error", "INCREMENTAL"),
    ("wearable", "events", "public", "events_signup", "INCREMENTAL"),
    ("integrated_analysis", "events", "public", "events_props", "INCREMENTAL"),
    ("irs_score", "sales", "scores", "lineitem_scores", "INCREMENTAL"),
)
#: The panel's raw columns: what a day holds of each channel, and the carried ones.
WIDE = {f"raw_{c}": "bigint" for ch in CHANNELS for c in (ch.value_col, ch.done_col) if c} | CARRIED_COLUMNS
READING_TARGETS = ("quantity", "extended_price", "discount", "tax")

LONG = ["ymd_date", "channel_code", "item", "n_rows", "n_flagged", *CARRIED_COLUMNS]


def replayed(day: Column | str) -> Column:
    """The panel day of a day of the order history (see the module text)."""
    d = F.col(day) if isinstance(day, str) else day
    return F.date_add(F.lit("2023-11-10").cast("date"), F.floor(F.datediff(d, F.lit("1995-01-01").cast("date")) / 30).cast("int"))


def _long(key: str, frame: DataFrame, day: Column, *marks: tuple[str, Column, Column, Column]) -> DataFrame:
    """Rows (key, day, channel, item, flag): one for each mark (channel, item,
    flag, whether the source row counts) of each source row."""
    none = F.lit(None)
    made = [F.when(counts, F.struct(F.lit(code).alias("channel_code"), item.cast("string").alias("item"), F.coalesce(flag, F.lit(False)).alias("flag")))
            for code, item, flag, counts in marks]
    rows = frame.select(F.col(key), day.alias("ymd_date"), F.inline(F.array_compact(F.array(*made))))
    return rows.select(key, "ymd_date", "channel_code", "item", F.lit(1).cast("bigint").alias("n_rows"),
                       F.col("flag").cast("bigint").alias("n_flagged"), *[none.cast(t).alias(c) for c, t in CARRIED_COLUMNS.items()])


def event_rows(spark: SparkSession, sf: str) -> DataFrame:
    """App channels and streams of the events: one scan."""
    no, yes = F.lit(False), F.lit(True)
    kind = F.col("event_type")
    marks = [(code, F.lit(None), no, kind == t) for t, code in APP_EVENTS.items()]
    measured = F.when(kind.isin([t for t, needs in STREAM_EVENTS.items() if needs]), F.col("value").isNotNull()).otherwise(yes)
    marks.append(("wearable", kind, measured, kind.isin(list(STREAM_EVENTS))))
    return _long("user_id", B.events(spark, sf).where(F.col("ts").isNotNull()), F.col("event_date"), *marks)


def analysis_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The day's last analysis, a row a user and day with its own columns."""
    e = S.drop_error_payloads(B.events(spark, sf), "props")
    last = S.last_row_wins(e, ["user_id", "event_date"], "ts", ["event_id"])
    return last.select("user_id", F.col("event_date").alias("ymd_date"), F.lit("integrated_analysis").alias("channel_code"),
                       F.lit(None).cast("string").alias("item"), F.lit(1).cast("bigint").alias("n_rows"), F.lit(0).cast("bigint").alias("n_flagged"),
                       json_text("props", "k").alias("signature_code"), F.col("event_id").cast("bigint").alias("signature_event_id"))


def _wide(key: str, frame: DataFrame) -> DataFrame:
    """``frame`` (the key, ymd_date and some of the panel's raw columns) with all of them."""
    return frame.select(key, "ymd_date", *[(F.col(c) if c in frame.columns else F.lit(None)).cast(t).alias(c) for c, t in WIDE.items()])


def widened(rows: DataFrame, channels=CHANNELS) -> DataFrame:
    """Long rows as rows of the panel's raw columns: each holds its channel's value
    by the measure, NULL for the others; their sums are the day's values."""
    value = {ROWS: F.col("n_rows"), CARRIED: F.col("n_rows"), ITEMS: F.lit(1), STREAMS: (F.col("n_flagged") > 0).cast("bigint")}
    flagged = {ROWS: F.col("n_flagged"), ITEMS: (F.col("n_flagged") > 0).cast("bigint")}
    cols: list[Column] = []
    for c in channels:
        mine = F.col("channel_code") == c.code
        cols.append(F.when(mine, value[c.measure]).cast("bigint").alias(f"raw_{c.value_col}"))
        if c.done_col:
            cols.append(F.when(mine, flagged[c.measure]).cast("bigint").alias(f"raw_{c.done_col}"))
    return rows.select("user_id", "ymd_date", *cols, *CARRIED_COLUMNS)


def delivery_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Links created and routines delivered: one pass over the deliveries."""
    none, one = F.lit(None).cast("int"), F.lit(1)
    cell = lambda day, created, delivered, done: F.struct(
        day.alias("ymd_date"), created.alias("raw_share_links_created"), delivered.alias("raw_routines_delivered"), done.alias("raw_routines_completed"))
    cells = F.array(cell(replayed(tu.local_date("delivered_at")), one, none, none),
                    cell(replayed("ymd_date"), none, one, F.col("completed_at").isNotNull().cast("int")))
    return _wide("user_id", B.deliveries(spark, sf).select("user_id", F.inline(cells)))


def serial_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Records that know their serial only (interactions, meals, readings; scores),
    counted by serial first, then given to the serial's user. Records that are
    only counted make one narrow row a serial and day, scores one an item."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_shipdate", "l_quantity", "l_returnflag"]).withColumnRenamed("l_orderkey", "user_lifelog_sn")
    parent = B.lifelog_parent(spark, sf).where(F.col("user_id").isNotNull()).select("user_lifelog_sn", "user_id")
    local, day = replayed(tu.local_date("l_shipdate")), replayed(F.to_date("l_shipdate"))
    none, one = F.lit(None).cast("int"), F.lit(1)
    kept = F.when(~F.col("l_returnflag").eqNullSafe("R"), one)
    records = li.select("user_lifelog_sn", local.alias("ymd_date"), one.alias("interactions"), kept.alias("meals"), none.alias("readings"))
    readings = FT.staged_reading_counts(spark, sf).select("user_lifelog_sn", replayed(tu.local_date("measured_at")).alias("ymd_date"), none, none, "n_readings")
    counted = records.union(readings).where(F.col("ymd_date").isNotNull()).groupBy("user_lifelog_sn", "ymd_date").agg(
        F.sum("interactions").alias("raw_share_interaction_events"), F.sum("meals").alias("raw_meal_records"), F.sum("readings").alias("raw_manual_measurements"))
    scored = (F.col("l_quantity") * 2).cast("int").isNotNull()
    items = (li.where(F.col("l_partkey").isNotNull()).select("user_lifelog_sn", day.alias("ymd_date"), F.col("l_partkey").alias("item"), scored.cast("int").alias("scored"))
             .where(F.col("ymd_date").isNotNull()).groupBy("user_lifelog_sn", "ymd_date", "item").agg(F.max("scored").alias("scored")))
    theirs = (items.join(parent, "user_lifelog_sn").groupBy("user_id", "ymd_date", "item").agg(F.max("scored").alias("scored"))
              .select("user_id", "ymd_date", F.lit(1).alias("raw_diseases_scored"), F.col("scored").alias("raw_diseases_with_irs_score")))
    return _wide("user_id", counted.join(parent, "user_lifelog_sn")).unionByName(_wide("user_id", theirs))


def _counted(rows: DataFrame, key: str) -> DataFrame:
    """Rows and flags by (key, day, channel, item); the carried columns are those
    of a single row and are part of the key."""
    return rows.groupBy(key, "ymd_date", "channel_code", "item", *CARRIED_COLUMNS).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_flagged").alias("n_flagged")).select(key, *LONG)


def fact_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All facts as rows of the panel's raw columns, whose sums by (user, day) are
    the day's values; not yet guarded. Events are counted by (user, day, channel,
    item) first, scores by (user, day, item)."""
    observed = union_all([_counted(event_rows(spark, sf), "user_id"), analysis_rows(spark, sf).select("user_id", *LONG)])
    parts = [widened(observed), delivery_rows(spark, sf), serial_rows(spark, sf)]
    return union_all([p.select("user_id", "ymd_date", *WIDE) for p in parts]).where(F.col("user_id").isNotNull() & F.col("ymd_date").isNotNull())


def daily_totals(rows: DataFrame) -> DataFrame:
    """One row a user and day: the sums of the raw columns, NULL where the channel
    has no row that day."""
    # a single row a day carries the carried columns: the largest is the only one
    return rows.groupBy("user_id", "ymd_date").agg(
        *[(F.max(c) if c in CARRIED_COLUMNS else F.sum(c).cast("bigint")).alias(c) for c in rows.columns if c not in ("user_id", "ymd_date")])


def daily_values(rows: DataFrame, channels=CHANNELS) -> DataFrame:
    """``daily_totals`` of long rows (user, day, channel, item, rows, flagged)."""
    return daily_totals(widened(rows, channels))


def control_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The control table that a replay of all sources records: a row a target, the
    position being the highest time loaded; full refreshes record the time of
    the run, the end of the replay."""
    e = B.events(spark, sf)
    at_end = F.lit(None).cast("timestamp_ntz")
    per_type = e.groupBy("event_type").agg(F.max("ts").alias("at"))
    events = per_type.select(F.lit("events").alias("source_system"), F.lit("public").alias("schema_name"),
                             F.concat(F.lit("events_"), "event_type").alias("table_name"), "at")
    props = e.where(F.col("props").isNotNull()).agg(F.max("ts").alias("at")).select(
        F.lit("events").alias("source_system"), F.lit("public").alias("schema_name"), F.lit("events_props").alias("table_name"), "at")
    shipped = read_table(spark, sf, "lineitem", ["l_shipdate"]).agg(F.max("l_shipdate").alias("last"))
    sales = shipped.select(F.inline(F.array(*[F.struct(F.lit("sales").alias("source_system"), F.lit(s).alias("schema_name"), F.lit(t).alias("table_name"))
                                             for s, t in [*(("readings", t) for t in READING_TARGETS), ("records", "meal"), ("scores", "lineitem_scores")]])),
                           F.to_timestamp_ntz(replayed(F.to_date("last")).cast("string")).alias("at"))
    end = per_type.agg(F.max("at").alias("at"))
    run_at = typed_lit(end.first()["at"], end.schema["at"].dataType)  # one scalar
    full = values_df(spark, [("crm", "public", "customer"), ("sales", "public", "orders"), ("sales", "public", "lineitem")],
                     "source_system string, schema_name string, table_name string").select("*", run_at.alias("at"))
    rows = union_all([events, props, sales, full.withColumn("at", F.coalesce("at", at_end))])
    return rows.select("source_system", "schema_name", "table_name", F.lit("SUCCESS").alias("last_status"), F.col("at").alias("updated_at"))


def _daily(spark: SparkSession, sf: str, users: DataFrame) -> DataFrame:
    """The guarded daily values, written once: bounds, frontiers and panel read them."""
    ensure_checkpoint_dir(spark)
    return guarded_totals(spark, sf, users).checkpoint(eager=True)


def guarded_totals(spark: SparkSession, sf: str, users: DataFrame) -> DataFrame:
    """The daily values of the cohort: the guard meets a row a user and day."""
    return daily_totals(fact_rows(spark, sf)).join(users.select("user_id"), "user_id", "left_semi")


def load_status(spark: SparkSession, sf: str, daily: DataFrame | None = None) -> DataFrame:
    """FCT-12 over eleven channels and twenty-two dependencies."""
    if daily is None:
        daily = guarded_totals(spark, sf, dim_user(spark, sf))
    return LS.channel_load_status(spark, sf, control=control_rows(spark, sf), frontiers=P.daily_frontiers(daily, CHANNELS), deps_list=DEPENDENCIES)


def user_day(spark: SparkSession, sf: str) -> DataFrame:
    """PNL-01 over all facts."""
    users = dim_user(spark, sf).select("user_id", "joined_date", "app_registered_date", "birth_year")
    daily = _daily(spark, sf, users)
    bounds = P.user_bounds(daily, users, CHANNELS)
    return P.dense_panel(daily, bounds, load_status(spark, sf, daily), CHANNELS, tuple(CARRIED_COLUMNS))


def user_month(panel: DataFrame, users: DataFrame) -> DataFrame:
    """PNL-03 over all facts; interactions with a user's links are no engaged days."""
    return P.user_month(panel, users, CHANNELS)
