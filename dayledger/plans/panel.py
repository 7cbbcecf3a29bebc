"""Dense user x day panel (PNL-01), its wide form (PNL-02) and the user x
month panel (PNL-03).

Unknown is not zero: a channel's value is the observed count, else 0 only
when the day is inside both the channel's load frontier and the user's
eligibility, else NULL — and a state column says which.

Plan shape (instead of one left join per channel):

1. channel events -> long rows ``(user, day, channel, done)`` -> **one**
   ``groupBy(user, day)`` with ``FILTER``-style conditional sums, then the
   cohort guard as a semi join on the (much smaller) daily aggregate;
2. per-user eligibility and first-activity bounds: one ``groupBy(user)``;
3. frontiers: one row of dates, taken as scalars (literals, no join);
4. spine: ``explode(sequence(lo, hi))`` per user — a Generate, no range join;
5. one left join of spine and daily counts on ``(user, day)``; the daily
   aggregate is checkpointed once (shared folder) because three consumers
   read it;
6. value and state ladders generated from the channel spec list.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions import timeutil as tu
from dayledger.plans import bindings as B
from dayledger.plans import load_status as LS
from dayledger.plans.dims import dim_user
from dayledger.session import ensure_checkpoint_dir

APP, PROGRAM, ENROLLED, PASSIVE = "APP", "PROGRAM", "ENROLLED", "PASSIVE"

# The state codes.
OBSERVED_ACTIVITY = "OBSERVED_ACTIVITY"
NOT_LOADED = "NOT_LOADED"
ELIGIBILITY_UNKNOWN = "ELIGIBILITY_UNKNOWN"
NOT_YET_ELIGIBLE = "NOT_YET_ELIGIBLE"
OBSERVED_ZERO = "OBSERVED_ZERO"
OBSERVED_STATES = (OBSERVED_ACTIVITY, OBSERVED_ZERO)


@dataclass(frozen=True)
class ChannelSpec:
    """A panel channel.

    kind: APP      eligible from least(app registration, first app-channel day);
                   has the ELIGIBILITY_UNKNOWN arm
          PROGRAM  eligible from least(joined, first day of this channel); no
                   unknown arm; carries a second count (``done``)
          ENROLLED eligible from joined; no unknown arm
          PASSIVE  never zero: observed, NOT_LOADED or ELIGIBILITY_UNKNOWN
    engages: an APP channel whose activity counts as the user's own; without
    it the channel extends eligibility (somebody else acted on the user's item)
    but never makes a day an engaged one
    collects: the PASSIVE channel behind ``had_passive_collection``
    """

    code: str
    kind: str
    value_col: str
    done_col: str | None = None
    engages: bool = True
    collects: bool = True


CHANNELS: tuple[ChannelSpec, ...] = (
    ChannelSpec("view", APP, "view_events"),
    ChannelSpec("click", APP, "click_events"),
    ChannelSpec("purchase", PROGRAM, "purchases_delivered", "purchases_completed"),
    ChannelSpec("error", PASSIVE, "error_events"),
    ChannelSpec("signup", ENROLLED, "signup_events"),
)
COMPLETED_MIN_VALUE = 50.0


def channel_rows(spark: SparkSession, sf: str, channels: Sequence[ChannelSpec] = CHANNELS
                 ) -> DataFrame:
    """Long form ``(user_id, ymd_date, channel_code, is_done)`` of every channel
    event (one scan for all channels). Not yet cohort-guarded: the guard is a
    filter on the user and is applied after the daily pre-aggregation."""
    e = B.events(spark, sf).where(F.col("event_type").isin([c.code for c in channels]))
    done_codes = [c.code for c in channels if c.done_col]
    done = F.col("event_type").isin(done_codes) & (F.col("value") >= COMPLETED_MIN_VALUE)
    return e.select("user_id", F.col("event_date").alias("ymd_date"),
                    F.col("event_type").alias("channel_code"),
                    F.coalesce(done, F.lit(False)).alias("is_done"))


def daily_counts(rows: DataFrame, channels: Sequence[ChannelSpec] = CHANNELS) -> DataFrame:
    """One aggregate: per (user, day) a count per channel, NULL (not 0) when
    the channel has no row that day."""
    aggs: list[Column] = []
    for ch in channels:
        is_c = F.col("channel_code") == ch.code
        aggs.append(F.sum(F.when(is_c, F.lit(1))).cast("bigint").alias(f"raw_{ch.value_col}"))
        if ch.done_col:
            aggs.append(F.sum(F.when(is_c, F.col("is_done").cast("int"))).cast("bigint")
                        .alias(f"raw_{ch.done_col}"))
    return rows.groupBy("user_id", "ymd_date").agg(*aggs)


def user_bounds(daily: DataFrame, users: DataFrame, channels: Sequence[ChannelSpec] = CHANNELS
                ) -> DataFrame:
    """Per-user eligibility dates and spine start: one ``groupBy(user)`` over
    the daily aggregate (every daily row has at least one channel present)."""
    app = [c for c in channels if c.kind == APP]
    any_app = None
    for c in app:
        p = F.col(f"raw_{c.value_col}").isNotNull()
        any_app = p if any_app is None else any_app | p
    aggs = [F.min("ymd_date").alias("first_activity_date"),
            F.min(F.when(any_app if any_app is not None else F.lit(False), F.col("ymd_date")))
            .alias("first_app_event_date")]
    for ch in channels:
        if ch.kind == PROGRAM:
            aggs.append(F.min(F.when(F.col(f"raw_{ch.value_col}").isNotNull(), F.col("ymd_date")))
                        .alias(f"first_{ch.code}_date"))
    firsts = daily.groupBy("user_id").agg(*aggs)
    u = users.join(firsts, "user_id", "left")
    cols = [F.col(c) for c in users.columns] + [
        F.least("app_registered_date", "first_app_event_date").alias("app_eligible_from_date"),
        F.col("joined_date").alias("enrolled_eligible_from_date"),
        F.least("joined_date", F.coalesce("first_activity_date", "joined_date")).alias("spine_from")]
    for ch in channels:
        if ch.kind == PROGRAM:
            cols.append(F.least("joined_date", f"first_{ch.code}_date")
                        .alias(f"{ch.code}_eligible_from_date"))
    return u.select(*cols)


def daily_frontiers(daily: DataFrame, channels: Sequence[ChannelSpec] = CHANNELS) -> DataFrame:
    """Observed frontier per channel from the daily aggregate: one global
    aggregate (partial per task), unpivoted to ``(channel_code, date)``."""
    one = daily.agg(*[F.max(F.when(F.col(f"raw_{c.value_col}").isNotNull(), F.col("ymd_date")))
                      .alias(c.code) for c in channels])
    stack = ", ".join(f"'{c.code}', `{c.code}`" for c in channels)
    return one.selectExpr(f"stack({len(channels)}, {stack}) AS (channel_code, observed_event_through_date)")


def _eligible_col(ch: ChannelSpec) -> str | None:
    return {APP: "app_eligible_from_date", ENROLLED: "enrolled_eligible_from_date",
            PROGRAM: f"{ch.code}_eligible_from_date", PASSIVE: None}[ch.kind]


def _ladders(ch: ChannelSpec) -> list[Column]:
    d = F.col("ymd_date")
    thr = F.col(f"{ch.code}_through")
    raw = F.col(f"raw_{ch.value_col}")
    out: list[Column] = []
    if ch.kind == PASSIVE:
        out.append(raw.alias(ch.value_col))
        state = (F.when(raw.isNotNull(), OBSERVED_ACTIVITY)
                 .when(thr.isNull() | (d > thr), NOT_LOADED).otherwise(ELIGIBILITY_UNKNOWN))
        out.append(state.alias(f"{ch.code}_state"))
        return out
    elig = F.col(_eligible_col(ch))
    zero_ok = (d <= thr) & (d >= elig)
    out.append(F.when(raw.isNotNull(), raw).when(zero_ok, F.lit(0).cast("bigint")).alias(ch.value_col))
    if ch.done_col:
        done = F.col(f"raw_{ch.done_col}")
        out.append(F.when(raw.isNotNull(), done).when(zero_ok, F.lit(0).cast("bigint"))
                   .alias(ch.done_col))
    state = F.when(raw.isNotNull(), OBSERVED_ACTIVITY).when(thr.isNull() | (d > thr), NOT_LOADED)
    if ch.kind == APP:
        state = state.when(elig.isNull(), ELIGIBILITY_UNKNOWN)
    state = state.when(d < elig, NOT_YET_ELIGIBLE).otherwise(OBSERVED_ZERO)
    out.append(state.alias(f"{ch.code}_state"))
    return out


def user_day(spark: SparkSession, sf: str, channels: Sequence[ChannelSpec] = CHANNELS,
             status: DataFrame | None = None, checkpoint: bool = True) -> DataFrame:
    """PNL-01: the dense user x local-day panel from each user's first day
    (joined or earlier activity) to the observation frontier (never today)."""
    users = dim_user(spark, sf).select("user_id", "joined_date", "app_registered_date", "birth_year")
    rows = channel_rows(spark, sf, channels)
    # Pre-aggregate per (user, day) first (partial aggregation per task; a hot
    # user spreads over its days), then apply the cohort guard to the small
    # aggregate: the guard join never sees raw rows, so it cannot skew.
    daily = daily_counts(rows, channels).join(users.select("user_id"), "user_id", "left_semi")
    # The user-day aggregate feeds three consumers (user bounds, frontiers ->
    # spine end, the final join). Spark would recompute it — i.e. re-read the
    # events — for each; a reliable checkpoint in the shared checkpoint folder
    # writes it once (it is far smaller than the events) and cuts the lineage.
    if checkpoint:
        ensure_checkpoint_dir(spark)
        daily = daily.checkpoint(eager=True)
    bounds = user_bounds(daily, users, channels)
    st = status if status is not None else LS.channel_load_status(
        spark, sf, frontiers=daily_frontiers(daily, channels))
    return dense_panel(daily, bounds, st, channels)


def dense_panel(daily: DataFrame, bounds: DataFrame, st: DataFrame, channels: Sequence[ChannelSpec],
                carried: Sequence[str] = ()) -> DataFrame:
    """The dense panel of the daily aggregate, the users' bounds and the load
    status; ``carried``: columns of the daily aggregate that go with it unchanged."""
    # The frontiers are one row of dates: taken as scalars and used as
    # literals (an uncorrelated scalar subquery), never joined.
    fr = LS.frontier_row(st, [c.code for c in channels]).first()
    through = {c: F.lit(fr[c]).cast("date") for c in fr.asDict()}
    spine = bounds.select("*", *[v.alias(k) for k, v in through.items()]).select(
        "*", F.explode(tu.date_series("spine_from", "panel_through")).alias("ymd_date"))
    raw = spine.join(daily, ["user_id", "ymd_date"], "left")
    d = F.col("ymd_date")
    first_app = next((c for c in channels if c.kind == APP), None)
    passive = next((c for c in channels if c.kind == PASSIVE and c.collects), None)
    cols: list[Column] = [
        F.col("user_id"), d,
        tu.age_years(d, "birth_year").cast("double").alias("age_at_activity"),
        tu.age_band(d, "birth_year").alias("age_band_5y"),
        tu.days_between(d, "joined_date").alias("days_since_joined"),
        tu.whole_months(d, "joined_date").alias("months_since_joined"), *map(F.col, carried)]
    for ch in channels:
        cols.extend(_ladders(ch))
    if first_app is not None:
        elig = F.col("app_eligible_from_date")
        thr = F.col(f"{first_app.code}_through")
        cols.append(F.when(F.col(f"raw_{first_app.value_col}").isNotNull(), F.lit(True))
                    .when((d <= thr) & (d >= elig), F.lit(False)).alias(f"did_{first_app.code}"))
    if passive is not None:
        cols.append(F.when(F.col(f"raw_{passive.value_col}").isNotNull(), F.lit(True))
                    .alias("had_passive_collection"))
    cols.extend(F.col(f"{c.code}_through") for c in channels)
    return raw.select(*cols)


def user_day_wide(panel: DataFrame, users: DataFrame) -> DataFrame:
    """PNL-02: panel + user attributes (one row per user, joined on the user
    key) + calendar attributes computed in place from the day (the calendar
    is a pure function of the date, so no join is needed for it)."""
    d = F.col("ymd_date")
    attrs = users.select("user_id", "segment", "site_name", "cohort_group")
    return panel.join(attrs, "user_id", "left").select(
        "*", tu.iso_day_of_week(d).alias("iso_day_of_week"),
        tu.trunc_date("week", d).alias("week_start_date"),
        tu.trunc_date("month", d).alias("month_start_date"),
        tu.month_label(d).alias("year_month"))


def user_month(panel: DataFrame, users: DataFrame, channels: Sequence[ChannelSpec] = CHANNELS
               ) -> DataFrame:
    """PNL-03: user x calendar month with numerator / observed-day denominator
    pairs, left-partial / right-censored flags and the cohort month index."""
    aggs: list[Column] = [F.min("ymd_date").alias("panel_start_date"),
                          F.max("ymd_date").alias("panel_end_date"),
                          F.count(F.lit(1)).alias("panel_days")]
    for ch in channels:
        if ch.kind != PASSIVE:
            aggs.append(F.count_if(F.col(f"{ch.code}_state").isin(*OBSERVED_STATES))
                        .alias(f"{ch.code}_observed_days"))
        aggs.append(F.sum(ch.value_col).cast("bigint").alias(ch.value_col))
        aggs.append(F.count_if(F.coalesce(F.col(ch.value_col), F.lit(0)) > 0)
                    .alias(f"{ch.code}_activity_days"))
        if ch.done_col:
            aggs.append(F.sum(ch.done_col).cast("bigint").alias(ch.done_col))
    app = [c for c in channels if c.kind == APP and c.engages]
    if app:
        engaged = None
        for c in app:
            e = F.coalesce(F.col(c.value_col), F.lit(0)) > 0
            engaged = e if engaged is None else engaged | e
        aggs.append(F.count_if(engaged).alias("app_engaged_days"))
    m = panel.groupBy("user_id", tu.trunc_date("month", "ymd_date").alias("month_start_date")).agg(*aggs)
    u = users.select("user_id", "joined_date")
    mend = tu.month_end("month_start_date")
    j = m.join(u, "user_id", "inner")
    return j.select(
        "user_id", "month_start_date", mend.alias("month_end_date"),
        tu.whole_months("month_start_date", tu.trunc_date("month", "joined_date")).alias("cohort_month_index"),
        *[c for c in m.columns if c not in ("user_id", "month_start_date")],
        (F.col("panel_start_date") > F.col("month_start_date")).alias("is_left_partial_month"),
        (F.col("panel_end_date") < mend).alias("is_right_censored"),
        ((F.col("panel_start_date") > F.col("month_start_date")) | (F.col("panel_end_date") < mend))
        .alias("is_partial_month"),
        # No approved qualifying-day definition exists: a typed NULL plus a
        # status saying so, never a guessed number (PRJ-10).
        F.lit(None).cast("int").alias("remote_care_qualifying_days"),
        F.lit("HYPOTHESIS_UNDEFINED").alias("remote_care_qualifying_day_status"))
