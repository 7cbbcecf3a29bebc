"""The reconciliation checks of the models as functions of frames: each returns
the rows that violate it, whatever frames it is given."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.functions import timeutil as tu
from dayledger.functions.jsonfn import json_has_key
from dayledger.operators import staging as S
from dayledger.operators.reconcile import multiset_differences, reconcile
from dayledger.operators.setops import union_all
from dayledger.plans import panel as P


def one_site_per_user(users: DataFrame, sites: DataFrame) -> DataFrame:
    """DQ-10: users (user_id, site_key) without exactly one site."""
    held = sites.select("site_key", F.col("site_key").alias("__site"))
    return (users.select("user_id", "site_key").join(held, "site_key", "left").groupBy("user_id")
            .agg(F.count("__site").alias("n_sites")).where(F.col("n_sites") != 1))


def stream_days(raw: DataFrame, collapsed: DataFrame, day: DataFrame) -> DataFrame:
    """DQ-12: by user and day, raw samples, collapsed samples and the day's aggregate
    agree in number, sum, mean, least and greatest value (means to 6 digits)."""
    key = ["user_id", "wear_date"]
    dated = lambda f: f.withColumn("user_id", F.col("user_lifelog_sn")).withColumn("wear_date", tu.local_date("measured_at"))
    value, times = F.col("sample_value").cast("decimal(38,6)"), F.col("source_row_count")
    total = lambda c: c.cast("decimal(38,6)")
    found = reconcile(
        {"raw": dated(raw.where(F.col("measured_at").isNotNull())), "collapsed": dated(collapsed), "day": day}, key,
        {"n": ("count", {"raw": F.lit(1), "collapsed": times, "day": F.col("n_samples")}),
         "sum": ("sum", {"raw": value, "collapsed": total(F.col("sample_value") * times), "day": total(F.col("value_sum"))}),
         "mean": ("mean", {"raw": F.col("sample_value").cast("double"), "day": F.col("value_mean").cast("double")}),
         "min": ("min", {"raw": value, "collapsed": value, "day": total(F.col("value_min"))}),
         "max": ("max", {"raw": value, "collapsed": value, "day": total(F.col("value_max"))})})
    rounded = [F.round(f"mean_{leg}", 6) for leg in ("raw", "day")]
    others = F.lit(False)
    for m in ("n", "sum", "min", "max"):
        others = others | ~F.col(f"{m}_raw").eqNullSafe(F.col(f"{m}_collapsed")) | ~F.col(f"{m}_raw").eqNullSafe(F.col(f"{m}_day"))
    apart = F.coalesce(F.abs(rounded[0] - rounded[1]) > 1.5e-6, ~F.col("mean_raw").isNull().eqNullSafe(F.col("mean_day").isNull()))
    return found.where(others | apart)


def staged_and_fact_rows(channels: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """DQ-13: channels whose staged rows and fact rows differ in number."""
    one = lambda f, c: f.select(F.lit(c).alias("channel_code"))
    legs = {"staged": union_all([one(staged, c) for c, (staged, _) in channels.items()]),
            "fact": union_all([one(fact, c) for c, (_, fact) in channels.items()])}
    found = reconcile(legs, ["channel_code"], {"rows": ("count", {"staged": F.lit(1), "fact": F.lit(1)})})
    return found.select("channel_code", F.coalesce("rows_staged", F.lit(0)).alias("staged_rows"), F.coalesce("rows_fact", F.lit(0)).alias("fact_rows"))


def staging_keeps_rows(landing: DataFrame, mapper: DataFrame, key: str, mapped_key: str) -> DataFrame:
    """DQ-14: one row if the key translation adds, loses or leaves unmapped rows."""
    staged = S.translate_key(landing, mapper, [(key, mapped_key)], {mapped_key: "__mapped"})
    return union_all([
        landing.select(F.lit(1).alias("landed"), F.lit(0).alias("staged"), F.lit(0).alias("unmapped")),
        staged.select(F.lit(0), F.lit(1), F.col("__mapped").isNull().cast("int")).toDF("landed", "staged", "unmapped")]).agg(
            F.coalesce(F.sum("landed"), F.lit(0)).alias("landing_rows"), F.coalesce(F.sum("staged"), F.lit(0)).alias("staging_rows"),
            F.coalesce(F.sum("unmapped"), F.lit(0)).alias("unmapped_rows")).where("landing_rows <> staging_rows or unmapped_rows > 0")


def error_payloads(rows: DataFrame, payload: str, most: int = 0) -> DataFrame:
    """DQ-15: the number of error payloads, reported above ``most``."""
    return rows.agg(F.count_if(json_has_key(payload, "error")).alias("error_rows")).where(F.col("error_rows") > most)


def outside_cohort(facts: dict[str, DataFrame], cohort: DataFrame) -> DataFrame:
    """DQ-17: users of facts (by name) that the cohort doesn't know."""
    seen = union_all([f.select("user_id", F.lit(name).alias("src")) for name, f in facts.items()])
    return seen.distinct().join(cohort, "user_id", "left_anti")


SIGNATURE = ("user_lifelog_sn", "measured_at", "metric_code", "metric_value")


def signature_differences(fact: DataFrame, raw: DataFrame, parents: DataFrame) -> DataFrame:
    """DQ-18: observation signatures that the measurement fact holds more or less
    often than the raw table's readings give, one a (serial, slot) for amounts and
    one a value for rates. The raw table is read here on its own, by aggregates
    and not by the staging model."""
    known = raw.join(parents.select("user_lifelog_sn"), "user_lifelog_sn", "left_semi")
    best = F.struct(*[F.col(c) for c in ("quantity", "extended_price", "measured_dt", "discount", "tax")])
    slot = known.groupBy("user_lifelog_sn", "slot").agg(F.max(best).alias("b"))
    amounts = [slot.select("user_lifelog_sn", F.col("b.measured_dt").alias("measured_at"), F.lit(c).alias("metric_code"),
                           F.col(f"b.{c}").cast("double").alias("metric_value")) for c in ("quantity", "extended_price")]
    cells = F.array(*[F.struct(F.lit(c).alias("metric_code"), F.col(c).cast("double").alias("metric_value")) for c in ("discount", "tax")])
    # both rates in one read of the known rows
    rates = known.select("user_lifelog_sn", F.col("measured_dt").alias("measured_at"), F.inline(cells)).distinct()
    expected = union_all([*amounts, rates]).where(F.col("metric_value").isNotNull())
    return multiset_differences(fact, expected, SIGNATURE)


def unattributed(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """DQ-19, DQ-28: rows whose key no parent has; a NULL key is such a row."""
    return rows.join(parents.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def precision_contradicted(milestones: DataFrame) -> DataFrame:
    """DQ-20: DATE milestones with a time, TIMESTAMP milestones without."""
    return milestones.where((F.col("temporal_precision") == "DATE") == F.col("occurred_at").isNotNull())


def unmapped_and_pinned(cohort: DataFrame, accounts: DataFrame, pinned: DataFrame) -> DataFrame:
    """DQ-23: users without an account that are not pinned, and pinned users that
    have one or are not in the cohort."""
    unmapped = cohort.select("user_id").join(accounts.select("user_id"), "user_id", "left_anti")
    sides = union_all([unmapped.select("user_id", F.lit(1).alias("a"), F.lit(0).alias("k")), pinned.select("user_id", F.lit(0).alias("a"), F.lit(1).alias("k"))])
    both = sides.groupBy("user_id").agg((F.max("a") > 0).alias("is_unmapped"), (F.max("k") > 0).alias("is_pinned"))
    return both.where(F.col("is_unmapped") != F.col("is_pinned"))


def state_contradictions(panel: DataFrame, channels: Sequence[P.ChannelSpec]) -> DataFrame:
    """DQ-24: (user, day, channel) whose state and value contradict each other. All
    channels come from one pass over the panel."""
    cells = F.array(*[F.struct(F.lit(c.code).alias("channel_code"), F.col(f"{c.code}_state").alias("state"),
                               F.col(c.value_col).cast("bigint").alias("value")) for c in channels])
    long = panel.select("user_id", "ymd_date", F.inline(cells))
    v, st = F.col("value"), F.col("state")
    # an active day of a channel that counts flagged items may hold the value 0
    return long.where(((st == P.OBSERVED_ACTIVITY) & v.isNull()) | ((st == P.OBSERVED_ZERO) & ~v.eqNullSafe(F.lit(0)))
                      | (~st.isin(P.OBSERVED_ACTIVITY, P.OBSERVED_ZERO) & v.isNotNull()))


def lost_activity(panel: DataFrame, facts: DataFrame, channels: Sequence[P.ChannelSpec]) -> DataFrame:
    """DQ-25: channels whose totals in the panel differ from those of the facts
    (channel_code, n)."""
    cells = F.array(*[F.struct(F.lit(c.code).alias("channel_code"), F.col(c.value_col).cast("bigint").alias("n")) for c in channels])
    legs = {"fact": facts.select("channel_code", "n"), "panel": panel.select(F.inline(cells))}
    found = reconcile(legs, ["channel_code"], {"total": ("count", {"fact": F.col("n"), "panel": F.col("n")})})
    return found.select("channel_code", F.col("total_fact").alias("fact_total"), F.col("total_panel").alias("panel_total"))


def pivot_differences(day: DataFrame, pivot: DataFrame, cohort: DataFrame, stream: str) -> DataFrame:
    """DQ-26: the cohort's days of a stream that the pivot holds otherwise."""
    own = day.where(F.col("stream_code") == stream).join(cohort.select("user_id"), "user_id", "left_semi")
    held = pivot.select("user_id", "ymd_date", F.col(f"{stream}_samples").alias("n_samples")).where(F.col("n_samples").isNotNull())
    return multiset_differences(own.select("user_id", F.col("wear_date").alias("ymd_date"), "n_samples"), held, ["user_id", "ymd_date", "n_samples"])


def multiplicity_totals(raw: DataFrame, collapsed: DataFrame, day: DataFrame, detail: DataFrame, cohort: DataFrame) -> DataFrame:
    """DQ-27: one row if raw samples, collapsed multiplicity and the days' samples
    differ in total, or the cohort's raw samples and the detail facts do."""
    theirs = raw.join(cohort.select(F.col("user_id").alias("user_lifelog_sn")), "user_lifelog_sn", "left_semi")
    one, times = F.lit(1), F.col("source_row_count")
    legs = {"raw": raw, "collapsed": collapsed, "day": day, "raw_cohort": theirs, "detail": detail}
    found = reconcile(legs, [], {"all": ("count", {"raw": one, "collapsed": times, "day": F.col("n_samples")}),
                                 "own": ("count", {"raw_cohort": one, "detail": times})})
    return found.select(F.col("all_raw").alias("raw_rows"), F.col("all_collapsed").alias("collapsed_rows"), F.col("all_day").alias("day_rows"),
                        F.coalesce("own_raw_cohort", F.lit(0)).alias("raw_cohort_rows"), F.col("own_detail").alias("detail_rows"))
