"""Build the warehouse in dependency order, materialising the shared expensive
models and gating the build on reconciliation checks (SURVEY §3.2, §4).

Only four models are written (the rest stay lazy views over them):
DIM-06 (full refresh each run), INT-01 and INT-02 (window replace on event
time after the first run: date-partitioned tables whose commits write the days
of the window and name all others) and PNL-01 (full rebuild, partitioned by month).
Each write is a new directory under ``spark.checkpoint.dir`` plus a pointer row,
so a failed build leaves the previous tables readable and a re-run is
idempotent. Old commits are kept unless ``retain`` says how many.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions import timeutil as tu
from dayledger.operators import quality as Q
from dayledger.operators import sinks as K
from dayledger.operators.partitioned import PartitionedTable
from dayledger.operators.setops import symmetric_difference
from dayledger.plans import panel as P
from dayledger.plans import wearable as W
from dayledger.plans.dims import dim_user, pin_dim_user


@dataclass
class BuildReport:
    tables: dict[str, str] = field(default_factory=dict)      # name -> snapshot path
    modes: dict[str, str] = field(default_factory=dict)       # name -> full / incremental
    checks: dict[str, int] = field(default_factory=dict)      # check -> violating rows
    written: dict[str, list[str]] = field(default_factory=dict)   # name -> dates written


#: The date-partitioned tables and their partition columns.
PARTITIONED = {"int01_collapsed": "measured_day", "int02_wearable_day": "wear_date"}


def partitioned(spark: SparkSession, name: str, base: str | None = None) -> PartitionedTable:
    """The table ``name`` of a build."""
    return PartitionedTable(spark, name, PARTITIONED[name], base)


def _collapsed_since(spark: SparkSession, sf: str, cut) -> DataFrame:
    """INT-01 from the cutoff's event time on; the bound reaches the scan."""
    raw = W.raw_samples(spark, sf, W.WEIGHTED_STREAM, since=cut)
    return W.collapse_samples(raw).withColumn("measured_day", F.to_date("measured_at"))


def _day_since(spark: SparkSession, sf: str, cut) -> DataFrame:
    """INT-02 from the cutoff's local date on. A local date >= cut means UTC event
    time >= cut - 1 day: a superset bound on the raw column that the scan can
    prune on; the exact filter follows."""
    if cut is None:
        return W.wearable_day(spark, sf)
    since = dt.datetime.combine(cut, dt.time()) - dt.timedelta(days=1)
    return W.wearable_day(spark, sf, since=since).where(F.col("wear_date") >= F.lit(cut))


def build(spark: SparkSession, sf: str, base: str | None = None, lookback_days: int = 30,
          incremental: bool = True, enforce_checks: bool = True, gates: bool = True,
          retain: int | None = None) -> BuildReport:
    """Materialise DIM-06, INT-01, INT-02, PNL-01 and (``gates``) run the gates;
    the gates recompute full models to compare, so they cost a full rebuild.
    ``retain``: commits of the partitioned tables that stay readable."""
    rep = BuildReport()

    def commit(name: str, df: DataFrame, mode: str, partition_by=()) -> DataFrame:
        path = K.commit_snapshot(df, name, base, partition_by)
        rep.tables[name], rep.modes[name] = path, mode
        return spark.read.parquet(path)

    pin_dim_user(spark, sf, None)                 # always rebuilt from the sources
    try:
        return _build(spark, sf, commit, rep, base, lookback_days, incremental, enforce_checks, gates, retain)
    finally:
        pin_dim_user(spark, sf, None)             # also after a failed build


def _build(spark, sf, commit, rep: BuildReport, base, lookback_days, incremental, enforce_checks, gates, retain) -> BuildReport:
    dim = commit("dim_user", dim_user(spark, sf), "full")
    Q.require_rows(dim, "dim_user")
    # Every later model of this build reads the snapshot, not the raw events.
    pin_dim_user(spark, sf, dim)

    def window(name: str, since, column: str, day_of=None) -> DataFrame:
        table = partitioned(spark, name, base)
        rep.modes[name] = "incremental" if incremental and table.folders() else "full"
        if rep.modes[name] == "full":
            new = table.replace_all(since(spark, sf, None), retain)
        else:
            new = table.replace_window(lambda cut: since(spark, sf, cut), column, lookback_days, day_of, retain)
        rep.tables[name], rep.written[name] = table.root, sorted({f.value for f in new if f.value})
        return table.read()

    int01 = window("int01_collapsed", _collapsed_since, "measured_at", lambda cut: cut.date())
    int02 = window("int02_wearable_day", _day_since, "wear_date")

    panel = P.user_day(spark, sf).withColumn("panel_month", tu.trunc_date("month", "ymd_date"))
    panel = commit("pnl01_user_day", panel, "full", ["panel_month"])
    Q.require_rows(panel, "pnl01_user_day")

    if not gates:
        return rep
    # Gates: incremental snapshots equal a full rebuild; panel states agree
    # with values.
    checks = {
        "int01_equals_full": symmetric_difference(int01.drop("measured_day"), W.collapsed_stream(spark, sf)),
        "int02_equals_full": symmetric_difference(int02, W.wearable_day(spark, sf).select(*int02.columns)),
        "panel_states_match_values": _state_violations(panel),
    }
    for name, violations in checks.items():
        rep.checks[name] = violations.count()
        if rep.checks[name] and enforce_checks:
            Q.enforce(violations, name, "error")
    return rep


def _state_violations(panel: DataFrame) -> DataFrame:
    bad = None
    for c in P.CHANNELS:
        st, v = F.col(f"{c.code}_state"), F.col(c.value_col)
        b = (((st == P.OBSERVED_ACTIVITY) & v.isNull())
             | ((st == P.OBSERVED_ZERO) & (v.isNull() | (v != 0)))
             | (st.isin(P.NOT_LOADED, P.NOT_YET_ELIGIBLE, P.ELIGIBILITY_UNKNOWN) & v.isNotNull()))
        bad = b if bad is None else bad | b
    return panel.where(bad)

