"""Registered queries of stored tables: landing runs, bucketed upserts and
date-partitioned window replaces, each on a fresh folder of its own."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions import timeutil as tu
from dayledger.operators import sinks as K
from dayledger.operators.partitioned import BucketedTable, PartitionedTable
from dayledger.plans import wearable as W
from dayledger.plans.registry import REGISTRY, register
from dayledger.session import scratch_path
from dayledger.sources.landing_run import FULL_REFRESH, KeyMissing, Landing, Target
from dayledger.sources.tables import read_table

EVENTS = Target("events", "public", "events", watermark_col="ts", keys=("event_id",), lookback_days=5, buckets=16)
#: A source without a key: the same stream by its position alone.
VALUES = Target("events", "public", "event_values", watermark_col="ts", lookback_days=5)
CUSTOMERS = Target("crm", "public", "customer", load_type=FULL_REFRESH)
FIRST_END, FIRST_AT, NEXT_AT = dt.datetime(2024, 1, 20), dt.datetime(2024, 1, 21), dt.datetime(2024, 2, 1)


def _fresh(spark: SparkSession) -> str:
    return scratch_path(spark, "runs", uuid.uuid4().hex[:16])


def _sources(spark: SparkSession, sf: str) -> list[tuple[Target, DataFrame]]:
    return [(EVENTS, read_table(spark, sf, "events")),
            (VALUES, read_table(spark, sf, "events", ["ts", "user_id", "event_type", "value"])),
            (CUSTOMERS, read_table(spark, sf, "customer"))]


def _first_run(spark: SparkSession, sf: str) -> Landing:
    run = Landing(spark, _fresh(spark))
    for target, source in _sources(spark, sf):
        run.run(target, source, FIRST_AT, upper=FIRST_END)
    return run


def _told(run: Landing, targets) -> DataFrame:
    """The control rows beside the rows that the landed tables hold."""
    held = None
    for t in targets:
        landed = run.table(t)
        n = landed.agg(F.count(F.lit(1)).alias("landed_rows")) if landed is not None else run.spark.range(1).select(F.lit(0).cast("bigint").alias("landed_rows"))
        one = n.select(F.lit(t.table_name).alias("table_name"), "landed_rows")
        held = one if held is None else held.unionByName(one)
    return run.control().join(held, "table_name").select(
        "table_name", tu.instant_to_naive("watermark_value").alias("watermark_value"), "last_status", "last_error", "row_count", "landed_rows",
        tu.instant_to_naive("updated_at").alias("updated_at"))


_FIRST = """first_run AS (
  SELECT t.table_name, MAX(e.ts) AS watermark_value, COUNT(*) AS row_count, COUNT(*) AS landed_rows
  FROM events e, (VALUES ('events'), ('event_values')) t(table_name)
  WHERE e.ts <= TIMESTAMP '2024-01-20' GROUP BY 1
  UNION ALL SELECT 'customer', TIMESTAMP '2024-01-21', COUNT(*), COUNT(*) FROM customer)"""


@register("src03_landing_first_run", f"""WITH {_FIRST}
SELECT table_name, watermark_value, 'SUCCESS' AS last_status, CAST(NULL AS VARCHAR) AS last_error, row_count, landed_rows,
       TIMESTAMP '2024-01-21' AS updated_at FROM first_run""")
def _first(spark, sf):
    """SRC-01/03/06/13, SNK-09/10: a first run of three targets up to a bound:
    positions and counts are observed by the job that writes the batch."""
    return _told(_first_run(spark, sf), [t for t, _ in _sources(spark, sf)])


@register("src05_landing_repeated_run", f"""WITH {_FIRST}
SELECT f.table_name, CASE f.table_name WHEN 'customer' THEN TIMESTAMP '2024-02-01' ELSE (SELECT MAX(ts) FROM events) END AS watermark_value,
       'SUCCESS' AS last_status, CAST(NULL AS VARCHAR) AS last_error,
       CASE f.table_name WHEN 'customer' THEN f.row_count
            ELSE (SELECT COUNT(*) FROM events WHERE ts > f.watermark_value - INTERVAL 5 DAY) END AS row_count,
       CASE f.table_name WHEN 'customer' THEN f.row_count ELSE (SELECT COUNT(*) FROM events) END AS landed_rows,
       TIMESTAMP '2024-02-01' AS updated_at FROM first_run f""")
def _repeated(spark, sf):
    """SRC-02/04/05, SNK-02/04: the next run reads from the stored position less
    the lookback; the re-read rows replace their copies, keyed or not."""
    run = _first_run(spark, sf)
    for target, source in _sources(spark, sf):
        run.run(target, source, NEXT_AT)
    return _told(run, [t for t, _ in _sources(spark, sf)])


@register("src06_landed_events", "SELECT * FROM events")
def _landed(spark, sf):
    """SRC-02 / SNK-02: what two runs landed into the bucketed table is the source."""
    run = Landing(spark, _fresh(spark))
    source = read_table(spark, sf, "events")
    run.run(EVENTS, source, FIRST_AT, upper=FIRST_END)
    run.run(EVENTS, source, NEXT_AT, overlap=dt.timedelta(days=7))
    return run.table(EVENTS).drop(K.LOADED_AT)


@register("snk10_landing_failed_run", f"""WITH {_FIRST}, lost AS (
  SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE event_type = 'error') AS bad FROM events
  WHERE ts > (SELECT watermark_value FROM first_run WHERE table_name = 'events') - INTERVAL 5 DAY)
SELECT table_name, watermark_value, 'FAILED' AS last_status,
       'KeyMissing: events.public.events: ' || bad || ' of ' || n || ' rows have no key' AS last_error, row_count, landed_rows,
       TIMESTAMP '2024-02-01' AS updated_at FROM first_run, lost WHERE table_name = 'events'""")
def _failed(spark, sf):
    """SNK-11: a run whose batch lacks keys fails; position, count and landed rows
    stay, the error is told."""
    run = Landing(spark, _fresh(spark))
    source = read_table(spark, sf, "events")
    run.run(EVENTS, source, FIRST_AT, upper=FIRST_END)
    broken = source.withColumn("event_id", F.when(F.col("event_type") != "error", F.col("event_id")))
    try:
        run.run(EVENTS, broken, NEXT_AT)
    except KeyMissing:
        return _told(run, [EVENTS])
    raise AssertionError("a batch without keys landed")


@register("snk02_bucketed_upsert", REGISTRY["snk02_upsert"].sql)
def _bucketed(spark, sf):
    """SNK-02 on a stored table: only the buckets that the batch meets are read and written."""
    e = read_table(spark, sf, "events")
    table = BucketedTable(spark, "events", ["event_id"], 16, _fresh(spark))
    table.replace_all(K.stamp_loaded(e.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")), dt.datetime(2024, 2, 1)))
    batch = K.stamp_loaded(e.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")).withColumn("value", F.col("value") * 2),
                           dt.datetime(2024, 2, 2))
    table.upsert(batch)
    return table.read().withColumn(K.LOADED_AT, tu.instant_to_naive(K.LOADED_AT))


@register("snk03_bucketed_insert_if_absent", REGISTRY["snk03_insert_if_absent"].sql)
def _absent(spark, sf):
    """SNK-03 on a stored table: absent keys come as new folders beside the old ones."""
    e = read_table(spark, sf, "events", ["user_id", "event_type", "ts"])
    cut = F.lit("2024-01-10").cast("timestamp_ntz")
    table = BucketedTable(spark, "pairs", ["user_id", "event_type"], 8, _fresh(spark))
    table.replace_all(e.where(F.col("ts") < cut).select("user_id", "event_type").distinct())
    table.upsert(e.where(F.col("ts") >= cut).select("user_id", "event_type").distinct(), check_batch=False)
    return table.read()


@register("snk05_partitioned_window_replace", REGISTRY["snk05_window_replace"].sql)
def _window(spark, sf):
    """SNK-05 / SNK-12 on a stored table: the replace writes the window's days and
    names all other folders."""
    table = PartitionedTable(spark, "wearable_day", "wear_date", _fresh(spark))
    table.replace_all(W.wearable_day(spark, sf, before="2024-01-25"))

    def since(cut):
        earliest = dt.datetime.combine(cut, dt.time()) - dt.timedelta(days=1)
        return W.wearable_day(spark, sf, since=earliest).where(F.col("wear_date") >= F.lit(cut))

    table.replace_window(since, "wear_date", 7)
    return table.read()
