"""Late data in the streaming forms (STR-01..04): a row inside the watermark
updates its day, a row behind the watermark is dropped, a replay from the same
checkpoint does not double count."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dayledger import streaming as STR


def _write(spark, root, name, rows):
    """One arrival = one parquet file (naive microsecond timestamps)."""
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq
    cols = list(zip(*rows))
    table = pa.table({
        "event_id": pa.array(cols[0], pa.int64()), "ts": pa.array(cols[1], pa.timestamp("us")),
        "user_id": pa.array(cols[2], pa.int64()), "event_type": pa.array(cols[3], pa.string()),
        "value": pa.array(cols[4], pa.float64()), "props": pa.array(cols[5], pa.string())})
    os.makedirs(root, exist_ok=True)
    pq.write_table(table, f"{root}/{name}")


def _day(d, h=3):
    return dt.datetime(2024, 1, 1, h) + dt.timedelta(days=d)


def test_late_rows_inside_and_behind_the_watermark(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "run")
    _write(spark, src, "events-001.parquet",
           [(i, _day(i), 1, "view", 1.0, "{}") for i in range(0, 41)])   # days 0..40
    agg = STR.daily_local_aggregate(STR.table_stream(spark, src, "events", glob="events-*.parquet"))
    out = STR.run_available_now(agg, "late", base=base)
    first = {r.day_window.start.date(): r.n_samples for r in
             STR.latest_per_key(spark, out, ["day_window", "event_type"]).collect()}
    assert sum(first.values()) == 41
    # second arrival: day 35 is within 30 days of the max (day 40), day 1 is not
    _write(spark, src, "events-002.parquet",
           [(100, _day(35, 4), 1, "view", 1.0, "{}"), (101, _day(1, 4), 1, "view", 1.0, "{}")])
    agg = STR.daily_local_aggregate(STR.table_stream(spark, src, "events", glob="events-*.parquet"))
    STR.run_available_now(agg, "late", base=base)          # same checkpoint: resumes
    res = STR.latest_per_key(spark, out, ["day_window", "event_type"])
    got = {r.local_date: r.n_samples for r in res.select(
        F.to_date(F.convert_timezone(None, F.lit("Asia/Seoul"), F.col("day_window.start")))
        .alias("local_date"), "n_samples").collect()}
    assert got[dt.date(2024, 2, 5)] == 2          # day 35: updated by the late row
    assert got[dt.date(2024, 1, 2)] == 1          # day 1: the late row was behind the watermark
    assert sum(got.values()) == 42


def test_replay_does_not_double_count(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "run")
    _write(spark, src, "events-001.parquet",
           [(1, _day(0), 1, "view", 1.0, "{}"), (2, _day(0), 1, "view", 1.0, "{}"),
            (3, _day(0), 1, "click", 2.0, "{}")])
    payload = ["user_id", "ts", "event_type"]
    s = STR.table_stream(spark, src, "events", glob="events-*.parquet")
    out = STR.run_available_now(STR.payload_multiplicity(s, payload, "ts"), "mult", base=base)
    STR.run_available_now(STR.payload_multiplicity(
        STR.table_stream(spark, src, "events", glob="events-*.parquet"), payload, "ts"), "mult", base=base)
    got = sorted((r.event_type, r.source_row_count) for r in STR.latest_per_key(spark, out, payload).collect())
    assert got == [("click", 1), ("view", 2)]


def _daily(spark, src, per_trigger=None):
    agg = STR.daily_local_aggregate(STR.table_stream(spark, src, "events", per_trigger, glob="events-*.parquet"))
    return agg.select(F.col("day_window.start").alias("day"), "event_type", "n_samples", "value_sum")


def _held(table):
    return sorted(map(tuple, table.read().select("day", "event_type", "n_samples", "value_sum").collect()), key=str)


def test_a_killed_run_merges_every_batch_once(spark, tmp_path, monkeypatch):
    from dayledger.operators.partitioned import BucketedTable
    src = str(tmp_path / "src")
    for n in range(4):
        _write(spark, src, f"events-00{n}.parquet", [(10 * n + i, _day(i), 1, "view", 1.5, "{}") for i in range(n, n + 5)])
    keys = ["day", "event_type"]
    whole = _held(STR.run_into_table(_daily(spark, src, 1), keys, "daily", str(tmp_path / "one")))

    merge, calls = BucketedTable.upsert, []

    def dies(self, batch, **options):
        calls.append(options["note"])
        out = merge(self, batch, **options)
        if options["note"] == "1":
            raise RuntimeError("killed after the merge, before the checkpoint")
        return out

    monkeypatch.setattr(BucketedTable, "upsert", dies)
    try:
        STR.run_into_table(_daily(spark, src, 1), keys, "daily", str(tmp_path / "two"))
        raise AssertionError("the run was to die")
    except Exception as error:
        assert "killed after the merge" in str(error)
    monkeypatch.setattr(BucketedTable, "upsert", merge)
    table = STR.run_into_table(_daily(spark, src, 1), keys, "daily", str(tmp_path / "two"))
    assert calls == ["0", "1"] and table.notes() >= {"0", "1", "2", "3"}
    assert _held(table) == whole
    # reading costs the table: every bucket has one folder, however many batches came
    values = [f.value for f in table.folders()]
    assert len(values) == len(set(values))


def test_late_rows_are_counted_beyond_the_last_progress_records(spark, tmp_path):
    src, report = str(tmp_path / "src"), {}
    _write(spark, src, "events-000.parquet", [(i, _day(i), 1, "view", 1.0, "{}") for i in range(41)])
    STR.run_into_table(_daily(spark, src), ["day", "event_type"], "daily", str(tmp_path / "run"))
    _write(spark, src, "events-001.parquet", [(100, _day(1, 4), 1, "view", 1.0, "{}")])
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for n in range(3):
            _write(spark, src, f"events-01{n}.parquet", [(200 + n, _day(40 + n), 1, "view", 1.0, "{}")])
        STR.run_into_table(_daily(spark, src, 1), ["day", "event_type"], "daily", str(tmp_path / "run"), report=report)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    assert report["rows_behind_watermark"] == 1
