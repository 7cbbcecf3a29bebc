"""Landing runs: position, window, merge and control row of first, repeated,
empty and failed runs; buckets that a batch does not meet stay as they are."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from dayledger.operators import sinks as K
from dayledger.operators.partitioned import BucketedTable
from dayledger.sources.landing_run import FULL_REFRESH, KeyMissing, Landing, Target

AT = dt.datetime(2024, 3, 1)
D = dt.datetime
SCHEMA = "id long, who long, made timestamp_ntz, changed timestamp_ntz, v string"
KEYED = Target("shop", "public", "orders", watermark_col="changed", fallback_col="made", keys=("id",), buckets=8)
KEYLESS = Target("shop", "public", "log", watermark_col="made", lookback_days=2)
FULL = Target("shop", "public", "people", load_type=FULL_REFRESH)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def values(df):
    return sorted((r.id, r.v) for r in df.collect())


def control(landing):
    return {r.table_name: r for r in landing.control().collect()}


FIRST = [(1, 7, D(2024, 1, 1), None, "a"), (2, 7, D(2024, 1, 2), D(2024, 1, 9), "b"), (3, 8, None, None, "no position")]


def test_first_and_second_run(spark, tmp_path):
    run = Landing(spark, str(tmp_path))
    done = run.run(KEYED, frame(spark, FIRST), AT)
    assert (done.rows, done.position) == (3, D(2024, 1, 9))  # a first run takes rows without a position along
    later = [*FIRST, (1, 7, D(2024, 1, 1), D(2024, 1, 12), "a2"), (4, 9, D(2024, 1, 10), None, "d")]
    done = run.run(KEYED, frame(spark, later[1:]), AT + dt.timedelta(days=1))
    assert (done.rows, done.position) == (2, D(2024, 1, 12))
    assert values(run.table(KEYED)) == [(1, "a2"), (2, "b"), (3, "no position"), (4, "d")]
    assert control(run)["orders"].row_count == 2 and control(run)["orders"].last_status == "SUCCESS"
    again = run.run(KEYED, frame(spark, later[1:]), AT + dt.timedelta(days=2))
    assert (again.rows, again.position, again.folders) == (0, D(2024, 1, 12), 0)


def test_upper_bound_and_overlap(spark, tmp_path):
    run = Landing(spark, str(tmp_path))
    rows = [(i, 1, D(2024, 1, i), None, str(i)) for i in range(1, 11)]
    run.run(KEYED, frame(spark, rows), AT, upper=D(2024, 1, 5))
    assert len(values(run.table(KEYED))) == 5 and run.position(KEYED) == D(2024, 1, 5)
    done = run.run(KEYED, frame(spark, rows), AT, overlap=dt.timedelta(days=2), upper=D(2024, 1, 7))
    assert done.rows == 4 and len(values(run.table(KEYED))) == 7


def test_a_failed_run_keeps_the_position(spark, tmp_path):
    run = Landing(spark, str(tmp_path))
    run.run(KEYED, frame(spark, FIRST), AT)
    with pytest.raises(KeyMissing, match="1 of 1"):
        run.run(KEYED, frame(spark, [(None, 1, D(2024, 2, 1), None, "x")]), AT)
    row = control(run)["orders"]
    assert row.last_status == "FAILED" and "have no key" in row.last_error and row.row_count == 3
    assert run.position(KEYED) == D(2024, 1, 9)
    with pytest.raises(K.DuplicateKeyError):
        run.run(KEYED, frame(spark, [(5, 1, D(2024, 2, 1), None, "x"), (5, 1, D(2024, 2, 1), None, "y")]), AT)
    assert run.position(KEYED) == D(2024, 1, 9) and len(values(run.table(KEYED))) == 3
    assert run.run(KEYED, frame(spark, [(5, 1, D(2024, 2, 1), None, "x")]), AT).rows == 1
    assert control(run)["orders"].last_error is None


def test_a_first_run_that_fails_stays_a_first_run(spark, tmp_path):
    run = Landing(spark, str(tmp_path))
    bad = frame(spark, FIRST).withColumn("v", F.expr("raise_error('source gone')"))
    with pytest.raises(Exception, match="source gone"):
        run.run(KEYED, bad, AT)
    assert control(run)["orders"].last_status == "FAILED" and run.position(KEYED) is None
    assert run.run(KEYED, frame(spark, FIRST), AT).rows == 3


def test_keyless_window_is_replayed(spark, tmp_path):
    run = Landing(spark, str(tmp_path))
    rows = [(i, 1, D(2024, 1, i, 12), None, "old") for i in range(1, 11)] + [(0, 1, None, None, "no position")]
    run.run(KEYLESS, frame(spark, rows), AT)
    # the source lost a row inside the lookback, changed one and got a back-dated one
    fresh = [r for r in rows if r[0] != 10 and r[2]] + [(10, 1, D(2024, 1, 10, 12), None, "new"), (11, 1, D(2024, 1, 9, 12), None, "late")]
    for _ in range(2):
        run.run(KEYLESS, frame(spark, fresh), AT)
    assert values(run.table(KEYLESS)) == sorted([(i, "old") for i in range(1, 10)] + [(0, "no position"), (10, "new"), (11, "late")])


def test_full_refresh_and_empty_read(spark, tmp_path):
    run = Landing(spark, str(tmp_path))
    run.run(FULL, frame(spark, FIRST), AT)
    assert run.position(FULL) == AT
    run.run(FULL, frame(spark, FIRST[:1]), AT + dt.timedelta(days=1))
    assert values(run.table(FULL)) == [(1, "a")]
    run.run(FULL, frame(spark, []), AT + dt.timedelta(days=2))
    assert values(run.table(FULL)) == [(1, "a")] and run.position(FULL) == AT + dt.timedelta(days=2)
    empty = Target("shop", "public", "people", load_type=FULL_REFRESH, truncate_on_empty=True)
    run.run(empty, frame(spark, []), AT + dt.timedelta(days=3))
    assert run.table(empty) is None or values(run.table(empty)) == []


def test_cohort_exclusion_and_growth(spark, tmp_path):
    run = Landing(spark, str(tmp_path))
    target = Target("shop", "public", "orders", watermark_col="made", keys=("id",), exclude=("changed",), cohort_key="who")
    members = spark.createDataFrame([(7,), (None,)], "member long")
    run.run(target, frame(spark, FIRST), AT, members=members)
    assert values(run.table(target)) == [(1, "a"), (2, "b")] and "changed" not in run.table(target).columns
    grown = frame(spark, [(9, 7, D(2024, 2, 1), None, "z")]).withColumn("extra", F.lit(1))
    run.run(target, grown, AT, members=members)
    assert sorted((r.id, r.extra) for r in run.table(target).collect()) == [(1, None), (2, None), (9, 1)]
    with pytest.raises(ValueError, match="members"):
        run.run(target, grown, AT)


def test_one_broken_target_does_not_stop_the_others(spark, tmp_path):
    run = Landing(spark, str(tmp_path))
    good, bad = frame(spark, FIRST), frame(spark, [(None, 1, D(2024, 2, 1), None, "x")])
    done = run.run_all([(KEYED, bad), (FULL, good)], AT)
    assert [d.ok for d in done] == [False, True] and "have no key" in done[0].error
    with pytest.raises(KeyMissing):
        run.run_all([(KEYED, bad), (FULL, good)], AT, fail_fast=True)


def test_positions_do_not_depend_on_the_session_zone(spark, tmp_path):
    run = Landing(spark, str(tmp_path))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
    try:
        run.run(KEYED, frame(spark, FIRST), AT)
        assert run.position(KEYED) == D(2024, 1, 9)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert run.run(KEYED, frame(spark, FIRST), AT).rows == 0


def test_untouched_buckets_stay(spark, tmp_path):
    table = BucketedTable(spark, "t", ["id"], 16, str(tmp_path))
    rows = spark.range(200).selectExpr("id", "id * 2 as v")
    table.replace_all(rows)
    stamps = {f.path: [(n, os.stat(os.path.join(f.path, n)).st_mtime_ns) for n in sorted(os.listdir(f.path))] for f in table.folders()}
    new = table.upsert(spark.range(3, 5).selectExpr("id", "0L as v"))
    met = {f.value for f in new}
    assert 1 <= len(met) <= 2
    for f in table.folders():
        if f.value not in met:
            assert stamps[f.path] == [(n, os.stat(os.path.join(f.path, n)).st_mtime_ns) for n in sorted(os.listdir(f.path))]
    got = {r.id: r.v for r in table.read().collect()}
    assert got == {i: 0 if i in (3, 4) else 2 * i for i in range(200)}


def test_rows_of_keys_alone_are_added_beside(spark, tmp_path):
    table = BucketedTable(spark, "t", ["id", "who"], 4, str(tmp_path))
    pairs = spark.createDataFrame([(i, i % 3) for i in range(20)], "id long, who int")
    table.replace_all(pairs)
    before = {f.path for f in table.folders()}
    table.upsert(spark.createDataFrame([(1, 1), (100, 1)], "id long, who int"))
    assert before <= {f.path for f in table.folders()}
    assert table.read().count() == 21
