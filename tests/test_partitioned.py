"""Date-partitioned tables: a window replace writes the days of its window and
names all other folders as they are."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from dayledger.operators import sinks as K
from dayledger.operators.partitioned import PartitionedTable

SCHEMA = "id long, day date, at timestamp_ntz, v double"


def _rows(days, tag=0.0, start=0):
    first = dt.date(2024, 1, 1)
    return [(start + i, first + dt.timedelta(days=d), dt.datetime(2024, 1, 1, 6) + dt.timedelta(days=d), tag + d) for i, d in enumerate(days)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _sorted(df):
    return sorted(map(tuple, df.select("id", "day", "at", "v").collect()), key=str)


def _stamps(table):
    """Files of the current table with their sizes and change times."""
    return {p: [(f, os.stat(os.path.join(p, f)).st_mtime_ns) for f in sorted(os.listdir(p))] for p in (x.path for x in table.folders())}


def test_first_commit_and_window_replace(spark, tmp_path):
    t = PartitionedTable(spark, "facts", "day", str(tmp_path))
    assert t.read() is None and t.folders() is None
    t.replace_all(_frame(spark, _rows(range(30))))
    before = _stamps(t)
    fresh = _frame(spark, _rows(range(20, 34), 100.0, 500))
    new = t.replace_window(lambda at: fresh if at is None else fresh.where(F.col("day") >= at), "day", 7)
    assert sorted(f.value for f in new) == [f"2024-01-{d:02d}" for d in range(23, 32)] + ["2024-02-01", "2024-02-02", "2024-02-03"]
    after = _stamps(t)
    kept = [p for p in after if p in before]
    assert len(kept) == 22 and all(after[p] == before[p] for p in kept)
    old = _frame(spark, _rows(range(30)))
    whole = K.window_replace(old, fresh, "day", 7, restrict_batch=True)
    assert _sorted(t.read()) == _sorted(whole)


def test_cutoff_inside_a_day_moves_its_earlier_rows(spark, tmp_path):
    t = PartitionedTable(spark, "facts", "day", str(tmp_path))
    day = [(i, dt.date(2024, 1, d), dt.datetime(2024, 1, d, h), 1.0) for i, (d, h) in enumerate([(1, 5), (8, 3), (8, 20), (9, 1), (15, 12)])]
    t.replace_all(_frame(spark, day))
    fresh = _frame(spark, [(10, dt.date(2024, 1, 8), dt.datetime(2024, 1, 8, 21), 2.0), (11, dt.date(2024, 1, 15), dt.datetime(2024, 1, 15, 12), 2.0)])
    t.replace_window(lambda at: fresh.where(F.col("at") >= at), "at", 7, day_of=lambda c: c.date())
    assert [r[0] for r in _sorted(t.read())] == [0, 1, 10, 11]


def test_null_values_stay_and_old_days_are_added_to(spark, tmp_path):
    t = PartitionedTable(spark, "facts", "day", str(tmp_path))
    t.replace_all(_frame(spark, [*_rows(range(10)), (90, None, None, 0.0)]))
    late = _frame(spark, [(50, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2), 5.0), (51, dt.date(2024, 1, 10), dt.datetime(2024, 1, 10), 5.0), (91, None, None, 1.0)])
    t.replace_window(lambda at: late, "day", 2)
    got = {r[0] for r in _sorted(t.read())}
    assert got == {*range(7), 50, 51, 90, 91}
    assert sum(f.value == "2024-01-02" for f in t.folders()) == 2


def test_empty_batch_and_vanished_rows(spark, tmp_path):
    t = PartitionedTable(spark, "facts", "day", str(tmp_path))
    t.replace_all(_frame(spark, _rows(range(10))))
    none = _frame(spark, [])
    t.replace_window(lambda at: none, "day", 2)
    assert [r[0] for r in _sorted(t.read())] == list(range(7))
    assert PartitionedTable(spark, "none", "day", str(tmp_path)).replace_window(lambda at: none, "day", 2) == []


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    t = PartitionedTable(spark, "facts", "day", str(tmp_path))
    t.replace_all(_frame(spark, _rows(range(5))))
    bad = _frame(spark, _rows(range(5))).withColumn("v", F.expr("raise_error('no')").cast("double"))
    with pytest.raises(Exception, match="no"):
        t.replace_window(lambda at: bad, "day", 3)
    assert len(_sorted(t.read())) == 5


def test_scan_is_pruned_by_the_date(spark, tmp_path):
    t = PartitionedTable(spark, "facts", "day", str(tmp_path))
    t.replace_all(_frame(spark, _rows(range(10))))
    plan = t.read().where("day = DATE '2024-01-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_retention_is_explicit(spark, tmp_path):
    t = PartitionedTable(spark, "facts", "day", str(tmp_path))
    t.replace_all(_frame(spark, _rows(range(10))))
    for _ in range(3):
        t.replace_window(lambda at: _frame(spark, _rows(range(8, 10), 1.0)), "day", 1)
    held = sum(len(os.listdir(tmp_path / "facts" / "data" / c)) for c in os.listdir(tmp_path / "facts" / "data"))
    before = _sorted(t.read())
    gone = t.expire(1)
    assert gone > 0 and _sorted(t.read()) == before
    assert sum(len([x for x in os.listdir(tmp_path / "facts" / "data" / c) if "=" in x]) for c in os.listdir(tmp_path / "facts" / "data")) == 10 < held
    with pytest.raises(ValueError, match="retained"):
        t.expire(0)


def test_columns_added_later_are_null_before(spark, tmp_path):
    t = PartitionedTable(spark, "facts", "day", str(tmp_path))
    t.replace_all(_frame(spark, _rows(range(5))))
    wide = _frame(spark, _rows(range(3, 6), 9.0)).withColumn("note", F.lit("x"))
    t.replace_window(lambda at: wide.where(F.col("day") >= at), "day", 1)
    assert sorted((r.day.day, r.note) for r in t.read().collect()) == [(1, None), (2, None), (3, None), (4, "x"), (5, "x"), (6, "x")]
