"""Generic operators: landing reads, sinks, control table, staging, set ops,
quality and privacy (SURVEY §2.1-2.7, §2.14-2.15). Replay tests follow the
reference's strategy: run twice -> same table; failures keep the position."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dayledger.operators import privacy as PV
from dayledger.operators import quality as Q
from dayledger.operators import sinks as K
from dayledger.operators import staging as S
from dayledger.operators import watermarks as WM
from dayledger.operators.setops import symmetric_difference
from dayledger.sources import landing as L
from dayledger.sources.seeds import date_spine

T0 = dt.datetime(2024, 1, 1)


def _key(t):
    return tuple((v is not None, v if v is not None else 0) for v in t)


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


@pytest.fixture()
def demo(spark):
    """Synthetic landing fixture: key, JSON payload, status, update / create."""
    data = [
        (1, '{"a": 1}', "ACTIVE", T0 + dt.timedelta(days=1), T0),
        (2, '{"a": 2}', "ACTIVE", None, T0 + dt.timedelta(days=2)),      # fallback column
        (3, '{"a": 3}', "DORMANT", T0 + dt.timedelta(days=5), T0),
        (4, '{"a": 4}', "ACTIVE", None, None),                           # NULL watermark
    ]
    return spark.createDataFrame(data, "user_no int, payload string, status_cd string, "
                                       "update_datetime timestamp, create_datetime timestamp")


def test_first_run_has_no_predicate_and_keeps_null_watermark_rows(demo):
    expr = L.watermark_expr("update_datetime", "create_datetime")
    win = L.plan_window(None, expr)
    assert win.predicate is None and win.is_full_read
    assert L.read_incremental(demo, win).count() == 4


def test_incremental_window_is_strict_below_inclusive_above(demo):
    expr = L.watermark_expr("update_datetime", "create_datetime")
    win = L.plan_window(T0 + dt.timedelta(days=1), expr, upper_bound=T0 + dt.timedelta(days=5))
    got = rows(L.read_incremental(demo, win), "user_no")
    assert got == [(2,), (3,)]          # day 1 excluded (strict), day 5 included, NULL never


def test_lookback_is_never_narrowed_by_overlap():
    assert L.lookback(dt.timedelta(minutes=5), 30) == dt.timedelta(days=30)
    assert L.lookback(dt.timedelta(days=40), 30) == dt.timedelta(days=40)
    assert L.lookback(dt.timedelta(minutes=5), None) == dt.timedelta(minutes=5)


def test_exclude_columns_guards(demo):
    assert L.exclude_columns(demo, ["payload"], keys=["user_no"]).columns == [
        "user_no", "status_cd", "update_datetime", "create_datetime"]
    with pytest.raises(ValueError):
        L.exclude_columns(demo, ["nope"])
    with pytest.raises(ValueError):
        L.exclude_columns(demo, ["user_no"], keys=["user_no"])
    with pytest.raises(ValueError):
        L.exclude_columns(demo, ["update_datetime"], protected=["update_datetime"])
    with pytest.raises(ValueError):
        L.exclude_columns(demo.select("user_no"), ["user_no"])


def test_cohort_filter_semi_join(spark, demo):
    members = spark.createDataFrame([(1,), (3,), (None,)], "user_no int")
    assert rows(L.cohort_filter(demo, members, "user_no"), "user_no") == [(1,), (3,)]


def test_landing_types():
    from pyspark.sql import types as T
    assert L.landing_type("numeric(12,2)") == T.DecimalType(12, 2)
    assert L.landing_type("numeric") == T.DecimalType(38, 10)
    assert L.landing_type("status_type") == T.StringType()          # enum -> text
    assert L.landing_type("integer[]") == T.ArrayType(T.IntegerType())
    assert L.landing_type("mood[]") == T.ArrayType(T.StringType())
    assert L.landing_type("timestamp without time zone") == T.TimestampNTZType()


def test_stamp_loaded_refuses_collision(demo):
    stamped = K.stamp_loaded(demo, T0)
    with pytest.raises(ValueError):
        K.stamp_loaded(stamped, T0)


def test_upsert_replaces_and_is_idempotent(spark, demo):
    target = K.stamp_loaded(demo, T0)
    batch = K.stamp_loaded(spark.createDataFrame(
        [(3, '{"a": 30}', "ACTIVE", T0 + dt.timedelta(days=6), T0),
         (5, '{"a": 5}', "ACTIVE", T0 + dt.timedelta(days=6), T0)], demo.schema), T0 + dt.timedelta(days=9))
    once = K.upsert(target, batch, ["user_no"])
    twice = K.upsert(once, batch, ["user_no"])
    assert rows(once) == rows(twice)
    got = {r.user_no: r.payload for r in once.collect()}
    assert got == {1: '{"a": 1}', 2: '{"a": 2}', 3: '{"a": 30}', 4: '{"a": 4}', 5: '{"a": 5}'}


def test_upsert_rejects_a_key_met_twice(spark, demo):
    dup = demo.unionByName(demo.where("user_no = 1"))
    with pytest.raises(K.DuplicateKeyError):
        K.upsert(demo, dup, ["user_no"])


def test_all_key_columns_insert_only_if_absent(spark):
    t = K.stamp_loaded(spark.createDataFrame([(1, "a")], "k int, v string"), T0)
    b = K.stamp_loaded(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"),
                       T0 + dt.timedelta(days=1))
    out = K.upsert(t, b, ["k", "v"])
    got = {(r.k, r.v): r._loaded_at for r in out.collect()}
    assert got[(1, "a")] == T0 and (2, "b") in got and len(got) == 2


def test_replace_window_is_idempotent_and_keeps_null_predicate_rows(demo):
    expr = L.watermark_expr("update_datetime")
    win = L.plan_window(T0, expr, upper_bound=T0 + dt.timedelta(days=5))
    batch = L.read_incremental(demo, win)
    once = K.replace_window(demo, batch, win.predicate)
    twice = K.replace_window(once, batch, win.predicate)
    assert rows(once) == rows(twice) == rows(demo)
    assert K.replace_window(demo, batch, None).count() == batch.count()   # full read truncates


def test_window_replace_drops_vanished_rows_and_keeps_old_ones(spark):
    schema = "d date, k string, v int"
    target = spark.createDataFrame([(dt.date(2024, 1, 1), "a", 1), (dt.date(2024, 1, 20), "b", 2),
                                    (dt.date(2024, 1, 25), "c", 3), (None, "n", 0)], schema)
    fresh = spark.createDataFrame([(dt.date(2024, 1, 20), "b", 20), (dt.date(2024, 1, 26), "d", 4),
                                   (dt.date(2024, 1, 2), "old", 9)], schema)
    out = K.window_replace(target, fresh, "d", days=10)   # cutoff = 2024-01-15; the whole batch comes in
    assert rows(out, "k", "v") == [("a", 1), ("b", 20), ("d", 4), ("n", 0), ("old", 9)]
    out = K.window_replace(target, fresh, "d", days=10, restrict_batch=True)
    assert rows(out, "k", "v") == [("a", 1), ("b", 20), ("d", 4), ("n", 0)]
    empty = spark.createDataFrame([], schema)
    boot = K.window_replace(empty, fresh, "d", days=10)   # cutoff from the batch minimum
    assert rows(boot, "k") == [("b",), ("d",), ("old",)]


def test_full_refresh_empty_guard(spark, demo):
    empty = demo.limit(0)
    assert K.full_refresh(demo, empty).count() == 4
    assert K.full_refresh(demo, empty, truncate_on_empty=True).count() == 0


def test_evolve_adds_and_keeps_dropped(spark):
    t = spark.createDataFrame([(1, "x")], "k int, old string")
    b = spark.createDataFrame([(2, 5)], "k int, new int")
    out, added, dropped = K.evolve(t, b)
    assert added == ["new"] and dropped == ["old"]
    assert sorted(out.columns) == ["k", "new", "old"]


def test_next_watermark_rules():
    now = dt.datetime(2024, 2, 1)
    assert K.next_watermark("FULL_REFRESH", T0, None, now) == now
    assert K.next_watermark("INCREMENTAL", T0, T0 + dt.timedelta(days=1), now) == T0 + dt.timedelta(days=1)
    assert K.next_watermark("INCREMENTAL", None, None, now) == now     # anchor on source clock
    assert K.next_watermark("INCREMENTAL", T0, None, now) is None      # nothing new


def test_control_table_failure_keeps_position(spark):
    tgt = ("src", "public", "t")
    ctl = WM.empty_control(spark)
    ctl = WM.record_failure(ctl, tgt, "boom", T0)                      # first run fails
    r = ctl.first()
    assert r.watermark_value is None and r.last_status == "FAILED"
    assert WM.last_watermark(ctl, tgt) is None
    ctl = WM.record_success(ctl, tgt, T0 + dt.timedelta(days=1), 10, T0 + dt.timedelta(days=1))
    ctl = WM.record_failure(ctl, tgt, "again", T0 + dt.timedelta(days=2))
    r = ctl.first()
    assert r.last_status == "FAILED" and r.last_error == "again" and r.row_count == 10
    assert r.updated_at == T0 + dt.timedelta(days=2)
    assert WM.last_watermark(ctl, tgt) == T0 + dt.timedelta(days=1)   # status ignored
    assert ctl.count() == 1


def test_commit_snapshot_and_read_current(spark, tmp_path):
    base = str(tmp_path / "tables")
    df1 = spark.createDataFrame([(1,)], "x int")
    df2 = spark.createDataFrame([(2,), (3,)], "x int")
    assert K.current_snapshot(spark, "t", base) is None
    K.commit_snapshot(df1, "t", base)
    K.commit_snapshot(df2, "t", base)
    assert rows(K.current_snapshot(spark, "t", base)) == [(2,), (3,)]


def test_last_row_wins_puts_null_time_first_like_descending_sort(spark):
    df = spark.createDataFrame([("u", "d", T0, 1), ("u", "d", T0 + dt.timedelta(hours=1), 2),
                                ("u", "e", T0, 3), ("u", "e", None, 4)],
                               "user string, day string, ts timestamp, id int")
    got = rows(S.last_row_wins(df, ["user", "day"], "ts", ["id"]), "day", "id")
    assert got == [("d", 2), ("e", 4)]


def test_pick_first_plans_a_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    out = S.pick_first(df, ["g"], [F.col("id").desc()])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert rows(out, "g", "id") == [(0, 99), (1, 97), (2, 98)]


def test_distinct_on_desc_nulls_last(spark):
    df = spark.createDataFrame([(1, 70.0, None), (1, 70.0, None), (1, None, 180.0), (1, 71.0, 170.0)],
                               "k int, w double, h double")
    got = S.distinct_on(df, ["k"], [F.col("w").desc_nulls_last(), F.col("h").desc_nulls_last()])
    assert rows(got) == [(1, 71.0, 170.0)]


def test_collapse_duplicates_keeps_multiplicity_and_groups_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (1, 5), (2, 5)], "a int, b int")
    got = rows(S.collapse_duplicates(df, ["a", "b"], "n", key_col="sk"), "a", "b", "n")
    assert got == [(1, None, 3), (1, 5, 1), (2, 5, 1)]


def test_unpivot_and_glucose_rule(spark):
    df = spark.createDataFrame([(1, 120.0, None, 6.9), (2, None, None, 68.0)], "sn int, sys double, dia double, g double")
    tall = S.unpivot_readings(df, ["sn"], [("sys", "sys", "mmHg"), ("dia", "dia", "mmHg")])
    assert rows(tall, "sn", "metric_code") == [(1, "sys")]
    g = rows(df.select("sn", S.normalise_glucose(F.col("g")).cast("double").alias("v")), "sn", "v")
    assert g == [(1, 124.3), (2, 68.0)]


def test_translate_key_filter_inside_right_side(spark):
    logs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "user_no int, x string")
    mapper = spark.createDataFrame([(1, "u1", "LOOP"), (2, "u2", "OTHER")], "user_no int, uid string, code string")
    out = S.translate_key(logs, mapper, "user_no", {"uid": "user_id"}, F.col("code") == "LOOP")
    assert rows(out, "user_no", "user_id") == [(1, "u1"), (2, None), (3, None)]


def test_soft_delete_rules(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "k int, d boolean")
    assert rows(df.where(S.keep_unless_deleted("d")), "k") == [(2,), (3,)]
    assert rows(df.where(S.keep_if_not_deleted("d")), "k") == [(2,)]


def test_symmetric_difference_counts_multiplicity(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (3,)], "x int")
    assert rows(symmetric_difference(a, b, "side"), "x", "side") == [(1, "left"), (2, "left"), (3, "right")]
    assert symmetric_difference(a, a).count() == 0


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", 5, '{"k": 1, "x": 2}'), (1, None, 50, '{"k": 2}'),
                                (2, "z", None, '[1]')], "id int, c string, v int, p string")
    parent = spark.createDataFrame([(1,)], "id int")
    assert Q.not_null(df, "c").count() == 1
    assert rows(Q.unique(df, "id")) == [(1, 2)]
    assert rows(Q.accepted_values(df, "c", ["a"]), "c") == [("z",)]
    assert rows(Q.relationships(df, "id", parent, "id"), "id") == [(2,)]
    assert rows(Q.accepted_range(df, "v", 0, 10), "v") == [(50,)]
    assert rows(Q.expression_is_true(df, "v < 10"), "v") == [(50,)]          # NULL passes
    assert Q.null_rate_below(df, "c", 0.5).count() == 0
    assert Q.null_rate_below(df, "c", 0.3).count() == 1
    assert rows(Q.json_key_drift(df, "p", ["k"])) == [("x", 1)]
    fresh = Q.freshness(spark.createDataFrame([(T0,)], "l timestamp"), "l", T0 + dt.timedelta(hours=30),
                        warn_after_hours=24, error_after_hours=48)
    assert fresh.first().severity == "warn"
    with pytest.raises(Q.CheckFailed):
        Q.enforce(Q.unique(df, "id"), "unique id")
    with pytest.raises(Q.CheckFailed):
        Q.require_rows(df.limit(0), "empty")


def test_privacy_jobs(spark):
    df = spark.createDataFrame([(1, "n", '{"user_name": "x", "k": {"a": 1}}')], "id int, name string, p string")
    out = PV.drop_identifiers(df, ["name", "phone"])
    assert out.columns == ["id", "p"]
    assert PV.prohibited_columns_present(df, ["NAME"]) == ["name"]
    import json
    stripped = PV.strip_payload_keys(df, "p", ["user_name"]).first().p
    assert json.loads(stripped) == {"k": {"a": 1}}


def test_date_spine(spark):
    assert date_spine(spark, "2024-01-30", "2024-02-02").count() == 4
    assert date_spine(spark, "2024-02-02", "2024-01-30").count() == 0


def test_read_seed_keeps_declared_types(spark, tmp_path):
    from pyspark.sql import types as T

    from dayledger.sources.seeds import read_seed
    p = tmp_path / "catalogue.csv"
    p.write_text('disease_id,label,active\nD01,"",true\nD02,,false\n')
    schema = T.StructType([T.StructField("disease_id", T.StringType()), T.StructField("label", T.StringType()),
                           T.StructField("active", T.BooleanType())])
    got = {r.disease_id: (r.label, r.active) for r in read_seed(spark, str(p), schema).collect()}
    assert got == {"D01": (None, True), "D02": (None, False)}   # CSV: empty field is NULL
    bad = tmp_path / "bad.csv"
    bad.write_text("disease_id,label,active\nD03,x,maybe\n")
    with pytest.raises(Exception):
        read_seed(spark, str(bad), schema).collect()
