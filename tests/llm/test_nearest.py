import math

import numpy as np
import pytest

from dayledger.llm import op9_nearest as op
from tests.oracle import compare

SF = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    assert compare(op.op9_nearest(spark, SF), op.SQL, SF, None)["match"]


@pytest.mark.parametrize("round_bytes", [1 << 20, 2000])
def test_brute_force_with_odd_rows(spark, round_bytes):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4)], 1, 1.0) for i in range(200)]
    rows += [(200, None, 1, 1.0), (220, [], 1, 1.0), (240, [0.0] * 4, 1, 1.0), (260, [1.0, math.nan, 0.0, 0.0], 1, 1.0),
             (280, [1.0, None, 0.0, 0.0], 1, 1.0), (300, [math.inf, 1.0, 0.0, 0.0], 1, 1.0), (None, [1.0, 2.0, 3.0, 4.0], 1, 1.0),
             (320, [1.0, 2.0], 1, 1.0), (321, [2.0, 1.0], 1, 1.0), (20, [9.0, 9.0, 9.0, 9.0], 1, 1.0), (5, [2.0, 2.0, 2.0, 2.0], 1, 1.0),
             (340, [1e-320, 0.0, 0.0, 1e-320], 1, 1.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, score double")
    got = [tuple(r) for r in op.nearest(df, df.where("vec_id % 20 = 0"), k=7, tile_rows=33, round_bytes=round_bytes).collect()]
    good = [(i, v) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    asked = {}
    for i, v in good:
        if i % 20 == 0:
            asked[i] = min(asked.get(i, v), v)
    want = []
    for q, v in asked.items():
        near = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v))[:7]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(near, 1)]
    assert sorted(got) == sorted(want)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert op.nearest(df, df).collect() == []
