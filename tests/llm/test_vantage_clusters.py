import hashlib
import math
import random

import numpy as np
import pytest

from dayledger.llm import op12_vantage_clusters as op


def brute(rows, k, rounds, dim, scale=1024, seed=3):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) by plain whole numbers."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    num = [(i, [n * scale // d for n, d in (float(x).as_integer_ratio() for x in v)]) for i, v in kept]
    text = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    order = sorted(range(len(kept)), key=lambda j: (text(kept[j][0]), kept[j][1]))
    cents = [num[j][1] for j in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(cents)) for _, v in num]

    for _ in range(rounds):
        at = assign()
        for c in range(len(cents)):
            mine = [v for (_, v), (_, own) in zip(num, at, strict=True) if own == c]
            if mine:
                cents[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    at = assign()
    fits = lambda x: x if x < 2**63 else None
    sums = {c: sum(d for d, own in at if own == c) for c in range(len(cents))}
    if any(d >= 2**63 for d, _ in at):
        whole, sums = None, {c: None if any(d >= 2**63 for d, own in at if own == c) else s for c, s in sums.items()}
    else:
        whole = fits(sum(sums.values()))
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, c, fits(d), None if sums[c] is None else fits(sums[c]), whole, sha[c])
                   for (i, _), (d, c) in zip(num, at, strict=True)), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as cluster", "2 as distance", "3 as v", "4 as n")


def vectors(n, dim, seed, size=1.0):
    rng = random.Random(seed)
    return [(i, [rng.uniform(-size, size) for _ in range(dim)]) for i in range(n)]


ODD = [(None, [0.5] * 4), (None, [0.25] * 4), (7, None), (8, []), (9, [1.0] * 3), (10, [1.0, None, 2.0, 3.0]),
       (11, [float("nan")] * 4), (12, [float("inf"), 0.0, 0.0, 0.0]), (13, [0.0] * 4), (13, [0.0] * 4), (13, [-0.0] * 4), (14, [-1e-9] * 4)]


@pytest.mark.parametrize("k, rounds, rows", [
    (8, 10, vectors(300, 4, 1) + ODD),
    (3, 4, [(i, [float(i % 3), 0.0, 0.0, 0.0]) for i in range(40)]),  # ties and repeated rows
    (8, 3, vectors(5, 4, 2)),  # fewer vectors than centroids
    (4, 3, vectors(60, 4, 3, 1e15) + vectors(20, 4, 4)),  # sums beyond 64 bits
    (4, 2, vectors(30, 4, 5, 1e300)),
])
def test_equals_brute_force(spark, k, rounds, rows):
    got = op.clustered(frame(spark, rows), k, rounds, dim=4).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, k, rounds, 4)


def test_empty(spark):
    assert op.clustered(frame(spark, []), dim=4).collect() == []
    assert op.clustered(frame(spark, [(1, None)]), dim=4).collect() == []


@pytest.mark.parametrize("n, leaf", [(1, 2), (2, 1), (9, 2), (200, 1), (200, 4)])
def test_tree_finds_the_nearest_and_the_smallest_of_equals(n, leaf):
    rng = np.random.default_rng(n + leaf)
    points = rng.integers(-6, 7, (n, 3))  # many at one distance, many alike
    queries = rng.integers(-8, 9, (500, 3))
    found, far = op.Tree(points.tolist(), leaf).nearest(queries)
    every = ((queries[:, None] - points[None]) ** 2).sum(2)
    assert found.tolist() == every.argmin(1).tolist() and far.tolist() == every.min(1).tolist()


def test_tree_prunes():
    rng = np.random.default_rng(5)
    points = rng.integers(-1000, 1000, (400, 2))
    tree = op.Tree(points.tolist())
    looked = 0
    whole = op.squared

    def counted(q, c):
        nonlocal looked
        looked += len(q)
        return whole(q, c)

    op.squared = counted
    try:
        tree.nearest(rng.integers(-1000, 1000, (300, 2)))
    finally:
        op.squared = whole
    assert looked < 0.4 * 400 * 300


def test_whole_numbers_floor():
    assert op.whole(np.array([[0.5 / 1024, -0.5 / 1024, -1.0]]), 1024).tolist() == [[0, -1, -1024]]
    assert op.whole(np.array([[1e300, -0.1]]), 1024).tolist() == [[int(1e300) * 1024, -103]]
