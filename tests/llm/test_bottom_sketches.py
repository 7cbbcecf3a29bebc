import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayledger.llm import common
from dayledger.llm import op13_bottom_sketches as op
from tests.llm.common import no_documents, odd_documents
from tests.llm.test_similarity import brute, near_copies


def expected(rows, k, percent):
    return sorted(((i, n, c, i == c) for i, n, c in brute(rows, k, percent)), key=str)


@pytest.mark.parametrize("k, percent, sketch, listed, block, short", [
    (4, 80, 192, 64, 512, 64), (5, 80, 128, 128, 8, 3), (4, 90, 256, 48, 16, 2), (4, 70, 128, 64, 64, 0)])
def test_components_equal_brute_force(spark, k, percent, sketch, listed, block, short):
    """Also with lists so short that all go by blocks, and groups of copies."""
    texts = [*near_copies(60, 1), *near_copies(40, 2, 200, 25), *near_copies(30, 3, 900, 60), *near_copies(25, 4, 900, 150),
             *["same words in all of them here"] * 30]
    docs = odd_documents(spark).select("doc_id", "text").union(
        spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    docs = docs.selectExpr("*", "1 as n", "2 as grp", "3 as sketch", "4 as part")
    got = op.sketch_components(docs, k, percent, sketch, listed, block, short).collect()
    assert sorted(map(tuple, got), key=str) == expected(docs.collect(), k, percent)


def test_common_passage(spark):
    """Documents that share most of their words with many others, on both sides of the bound."""
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(300)]
    rows = []
    for i in range(150):
        own = [f"d{i}x{j}" for j in range(rng.choice((30, 60, 70, 75, 90, 200)))]
        rows.append((i, " ".join(passage + own)))
        if i % 10 == 0:
            rows.append((1000 + i, " ".join(passage + own[:-3])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block, short in ((512, 64), (16, 4)):
        got = op.sketch_components(docs, 4, 80, 128, 48, block, short).collect()
        assert sorted(map(tuple, got), key=str) == expected(docs.collect(), 4, 80)


def test_one_id_with_several_texts(spark):
    rows = [(5, "a b c d e f g h"), (7, "a b c d e f g h"), (7, "q r s t u v w x"), (9, "q r s t u v w x"), (7, "q r s t u v w x"), (9, None), (11, "")]
    got = op.sketch_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80).collect()
    assert sorted({(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got}) == [(5, 5, 5, True), (7, 5, 5, False), (9, 0, 9, True), (9, 5, 5, False), (11, 0, 11, True)]


def test_empty(spark):
    assert op.sketch_components(no_documents(spark)).collect() == []


def sets_of(rng, n, size):
    base = rng.integers(0, 2**63, size, dtype=np.uint64)
    for _ in range(n):
        part = base[rng.random(size) > rng.random() * 0.35]
        yield np.unique(np.append(part, rng.integers(0, 2**63, max(1, int(size * rng.random() * 0.3)), dtype=np.uint64)))


@pytest.mark.parametrize("size", [5, 60, 110, 160, 1500])
def test_estimates_allow_every_link(size):
    """Overlaps are exact, and no linked pair is below the bound."""
    rng = np.random.default_rng(size)
    sets = list(sets_of(rng, 60, size))
    rows = [(i, len(s), i, 0, np.sort(op.mix(s ^ op.ORDER))[:128].astype("<u8").tobytes()) for i, s in enumerate(sets)]
    over = op.Block(rows, 128, 80, listed=128).overlaps()
    i, j, share = op.Block(rows, 128, 80, whole=max(map(len, sets)) <= 128).pairs()
    found = set(zip(i.tolist(), j.tolist(), strict=True))
    for y in range(len(sets)):
        for x in range(y):
            a, b = (np.frombuffer(rows[z][4], "<u8") for z in (x, y))
            assert over[x, y] == len(np.intersect1d(a, b))
            both = len(np.intersect1d(sets[x], sets[y]))
            if 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                assert (x, y) in found
    exact = [len(np.intersect1d(sets[x], sets[y])) / len(np.union1d(sets[x], sets[y])) for x, y in zip(i, j, strict=True)]
    assert np.abs(share - exact).max(initial=0) < 0.25


def test_bounds():
    """The bounds fall with the union and hold for drawn samples."""
    assert op.least_matches(128, 100, np.array([128, 10**6])).tolist() == [128, 128]
    sizes = np.array([256, 300, 400, 1000, 10**4, 10**7])
    least = op.least_matches(256, 80, sizes)
    assert (np.diff(least) <= 0).all() and least[0] == 205 and 150 < least[-1] < 175
    rng = np.random.default_rng(1)
    for union, t in zip(sizes[:4].tolist(), least[:4].tolist(), strict=True):
        common = -(-80 * union // 100)
        assert rng.hypergeometric(common, union - common, 256, 20_000).min() >= t
    n = np.array([1, 2, 50, 102, 103, 128, 1000])
    need = op.least_shared(n, 128, 80)
    assert need.tolist()[:4] == [1, 2, 40, 82] and (need[4:] <= np.ceil(n[4:] * 0.8)).all()


def test_forest_spans_groups():
    rows = [(i, 3, g, 0, np.arange(3, dtype="<u8").tobytes()) for i, g in enumerate([0, 0, 2, 3, 3, 5])]
    block = op.Block(rows, 128, 80)
    i, j, _ = block.pairs()
    tied = op.Block(rows, 128, 80).forest(i, j)
    assert len(tied) == 3 and {a for p in tied for a in p} <= set(range(6))


def test_a_written_step_leaves_no_shuffle_files(spark):
    """They go when the step ends, not when the driver collects its garbage."""
    dirs = list(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString())
    shuffles = lambda: {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}
    setting = spark.conf.get(common.DROP_SETTING)
    before = shuffles()
    rows = common.written(spark.range(1000).repartition(6, "id").groupBy((F.col("id") % 7).alias("k")).count(), "step")
    until = time.time() + 15
    while shuffles() - before and time.time() < until:  # files are removed beside the job's end
        time.sleep(0.2)
    assert not shuffles() - before
    assert rows.agg(F.sum("count")).first()[0] == 1000 and spark.conf.get(common.DROP_SETTING) == setting
