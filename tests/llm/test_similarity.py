import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from dayledger.llm import graph
from dayledger.llm import op4_signature_tree as op
from dayledger.llm.common import written
from dayledger.llm.graph import Sets, components
from tests.llm.common import no_documents, odd_documents, words


def brute(rows, k, percent):
    """doc_id to (set size, component)."""
    sets = {}
    for r in rows:
        w = words(r.text, lower=True)
        s = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
        sets.setdefault(r.doc_id, []).append(s)
    holders = collections.defaultdict(list)
    every = [(i, s) for i, many in sets.items() if i is not None for s in many if s]
    for n, (_, s) in enumerate(every):
        for x in s:
            holders[x].append(n)
    tied = Sets()
    for n, (i, s) in enumerate(every):
        both = collections.Counter(m for x in s for m in holders[x] if m < n)
        for m, c in both.items():
            j, t = every[m]
            if i != j and 100 * c >= percent * (len(s) + len(t) - c):
                tied.join(i, j)
    return sorted(((i, len(s), tied.find(i) if i is not None else None) for i, many in sets.items() for s in many), key=str)


def near_copies(n, seed, size=60, edits=3):
    rng = random.Random(seed)
    base = [f"t{rng.randrange(10**6)}" for _ in range(size)]
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        yield " ".join(w[rng.randrange(3):])


@pytest.mark.parametrize("k, percent, block", [(4, 85, 8192), (5, 80, 8)])
def test_components_equal_brute_force(spark, k, percent, block):
    """Also with blocks so small that hot keys are split, and groups of copies."""
    more = [(10_000 + i, t) for i, t in enumerate([*near_copies(60, 1), *near_copies(40, 2, 200, 25), *["same words in all of them here"] * 30])]
    docs = odd_documents(spark).select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    docs = docs.selectExpr("*", "1 as n", "2 as grp", "3 as bits")
    got = op.similar_components(docs, k, percent, block).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs.collect(), k, percent)


def test_empty(spark):
    assert op.similar_components(no_documents(spark)).collect() == []


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_trees_find_every_linked_pair(percent):
    rng = np.random.default_rng(percent)
    sets = []
    for _ in range(25):
        base = rng.integers(0, 2**63, rng.integers(1, 120), dtype=np.uint64)
        for _ in range(rng.integers(1, 8)):
            keep = base[rng.random(len(base)) > rng.random() * 0.3]
            sets.append(np.unique(np.append(keep, rng.integers(0, 2**63, rng.integers(0, 9) + (not len(keep)), dtype=np.uint64))))
    bitmaps = [op.bitmap(s) for s in sets]
    ids = list(range(len(sets)))
    found = set(op.block_pairs(ids, [len(s) for s in sets], ids, bitmaps, percent, spanning=False))
    linked = {(i, j) for j in ids for i in range(j)
              if 100 * (both := len(np.intersect1d(sets[i], sets[j]))) >= percent * (len(sets[i]) + len(sets[j]) - both)}
    assert linked <= found and len(found) < len(ids) * (len(ids) - 1) / 4


def test_shingles_of_texts():
    col = pa.array(["a b c d e", "A B C D E", "a b", "", "x a b", "b a"], pa.large_string())
    values, row = op.shingles(col, 4)
    per = [set(values[row == i].tolist()) for i in range(6)]
    assert per[0] == per[1] and len(per[0]) == 2
    assert len(per[2]) == 1 and not per[3] and len({*per[2], *per[4], *per[5]}) == 3


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 500)] + [(1000, i) for i in range(1001, 1400)] + [(5000, 4000), (4000, 3000), (7, 7)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    assert got == {i: 0 for i in range(501)} | {i: 1000 for i in range(1000, 1400)} | {i: 3000 for i in (3000, 4000, 5000)}


@pytest.mark.parametrize("parts,writes,shuffles", [(1, 2, 1), (6, 6, 5)])
def test_components_shuffle_little(spark, monkeypatch, parts, writes, shuffles):
    """Each shuffle has as many tasks as the session has partitions, whatever it
    moves: a table of stars is found settled by one, and two rounds of two make
    a star of a scattered family."""
    seen = []

    def counted(df, what):
        seen.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return written(df, what)

    monkeypatch.setattr(graph, "written", counted)
    edges = spark.createDataFrame([(100 + i, i % 10) for i in range(120)] + [(1000, i) for i in range(10)], "a long, b long").repartition(parts)
    got = {r[0]: r[1] for r in components(edges).collect()}
    assert got == dict.fromkeys([*range(10), *range(100, 220), 1000], 0)
    assert len(seen) <= writes and sum(seen) <= shuffles, seen


def test_components_of_random_graphs(spark):
    rnd = random.Random(7)
    for links in (60, 150, 400):
        edges = [(rnd.randrange(200), rnd.randrange(-100, 100)) for _ in range(links)] + [(5, None), (9999, 9999)]
        sets = Sets()
        for a, b in edges[:-2]:
            sets.join(a, b)
        want = {(x, sets.find(x)) for a, b in edges[:-2] if a != b for x in (a, b)}
        got = [tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long").repartition(9)).collect()]
        assert len(got) == len(want) and set(got) == want


def meetings(docs, sizes, groups, block, percent=85):
    """The rows of one key that these documents hold."""
    n = len(docs)
    keys = pa.array([np.array([77], np.uint64).tobytes()] * n, pa.binary())
    batch = pa.RecordBatch.from_pydict({"doc_id": docs, "n": sizes, "keys": keys, "grp": groups})
    return [r for b in op._meetings(percent, block)(op._postings(1)(iter([batch]))) for r in b.to_pylist()]


def test_lists_of_one_component_do_not_meet():
    n = 4000
    assert meetings(list(range(n)), [100] * n, [0] * n, 50) == []
    # a component of 4,000 and 20 others: the component's runs meet only the others' run
    rows = meetings(list(range(n + 20)), [100] * (n + 20), [0] * n + list(range(n, n + 20)), 50)
    members, met = [r for r in rows if r["run"] >= 0], [r for r in rows if r["run"] == -2]
    assert len(members) == n + 20 and len(met) == 81
    run = {r["doc_id"]: r["run"] for r in members}
    meet = {(r["x"], r["y"]) for r in met}
    for i in range(n, n + 20):
        assert all((min(a, b), max(a, b)) in meet for a, b in ((run[i], run[j]) for j in range(n + 20)))


@pytest.mark.parametrize("percent", [50, 85])
def test_runs_that_may_hold_a_pair_meet(percent):
    rng = np.random.default_rng(percent)
    sizes, groups = rng.integers(20, 60, 300).tolist(), rng.integers(0, 40, 300).tolist()
    groups = [g if g > 20 else 0 for g in groups]
    rows = meetings(list(range(300)), sizes, groups, 8, percent)
    run, meet = {}, set()
    for r in rows:
        if r["run"] >= 0:
            run[r["doc_id"]] = (r["key"], r["run"])
        elif r["run"] == -2:
            meet.add((r["key"], r["x"], r["y"]))
    for i in range(300):
        for j in range(i):
            if groups[i] != groups[j] and op.compatible(min(sizes[i], sizes[j]), max(sizes[i], sizes[j]), percent):
                (k, x), (q, y) = run[i], run[j]
                assert k == q and (k, min(x, y), max(x, y)) in meet


def test_trees_of_two_runs_find_the_pairs_across():
    rng = np.random.default_rng(5)
    bases = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (30, 32, 33, 64, 70) * 4]
    sets = [np.unique(b[rng.random(len(b)) > 0.1]) for b in bases for _ in range(6)]
    ids, sides = list(range(len(sets))), rng.integers(0, 2, len(sets)).tolist()
    bitmaps, sizes = [op.bitmap(s) for s in sets], [len(s) for s in sets]
    every = set(op.block_pairs(ids, sizes, ids, bitmaps, 60, False))
    got = op.block_pairs(ids, sizes, ids, bitmaps, 60, False, None, sides)
    assert sorted(got) == sorted((i, j) for i, j in every if sides[i] != sides[j]) and got


def test_an_id_of_several_texts_is_one_node(spark):
    a, b = "one two three four five six", "red blue green white black grey"
    docs = spark.createDataFrame([(5, a), (7, a), (7, b), (9, b)], "doc_id long, text string")
    assert sorted(map(tuple, op.similar_components(docs).collect())) == [(5, 2, 5), (7, 2, 5), (7, 2, 5), (9, 2, 5)]
