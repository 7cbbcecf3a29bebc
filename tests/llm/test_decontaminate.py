import random

import pytest

from dayledger.llm import op7_decontaminate as op
from tests.llm.common import SF, no_documents, odd_documents, words


def distance(pattern, text):
    """Least edits of the pattern to a part of the text, column by column."""
    column = list(range(len(pattern) + 1))
    best = column[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(column[i] + 1, new[-1] + 1, column[i - 1] + (p != c)))
        column = new
        best = min(best, column[-1])
    return best


def test_bit_parallel_distance():
    rng = random.Random(3)
    for _ in range(300):
        p, t = bytes(rng.choices(b"abc", k=rng.randint(1, 90))), bytes(rng.choices(b"abc", k=rng.randint(0, 130)))
        d, end = op.Pattern(p).best(t)
        assert d == distance(p, t)
        again, back = op.Pattern(p[::-1]).best(t[:end][::-1], anchored=True)
        assert again == d and (d == len(p) or distance(p, t[end - back:end]) == d)


def folded(text):
    kept = "".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in (text or "").lower())
    return f" {' '.join(kept.split(' '))} ".encode()


def squeezed(text):
    return b" " + b" ".join(x for x in folded(text).split(b" ") if x) + b" "


def edited(text, edits, rng):
    x = list(text)
    for _ in range(edits):
        i, kind = rng.randrange(len(x)), rng.randrange(3)
        x[i:i + 1] = [["q"], [], [x[i], "z"]][kind]
    return "".join(x)


@pytest.mark.parametrize("block_bytes", [4 << 20, 2000])
def test_matches_equal_brute_force(spark, block_bytes):
    rng = random.Random(9)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()][:12]
    docs = [(i, "one two " + edited(t, len(t) * p // 100, rng) + " three") for i, (_, t) in enumerate(items) for p in (0, 2, 5, 9, 20)]
    docs = [(i, t) for i, (_, t) in enumerate(docs)]
    docs += [(1000, items[0][1].upper().replace(" ", ",  \n") + " and " + items[1][1]), (1001, items[2][1] * 3), (1002, items[3][1][:60]),
             (1003, "short"), (1004, "shorten"), (None, items[4][1]), (1005, ""), (1006, None), (1005, items[5][1])]
    items += [(100, ""), (101, None), (102, " ,; "), (103, "Short!"), (104, items[0][1]), (None, items[1][1])]
    rows = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, item_id int, distance int")
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    got = op.benchmark_matches(rows, asked, percent=6, block_bytes=block_bytes).collect()
    want = set()
    for d, t in docs:
        for i, x in items:
            p = squeezed(x)
            if p.strip() and (n := distance(p, squeezed(t))) <= len(p) * 6 // 100:
                want.add((d, i, n))
    assert {(r.doc_id, r.item_id, r.distance) for r in got} == want and len(want) > 30
    for r in got:
        assert r.end - r.start <= r.item_bytes + r.distance
    clean = op.without_benchmark(rows, asked, percent=6, block_bytes=block_bytes)
    assert clean.columns == rows.columns
    dirty = {(d, t) for d, t in docs for i, x in items if squeezed(x).strip() and distance(squeezed(x), squeezed(t)) <= len(squeezed(x)) * 6 // 100}
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted((x for x in docs if x not in dirty), key=str)


def test_planted_passages(spark):
    docs = odd_documents(spark)
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in op.benchmark_matches(docs, items).collect()}
    texts = {r.item_id: " ".join(words(r.text)) for r in items.collect()}
    exact = {(r.doc_id, i) for r in docs.collect() for i, t in texts.items() if t in " ".join(words(r.text))}
    assert exact and exact <= found


def test_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = odd_documents(spark, sample=False)
    assert op.benchmark_matches(docs, none).collect() == []
    assert op.without_benchmark(docs, none).count() == docs.count()
    assert op.benchmark_matches(no_documents(spark), spark.createDataFrame([(1, "x y")], "item_id long, text string")).collect() == []
