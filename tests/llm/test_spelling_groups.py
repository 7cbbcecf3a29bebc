import collections
import random
import re
import zlib

import pytest

from dayledger.llm import op11_spelling_groups as op
from tests.llm.common import no_documents, odd_documents

LOWER = {i: i + 32 for i in range(65, 91)}


def one_edit(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    m = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[m + 1:] == b[m + 1:] if len(a) == len(b) else a[m:] == b[m + 1:]


def counts_of(rows, least_length=5, least_n=3, drop=97):
    n = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % drop == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= least_length and c >= least_n}


def neighbours(words):
    """Pairs at one edit, by what is left of each word without one letter."""
    left = collections.defaultdict(set)
    for w in words:
        for form in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            left[form].add(w)
    return {(a, b) for group in left.values() for a in group for b in group if one_edit(a, b)}


def brute(rows, ratio=2, **k):
    n = counts_of(rows, **k)
    near = collections.defaultdict(list)
    for a, b in neighbours(n):
        near[a].append(b)
    best = {w: min(near[w], key=lambda x: (-n[x], x)) for w in near}
    form = {w: b for w, b in best.items() if n[b] >= ratio * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near.get(w, [])), n.get(form.get(w))))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "2 as word", "3 as node", "4 as s", "5 as id")


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(op.spelling_groups(docs)) == brute(rows)
    more = {"least_length": 2, "least_n": 1, "drop": 3}  # a dense trie, many deletions
    assert got(op.spelling_groups(docs, **more)) == brute(rows, **more)


@pytest.mark.parametrize("seed, alphabet, least_length", [(1, "ab", 1), (2, "abÀÿ", 3), (3, "abcdefgh", 5)])
def test_random_words(spark, seed, alphabet, least_length):
    rng = random.Random(seed)
    words = ["".join(rng.choices(alphabet, k=rng.randrange(1, 9))) for _ in range(700)]
    words += [w[:i] + rng.choice(alphabet) + w[i + rng.randrange(2):] for w in words for i in (rng.randrange(len(w)),)]
    rows = [(i, " ".join(rng.choices(words, weights=[1 / (1 + j % 40) for j in range(len(words))], k=60))) for i in range(200)]
    k = {"least_length": least_length, "least_n": 2}
    assert got(op.spelling_groups(frame(spark, rows), **k)) == brute(rows, **k)


def test_long_words_and_ends(spark):
    """Edits at the first and last letter, in runs of one letter, and in words of thousands of letters."""
    rng = random.Random(9)
    long = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5000))
    words = ["eagle", "beagle", "eagles", "agle" + "x", "aagle", "aaaaa", "aaaaaa", "aaaaaaa", "baaaaa", "aaaaab", "aabaaa", "àgile", "ágile", "agile",
             long, long[:-1], long[1:], long[:2500] + "Z".lower() + long[2501:], "x" + long, long + "x", long[::-1]]
    rows = [(i, " ".join(w for w, times in zip(words, range(3, 60), strict=False) if i < times)) for i in range(60)]
    assert got(op.spelling_groups(frame(spark, rows))) == brute(rows)


def test_chains_of_forms(spark):
    """Roots over many steps; ties go to the smaller word."""
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb"]
    rows = [(i, " ".join(w for j, w in enumerate(chain) if i < 4 * 3 ** j)) for i in range(1000)]
    rows += [(1000 + i, "ccccc ccccd cccce" if i < 8 else "ccccd cccce") for i in range(40)]
    result = got(op.spelling_groups(frame(spark, rows)))
    assert result == brute(rows)
    assert next(r for r in result if r[0] == "aaaaa")[2] == "bbbbb"


def test_empty(spark):
    assert op.spelling_groups(no_documents(spark)).collect() == []
    assert op.spelling_groups(frame(spark, [(1, None), (None, ""), (2, "12 34")])).collect() == []


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_and_pairs_are_cheap(spark):
    """A short run never becomes a row, and a pair of state and edge calls no function on an array."""
    docs = frame(spark, [(1, "a to the house houses horse")])
    assert "{5,}" in plan(op.word_counts(docs, 5, 1, 97))
    paths = op.written(op.spines(spark.createDataFrame([("house",), ("houses",), ("horse",)], "word string")), "test-paths")
    started = op._started(paths, op.written(op.trie(paths), "test-edges"))
    assert started.count() and "lambda" not in plan(started)


def test_capitals_of_all_kinds(spark):
    """Only A-Z are lower-cased, in runs of any letters and of any least length."""
    texts = ["ÉCOLE École école ecole ECOLE Ecole", "Straße STRASSE straÞe µÀÿ aÀB Ab aB É e E ×÷ ×a÷"]
    rows = [(i, t) for i in range(40) for t in texts]
    for least_length in (0, 1, 3, 5):
        k = {"least_length": least_length, "drop": 5}
        assert got(op.spelling_groups(frame(spark, rows), **k)) == brute(rows, **k)
