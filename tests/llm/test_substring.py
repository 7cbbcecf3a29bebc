import collections
import hashlib

import numpy as np
import pyarrow as pa
import pytest

from dayledger.llm import op5_substring_dedup as op
from dayledger.llm.fmindex import Bits, FMIndex
from tests.llm.common import no_documents, odd_documents, words


def brute(rows, window):
    first = {}
    for r in rows:
        w = words(r.text)
        for i in range(len(w) - window + 1 if r.doc_id is not None else 0):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, r.doc_id), r.doc_id)
    for r in rows:
        w = words(r.text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1 if r.doc_id is not None else 0):
            if first[tuple(w[i:i + window])] < r.doc_id:
                gone[i:i + window] = [True] * window
        yield r.doc_id, [x for x, g in zip(w, gone, strict=True) if not g], len(w)


@pytest.mark.parametrize("window, small", [(13, 10**6), (2, 0), (25, 10**6)])
def test_documents_equal_brute_force(spark, window, small):
    docs = odd_documents(spark)
    rows = docs.collect()
    got = op.substring_digests(docs, window) if small else None
    want = collections.Counter((i, n, n - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()) for i, kept, n in brute(rows, window))
    if got is not None:
        assert collections.Counter(map(tuple, got.collect())) == want
    plain = docs.select("doc_id", "text")
    cut = op.cut_documents(plain, window, small).collect()
    assert {(r.doc_id, r.n_removed, r.kept_sha256) for r in cut} == {(i, m, h) for i, _, m, h in want if m}
    for r in cut:  # the cut text holds just the kept words
        assert hashlib.sha256(" ".join(words(r.kept_text)).encode()).hexdigest() == r.kept_sha256


def test_empty(spark):
    assert op.substring_digests(no_documents(spark)).collect() == []


def test_bits_rank():
    rng = np.random.default_rng(2)
    for n in (0, 1, 63, 64, 65, 1000):
        bits = rng.random(n) < 0.4
        i = np.arange(n + 1)
        assert (Bits(bits).rank(i) == np.concatenate([[0], np.cumsum(bits)])).all()


@pytest.mark.parametrize("kinds", [1, 2, 5, 300])
def test_backward_search_finds_all_places(kinds):
    rng = np.random.default_rng(kinds)
    text = np.append(rng.integers(1, kinds + 1, 400), 0)
    index = FMIndex(text, kinds + 1, 13)
    for length in (1, 2, 5, 13):
        ends = np.arange(length, 400)
        matched, lo, hi = index.matches(text, ends, length)
        for e, m, a, b in zip(ends.tolist(), matched.tolist(), lo.tolist(), hi.tolist(), strict=True):
            pattern = text[e - length:e]
            places = {p for p in range(len(text) - length + 1) if (text[p:p + length] == pattern).all()}
            if len(places) > 1:
                assert m == length and set(index.order[a:b].tolist()) == places
            elif m < length:
                assert b - a == 1


HEAD = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu"


@pytest.mark.parametrize("last", [("v57301", "v247476"), ("v21349", "v86762"), ("v3238044", "v3795005"), ("v3857936", "v3157491")])
def test_windows_of_one_anchor_are_told_apart(spark, last):
    """Segments of one anchor whose content hashes share 32 bits, or which differ
    in one word and its hashes share 40 bits."""
    texts = [f"{HEAD} {v}" for v in last]
    anchor = op.segments(pa.array(texts, pa.large_string()), 13)["anchor"].tolist()
    assert anchor[0] == anchor[1]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r.doc_id, r.n_removed) for r in op.substring_digests(docs, 13).collect()} == {(0, 0), (1, 0)}


def test_hot_anchors_are_split(spark):
    """No anchor holds many contents; the results are those of brute force."""
    texts = [f"{HEAD} v{i % 150} w{i % 70} x{i}" for i in range(300)]
    col = pa.array(texts, pa.large_string())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hot = op.hot_anchors(docs, 13, 50)
    assert len(hot)

    def most(s):
        return max(collections.Counter(a for a, _ in set(zip(s["anchor"].tolist(), s["content"].tolist(), strict=True))).values())

    assert most(op.segments(col, 13)) > 50 and most(op.segments(col, 13, hot)) < 50
    got = op.repeated_spans(docs.union(odd_documents(spark).select("doc_id", "text")), 13, hot=50)
    cut = {(r.doc_id, r.text, int((~op.keep_mask(pa.array([s.asDict() for s in r.spans]), len(words(r.text)))).sum())) for r in got.collect()}
    rows = docs.union(odd_documents(spark).select("doc_id", "text")).collect()
    want = {(r.doc_id, r.text, n - len(kept)) for r, (_, kept, n) in zip(rows, brute(rows, 13), strict=True) if n > len(kept)}
    assert cut == want


@pytest.mark.parametrize("phrase", [1, 2, 5, 13, 14, 40])
def test_a_phrase_said_over_and_over_is_one_place(spark, phrase):
    """The pipeline's check: documents of one repeated phrase made a row a window."""
    said = [f"w{i}" for i in range(phrase)]
    texts = [" ".join([f"a{d}", f"b{d}"] + said * 60 + [f"c{d}"] + said * (d % 3 * 20) + [f"e{d}"]) for d in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for hot in (None, np.arange(0)):
        found = op.segments(pa.array(texts, pa.large_string()), 13, hot)
        if phrase <= 13:
            assert len(found["row"]) < 12 * (2 * phrase + 40) and (found["reach"] > 0).any()
    every = np.unique(op.segments(pa.array(texts, pa.large_string()), 13)["anchor"])
    split = op.segments(pa.array(texts, pa.large_string()), 13, every)
    assert phrase > 13 or len(split["row"]) < 12 * (2 * phrase + 40)
    want = {(i, n - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()) for i, kept, n in brute(docs.collect(), 13)}
    plain = {(r.doc_id, r.n_removed, r.kept_sha256) for r in op.substring_digests(docs).collect()}
    assert plain == want
    spans = op.repeated_spans(docs, 13, hot=1)  # every anchor's windows dealt by their own hashes
    gone = {r.doc_id: int((~op.keep_mask(pa.array([s.asDict() for s in r.spans]), len(words(r.text)))).sum()) for r in spans.collect()}
    assert {(i, n) for i, n, _ in want if n} == set(gone.items())
