import collections
import math
import zlib

import numpy as np
import public_tokenizers
import pytest

from dayledger.llm import op6_lattice_lm as op
from tests.llm.common import no_documents, odd_documents, words

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
WORDS = ["the", "thntblere", "a", "zß日q", "😀x", "x" * 50, "▁b", "a▁b", "ééé", "<0x41>"]


@pytest.fixture(scope="module")
def trie():
    return op.Trie(VOCABULARY)


def _pieces():
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    return {m.id_to_piece(i): i for i in range(m.get_piece_size())
            if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i)) and "▁" not in m.id_to_piece(i)[1:]}


def _edges(trie, pieces, word):
    """All (from, to, piece ids) of the word's lattice."""
    n = len(word) + 1
    for i in range(n):
        for j in range(i + 1, n + 1):
            part = word[max(i - 1, 0):j - 1]
            name = ("▁" if i == 0 else "") + part
            if ("▁" not in part) and name in pieces:
                yield i, j, [pieces[name]]
        if i and (word[i - 1] == "▁" or word[i - 1] not in pieces):
            yield i, i + 1, [int(trie.bytes[b]) for b in word[i - 1].encode()]


def test_forward_sums_all_segmentations(trie):
    weight, pieces = trie.start(), _pieces()
    got, _ = op.lattice(trie, weight, WORDS)
    for word, value in zip(WORDS, got):
        total = [1.0] + [0.0] * (len(word) + 1)
        for i, j, ids in sorted(_edges(trie, pieces, word)):
            total[j] += total[i] * math.exp(sum(weight[p] for p in ids))
        assert value == pytest.approx(math.log(total[-1]), abs=1e-9)


def test_expected_counts(trie):
    """The derivative of the log likelihood with respect to a log weight."""
    weight = trie.start()
    counts = np.arange(1.0, len(WORDS) + 1)
    _, expected = op.lattice(trie, weight, WORDS, counts)
    for p in np.flatnonzero(expected)[::7]:
        up, down = weight.copy(), weight.copy()
        up[p] += 1e-4
        down[p] -= 1e-4
        slope = (op.lattice(trie, up, WORDS)[0] @ counts - op.lattice(trie, down, WORDS)[0] @ counts) / 2e-4
        assert expected[p] == pytest.approx(slope, rel=1e-4, abs=1e-6)


@pytest.mark.parametrize("entries", [0, 50])
def test_documents(spark, trie, entries):
    docs = odd_documents(spark)
    got = op.lattice_scores(docs, VOCABULARY, rounds=1, table_entries=entries).collect()
    rows = docs.collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = collections.Counter()
    for r in rows:
        if not held(r.doc_id):
            c.update(words(r.text, lower=True) + [None])
    total = sum(c.values())
    expected = np.zeros(trie.size)
    train = [w for w in c if w is not None]
    expected += op.lattice(trie, trie.start(), train, np.array([float(c[w]) for w in train]))[1]
    expected[trie.end] = c[None]
    weight = trie.trained(expected)
    every = sorted({w for r in rows for w in words(r.text, lower=True)})
    value = dict(zip(every, op.lattice(trie, weight, every)[0] / math.log(10))) | {None: weight[trie.end] / math.log(10)}
    want = collections.defaultdict(list)
    for r in rows:
        t = words(r.text, lower=True) + [None]
        want[r.doc_id].append((held(r.doc_id), len(t), sum(c[w] > 0 for w in t), total,
                               sum(math.log10((c[w] + 1) / (total + len(c) + 1)) for w in t), sum(value[w] for w in t)))
    found = collections.defaultdict(list)
    for g in got:
        found[g.doc_id].append(tuple(g)[1:])
    assert found.keys() == want.keys()
    for k in want:
        for a, b in zip(sorted(found[k]), sorted(want[k]), strict=True):
            assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)


def test_training_helps(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    score = [sum(r.score for r in op.lattice_scores(docs, VOCABULARY, rounds=n).where("held_out").collect()) for n in (0, 2)]
    assert score[1] > score[0]


def test_empty(spark):
    assert op.lattice_scores(no_documents(spark), VOCABULARY, rounds=1).collect() == []
