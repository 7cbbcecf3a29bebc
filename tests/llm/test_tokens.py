"""Operators 3, 8 and 10 against the tokenizers library on whole texts."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from dayledger.llm import op3_token_counts as op3
from dayledger.llm import op8_token_files as op8
from dayledger.llm import op10_bpe as op10
from dayledger.llm.common import new_path
from tests.llm.common import no_documents, odd_documents

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


LIBRARY = {path: Tokenizer.from_file(path) for path in (BYTE, WORD)}


def _ids(path, text):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("cache", [400_000, 10])
def test_counts(spark, cache):
    docs = odd_documents(spark)
    got = op3.token_counts(docs, BYTE, limit=50, table_entries=300, per_task=200, cache_entries=cache).collect()
    want = [(r.doc_id, len((r.text or "").encode()), n := len(_ids(BYTE, r.text)), n > 50) for r in docs.collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_counts_of_nothing(spark):
    assert op3.token_counts(no_documents(spark), BYTE).collect() == []


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 3000])
@pytest.mark.parametrize("top", [1, 2, 50_000, 2**32 - 1])
def test_blocks_round_trip(n, top):
    rng = np.random.default_rng(n + top)
    ids = rng.integers(0, top, n).astype("<u4")
    ids[rng.random(n) < 0.04] = 2**32 - 1
    for percentile in (0.01, 0.5, 0.95, 1.0):
        starts, payload = op8.pack(ids, percentile)
        assert len(starts) == -(-n // 128)
        assert (op8.unpack(payload, starts, n) == ids).all()


@pytest.mark.parametrize("chunk", [64, 1 << 16])
def test_token_files(spark, chunk):
    docs = odd_documents(spark)
    path = new_path(spark, "test-token-files")
    op8.write_token_files(docs, path, WORD, chunk_ids=chunk)
    got = op8.read_token_files(spark, path).orderBy("start").collect()
    at = 0
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode()))
    for r, g in zip(rows, got, strict=True):
        ids = _ids(WORD, r.text) + [1]
        assert tuple(g) == (r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_token_files_of_nothing(spark):
    path = new_path(spark, "test-token-files")
    op8.write_token_files(no_documents(spark), path, WORD)
    assert op8.read_token_files(spark, path).collect() == []


@pytest.mark.parametrize("cache", [150_000, 5])
def test_bpe(spark, cache):
    docs = odd_documents(spark)
    got = op10.token_digests(docs, WORD, cache_entries=cache).collect()
    library = LIBRARY[WORD]
    for r, g in zip(docs.collect(), got, strict=True):
        ids = _ids(WORD, r.text)
        text = library.decode(ids, skip_special_tokens=False)
        assert tuple(g) == (r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                            hashlib.sha256(text.encode()).hexdigest())


def test_bpe_full_output(spark):
    docs = odd_documents(spark, sample=False)
    for r, g in zip(docs.collect(), op10.encode(docs, WORD).collect(), strict=True):
        assert (g.doc_id, g.n_tokens, g.ids, g.decoded) == (
            r.doc_id, len(g.ids), _ids(WORD, r.text), LIBRARY[WORD].decode(g.ids, skip_special_tokens=False))
    assert op10.encode(no_documents(spark), WORD).collect() == []


def test_merges_that_overlap():
    v = op10.Vocabulary(WORD)
    for text in ("aaaaaaa", "ababababab", "x", "thththth", "zzzzzzzzzzzzzzzzzzz"):
        assert v.encode_units([text.encode()] * 2) == [_ids(WORD, text)] * 2


def test_words_are_not_split_and_give_the_library_s_ids(monkeypatch):
    """Pieces of letters alone are one pre-token: the pattern isn't asked."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD)
    encoder = op8.Encoder(WORD, 100)
    texts = ["Hello", "straightforward", "X", "a1b", "don't", "na\u00efve", "\u0130stanbul"]
    for text in texts:
        want = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.piece(text) == want and encoder.piece(text) == want
    class Refused:
        def findall(self, text):
            raise AssertionError(text)
    monkeypatch.setattr(op8, "WORD_PATTERN", Refused())
    assert encoder.piece("Unheard") and encoder.piece("hello")


def test_words_share_a_lookup_in_any_case_and_before_any_marks(monkeypatch):
    """A slice's words of plain letters go to the library together, whatever marks follow them."""
    import pyarrow as pa

    texts = ["Word word, WORD. word!!! Élan élan; µ's", "", "don't foo' foo.'s foo's. a<|endoftext|> ª, ß) x1 x1, ...",
             "İstanbul, <|startoftext|> Σς. é, naïve-- tail>", "word" * 50 + ",", "  "]
    col = pa.array(texts, pa.large_string())
    for entries in (1000, 2):
        flat, lens = op8.Encoder(WORD, entries).texts(col, end=1)
        want = [_ids(WORD, t) + [1] for t in texts]
        assert lens.tolist() == list(map(len, want)) and flat.tolist() == sum(want, [])
    encoder = op8.Encoder(WORD, 1000)
    for one_by_one in ("piece", "pretoken"):
        monkeypatch.setattr(encoder, one_by_one, lambda text: pytest.fail(text))
    flat, _ = encoder.texts(pa.array(["Unheard unheard, UNHEARD!", "élan. Élan"], pa.large_string()))
    assert flat.tolist() == _ids(WORD, "Unheard unheard, UNHEARD!") + _ids(WORD, "élan. Élan")
