"""The pipeline's stages against brute force, each on its own input."""

import hashlib
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from dayledger.llm.common import written
from dayledger.llm.op1_quality import quality_scores
from dayledger.llm.op7_decontaminate import benchmark_matches
from tests.llm.common import LONG, SF
from tests.llm.test_similarity import brute as components
from tests.llm.test_substring import brute as cuts

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _prose(n, seed):
    rng = random.Random(seed)
    parts = "th er on an re in ed nd ha to en es of at it".split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n))


def _key(rows):
    return sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=str)


def test_stages_equal_brute_force(spark):
    long, rest = _prose(70, 1), _prose(200, 2)
    odd = [(900000, "", None, "s", 0), (900001, None, "en", None, None), (900002, LONG, "en", "s", 1), (900003, LONG, "en", "s", 1),
           (900002, LONG, "en", "s", 1), (None, LONG, "en", "s", 1), (900004, _prose(90, 3) + " " + long + " two three.", "en", "s", 1),
           (900005, "The other\tthing.\n\nInto " + long + " \n there.  Then " + rest, "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)
    docs = docs.union(spark.createDataFrame(odd, schema)).selectExpr("*", "1 as mark", "2 as kept_text")
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["quality classifier", "n-gram Jaccard join", "substring dedup", "benchmark decontamination", "BPE encoding and decoding"]
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), "test-stage"))
    rows = [x.collect() for x in out]

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in quality_scores(docs, labels).collect() if r.predicted}
    assert out[1].columns == COLUMNS and _key(rows[1]) == _key([r for r in rows[0] if r.doc_id in good])

    of = {i: c for i, _, c in components(rows[1], 5, 80)}
    first = {}
    for r in rows[1]:
        if r.doc_id is not None and of[r.doc_id] == r.doc_id:
            first.setdefault(r.doc_id, r)
    assert out[2].columns == COLUMNS
    assert _key(rows[2]) == _key([*first.values(), *[r for r in rows[1] if r.doc_id is None]])

    assert out[3].columns == COLUMNS
    kept = {i: w for i, w, _ in cuts(rows[2], 50)}
    before = {r.doc_id: r for r in rows[2]}
    assert len(rows[3]) == len(rows[2])
    for r in rows[3]:
        old = before[r.doc_id]
        assert (r.text or "").split() == [w for w in (" ".join(kept[r.doc_id])).split()]
        assert (r.lang, r.source) == (old.lang, old.source)
        if len(kept[r.doc_id]) == len((old.text or "").split()):
            assert r == old
        else:
            assert r.n_chars == len(r.text)
    assert any(r.doc_id == 900005 and r.text == "The other\tthing.\n\nInto there.  Then " + rest for r in rows[3])

    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    dirty = {r.doc_id for r in benchmark_matches(out[3], items).collect()}
    assert dirty and out[4].columns == COLUMNS and _key(rows[4]) == _key([r for r in rows[3] if r.doc_id not in dirty])

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r, g in zip(rows[4], rows[5], strict=True):
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (g.doc_id, g.n_tokens, g.ids, g.decoded_sha256) == (r.doc_id, len(ids), ids, hashlib.sha256(text.encode()).hexdigest())


def test_run_is_all_stages(spark):
    rows = pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    assert 0 < rows.count() < spark.read.parquet(f"{SF}/documents.parquet").count()


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []
    assert np.all([stage for _, stage in pipeline.STAGES])
