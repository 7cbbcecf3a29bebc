import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dayledger.llm import op1_quality as op
from tests.llm.common import no_documents, odd_documents

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    return op.op1_quality(spark, SF).toPandas()


def test_held_out_accuracy(spark, scored):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    both = scored.merge(labels, on="doc_id")
    both = both[both.held_out]
    assert len(scored) == 1000 and (both.predicted == both.quality).mean() >= 0.97
    assert ((scored.score >= 0.5) == (scored.predicted == 1)).all() and scored.score.between(0, 1).all()


def test_fold(scored):
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(scored.doc_id, scored.held_out, strict=True))


def test_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    other = labels.withColumn("quality", F.when(op.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in op.quality_scores(docs, x, steps=3).collect()} for x in (labels, other))
    assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], abs=1e-9) for i in a)


def test_risk_terms_are_gradients():
    rng = np.random.default_rng(1)
    x, w = rng.normal(size=(20, op.SIZE)), rng.normal(size=op.SIZE)
    mean, scale = np.zeros(op.SIZE), np.ones(op.SIZE)
    at = lambda v: op._terms(v, mean, scale)(x).mean(0)
    here, n = at(w), op.SIZE
    for k in range(0, n, 9):
        step = np.zeros(n)
        step[k] = 1e-5
        up, down = at(w + step), at(w - step)
        for loss, gradient in ((0, 1), (n + 1, n + 2)):
            assert here[gradient + k] == pytest.approx((up[loss] - down[loss]) / 2e-5, rel=1e-4, abs=1e-7)


def test_odd_rows_are_scored(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 1) for i in range(100)] + [(None, 1, 1), (7, None, 1), (8, 1, 1), (10**9, 0, 1)],
                                   "doc_id long, quality int, text int")
    got = op.quality_scores(docs, labels, steps=3).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert op.good_documents(docs, labels, steps=3).columns == docs.columns


def test_no_labels_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = odd_documents(spark, sample=False)
    assert {r.score for r in op.quality_scores(docs, none).collect()} == {0.5}
    assert op.quality_scores(no_documents(spark), none).collect() == []


def test_features_ignore_batch_borders():
    texts = ["", "a b", "X!! | 1", "\n", "é é", "one\ntwo\none"]
    whole = op.features(pa.array(texts, pa.large_string()))
    each = np.concatenate([op.features(pa.array([t], pa.large_string())) for t in texts])
    assert np.allclose(whole, each) and not whole[0][:-1].any()
