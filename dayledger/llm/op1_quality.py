"""Quality scores by positive-unlabelled learning.

Trusted positives P are the documents labelled good in the training fold;
unlabelled text U is every document of the fold, whatever its label. With the
class prior q (the share of good documents) a linear model g on text statistics
minimises the non-negative unbiased risk under the logistic loss l,
    q E_P[l(g)] + max(0, E_U[l(-g)] - q E_P[l(-g)])  (+ a small L2 term):
the bracket estimates the risk on bad documents; when it falls below zero the
step goes against its gradient instead, which stops overfitting. No label other
than "good" enters the risk.

The prior is estimated as the share of good documents among the labelled ones
of the fold (``prior`` overrides it).

Features are shares and repetition statistics of the whole text (character
classes, words in capitals, words with symbols, repeated words and lines),
computed by whole-array operations; doc_id, source, language and labels are
none of them. They are written once (about a tenth of the text's bytes) and each
of ``steps`` full-batch steps sums the gradient over all rows of the fold: a
task gives one row a feature and set. Nothing is sampled, and the driver sees
sums only.

Defined cases: a null or empty text has all-zero statistics and gets their
score; without positives or without training rows every score is the prior (0.5
if it is unknown too); rows with a null doc_id are scored and hash as empty text;
labels without a document, null labels and repeated labels of one document count
once, by the largest value; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm.common import batch_of, fresh_worker, slices, table, written
from dayledger.llm.textops import FACTOR, mix, row_of, utf8, word_hashes, words

SLICE = 1 << 20
CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "mark", "symbol", "bar", "wide")


def _class_table() -> np.ndarray:
    kind = np.full(256, CLASSES.index("symbol"), np.uint8)
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = 0, 1, 2, CLASSES.index("wide")
    kind[[0x20, 0x09, 0x0B, 0x0C]], kind[[0x0A, 0x0D]] = 3, 4
    for c in b".,;:'\"()-":
        kind[c] = CLASSES.index("stop")
    for c in b"!?":
        kind[c] = CLASSES.index("mark")
    kind[ord("|")] = CLASSES.index("bar")
    return kind


KIND = _class_table()
KIND_BIT = np.left_shift(1, KIND.astype(np.uint16)).astype(np.uint16)
NAMES = (*CLASSES, "log_words", "word_length", "capital_words", "symbol_words", "mark_words", "digit_words", "single_words",
         "repeated_next", "repeated_second", "distinct_words", "distinct_pairs", "distinct_lines", "top_word")
SIZE = 2 * len(NAMES) + 1  # each as it is and its square root, and a constant


def _share(of: np.ndarray, n: np.ndarray) -> np.ndarray:
    return of / np.maximum(n, 1)


def _distinct(values: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, and how often its most frequent one occurs."""
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    first = np.flatnonzero(new)
    top = np.zeros(rows, np.int64)
    np.maximum.at(top, r[first], np.diff(np.append(first, len(v))))
    return np.bincount(r[first], minlength=rows), top


def features(col: pa.Array) -> np.ndarray:
    """One row of statistics for each text."""
    data, offs = utf8(col)
    rows = len(offs) - 1
    out = np.zeros((rows, len(NAMES)))
    kind, size = KIND[data], np.diff(offs)
    put = lambda name, value: out.__setitem__((slice(None), NAMES.index(name)), value)
    each = [np.bincount(kind[x:y], minlength=len(CLASSES)) for x, y in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
    out[:, :len(CLASSES)] = np.array(each).reshape(rows, -1) / np.maximum(size, 1)[:, None]
    starts, ends, counts = words(data, offs)
    n, row = np.diff(counts), row_of(counts)
    per_row = lambda flag: np.bincount(row[flag], minlength=rows)
    # the classes in each word, a bit each; white space up to the next word adds its own bits only
    bits = np.bitwise_or.reduceat(KIND_BIT[data], starts) if len(starts) else np.zeros(0, np.uint16)

    def holds(*kinds: str) -> np.ndarray:
        return bits & sum(1 << CLASSES.index(k) for k in kinds) > 0

    put("log_words", np.log1p(n) / 10)
    put("word_length", _share(np.bincount(row, ends - starts, minlength=rows), n) / 10)
    put("capital_words", _share(per_row(holds("upper") & ~holds("lower") & (ends - starts > 1)), n))
    put("symbol_words", _share(per_row(holds("symbol", "bar")), n))
    put("mark_words", _share(per_row(holds("mark")), n))
    put("digit_words", _share(per_row(holds("digit")), n))
    put("single_words", _share(per_row(ends - starts == 1), n))
    h = word_hashes(data, starts, ends, lower=True)
    for gap, name in ((1, "repeated_next"), (2, "repeated_second")):
        again = np.zeros(len(h), bool)
        again[gap:] = (h[gap:] == h[:-gap]) & (row[gap:] == row[:-gap])
        put(name, _share(per_row(again), n))
    # repetition grows with length, so it is measured against its usual growth
    kinds, top = _distinct(h, row, rows)
    put("distinct_words", _share(kinds, np.maximum(n, 1) ** 0.85))
    put("top_word", _share(top, n))
    pair = mix(h[1:] * FACTOR + h[:-1])
    inside = row[1:] == row[:-1]
    kinds, _ = _distinct(pair[inside], row[1:][inside], rows)
    put("distinct_pairs", _share(kinds, np.maximum(n - 1, 1)))
    put("distinct_lines", _line_share(data, offs))
    return np.concatenate([out, np.sqrt(np.abs(out)), np.ones((rows, 1))], axis=1)


def _line_share(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Distinct lines of each text against all its lines."""
    rows = len(offs) - 1
    if not len(data):
        return np.zeros(rows)
    cut = np.unique(np.concatenate([offs[:-1][np.diff(offs) > 0], np.flatnonzero(data[:-1] == 0x0A) + 1]))
    ends = np.append(cut[1:], len(data))
    h = word_hashes(data, cut, ends, lower=True)
    row = np.searchsorted(offs, cut, side="right") - 1
    kinds, _ = _distinct(h, row, rows)
    return _share(kinds, np.bincount(row, minlength=rows))


# ---- learning ---------------------------------------------------------------

def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("x", pa.binary())])
    fresh_worker()
    for rows, col in slices(batches, "text", SLICE):
        x = features(col).astype("<f4")
        yield batch_of(schema, doc_id=rows.column("doc_id"), held_out=rows.column("held_out"), x=[r.tobytes() for r in x])


def _matrix(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), "<f4").reshape(-1, SIZE).astype(np.float64)


def _sums(function):
    """Per task: sums of ``function(x)`` over all rows (of: u) and over the
    positives (of: p), one row an entry."""
    schema = pa.schema([("of", pa.string()), ("k", pa.int32()), ("v", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            value = function(_matrix(batch.column("x")))
            good = np.asarray(batch.column("good"), dtype=bool)
            for of, part in (("u", value), ("p", value[good])):
                total[of] = total.get(of, 0) + part.sum(0)
        for of, v in total.items():
            yield batch_of(schema, of=[of] * len(v), k=np.arange(len(v)), v=v)

    return run


def _collect_sums(rows: DataFrame, function, size: int) -> dict[str, np.ndarray]:
    out = {"u": np.zeros(size), "p": np.zeros(size)}
    found = rows.select("x", "good").mapInArrow(_sums(function), "of string, k int, v double")
    for row in found.groupBy("of", "k").agg(F.sum("v").alias("v")).toArrow().to_pylist():  # 2 * size rows at most
        out[row["of"]][row["k"]] = row["v"]
    return out


def _moments(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, x * x, np.ones((len(x), 1))], axis=1)


def _terms(w: np.ndarray, mean: np.ndarray, scale: np.ndarray):
    """Per row: loss and gradient as a positive, loss and gradient as a negative, one."""
    def run(x: np.ndarray) -> np.ndarray:
        z = (x - mean) / scale
        g = z @ w
        p = 1 / (1 + np.exp(-np.clip(g, -40, 40)))
        return np.concatenate([np.logaddexp(0, -g)[:, None], z * (p - 1)[:, None], np.logaddexp(0, g)[:, None],
                               z * p[:, None], np.ones((len(x), 1))], axis=1)

    return run


class Model:
    def __init__(self, w: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.w, self.mean, self.scale = w, mean, scale

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.w, self.mean, self.scale

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((x - self.mean) / self.scale @ self.w, -40, 40)))


def fit(rows: DataFrame, prior: float, steps: int, rate: float, l2: float) -> Model:
    """``rows``: x, good (a trusted positive). Full-batch descent with momentum
    terms per weight (Adam)."""
    m = _collect_sums(rows, _moments, 2 * SIZE + 1)["u"]
    n = max(m[-1], 1)
    mean = m[:SIZE] / n
    scale = np.sqrt(np.maximum(m[SIZE:2 * SIZE] / n - mean**2, 0))
    scale[scale < 1e-6] = 1
    mean[-1], scale[-1] = 0, 1
    w, first, second = np.zeros(SIZE), np.zeros(SIZE), np.zeros(SIZE)
    w[-1] = np.log(prior / (1 - prior))
    for step in range(1, steps + 1):
        s = _collect_sums(rows, _terms(w, mean, scale), 2 * SIZE + 3)
        if not s["p"][-1] or not s["u"][-1]:
            return Model(w, mean, scale)
        p, u = s["p"] / s["p"][-1], s["u"] / s["u"][-1]
        bad = u[SIZE + 1] - prior * p[SIZE + 1]
        bad_gradient = u[SIZE + 2:-1] - prior * p[SIZE + 2:-1]
        gradient = prior * p[1:SIZE + 1] + bad_gradient if bad >= 0 else -bad_gradient
        gradient = gradient + l2 * np.append(w[:-1], 0)
        first, second = 0.9 * first + 0.1 * gradient, 0.98 * second + 0.02 * gradient**2
        w = w - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.98**step)) + 1e-8)
    return Model(w, mean, scale)


def _score(shared):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = Model(*shared.value).scores(_matrix(batch.column("x")))
                yield batch_of(schema, doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), score=s, predicted=(s >= 0.5).astype(np.int32))

    return run


def train(docs: DataFrame, labels: DataFrame, prior: float | None = None, steps: int = 30, rate: float = 0.25,
          l2: float = 1e-4) -> tuple[Model, DataFrame]:
    """The model, and the written features (doc_id, held_out, x) of all ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    x = written(rows.mapInArrow(_features, "doc_id long, held_out boolean, x binary"), "quality-features")
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").where("quality is not null and doc_id is not null")
             .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.max("quality") > 0).alias("good")))
    if prior is None:
        share = known.agg(F.avg(F.col("good").cast("int"))).first()[0]
        prior = 0.5 if share is None else share
    prior = min(max(prior, 0.02), 0.98)
    fold = written(x.where(~F.col("held_out")).join(known, "doc_id", "left")
                   .select("x", F.coalesce("good", F.lit(False)).alias("good")), "quality-fold")
    return fit(fold, prior, steps, rate, l2), x


def quality_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    model, x = train(docs, labels, **options)
    return x.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model.parts())), "doc_id long, held_out boolean, score double, predicted int")


def _keep(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker()
        model = Model(*shared.value)
        for rows, col in slices(batches, "text", SLICE):
            yield rows.filter(pa.array(model.scores(features(col).astype("<f4")) >= 0.5))

    return run


def good_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the model accepts, all columns kept."""
    model, _ = train(docs, labels, **options)
    return docs.mapInArrow(_keep(docs.sparkSession.sparkContext.broadcast(model.parts())), docs.schema)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_scores(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))
