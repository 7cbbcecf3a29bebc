"""Document likelihood by a subword lattice over an existing vocabulary.

The vocabulary's pieces form a unigram model. A token's probability is the sum
over all its segmentations into pieces, by a forward recursion in log space over
the lattice of the token's characters (a word starts with the vocabulary's word
mark; a character without a piece is the product of its byte pieces). Tokens
are independent given the weights, so a document's log probability is the sum
over its tokens, the end token included.

Weights: the file's scores are the ranks of a merge vocabulary, so a weight
starts at 1 / (rank + 3) and is then re-estimated by ``rounds`` rounds of
expectation maximisation (forward-backward) over the distinct words of the
training documents, each weighted by its count.

Plan: words are counted per task before the shuffle; the lexicon (every
distinct word of all documents with its training count) is written once; the
recursion runs once a distinct word, not once a token. A document's sums come in
two tiers: the ``table_entries`` most frequent words (a bounded broadcast table)
are looked up in the map task, so no frequent word is a join key; the rest go
to their lexicon rows by a shuffle of (document, word hash, times).

Defined cases: a null text is empty (one token, the end); repeated rows and
null ids give a row each (a null id hashes as empty text, so it trains); with no
training documents all counts are zero; an empty table gives none; other
columns are ignored. Words meet their lexicon row by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm.common import batch_of, most_frequent, slices, table, worker_cache, written
from dayledger.llm.pretokens import pieces, sums
from dayledger.llm.textops import utf8, word_hashes

SLICE = 8 << 20
MARK = 0x110000  # the word start: no character
LN10 = np.log(10)


class Trie:
    """The vocabulary's pieces as transitions (state, character) -> state, held
    in an open-addressed table of arrays. Piece numbers: the file's ids; the
    end token comes after them."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size() + 1
        self.end = self.size - 1
        self.bytes = np.full(256, -1)
        self.rank = np.full(self.size, np.nan)
        steps: dict[tuple[int, int], int] = {}
        final = [-1]
        for i in range(self.end):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.rank[i] = self.end
                continue
            if model.is_control(i) or model.is_unknown(i) or "▁" in piece[1:]:
                continue
            self.rank[i] = -model.get_score(i)
            state = 0
            for c in piece:
                key = (state, MARK if c == "▁" else ord(c))
                if key not in steps:
                    steps[key] = len(final)
                    final.append(-1)
                state = steps[key]
            final[state] = i
        self.rank[self.end] = 0
        self.final = np.array(final)
        keys = np.array([s << 21 | c for s, c in steps], dtype=np.int64)
        to = np.array(list(steps.values()), dtype=np.int64)
        self.bits = np.uint64(64 - int(np.ceil(np.log2(len(keys) * 4))))
        self.slot_key = np.full(1 << (64 - int(self.bits)), -1, dtype=np.int64)
        self.slot_to = np.full(len(self.slot_key), -1, dtype=np.int64)
        while len(keys):  # place what fits, try the next slot with the rest
            at = self._slot(keys) if not hasattr(self, "_tries") else (self._slot(keys) + self._tries) % len(self.slot_key)
            free = self.slot_key[at] < 0
            _, one = np.unique(at[free], return_index=True)
            take = np.flatnonzero(free)[one]
            self.slot_key[at[take]], self.slot_to[at[take]] = keys[take], to[take]
            rest = np.ones(len(keys), bool)
            rest[take] = False
            keys, to = keys[rest], to[rest]
            self._tries = getattr(self, "_tries", 0) + 1
        self.single = {c for (s, c), t in steps.items() if s == 0 and final[t] >= 0}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.bits).astype(np.int64)

    def step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The next states, -1 where there is none."""
        key = state << 21 | char
        at = self._slot(key)
        got = self.slot_key[at]
        out = np.where(got == key, self.slot_to[at], -1)
        open_ = np.flatnonzero((got != key) & (got >= 0))
        for t in range(1, self._tries):
            if not len(open_):
                break
            at_t = (at[open_] + t) % len(self.slot_key)
            got = self.slot_key[at_t]
            hit = got == key[open_]
            out[open_[hit]] = self.slot_to[at_t[hit]]
            open_ = open_[~hit & (got >= 0)]
        return out

    def start(self) -> np.ndarray:
        """Log weights before any training."""
        w = np.where(np.isnan(self.rank), 0, 1 / (self.rank + 3))
        with np.errstate(divide="ignore"):
            return np.log(w / w.sum())

    def trained(self, expected: np.ndarray, smooth: float = 0.1) -> np.ndarray:
        """Log weights from expected counts."""
        w = np.where(np.isnan(self.rank), 0, expected + smooth)
        with np.errstate(divide="ignore"):
            return np.log(w / w.sum())


def lattice(trie: Trie, weight: np.ndarray, words: list[str], counts: np.ndarray | None = None):
    """Natural log probability of each word; with ``counts`` also the expected
    times that each piece is used in all of them."""
    out = np.zeros(len(words))
    expected = None if counts is None else np.zeros(trie.size)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    order = np.argsort(size, kind="stable")
    lo = 0
    while lo < len(order):
        n = int(size[order[lo]])
        hi = min(int(np.searchsorted(size[order], n, side="right")), lo + max(1, 2_000_000 // n))
        at = order[lo:hi]
        lo = hi
        text = "".join([words[i] for i in at.tolist()])
        chars = np.full((len(at), n), MARK, dtype=np.int64)
        chars[:, 1:] = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(at), n - 1)
        # characters without a piece of their own: their bytes, as one edge
        odd = {c: [int(trie.bytes[b]) for b in chr(c).encode("utf-8", "surrogatepass")]
               for c in np.unique(chars).tolist() if c not in trie.single and c != MARK}
        odd_chars = np.array(sorted(odd), dtype=np.int64)
        odd_weight = np.array([weight[odd[c]].sum() for c in odd_chars.tolist()])
        alpha = np.full((len(at), n + 1), -np.inf)
        alpha[:, 0] = 0
        edges = []  # (from, to, words, pieces or -1 - odd character, log weight)
        for i in range(n):
            live, state = np.arange(len(at)), np.zeros(len(at), np.int64)
            if len(odd_chars):
                k = np.minimum(np.searchsorted(odd_chars, chars[:, i]), len(odd_chars) - 1)
                w = np.flatnonzero(odd_chars[k] == chars[:, i])
                if len(w):
                    edges.append((i, i + 1, w, -1 - k[w], odd_weight[k[w]]))
                    alpha[w, i + 1] = np.logaddexp(alpha[w, i + 1], alpha[w, i] + odd_weight[k[w]])
            for j in range(i + 1, n + 1):
                state = trie.step(state, chars[live, j - 1])
                ok = state >= 0
                live, state = live[ok], state[ok]
                if not len(live):
                    break
                piece = trie.final[state]
                w = piece >= 0
                if w.any():
                    who, p = live[w], piece[w]
                    edges.append((i, j, who, p, weight[p]))
                    alpha[who, j] = np.logaddexp(alpha[who, j], alpha[who, i] + weight[p])
        out[at] = alpha[:, n]
        if expected is not None:
            beta = np.full((len(at), n + 1), -np.inf)
            beta[:, n] = 0
            for i, j, who, _, w in sorted(edges, key=lambda e: -e[0]):
                beta[who, i] = np.logaddexp(beta[who, i], beta[who, j] + w)
            times = counts[at]
            for i, j, who, p, w in edges:
                share = np.exp(alpha[who, i] + w + beta[who, j] - alpha[who, n]) * times[who]
                real = p >= 0
                expected += np.bincount(p[real], share[real], minlength=trie.size)
                for k in np.unique(-1 - p[~real]).tolist():
                    total = share[p == -1 - k].sum()
                    for b in odd[int(odd_chars[k])]:
                        expected[b] += total
    return out, expected


def _trie(path: str) -> Trie:
    return worker_cache(f"trie:{path}", lambda: Trie(path))


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold


def _words(col: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct lower-cased words, the number of each word in turn, words before each row."""
    distinct, index, offs = pieces(pc.ascii_lower(col), single_space=False)
    words = pa.array(distinct, pa.large_string())
    real = np.fromiter(map(bool, distinct), bool, len(distinct))[index]
    counts = sums(real.astype(np.int64), offs)
    return words, index[real], np.concatenate([[0], np.cumsum(counts)])


def _hash(words: pa.Array) -> np.ndarray:
    data, offs = utf8(words)
    full = np.flatnonzero(np.diff(offs))
    out = np.zeros(len(words), np.uint64)
    out[full] = word_hashes(data, offs[:-1][full], offs[1:][full], lower=False)
    return out.view(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.large_string()), ("n", pa.int64())])
    for rows, col in slices(batches, "text", SLICE):
        words, index, offs = _words(col)
        trains = np.repeat(~np.asarray(rows.column("held_out"), dtype=bool), np.diff(offs))
        n = np.bincount(index[trains], minlength=len(words))
        used = np.bincount(index, minlength=len(words)) > 0
        yield pa.RecordBatch.from_arrays([words.filter(pa.array(used)), pa.array(n[used])], schema=schema)


def _expect(path: str, shared):
    schema = pa.schema([("piece", pa.int64()), ("times", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(path)
        total = np.zeros(trie.size)
        for b in batches:
            total += lattice(trie, shared.value, b.column(0).to_pylist(), np.asarray(b.column(1), dtype=np.float64))[1]
        at = np.flatnonzero(total)
        yield batch_of(schema, piece=at, times=total[at])

    return run


def _weigh(path: str, shared):
    schema = pa.schema([("h", pa.int64()), ("n", pa.int64()), ("lattice", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(path)
        for b in batches:
            words = b.column(0)
            value, _ = lattice(trie, shared.value, words.to_pylist())
            yield batch_of(schema, h=_hash(words.cast(pa.large_string())), n=b.column(1), lattice=value / LN10)

    return run


PARTIAL = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, lattice double, "
           "rest array<struct<h: long, times: int>>")


def _score(shared, end_base: float, end_lattice: float, end_known: int):
    rest = pa.list_(pa.struct([("h", pa.int64()), ("times", pa.int32())]))
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("base", pa.float64()), ("lattice", pa.float64()), ("rest", rest)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, known, base, lat = shared.value
        at = TaskContext.get().partitionId() << 40
        for rows, col in slices(batches, "text", SLICE):
            words, index, offs = _words(col)
            h = _hash(words)
            k = np.minimum(np.searchsorted(keys, h), max(0, len(keys) - 1))
            hit = keys[k] == h if len(keys) else np.zeros(len(h), bool)
            value = lambda x, k=k, hit=hit: np.where(hit, x[k] if len(x) else 0, 0)
            n = len(col)
            row = np.repeat(np.arange(n), np.diff(offs))
            miss = ~hit[index]
            pair, times = np.unique(row[miss] * len(words) + index[miss], return_counts=True)
            of, which = np.divmod(pair, max(1, len(words)))
            ends = np.searchsorted(of, np.arange(n + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(h[which]), pa.array(times, pa.int32())], names=["h", "times"]))
            yield pa.RecordBatch.from_arrays([
                pa.array(at + np.arange(n)), rows.column("doc_id"), rows.column("held_out"),
                pa.array(np.diff(offs) + 1), pa.array(sums(value(known)[index], offs) + end_known),
                pa.array(sums(value(base)[index], offs) + end_base),
                pa.array(sums(value(lat)[index], offs) + end_lattice), lists], schema=schema)
            at += n

    return run


def lattice_scores(docs: DataFrame, vocabulary: str, rounds: int = 2, table_entries: int = 400_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of
    each document; learns from the documents that are not held out."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    lexicon = written(rows.select("held_out", "text").mapInArrow(_count, "word string, n long")
                      .groupBy("word").agg(F.sum("n").alias("n")), "lexicon")
    trained = rows.where(~F.col("held_out")).count()
    stats = lexicon.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    total, distinct = (stats["n"] or 0) + trained, (stats["v"] or 0) + (trained > 0)

    trie = Trie(vocabulary)
    weight = trie.start()
    for _ in range(rounds):
        expected = np.zeros(trie.size)
        found = (lexicon.where("n > 0").mapInArrow(_expect(vocabulary, sc.broadcast(weight)), "piece long, times double")
                 .groupBy("piece").agg(F.sum("times").alias("times")).toArrow())  # a row a piece at most
        expected[np.asarray(found.column(0))] = np.asarray(found.column(1))
        expected[trie.end] = trained
        weight = trie.trained(expected)

    base = F.log10((F.col("n") + 1) / F.lit(float(total + distinct + 1)))
    weighed = written(lexicon.mapInArrow(_weigh(vocabulary, sc.broadcast(weight)), "h long, n long, lattice double")
                      .select("h", "n", base.alias("base"), "lattice"), "lexicon-scores")
    top = most_frequent(weighed, "n", table_entries).toArrow().sort_by("h")  # table_entries rows at most
    shared = sc.broadcast((np.asarray(top["h"]), (np.asarray(top["n"]) > 0).astype(np.int64),
                           np.asarray(top["base"]), np.asarray(top["lattice"])))

    end_base = float(np.log10((trained + 1) / (total + distinct + 1)))
    partial = written(rows.mapInArrow(_score(shared, end_base, float(weight[trie.end] / LN10), int(trained > 0)), PARTIAL),
                      "partial-scores")
    rest = (partial.select("row", F.explode("rest").alias("r")).select("row", F.col("r.h").alias("h"), "r.times")
            .join(weighed, "h").groupBy("row")
            .agg(F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rest_known"),
                 F.sum(F.col("base") * F.col("times")).alias("rest_base"),
                 F.sum(F.col("lattice") * F.col("times")).alias("rest_lattice")))
    more = lambda c, kind: F.coalesce(F.col(c), F.lit(0).cast(kind))
    return partial.drop("rest").join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + more("rest_known", "long")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + more("rest_base", "double")).alias("base_score"),
        (F.col("lattice") + more("rest_lattice", "double")).alias("score"))


def op6_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under the subword lattice model."""
    return lattice_scores(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
