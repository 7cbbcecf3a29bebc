"""Token counts by a two-tier lookup inside each map task; no pre-token is shuffled.

First tier: a hash table of the corpus's frequent pre-tokens and their token
counts, at most ``table_entries`` entries, broadcast. It comes from a pass over
all documents in which each task counts its pre-tokens in bounded memory and
hands on its ``per_task`` most frequent ones. The table only saves work: counts
do not depend on what it holds. Second tier: pre-tokens it misses are encoded
by the tokenizers library and kept in the worker's bounded cache.

A text is cut at spaces (arrow), its distinct pieces at the pre-token pattern.
Pieces with characters beyond Latin-1, control characters or special strings go
to the library whole, so its defaults hold for them.

Defined cases: a null text is empty (0 bytes, 0 tokens); repeated rows and null
ids give a row each; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm.common import batch_of, most_frequent, slices, table, worker_cache, written
from dayledger.llm.pretokens import BYTE_PATTERN, PLAIN, Bounded, byte_alphabet, pieces, specials, sums

#: A piece that starts or ends with white space, or is empty, is not on its own:
#: its text is cut by this pattern instead.
ALONE = re.compile(r"\S(.*\S)?", re.DOTALL).fullmatch
LOOSE = re.compile(r" ?\S+|\s+(?!\S)|\s+")
SLICE = 8 << 20


class Counter:
    """Token counts of pre-tokens by a tokenizer file, with a bounded memory of
    what the broadcast table does not hold."""

    def __init__(self, path: str, entries: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.byte_char = str.maketrans(dict(enumerate(byte_alphabet())))
        self.special = [t for t, _ in specials(path)]
        self.cache = Bounded(entries)
        self.frequent: dict[str, int] = {}

    def whole(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def plain(self, text: str) -> bool:
        return PLAIN(text) is not None and not any(s in text for s in self.special)

    def pretoken(self, p: str) -> int:
        n = self.frequent.get(p)
        if n is None and (n := self.cache.get(p)) is None:
            mapped = p.encode("utf-8").decode("latin-1").translate(self.byte_char)
            n = self.cache.put(p, len(self.library.model.tokenize(mapped)))
        return n

    def piece(self, text: str) -> int:
        """Tokens of a text that starts at a pre-token's start and whose end is one's end."""
        if self.plain(text):
            return sum(map(self.pretoken, BYTE_PATTERN.findall(text)))
        return self.whole(text)


def _pretokens_of(col: pa.Array) -> Iterator[tuple[str, int]]:
    """Plain pre-tokens of a batch with how often they occur (white space that
    follows white space aside: it is rare and left to the cache)."""
    distinct, index, _ = pieces(col, single_space=True)
    times = np.bincount(index, minlength=len(distinct)).tolist()
    for text, n in zip(distinct, times, strict=True):
        if ALONE(text) and PLAIN(text):
            for p in BYTE_PATTERN.findall(" " + text):
                yield p, n


def _frequent(per_task: int, memory: int):
    schema = pa.schema([("pretoken", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for _, col in slices(batches, "text", SLICE):
            for p, n in _pretokens_of(col):
                seen[p] = seen.get(p, 0) + n
            if len(seen) > memory:  # the rare half goes; a frequent one comes back
                least = sorted(seen.values())[len(seen) // 2]
                seen = {p: n for p, n in seen.items() if n > least}
        best = sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:per_task]
        if best:
            p, n = zip(*best, strict=True)
            yield batch_of(schema, pretoken=p, n=n)

    return run


def frequent_pretokens(docs: DataFrame, entries: int, per_task: int, memory: int = 400_000) -> list[str]:
    """The corpus's most frequent pre-tokens, at most ``entries``, each of at most
    64 characters (so the broadcast table is at most a few MB)."""
    counts = written(docs.select("text").mapInArrow(_frequent(per_task, memory), "pretoken string, n long")
                     .where(F.length("pretoken") <= 64).groupBy("pretoken").agg(F.sum("n").alias("n")), "pretoken-counts")
    return most_frequent(counts, "n", entries).select("pretoken").toArrow().column(0).to_pylist()


def _count(path: str, known, cache: int, limit: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_cache(f"token-counter:{path}:{cache}", lambda: Counter(path, cache))
        counter.frequent = known.value
        for rows, col in slices(batches, "text", SLICE):
            distinct, index, offs = pieces(col, single_space=True)
            alone = np.fromiter((ALONE(t) is not None for t in distinct), bool, len(distinct))
            n = np.fromiter((counter.piece(" " + t) if ok else 0 for t, ok in zip(distinct, alone.tolist(), strict=True)),
                            np.int64, len(distinct))
            per_piece = n[index]
            first = offs[:-1]
            per_piece[first] = [counter.piece(distinct[i]) if alone[i] else 0 for i in index[first].tolist()]
            totals = sums(per_piece, offs)
            for row in np.flatnonzero(sums(~alone[index], offs)).tolist():
                text = col[row].as_py()
                totals[row] = (sum(map(counter.piece, LOOSE.findall(text))) if counter.plain(text)
                               else counter.whole(text))
            size = np.diff(np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1])
            yield batch_of(schema, doc_id=rows.column("doc_id"), n_bytes=size, n_tokens=totals, over_limit=totals > limit)

    return run


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, table_entries: int = 100_000,
                 per_task: int = 20_000, cache_entries: int = 400_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) of each document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counter = Counter(tokenizer, 0)
    known = {p: counter.pretoken(p) for p in frequent_pretokens(rows, table_entries, per_task)}
    shared = docs.sparkSession.sparkContext.broadcast(known)
    return rows.mapInArrow(_count(tokenizer, shared, cache_entries, limit),
                           "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the byte-level vocabulary."""
    return token_counts(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
