"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared after folding: lower case, every run of ASCII characters
other than letters and digits is one space, one space at either end. An item of
m folded bytes matches a document if some part of its folded text is within
``percent`` % of m edits (insert, delete, replace a byte). With k edits to spend
and the item split into k + 1 pieces, one piece at least must occur unchanged:
an automaton over all pieces finds those hits in one pass over the text. Each
hit fixes where the item would lie; the region around it is verified with
Myers' bit-parallel distance (an item is one integer, whatever its length).

Items are broadcast in blocks of at most ``block_bytes`` of text; a larger
benchmark takes further passes over the documents. Documents never move.

Defined cases: null, empty or wordless items match nothing; null or empty texts
hold nothing; items of equal text are found each under its id; repeated rows and
null ids give rows of their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm.common import batch_of, slices, table
from dayledger.llm.textops import utf8

SLICE = 4 << 20
FOLD = np.full(256, 0x20, np.uint8)
FOLD[0x80:] = np.arange(0x80, 0x100)
FOLD[0x30:0x3A] = np.arange(0x30, 0x3A)
FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


def folded(col: pa.Array) -> tuple[bytes, np.ndarray]:
    """All folded texts, each within spaces and followed by a line end, and the
    start of each."""
    data, offs = utf8(pc.utf8_lower(col))
    n = len(offs) - 1
    out = np.empty(len(data) + 3 * n, np.uint8)
    # text i moves by 3 i + 1: a space before it, a space and a line end after it
    shift = np.repeat(3 * np.arange(n) + 1, np.diff(offs))
    out[offs[:-1] + 3 * np.arange(n)] = 0x20
    out[np.arange(len(data)) + shift] = FOLD[data]
    out[offs[1:] + 3 * np.arange(n) + 1] = 0x20
    out[offs[1:] + 3 * np.arange(n) + 2] = 0x0A
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 0x20) | (out[:-1] != 0x20)
    starts = offs[:-1] + 3 * np.arange(n)
    before = np.concatenate([[0], np.cumsum(keep)])
    return out[keep].tobytes(), before[starts]


class Pattern:
    """A folded item for Myers' bit-parallel distance."""

    def __init__(self, text: bytes):
        self.size = len(text)
        self.full = (1 << self.size) - 1
        self.top = 1 << (self.size - 1)
        self.where: dict[int, int] = {}
        for i, c in enumerate(text):
            self.where[c] = self.where.get(c, 0) | 1 << i

    def best(self, text: bytes, anchored: bool = False) -> tuple[int, int]:
        """Least distance of the whole pattern to a part of ``text`` (to a prefix
        if anchored), and where that part ends (the first such end)."""
        up, down, distance = self.full, 0, self.size
        least, end = self.size, 0
        full, top, where = self.full, self.top, self.where
        for at, c in enumerate(text, 1):
            eq = where.get(c, 0)
            x = eq | down
            h = (((eq & up) + up) ^ up) | eq
            plus = down | (full & ~(h | up))
            minus = up & h
            if plus & top:
                distance += 1
            elif minus & top:
                distance -= 1
            plus = (plus << 1 | anchored) & full
            minus = minus << 1 & full
            up = minus | (full & ~(x | plus))
            down = plus & x
            if distance < least:
                least, end = distance, at
        return least, end


class Items:
    """A block of items: their pieces in one automaton, patterns made on demand."""

    def __init__(self, rows: list[tuple[int, bytes]], percent: int):
        import ahocorasick

        self.rows = rows
        self.budget = [len(t) * percent // 100 for _, t in rows]
        self.patterns: dict[int, tuple[Pattern, Pattern]] = {}
        pieces: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text) in enumerate(rows):
            parts = self.budget[i] + 1
            cuts = [len(text) * p // parts for p in range(parts + 1)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                pieces.setdefault(text[a:b].decode("latin-1"), []).append((i, a))
        self.automaton = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.automaton.add_word(piece, (len(piece), where))
        if pieces:
            self.automaton.make_automaton()
        self.empty = not pieces

    def pattern(self, i: int) -> tuple[Pattern, Pattern]:
        if i not in self.patterns:
            text = self.rows[i][1]
            self.patterns[i] = Pattern(text), Pattern(text[::-1])
        return self.patterns[i]

    def matches(self, text: bytes, starts: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, distance, start, end) of each item found in a row, its
        best place; places are bytes of the row's folded text."""
        if self.empty or not len(starts):
            return
        plain = text.decode("latin-1")
        regions: dict[tuple[int, int], list[list[int]]] = {}
        hits = [(end + 1 - size, where) for end, (size, where) in self.automaton.iter(plain)]
        rows = (np.searchsorted(starts, [h[0] for h in hits], side="right") - 1).tolist() if hits else []
        ends = np.append(starts[1:], len(text)) - 1  # without the line end
        for row, (at, where) in zip(rows, hits, strict=True):
            for i, offset in where:
                k = self.budget[i]
                lo = max(int(starts[row]), at - offset - k)
                hi = min(int(ends[row]), at - offset + len(self.rows[i][1]) + k)
                if hi - lo < len(self.rows[i][1]) - k:
                    continue
                spans = regions.setdefault((row, i), [])
                if spans and lo <= spans[-1][1] and lo >= spans[-1][0]:
                    spans[-1][1] = max(spans[-1][1], hi)
                else:
                    spans.append([lo, hi])
        for (row, i), spans in regions.items():
            spans.sort()
            merged = [spans[0]]
            for lo, hi in spans[1:]:
                if lo <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], hi)
                else:
                    merged.append([lo, hi])
            forward, backward = self.pattern(i)
            found = []
            for lo, hi in merged:
                distance, end = forward.best(text[lo:hi])
                if distance <= self.budget[i]:
                    found.append((distance, lo + end, lo))
            if found:
                distance, end, lo = min(found)
                _, back = backward.best(text[lo:end][::-1], anchored=True)
                yield row, i, distance, end - back - int(starts[row]), end - int(starts[row])


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, bytes]]]:
    """Folded items, some MB at a time."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).orderBy("item_id", "text").toArrow()
        col = part.column("text").cast(pa.large_string()).fill_null("").combine_chunks()
        col = pa.concat_arrays(col.chunks) if isinstance(col, pa.ChunkedArray) else col
        text, _ = folded(col)
        yield [(i, t) for i, t in zip(part.column("item_id").to_pylist(), text.split(b"\n"), strict=False) if t.strip()]


MATCH_DDL = "doc_id long, item_id long, distance int, item_bytes int, start int, end int"


def _matches(shared, percent: int):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), *[(c, pa.int32()) for c in ("distance", "item_bytes", "start", "end")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(shared.value, percent)
        for rows, col in slices(batches, "text", SLICE):
            ids = rows.column("doc_id")
            found = [(ids[r].as_py(), items.rows[i][0], d, len(items.rows[i][1]), a, b)
                     for r, i, d, a, b in items.matches(*folded(col))]
            if found:
                yield batch_of(schema, **dict(zip(schema.names, zip(*found, strict=True), strict=True)))

    return run


def _clean(shared, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(shared.value, percent)
        for rows, col in slices(batches, "text", SLICE):
            keep = np.ones(rows.num_rows, bool)
            keep[[m[0] for m in items.matches(*folded(col))]] = False
            yield rows.filter(pa.array(keep))

    return run


def benchmark_matches(docs: DataFrame, items: DataFrame, percent: int = 6, block_bytes: int = 4 << 20) -> DataFrame:
    """A row for each document and item found in it: doc_id, item_id, distance,
    item_bytes, and the place (start, end) in the folded text."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], MATCH_DDL)
    for block in item_blocks(items, block_bytes):
        shared = spark.sparkContext.broadcast(block)
        out = out.union(rows.mapInArrow(_matches(shared, percent), MATCH_DDL))
    return out


def without_benchmark(docs: DataFrame, items: DataFrame, percent: int = 6, block_bytes: int = 4 << 20) -> DataFrame:
    """The rows of ``docs`` in whose text no item is found, all columns kept."""
    spark = docs.sparkSession
    for block in item_blocks(items, block_bytes):
        docs = docs.mapInArrow(_clean(spark.sparkContext.broadcast(block), percent), docs.schema)
    return docs


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document, exactly or with up to 6 % edits."""
    return benchmark_matches(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
