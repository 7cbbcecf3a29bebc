"""Near-duplicate documents by bottom-k sketches.

A document's set is its distinct k-word shingles. One hash function orders all
shingles; a document's sketch holds the smallest ``SKETCH`` values of its set (all
of a smaller set). A sample of the union of two sets is the smallest ``SKETCH``
values of both sketches together, and the share of these that both sketches hold
estimates the similarity. The sample is drawn without replacement, so the law of its
common values is hypergeometric in the size of the union, which the sizes of the
sets bound: a linked pair is missed with a probability below ``RISK``. Sketches
that hold whole sets are compared exactly.

1. Equal sets (by a 128-bit fingerprint) are one class; its smallest id stands
   for it from here on.
2. Inverted lists of the smallest retained value, then of the second: inside a
   list the values that members share are counted, pairs are estimated, and a few
   trees that span what the estimate allows become candidates. They are
   confirmed on the full sets, and what they tie is one group from then on.
3. What may still be linked: two whole sets share all but a fifth of the larger
   one; longer sets have, among their smallest ``LISTED`` values, a least number of
   common ones by the same law. So a linked pair shares ``SHARED`` of the values
   that a document has beyond this number, in one order of all values with the
   frequent ones last. Lists of these values that hold several groups
   give the overlaps of pairs of different groups: short lists by a join that
   counts the common values of a pair, long ones in blocks of bounded size, each two
   blocks in a task of their own, by counts over the blocks' values. All
   pairs that pass the estimate on whole sketches are confirmed.

Nothing is capped: a hot list is dealt to many tasks, and lists that hold one
group only are dropped because all their members are tied already. Texts are
read again for candidates alone; the text of a document in many pairs goes
once to each task that confirms some of them.

Defined cases: a document without words (null, empty, white space) has an empty
set, size 0, and is linked with nothing; one of fewer words than k has its whole
sequence as one shingle; rows that share a doc_id are one node; a null doc_id
takes no part, has no component and is kept; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm.common import batch_of, most_frequent, slices, small_batches, table, written
from dayledger.llm.graph import EDGES, components
from dayledger.llm.op4_signature_tree import shingles
from dayledger.llm.textops import mix, ragged

SLICE = 2 << 20
SKETCH = 192
#: Values of a sketch, the smallest, whose inverted lists are read for sets that
#: the sketch does not hold whole.
LISTED = 64
RISK = 1e-12
#: Up to so many pairs of a block are estimated at once, without counting overlaps.
FEW = 20_000
#: Values that a linked pair shares among its listed ones.
SHARED = 4
#: Rounds of spanning trees before the whole lists are read.
ROUNDS = 2
ORDER, SAMPLED = np.uint64(0xB0770), np.uint64(0x5A3D1ED)
PAD = np.uint64(2**64 - 1)


def _first_beyond(risk: float, chance, sketch: int) -> int:
    """The least t at which the chances of 0 to t together exceed ``risk``."""
    below = 0.0
    for t in range(sketch):
        below += chance(t)
        if below > risk:
            return t
    return sketch


@functools.cache
def _match_bounds(sketch: int, percent: int, risk: float) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of unions, ascending, and for each the least number of common values
    in a sample of ``sketch``: a linked pair has fewer with a probability below
    ``risk``. The last bound is the binomial law's, for unions beyond all sizes."""
    sizes = np.unique(np.rint(sketch * 1.03 ** np.arange(190)).astype(np.int64))
    choose = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    least = []
    for union in sizes.tolist():
        common = -(-percent * union // 100)
        apart = union - common
        chance = lambda t: (math.exp(choose(common, t) + choose(apart, sketch - t) - choose(union, sketch))  # noqa: E731, B023
                            if t <= common and sketch - t <= apart else 0.0)  # noqa: B023
        least.append(_first_beyond(risk, chance, sketch))
    p = percent / 100
    least.append(_first_beyond(risk, lambda t: math.comb(sketch, t) * p ** t * (1 - p) ** (sketch - t), sketch))
    return sizes, np.array(least)


def least_matches(sketch: int, percent: int, union: np.ndarray, risk: float = RISK) -> np.ndarray:
    """The least number of common values that samples of ``sketch`` values have,
    for linked pairs whose unions are at most so large."""
    sizes, least = _match_bounds(sketch, percent, risk)
    return least[np.searchsorted(sizes, union)]


def least_shared(n: np.ndarray, sketch: int, percent: int) -> np.ndarray:
    """Common retained values that any link of a set of n shingles needs. A
    partner has up to n * 100 / percent shingles, and so has the union."""
    exact = -(-percent * n // 100)
    return np.where(n * 100 <= percent * sketch, exact, np.minimum(exact, least_matches(sketch, percent, n * 100 // percent)))


# ---- sets ------------------------------------------------------------------

SET = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("sketch", pa.binary())])
SET_DDL = "doc_id long, n long, f1 long, f2 long, sketch binary"


def _sketches(k: int, sketch: int):
    """Set sizes, fingerprints and sketches; of equal sets in a slice the first
    has the sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, col in slices(batches, "text", SLICE):
            values, of = shingles(col, k)
            placed = mix(values ^ ORDER)
            order = np.lexsort((placed, of))
            placed, of = placed[order], of[order]
            ends = np.searchsorted(of, np.arange(len(col) + 1))
            n = np.diff(ends)
            real = np.flatnonzero(n)
            f1, f2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            if len(real):
                f1[real] = np.add.reduceat(mix(placed ^ np.uint64(0xA5A5)), ends[real])
                f2[real] = np.add.reduceat(mix(placed * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7)), ends[real])
            ids = rows.column("doc_id").to_pylist()
            marks = list(zip(n.tolist(), f1.tolist(), f2.tolist(), strict=True))
            first: dict[tuple, int] = {}
            for i in sorted((i for i, x in enumerate(ids) if x is not None and n[i]), key=lambda i: ids[i]):
                first.setdefault(marks[i], i)
            held = set(first.values())
            yield batch_of(SET, doc_id=rows.column("doc_id"), n=n, f1=f1.view(np.int64), f2=f2.view(np.int64),
                           sketch=[placed[ends[i]:min(ends[i + 1], ends[i] + sketch)].astype("<u8").tobytes() if i in held else None for i in range(len(n))])

    return run


def _common(per_task: int):
    """The most frequent retained values of a task, in bounded memory."""
    schema = pa.schema([("v", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                raw = b"".join(batch.column("sketch").slice(lo, 1000).to_pylist())
                values, n = np.unique(np.frombuffer(raw, "<u8"), return_counts=True)
                held, where = np.unique(np.concatenate([held, values[n > 1]]), return_inverse=True)
                times = np.bincount(where, np.concatenate([times, n[n > 1]]), minlength=len(held)).astype(np.int64)
                if len(held) > 8 * per_task:
                    top = np.sort(np.argpartition(-times, 4 * per_task)[:4 * per_task])
                    held, times = held[top], times[top]
        top = np.argsort(-times, kind="stable")[:per_task]
        yield batch_of(schema, v=held[top].view(np.int64), n=times[top])

    return run


def frequent_values(signed: DataFrame, least: int = 16, entries: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent retained values (at most ``entries``) and their counts,
    ascending by value. They set an order, no result."""
    counts = written(signed.select("sketch").mapInArrow(_common(entries // 10), "v long, n long")
                     .groupBy("v").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "value-counts")
    found = most_frequent(counts, "n", entries).toArrow()
    v, n = np.asarray(found["v"]).view(np.uint64), np.asarray(found["n"])
    order = np.argsort(v)
    return v[order], n[order]


# ---- overlaps and estimates inside a task -----------------------------------

def common_counts(values: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """For documents that hold ``lens`` different values each: how many every two
    of them (i < j) have in common."""
    m = len(lens)
    of = np.repeat(np.arange(m), lens)
    order = np.argsort(values, kind="stable")
    value, of = values[order], of[order]
    first = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(value)))
    total = np.zeros((m, m), np.int32)
    long = np.flatnonzero(times > 16)
    for lo in range(0, len(long), 1024):
        part = long[lo:lo + 1024]
        held = np.zeros((len(part), m), np.float32)
        held[np.repeat(np.arange(len(part)), times[part]), ragged(of, first[part], times[part])] = 1
        total += (held.T @ held).astype(np.int32)
    for size in range(2, 17):
        at = first[times == size]
        if len(at):
            members = of[at[:, None] + np.arange(size)]
            i, j = np.triu_indices(size, 1)
            total += np.bincount((members[:, i] * m + members[:, j]).ravel(), minlength=m * m).reshape(m, m).astype(np.int32)
    return np.triu(total, 1)


class Block:
    """Some documents with their sketches, compared with each other: common
    values are counted among the smallest ``listed`` (``whole``: among all, of sets
    that their sketches hold), estimates take the sketches."""

    def __init__(self, rows: list[tuple], sketch: int, percent: int, listed: int = LISTED, whole: bool = False):
        doc, n, group, mark, raw = zip(*rows, strict=True)
        self.doc, self.n, self.group, self.mark = (np.array(x, np.int64) for x in (doc, n, group, mark))
        self.lens = np.array([len(x) // 8 for x in raw])
        self.values = np.frombuffer(b"".join(raw), "<u8")
        self.sketch, self.percent, self.listed = sketch, percent, sketch if whole else listed
        self.need = -(-percent * self.n // 100) if whole else least_shared(self.n, listed, percent)

    def overlaps(self) -> np.ndarray:
        """Common listed values of every two documents (i < j), from the block's
        inverted lists."""
        some = np.arange(len(self.values)) - np.repeat(np.cumsum(self.lens) - self.lens, self.lens) < self.listed
        return common_counts(self.values[some], np.minimum(self.lens, self.listed))

    def estimated(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the sketches of each pair allow a link, and their similarity
        in the sample of the union."""
        ok, share = np.zeros(len(i), bool), np.zeros(len(i))
        padded = np.full((len(self.doc), self.sketch), PAD)
        padded[np.arange(self.sketch) < self.lens[:, None]] = self.values
        n, m = self.n[i], self.n[j]
        bound = least_matches(self.sketch, self.percent, 100 * (n + m) // (100 + self.percent))
        for lo in range(0, len(i), 4096):
            a, b = i[lo:lo + 4096], j[lo:lo + 4096]
            both = np.sort(np.concatenate([padded[a], padded[b]], axis=1), axis=1)
            same = np.zeros(both.shape, bool)
            same[:, 1:] = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != PAD)
            rank = np.arange(1, both.shape[1] + 1) - np.cumsum(same, axis=1)
            union = self.lens[a] + self.lens[b] - same.sum(1)
            whole = (self.n[a] <= self.sketch) & (self.n[b] <= self.sketch)
            size = np.where(whole, union, np.minimum(union, self.sketch))
            hits = (same & (rank <= size[:, None])).sum(1)
            ok[lo:lo + 4096] = np.where(whole, 100 * hits >= self.percent * union, hits >= bound[lo:lo + 4096])
            share[lo:lo + 4096] = hits / size
        return ok, share

    def pairs(self, across: np.ndarray | None = None, met: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of one mark and different groups that may be linked, and their
        estimates. ``across``: sides; only pairs across them. ``met``: pairs that
        are compared elsewhere."""
        low, high = np.minimum(self.n[:, None], self.n), np.maximum(self.n[:, None], self.n)
        fine = np.triu(low * 100 >= high * self.percent, 1)
        fine &= (self.group[:, None] != self.group) & (self.mark[:, None] == self.mark) & (self.doc[:, None] != self.doc)
        if across is not None:
            fine &= across[:, None] != across
        if met is not None:
            fine &= ~met
        if np.count_nonzero(fine) > FEW:
            fine &= self.overlaps() >= np.maximum(self.need[:, None], self.need)
        i, j = np.nonzero(fine)
        ok, share = self.estimated(i, j)
        return i[ok], j[ok], share[ok]

    def forest(self, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
        """Stars over the pairs (i, j) that span what these and the groups tie
        together; the start of each has the most pairs."""
        m = len(self.doc)
        near = np.zeros((m, m), bool)
        near[i, j] = near[j, i] = True
        group = np.unique(self.group, return_inverse=True)[1]
        tied = np.zeros(group.max(initial=0) + 1, bool)
        out = []
        for start in np.argsort(-near.sum(1), kind="stable").tolist():
            if tied[group[start]] or not near[start].any():
                continue
            tied[group[start]] = True
            queue = np.flatnonzero(group == group[start]).tolist()
            while queue:
                at = queue.pop(0)
                more = np.flatnonzero(near[at] & ~tied[group])
                _, one = np.unique(group[more], return_index=True)  # one of each group
                for to in more[one].tolist():
                    out.append((int(self.doc[at]), int(self.doc[to])))
                    tied[group[to]] = True
                    queue += np.flatnonzero(group == group[to]).tolist()
        return out


def _pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True)
    return batch_of(pa.schema([("a", pa.int64()), ("b", pa.int64())]), a=a, b=b)


def _forests(sketch: int, listed: int, percent: int, block: int):
    """Rows sorted by (list, part): candidates that span each part. Several small
    parts are compared in one block; a part is no longer than a block but by chance."""
    def close(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        these = Block(held, sketch, percent, listed)
        i, j, share = these.pairs()
        sure = share * 100 >= percent
        found = {*these.forest(i[sure], j[sure]), *these.forest(i, j)}
        if found:
            yield _pair_batch(sorted(found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now, mark, since = None, 0, 0
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("list", "part", "doc_id", "n", "grp", "sketch")]
            for name, part, doc, n, grp, raw in zip(*cols, strict=True):
                if (name, part) != now:
                    if len(held) >= block // 2:
                        yield from close(held)
                        held = []
                    now, mark, since = (name, part), mark + 1, 0
                elif since >= 2 * block:  # parts are even only on the whole
                    yield from close(held)
                    held, since = [], 0
                since += 1
                held.append((doc, n, grp, mark, raw))
        if held:
            yield from close(held)

    return run


def _blocks(sketch: int, listed: int, percent: int):
    """Rows sorted by (key, size class, x, y): all pairs across the blocks x and y
    of a long list (within it where x = y) that may be linked, given in the
    class of the smaller set and in the first of the long lists that both are in."""
    def close(held: list[tuple], key: int, whole: bool, size: int, x: int, y: int) -> Iterator[pa.RecordBatch]:
        if len(held) < 2:
            return
        *rows, turn, sizes, lists = zip(*held, strict=True)
        before = [[v for v in own if v < key] for own in lists]
        met = common_counts(np.array([v for own in before for v in own], np.int64), np.array([len(own) for own in before])) > 0
        these = Block(list(zip(*rows, strict=True)), sketch, percent, listed, whole)
        i, j, _ = these.pairs(np.array(turn) if x != y else None, met)
        sizes = np.array(sizes)
        mine = np.minimum(sizes[i], sizes[j]) == size
        a, b = these.doc[i[mine]].tolist(), these.doc[j[mine]].tolist()
        for lo in range(0, len(a), 50_000):
            yield _pair_batch([(min(p), max(p)) for p in zip(a[lo:lo + 50_000], b[lo:lo + 50_000], strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now = None
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("key", "whole", "size", "x", "y", "doc_id", "n", "grp", "sketch", "turn", "own_size", "lists")]
            for *here, doc, n, grp, raw, turn, own, lists in zip(*cols, strict=True):
                if here != now:
                    if held:
                        yield from close(held, *now)
                        held = []
                    now = here
                held.append((doc, n, grp, 0, raw, turn, own, lists))
        if held:
            yield from close(held, *now)

    return run


POSTING_DDL = "key long, whole boolean, doc_id long, n long, grp long, need int"


def _postings(sketch: int, listed: int, percent: int, shared):
    """A row for each listed value of a document: its rarest ones, SHARED more
    than those it has beyond the overlap that any link needs. Sets that a sketch
    holds list of all their values; sets with a partner that none holds, of their smallest."""
    schema = pa.schema([("key", pa.int64()), ("whole", pa.bool_()), ("doc_id", pa.int64()), ("n", pa.int64()), ("grp", pa.int64()), ("need", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, times = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                size = np.asarray(part.column("n"))
                for whole, some in ((True, size <= sketch), (False, size * 100 > sketch * percent)):
                    mine = part.filter(pa.array(some))
                    if not mine.num_rows:
                        continue
                    n = size[some]
                    raw = [x if whole else x[:8 * listed] for x in mine.column("sketch").to_pylist()]
                    lens = np.array([len(x) // 8 for x in raw])
                    values = np.frombuffer(b"".join(raw), "<u8")
                    row = np.repeat(np.arange(len(lens)), lens)
                    count = np.zeros(len(values), np.int64)
                    if len(often):
                        at = np.minimum(np.searchsorted(often, values), len(often) - 1)
                        count = np.where(often[at] == values, times[at], 0)
                    order = np.lexsort((values, count, row))
                    need = -(-percent * n // 100) if whole else least_shared(n, listed, percent)
                    place = np.arange(len(values)) - np.repeat(np.cumsum(lens) - lens, lens)
                    first = order[place < (lens - need + SHARED)[row]]  # rows keep their places under the order
                    of = row[first]
                    key = values[first] if whole else values[first] ^ SAMPLED
                    yield batch_of(schema, key=key.view(np.int64), whole=np.full(len(of), whole), doc_id=np.asarray(mine.column("doc_id"))[of],
                                   n=n[of], grp=np.asarray(mine.column("grp"))[of], need=need[of])

    return run


def _allowed(sketch: int, percent: int):
    """Pairs with both sketches: those that the estimate allows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                m = part.num_rows
                col = lambda c: part.column(c).to_pylist()  # noqa: E731, B023
                these = Block([*zip(col("a"), col("n_a"), [0] * m, [0] * m, col("sketch_a"), strict=True),
                               *zip(col("b"), col("n_b"), [0] * m, [0] * m, col("sketch_b"), strict=True)], sketch, percent)
                ok, _ = these.estimated(np.arange(m), np.arange(m, 2 * m))
                keep = pa.array(ok)
                yield pa.RecordBatch.from_arrays([part.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])

    return run


# ---- confirmation on the full sets ------------------------------------------

def _confirm(k: int, percent: int):
    """Rows sorted by (a, part), the texts of a (b null) before those of its
    partners: the pairs whose full sets are linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: list[np.ndarray] = []
        now = None
        for rows, col in slices(batches, "text", SLICE):
            values, of = shingles(col, k)
            ends = np.searchsorted(of, np.arange(len(col) + 1)).tolist()
            found = []
            for i, (a, part, b) in enumerate(zip(*[rows.column(c).to_pylist() for c in ("a", "part", "b")], strict=True)):
                if (a, part) != now:
                    heads, now = [], (a, part)
                mine = values[ends[i]:ends[i + 1]]
                if b is None:
                    heads.append(mine.copy())
                    continue
                for x in heads:
                    both = len(np.intersect1d(x, mine, assume_unique=True))
                    if both and 100 * both >= percent * (len(x) + len(mine) - both):
                        found.append((a, b))
                        break
            if found:
                yield _pair_batch(found)

    return run


def confirmed(pairs: DataFrame, docs: DataFrame, k: int, percent: int, small: int, per_task: int = 256) -> DataFrame:
    """The (written) pairs whose full sets are linked."""
    spark = docs.sparkSession
    ids = written(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "pair-ids")
    few = ids.count() <= small
    texts = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    texts = written(texts.groupBy("doc_id", F.xxhash64("text").alias("mark")).agg(F.any_value("text").alias("text")).select("doc_id", "text"), "pair-texts")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / per_task).cast("int").alias("parts"))
    heads = (parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
             .join(texts.withColumnRenamed("doc_id", "a"), "a").select("a", "part", F.lit(None).cast("long").alias("b"), "text"))
    tails = (pairs.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"), "b")
             .join(texts.withColumnRenamed("doc_id", "b"), "b").select("a", "part", "b", "text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = heads.union(tails).repartition(n, "a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    return rows.mapInArrow(_confirm(k, percent), EDGES)


# ---- the operator -----------------------------------------------------------

def sketch_components(docs: DataFrame, k: int = 5, percent: int = 80, sketch: int = SKETCH, listed: int = LISTED,
                      block: int = 512, short: int = 64, small: int = 1_000_000) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each document; sets are linked
    at a Jaccard similarity of ``percent`` / 100 or more. ``sketch``: values a
    document retains; ``listed``: of these, the ones whose lists are read; ``short``: length of lists that are joined; ``block``:
    documents compared at once; ids up to ``small`` are broadcast."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = written(rows.mapInArrow(_sketches(k, sketch), SET_DDL), "sketches")
    real = sets.where("n > 0 and doc_id is not null").select("doc_id", "n", "f1", "f2")
    classes = written(real.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep")), "classes")
    signed = written(sets.where("sketch is not null")
                     .join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "n", "f1", "f2"], "left_semi")
                     .select("doc_id", "n", "sketch"), "signed")
    ids = signed.select("doc_id").distinct()

    links = None
    group = ids.select("doc_id", F.col("doc_id").alias("grp"))
    for turn in range(ROUNDS):
        value = F.expr(f"substring(sketch, {8 * turn + 1}, 8)")
        named = signed.select("doc_id", value.alias("list")).where(f"n > {turn}").join(group, "doc_id")
        lists = (named.groupBy("list").agg(F.count("*").alias("held"), F.min("grp").alias("x"), F.max("grp").alias("y"))
                 .where("x < y").select("list", F.ceil(F.col("held") / block).alias("parts")))
        dealt = named.join(lists, "list").select("list", F.pmod(F.xxhash64("doc_id"), "parts").alias("part"), "doc_id", "grp")
        members = (dealt.join(signed, "doc_id").select("list", "part", "doc_id", "n", "grp", "sketch")
                   .repartition(parts, "list", "part").sortWithinPartitions("list", "part", "n"))
        pairs = written(members.mapInArrow(_forests(sketch, listed, percent, block), EDGES).distinct(), "spanning-pairs")
        found = confirmed(pairs, rows, k, percent, small)
        links = written(found if links is None else found.union(links), "links")
        group = written(ids.join(components(links), F.col("doc_id") == F.col("node"), "left")
                        .select("doc_id", F.coalesce("component", "doc_id").alias("grp")), "groups")

    shared = spark.sparkContext.broadcast(frequent_values(signed))
    postings = written(signed.join(group, "doc_id").mapInArrow(
        _postings(sketch, listed, percent, shared), POSTING_DDL), "postings")
    lists = (postings.groupBy("key").agg(F.count("*").alias("held"), F.min("grp").alias("x"), F.max("grp").alias("y"))
             .where("x < y").select("key", "held"))
    met = written(postings.join(lists, "key"), "met-postings")

    side = lambda c, of: of.select("key", *[F.col(x).alias(f"{x}_{c}") for x in ("doc_id", "n", "grp", "need")])
    brief = met.where(F.col("held") <= short)
    compatible = (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent) & (F.col("grp_a") != F.col("grp_b"))
    counted = (side("a", brief).join(side("b", brief), "key").where(F.col("doc_id_a") < F.col("doc_id_b")).where(compatible)
               .groupBy(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b"))
               .agg(F.count("*").alias("common"), F.max(F.greatest("need_a", "need_b")).alias("need"))
               .where(F.col("common") >= F.least("need", F.lit(SHARED))).select("a", "b"))
    signs = lambda c: signed.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    open_ = (counted.join(signs("a"), "a").join(signs("b"), "b").select("a", "n_a", "sketch_a", "b", "n_b", "sketch_b")
             .mapInArrow(_allowed(sketch, percent), EDGES))

    size = F.floor(F.log("n") / math.log(100 / percent) + 1e-9) if percent < 100 else F.col("n")
    in_long = met.where(F.col("held") > short)
    lists_of = in_long.groupBy("doc_id").agg(F.collect_set("key").alias("lists"))  # at most ``listed``
    long = (in_long.select("key", "whole", "doc_id", "grp", size.alias("own_size"))
            .withColumn("size", F.explode(F.array(F.col("own_size") - 1, F.col("own_size")))))
    dealt = (long.groupBy("key", "size").agg(F.count("*").alias("held"), F.min("grp").alias("x"), F.max("grp").alias("y"))
             .where("x < y").select("key", "size", F.ceil(F.col("held") / (2 * block)).cast("int").alias("parts")))
    turn = F.pmod(F.xxhash64("doc_id"), "parts").cast("int")
    meet = (long.join(dealt, ["key", "size"]).withColumn("turn", turn)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("key", "whole", "size", F.least("turn", "other").alias("x"), F.greatest("turn", "other").alias("y"), "doc_id", "grp", "turn", "own_size"))
    across = (meet.join(lists_of, "doc_id").join(signed, "doc_id").repartition(parts, "key", "size", "x", "y").sortWithinPartitions("key", "size", "x", "y")
              .mapInArrow(_blocks(sketch, listed, percent), EDGES))
    more = written(confirmed(written(open_.union(across).distinct(), "last-pairs"), rows, k, percent, small), "last-links")

    # an id with several texts is one node: it ties the classes of its texts
    mark = F.struct("n", "f1", "f2")
    several = real.groupBy("doc_id").agg(F.min(mark).alias("x"), F.max(mark).alias("y")).where("x <> y").select("doc_id")
    same = (real.join(several, "doc_id").distinct().join(classes, ["n", "f1", "f2"])
            .where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    final = written(components(links.union(more).union(same)), "components")
    named = classes.join(final, F.col("rep") == F.col("node"), "left").select("n", "f1", "f2", F.coalesce("component", "rep").alias("of"))
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    out = sets.select("doc_id", "n", "f1", "f2")
    told = out.where(~alone).join(named, ["n", "f1", "f2"]).select("doc_id", "n", "of").union(
        out.where(alone).select("doc_id", "n", "doc_id"))
    return told.select("doc_id", F.col("n").alias("n_shingles"), F.col("of").alias("component_id"),
                       (F.col("doc_id").eqNullSafe(F.col("of"))).alias("kept"))


def op13_bottom_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the documents linked at 80 % of their 4-word shingles."""
    return sketch_components(table(spark, sf_dir, "documents", "doc_id", "text"), k=4, percent=80)
