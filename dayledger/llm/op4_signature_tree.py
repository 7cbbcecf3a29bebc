"""Documents whose word shingles overlap: an exact Jaccard join by signature trees.

A document's set is its distinct k-word shingles (64-bit hashes). Its signature
is a token bitmap (a power of two of at least eight bits a shingle) with its set
size. A tree node holds the OR of its documents' bitmaps, their size range and
the largest number of shingles that share a bit. Two sets overlap in at most
    common bits + the smaller surplus of shingles over bits,
and the same holds for nodes, so the dual traversal of two trees drops a node
pair whose sizes are incompatible or whose possible overlap is too small.
Pairs of leaves give candidates, which are verified on the whole texts.

Which documents meet. Any two linked sets share one of their first
n - ceil(t n) + 1 shingles in one common order (frequent shingles last, else by
hash): those are a document's keys. Most linked sets also share one of a few
smallest hashes: those are its buckets.

1. Equal sets (by a 128-bit fingerprint) are one class; its smallest id stands
   for it from here on.
2. Components: bucket by bucket, trees over the bucket's classes give a spanning
   set of candidates between what is not yet tied; they are verified.
3. Links between components: trees over each bucket give all candidates of
   different components; a pair is given in the first bucket that it shares.
4. The rest: classes of different components that share a key but no bucket are
   found from the keys' lists, of which those of one component are dropped first.
   Trees over each two runs of a list give candidates; a list no longer than a
   leaf has no nodes to prune, its pairs are compared one by one.
Steps 3 and 4 look at every pair that shares a key and is not in one component
already, so the result is exact; nothing is capped.

Skew: copies collapse inside map tasks and by partial aggregates; a hot bucket
(known from a pass that counts shingles in bounded memory) is salted; the keys'
lists travel as packed arrays; a key with more than ``block`` classes is split
into runs by size (large components apart), and only runs of compatible sizes
and not of one component meet, each two as a row, in tasks of their own.
Texts are read again only for candidates.

Defined cases: a document without words (null, empty, white space) has an empty
set, size 0, and is linked with nothing; one of fewer words than k has its whole
sequence as one shingle; rows that share a doc_id are one node; a null doc_id
takes no part and has no component; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm.common import batch_of, fresh_worker, most_frequent, slices, small_batches, table, written
from dayledger.llm.graph import EDGES, Sets, components
from dayledger.llm.textops import gram_hashes, mix, ragged, row_of, utf8, word_hashes, words

SLICE = 1 << 20
LEAF = 32
#: Buckets of a document: its smallest shingles under this many orders.
BUCKETS = 4
#: Spanning forests a bucket in the first rounds, and rounds: some candidates fail.
FORESTS, ROUNDS = 3, 3


def shingles(col: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and the row of each."""
    data, offs = utf8(col)
    starts, ends, counts = words(data, offs)
    h = word_hashes(data, starts, ends, lower=True)
    rows, n = row_of(counts), np.diff(counts)
    grams = gram_hashes(h, k)
    at = np.arange(len(grams))
    whole = at + k <= counts[1:][rows[at]] if len(at) else np.zeros(0, bool)
    values, of = grams[whole], rows[at][whole]
    few = np.flatnonzero((n > 0) & (n < k))
    if len(few):
        short = np.full(len(few), np.uint64(0x51ED27), dtype=np.uint64)
        for j in range(k - 1):
            more = n[few] > j
            short[more] = mix(short[more] * np.uint64(31) + h[counts[few[more]] + j] + n[few[more]].astype(np.uint64))
        values, of = np.concatenate([values, short]), np.concatenate([of, few])
    order = np.lexsort((values, of))
    values, of = values[order], of[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    return values[new], of[new]


def needed(n, m, percent: int):
    """The least overlap of linked sets of sizes n and m."""
    return -(-percent * (n + m) // (100 + percent))


def compatible(n, m, percent: int):
    """Whether sets of sizes n <= m can be linked at all."""
    return n * 100 >= m * percent


# ---- first pass: frequent shingles ---------------------------------------

def _frequent(k: int, per_task: int):
    schema = pa.schema([("s", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker()
        held, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for _, col in slices(batches, "text", SLICE):
            values, _ = shingles(col, k)
            values, n = np.unique(values, return_counts=True)
            more = n > 1
            both, where = np.unique(np.concatenate([held, values[more]]), return_inverse=True)
            times = np.bincount(where, np.concatenate([times, n[more]]), minlength=len(both)).astype(np.int64)
            held = both
            if len(held) > 8 * per_task:
                top = np.sort(np.argpartition(-times, 4 * per_task)[:4 * per_task])
                held, times = held[top], times[top]
        top = np.argsort(-times, kind="stable")[:per_task]
        yield batch_of(schema, s=held[top].view(np.int64), n=times[top])

    return run


def frequent_shingles(docs: DataFrame, k: int, least: int = 16, entries: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles (at most ``entries``, each seen ``least`` times)
    and their counts, sorted by shingle. They set an order and salts, no result."""
    counts = written(docs.select("text").mapInArrow(_frequent(k, entries // 10), "s long, n long")
                     .groupBy("s").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "shingle-counts")
    found = most_frequent(counts, "n", entries).toArrow()
    s, n = np.asarray(found["s"]).view(np.uint64), np.asarray(found["n"])
    order = np.argsort(s)
    return s[order], n[order]


# ---- sets: size, fingerprint, keys, signature ----------------------------

BUCKET_NAMES = [f"b{p}" for p in range(BUCKETS)]
SET = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
                 *[(b, pa.int32()) for b in BUCKET_NAMES], ("keys", pa.binary()), ("bits", pa.binary())])
SET_DDL = ("doc_id long, n long, f1 long, f2 long, " + ", ".join(f"{b} int" for b in BUCKET_NAMES) + ", keys binary, bits binary")


def bitmap_bits(n: int) -> int:
    return max(64, 1 << int(8 * n - 1).bit_length())


def bitmap(values: np.ndarray) -> bytes:
    flags = np.zeros(bitmap_bits(len(values)), bool)
    flags[(values >> np.uint64(20)) & np.uint64(len(flags) - 1)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def _sets(k: int, percent: int, shared, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker()
        heavy, times = shared.value
        for rows, col in slices(batches, "text", SLICE):
            values, of = shingles(col, k)
            ends = np.searchsorted(of, np.arange(len(col) + 1))
            ids = rows.column("doc_id").to_pylist()
            at = np.minimum(np.searchsorted(heavy, values), max(0, len(heavy) - 1))
            often = heavy[at] == values if len(heavy) else np.zeros(len(values), bool)
            place = (values >> np.uint64(1)) | (often.astype(np.uint64) << np.uint64(63))
            # any shingle may lead: those of a family of copies are all frequent
            orders = [mix(values ^ np.uint64(0xC0FFEE + 977 * p)) for p in range(BUCKETS)]
            f1, f2 = mix(values ^ np.uint64(0xA5A5)), mix(values * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7))
            out: list[list] = [[] for _ in SET]
            first: set[tuple] = set()
            for i in sorted(range(len(ids)), key=lambda x: (ids[x] is None, ids[x])):
                a, b = int(ends[i]), int(ends[i + 1])
                n = b - a
                mark = (n, int(f1[a:b].sum().view(np.int64)), int(f2[a:b].sum().view(np.int64))) if n else (0, 0, 0)
                buckets, keys, bits = [None] * BUCKETS, None, None
                if n and ids[i] is not None and mark not in first:
                    first.add(mark)
                    order = np.argsort(place[a:b], kind="stable")[:n - -(-percent * n // 100) + 1]
                    keys, bits = values[a:b][order].tobytes(), bitmap(values[a:b])
                    leads = np.empty(BUCKETS, np.uint64)
                    for p in range(BUCKETS):
                        lead = int(orders[p][a:b].argmin()) + a
                        leads[p] = orders[p][lead]
                        if often[lead]:  # a salt for every ``block`` documents
                            salt = (mark[1] >> (7 * p) & 0xFFFFFF) % max(1, int(times[at[lead]]) // block)
                            leads[p] += np.uint64(salt)
                    buckets = (mix(leads) & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32).tolist()
                for x, v in zip(out, (ids[i], *mark, *buckets, keys, bits), strict=True):
                    x.append(v)
            yield batch_of(SET, **{f.name: v for f, v in zip(SET, out, strict=True)})

    return run


# ---- signature trees ------------------------------------------------------

class Node:
    __slots__ = ("lo", "hi", "bits", "least", "most", "surplus", "group", "kids")


def tree(bits: np.ndarray, sizes: np.ndarray, groups: np.ndarray, lo: int, hi: int) -> Node:
    """A tree over the documents lo..hi-1 (sorted by size): ``bits`` rows are
    their bitmaps as uint64."""
    node = Node()
    node.lo, node.hi, node.kids = lo, hi, ()
    if hi - lo <= LEAF:
        part = bits[lo:hi]
        node.bits = np.bitwise_or.reduce(part, axis=0)
        node.least, node.most = int(sizes[lo:hi].min()), int(sizes[lo:hi].max())
        node.surplus = int((sizes[lo:hi] - np.bitwise_count(part).sum(1, dtype=np.int64)).max())
        node.group = groups[lo] if (groups[lo:hi] == groups[lo]).all() else None
    else:
        mid = (lo + hi) // 2
        a, b = node.kids = tree(bits, sizes, groups, lo, mid), tree(bits, sizes, groups, mid, hi)
        node.bits = a.bits | b.bits
        node.least, node.most = min(a.least, b.least), max(a.most, b.most)
        node.surplus = max(a.surplus, b.surplus)
        node.group = a.group if a.group is not None and a.group == b.group else None
    return node


def traverse(x: Node, y: Node, xs: tuple, ys: tuple, percent: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into xs, into ys) that may be linked and are of different
    groups. xs, ys: (bits, sizes, groups). same: both trees are one tree."""
    stack = [(x, y)]
    while stack:
        u, v = stack.pop()
        if u.group is not None and u.group == v.group:
            continue
        if u.most * 100 < v.least * percent or v.most * 100 < u.least * percent:
            continue
        if u is not v:
            over = int(np.bitwise_count(u.bits & v.bits).sum()) + min(u.surplus, v.surplus)
            if min(over, u.most, v.most) < needed(u.least, v.least, percent):
                continue
        if u.kids and (not v.kids or u.hi - u.lo >= v.hi - v.lo):
            if same and u is v:
                a, b = u.kids
                stack += [(a, a), (b, b), (a, b)]
            else:
                stack += [(kid, v) for kid in u.kids]
        elif v.kids:
            stack += [(u, kid) for kid in v.kids]
        else:
            (p, n, g), (q, m, h) = [(b[t.lo:t.hi], s[t.lo:t.hi], w[t.lo:t.hi]) for (b, s, w), t in ((xs, u), (ys, v))]
            left, right = n[:, None], m[None, :]
            over = np.bitwise_count(p[:, None] & q[None]).sum(2, dtype=np.int64)
            over += np.minimum((n - np.bitwise_count(p).sum(1, dtype=np.int64))[:, None],
                               (m - np.bitwise_count(q).sum(1, dtype=np.int64))[None, :])
            low, high = np.minimum(left, right), np.maximum(left, right)
            ok = (low * 100 >= high * percent) & (np.minimum(over, low) >= needed(left, right, percent)) & (g[:, None] != h[None, :])
            if same and u is v:
                ok = np.triu(ok, 1)
            i, j = np.nonzero(ok)
            if len(i):
                yield i + u.lo, j + v.lo


def fold(bits: np.ndarray) -> np.ndarray:
    """Bitmaps at half their width (bit positions are the hash's low bits)."""
    half = bits.shape[1] // 2
    return bits[:, :half] | bits[:, half:]


def block_pairs(ids: list[int], sizes: list[int], groups: list[int], bitmaps: list[bytes], percent: int,
                spanning: bool, before: np.ndarray | None = None, sides: list[int] | None = None) -> list[tuple[int, int]]:
    """Candidate pairs of ids of one block, or with ``sides`` (0 or 1) those across. ``spanning``: only a few forests that
    each tie together what the candidates tie together. ``before``: buckets a document;
    a pair that shares one of them is left out."""
    by_width: dict[tuple[int, int], list[int]] = {}
    for i in sorted(range(len(ids)), key=lambda x: (sizes[x], groups[x], ids[x])):
        by_width.setdefault((len(bitmaps[i]) * 8, sides[i] if sides else 0), []).append(i)
    trees = {}
    for where, at in by_width.items():
        bits = np.frombuffer(b"".join([bitmaps[i] for i in at]), "<u8").reshape(len(at), -1)
        trees[where] = (np.array(at), bits, np.array([sizes[i] for i in at]), np.array([groups[i] for i in at]))
    name = np.array(ids)
    group = np.array(groups)
    out, forests = [], [Sets() for _ in range(FORESTS)]

    def keep(at, bt, pairs):
        for i, j in pairs:
            i, j = at[i], bt[j]
            fresh = name[i] != name[j]
            if before is not None:
                fresh &= ~(before[i] == before[j]).any(1)
            i, j = i[fresh], j[fresh]
            if spanning:
                for x, y, g, h in zip(name[i].tolist(), name[j].tolist(), group[i].tolist(), group[j].tolist(), strict=True):
                    if any(forest.join(g, h) for forest in forests):  # the first one that it helps
                        out.append((min(x, y), max(x, y)))
            else:
                x, y = name[i], name[j]
                out.extend(zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist(), strict=True))

    for (width, side), (at, bits, n, g) in trees.items():
        mine = (bits, n, g)
        root = tree(*mine, 0, len(at))
        across = 1 - side if sides else 0
        if not sides:
            keep(at, at, traverse(root, root, mine, mine, percent, True))
        elif side == 0 and (width, 1) in trees:
            bt, *other = trees[width, 1]
            keep(at, bt, traverse(root, tree(*other, 0, len(bt)), mine, tuple(other), percent, False))
        if (2 * width, across) in trees:  # sizes of more than twice each other are never compatible
            bt, wide, m, h = trees[2 * width, across]
            other = (fold(wide), m, h)
            keep(at, bt, traverse(root, tree(*other, 0, len(bt)), mine, other, percent, False))
    return out


PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _pair_batches(found: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(found), 50_000):
        a, b = zip(*found[lo:lo + 50_000], strict=True)
        yield batch_of(PAIR, a=a, b=b)


def _blocks(percent: int, spanning: bool, turn: int):
    """Rows sorted by bucket (number ``turn``): candidate pairs of each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now = None

        def close() -> list[tuple[int, int]]:
            found = []
            if len(held) > 1:
                *rest, buckets = map(list, zip(*held, strict=True))
                found = block_pairs(*rest, percent, spanning, None if spanning or not turn else np.array(buckets)[:, :turn])
            held.clear()
            return found

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "n", "grp", "bits")]
            buckets = list(zip(*[batch.column(b).to_pylist() for b in BUCKET_NAMES], strict=True))
            for *row, own in zip(*cols, buckets, strict=True):
                if own[turn] != now:
                    yield from _pair_batches(close())
                    now = own[turn]
                held.append((*row, own))
        yield from _pair_batches(close())

    return run


# ---- pairs that share a key but no bucket ----------------------------------

POSTING_PARTS = ("keys", "docs", "sizes", "groups")


def _postings(shards: int):
    schema = pa.schema([("shard", pa.int32()), *[(p, pa.binary()) for p in POSTING_PARTS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            lists = [np.frombuffer(b.as_buffer(), np.uint64) for b in batch.column("keys")]
            if not lists:
                continue
            lens = np.array([len(x) for x in lists])
            keys = np.concatenate(lists)
            docs = np.repeat(np.asarray(batch.column("doc_id")), lens)
            sizes = np.repeat(np.asarray(batch.column("n")), lens).astype(np.int32)
            groups = np.repeat(np.asarray(batch.column("grp")), lens)
            shard = (mix(keys) % np.uint64(shards)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(cuts)).tolist():
                at = order[cuts[s]:cuts[s + 1]]
                yield batch_of(schema, shard=[s], keys=[keys[at].tobytes()], docs=[press.compress(np.diff(docs[at], prepend=0).tobytes())],
                               sizes=[press.compress(sizes[at].tobytes())], groups=[press.compress((docs[at] - groups[at]).tobytes())])

    return run


#: Runs of one list, bounded by this many bytes of bitmaps as well.
RUN_BYTES = 16 << 20
#: run: -1 in a list of one leaf, -2 for the runs x and y that meet.
MEET_DDL = "key long, run int, doc_id long, grp long, x int, y int"


def runs_of(sizes: np.ndarray, groups: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of one list and the starts of its runs in it: groups of more than
    ``block`` members have runs of their own, the others share runs by size."""
    _, which, count = np.unique(groups, return_inverse=True, return_counts=True)
    large = np.where(count[which] > block, which + 1, 0)
    order = np.lexsort((sizes, large))
    large = large[order]
    weight = np.cumsum(2 * sizes[order])
    starts, at = [], 0
    while at < len(order):
        starts.append(at)
        to = min(at + block, int(np.searchsorted(large, large[at], side="right")),
                 int(np.searchsorted(weight, weight[at] + RUN_BYTES, side="right")))
        at = max(at + 1, to)
    return order, np.array(starts)


def _meetings(percent: int, block: int):
    """A shard's keys that several groups hold in compatible sizes, given once
    where lists repeat in the shard. A list of one leaf: a row for each document.
    A longer one: each document in its run, and a row for each two runs that may
    hold a pair of different groups."""
    schema = pa.schema([("key", pa.int64()), ("run", pa.int32()), ("doc_id", pa.int64()), ("grp", pa.int64()), ("x", pa.int32()), ("y", pa.int32())])

    def long_list(name: int, docs: np.ndarray, sizes: np.ndarray, groups: np.ndarray) -> Iterator[pa.RecordBatch]:
        order, starts = runs_of(sizes, groups, block)
        docs, sizes, groups = docs[order], sizes[order], groups[order]
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(docs))))
        least, most = np.minimum.reduceat(sizes, starts), np.maximum.reduceat(sizes, starts)
        low, high = np.minimum.reduceat(groups, starts), np.maximum.reduceat(groups, starts)
        for lo in range(0, len(docs), 50_000):
            p = slice(lo, lo + 50_000)
            none = np.zeros(len(docs[p]), np.int32)
            yield batch_of(schema, key=np.full(len(none), name), run=run[p], doc_id=docs[p], grp=groups[p], x=none, y=none)
        for x in range(len(starts)):
            may = (most[x:] * 100 >= least[x] * percent) & (most[x] * 100 >= least[x:] * percent)
            may &= (low[x] != high[x]) | (low[x:] != high[x:]) | (low[x] != low[x:])
            y = np.flatnonzero(may) + x
            if len(y):
                none = np.zeros(len(y), np.int64)
                yield batch_of(schema, key=none + name, run=none - 2, doc_id=none, grp=none, x=none + x, y=y)

    def close(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        keys, docs, sizes, groups = (np.concatenate(c) for c in zip(*held, strict=True))
        held.clear()
        order = np.lexsort((docs, sizes, keys))
        keys, docs, sizes, groups = keys[order], docs[order], sizes[order].astype(np.int64), groups[order]
        cut = np.ones(len(keys), bool)  # a new key, or sizes too far apart for any pair across
        cut[1:] = (keys[1:] != keys[:-1]) | (sizes[:-1] * 100 < sizes[1:] * percent)
        starts = np.flatnonzero(cut)
        lens = np.diff(np.append(starts, len(keys)))
        mark = np.add.reduceat(mix(docs.view(np.uint64)), starts)
        several = np.flatnonzero(np.minimum.reduceat(groups, starts) < np.maximum.reduceat(groups, starts))
        _, one = np.unique(np.stack([mark[several], lens[several].astype(np.uint64)]), axis=1, return_index=True)
        given = several[np.sort(one)]
        # the smallest size tells apart the runs of one key
        names = (keys[starts[given]] + sizes[starts[given]].astype(np.uint64)).view(np.int64)
        short = lens[given] <= min(block, LEAF)
        for i, name in zip(given[~short].tolist(), names[~short].tolist(), strict=True):
            p = slice(int(starts[i]), int(starts[i] + lens[i]))
            yield from long_list(name, docs[p], sizes[p], groups[p])
        given, names = given[short], names[short]
        for lo in range(0, len(given), 5_000):
            i = given[lo:lo + 5_000]
            at = ragged(np.arange(len(keys)), starts[i], lens[i])
            none = np.zeros(len(at), np.int32)
            yield batch_of(schema, key=np.repeat(names[lo:lo + 5_000], lens[i]), run=none - 1, doc_id=docs[at], grp=groups[at], x=none, y=none)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now = None
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                shard = batch.column("shard")[i].as_py()
                if shard != now and held:
                    yield from close(held)
                now = shard
                keys, *rest = (batch.column(c)[i].as_py() for c in POSTING_PARTS)
                docs, sizes, groups = (np.frombuffer(open_.decompress(x), t) for x, t in zip(rest, (np.int64, np.int32, np.int64), strict=True))
                docs = np.cumsum(docs)
                held.append((np.frombuffer(keys, np.uint64), docs, sizes, docs - groups))
        if held:
            yield from close(held)

    return run


def _run_pairs(percent: int):
    """Rows sorted by key and runs x, y: the candidates of two runs (or within
    one) that share no bucket, by trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now = None

        def close() -> list[tuple[int, int]]:
            found = []
            if len(held) > 1:
                *rest, buckets, runs = map(list, zip(*held, strict=True))
                sides = None if now[1] == now[2] else [int(r == now[2]) for r in runs]
                found = block_pairs(*rest, percent, False, np.array(buckets), sides)
            held.clear()
            return found

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "n", "grp", "bits")]
            buckets = zip(*[batch.column(b).to_pylist() for b in BUCKET_NAMES], strict=True)
            lists = zip(*[batch.column(c).to_pylist() for c in ("key", "x", "y")], strict=True)
            for own, *row in zip(lists, *cols, buckets, batch.column("run").to_pylist(), strict=True):
                if own != now:
                    yield from _pair_batches(close())
                    now = own
                held.append(tuple(row))
        yield from _pair_batches(close())

    return run


def _unmet(percent: int):
    """Rows sorted by list (of one leaf): pairs of different groups, compatible
    sizes and no common bucket."""
    names = ["doc_id", "n", "grp", *BUCKET_NAMES]

    def close(parts: list[np.ndarray]) -> list[tuple[int, int]]:
        x = np.concatenate(parts, axis=1)
        doc, n, group, buckets = x[0], x[1], x[2], x[3:]
        found = []
        for lo in range(0, len(doc), 256):
            i = slice(lo, lo + 256)
            low, high = np.minimum(n[i, None], n[None]), np.maximum(n[i, None], n[None])
            ok = (low * 100 >= high * percent) & (group[i, None] != group[None]) & (doc[i, None] < doc[None])
            for b in buckets:
                ok &= b[i, None] != b[None]
            u, v = np.nonzero(ok)
            found.extend(zip(doc[u + lo].tolist(), doc[v].tolist(), strict=True))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[tuple[int, int]] = set()  # lists of one task repeat their pairs
        now = None

        def fresh() -> Iterator[pa.RecordBatch]:
            found = [p for p in dict.fromkeys(close(held)) if p not in seen] if held else []
            held.clear()
            if len(seen) > 500_000:
                seen.clear()
            seen.update(found)
            yield from _pair_batches(found)

        for batch in batches:
            x = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in names])
            key = np.asarray(batch.column("key"))
            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if key[a] != now:
                    yield from fresh()
                    now = key[a]
                held.append(x[:, a:b])
        yield from fresh()

    return run


def _possible(percent: int):
    """Pairs with both signatures: those whose bitmaps allow a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            cols = [batch.column(c).to_pylist() for c in ("a", "b", "n_a", "n_b", "bits_a", "bits_b")]
            for a, b, n, m, x, y in zip(*cols, strict=True):
                x, y = np.frombuffer(x, "<u8")[None], np.frombuffer(y, "<u8")[None]
                while x.shape[1] > y.shape[1]:
                    x = fold(x)
                while y.shape[1] > x.shape[1]:
                    y = fold(y)
                count = lambda z: int(np.bitwise_count(z).sum())
                over = count(x & y) + min(n - count(x), m - count(y))
                if min(over, n, m) >= needed(n, m, percent):
                    found.append((a, b))
            yield from _pair_batches(found)

    return run


# ---- verification ----------------------------------------------------------

def _verify(k: int, percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                sides = []
                for c in ("text_a", "text_b"):
                    values, of = shingles(part.column(c).cast(pa.large_string()).fill_null(""), k)
                    sides.append((values, np.searchsorted(of, np.arange(part.num_rows + 1))))
                (va, ea), (vb, eb) = sides
                ok = []
                for i in range(part.num_rows):
                    x, y = va[ea[i]:ea[i + 1]], vb[eb[i]:eb[i + 1]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                keep = pa.array(ok)
                yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], schema=schema)

    return run


def verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int, small: int = 1_000_000) -> DataFrame:
    """The pairs (a, b) whose texts are linked. Texts move only for documents in
    a pair; their ids are broadcast if they are at most ``small``."""
    ids = written(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "pair-ids")
    few = ids.count() <= small
    texts = docs.select("doc_id", "text").join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    texts = written(texts, "pair-texts")
    one = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    two = one.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return two.select("a", "b", "text_a", "text_b").mapInArrow(_verify(k, percent), EDGES)


def similar_components(docs: DataFrame, k: int = 5, percent: int = 80, block: int = 8192, small: int = 1_000_000) -> DataFrame:
    """doc_id, n_shingles and component_id of each document; sets are linked at a
    Jaccard similarity of ``percent`` / 100 or more (from 50 on)."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(frequent_shingles(rows, k))
    sets = written(rows.mapInArrow(_sets(k, percent, shared, block), SET_DDL), "sets")
    classes = written(sets.where("n > 0 and doc_id is not null").groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep")), "classes")
    # rows with keys are the smallest ids of their slice; that of the class is among them
    kept = sets.where("keys is not null")
    reps = kept.join(classes.select(F.col("rep").alias("doc_id"), "n", "f1", "f2"), ["doc_id", "n", "f1", "f2"], "left_semi")

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    signed = written(reps.select("doc_id", "n", *BUCKET_NAMES, "bits"), "signatures")
    ids = signed.select("doc_id").distinct()

    def candidates(turn: int, group: DataFrame, spanning: bool) -> DataFrame:
        """Of the buckets of this turn that several groups share."""
        bucket = BUCKET_NAMES[turn]
        named = signed.select("doc_id", bucket).join(group, "doc_id")
        several = (named.groupBy(bucket).agg(F.min("grp").alias("x"), F.max("grp").alias("y")).where("x < y").select(bucket))
        rows = (signed.join(several, bucket).join(group, "doc_id").select("doc_id", "n", "grp", *BUCKET_NAMES, "bits")
                .repartition(parts, bucket).sortWithinPartitions(bucket, "n", "doc_id"))
        return rows.mapInArrow(_blocks(percent, spanning, turn), EDGES)

    links = None
    group = ids.select("doc_id", F.col("doc_id").alias("grp"))
    for turn in range(ROUNDS):
        pairs = written(candidates(turn, group, True).distinct(), "spanning-pairs")
        found = verified(pairs, rows, k, percent)
        links = written(found if links is None else found.union(links), "links")
        group = written(ids.join(components(links), F.col("doc_id") == F.col("node"), "left")
                        .select("doc_id", F.coalesce("component", "doc_id").alias("grp")), "groups")

    posting_ddl = "shard int, " + ", ".join(f"{p} binary" for p in POSTING_PARTS)
    held = (kept.select("doc_id", "n", "keys").join(group, "doc_id").mapInArrow(_postings(parts), posting_ddl)
            .repartition(parts, "shard").sortWithinPartitions("shard"))
    meet = written(held.mapInArrow(_meetings(percent, block), MEET_DDL), "meetings")
    look = (meet.where("run = -1").select("key", "doc_id", "grp").join(signed.select("doc_id", "n", *BUCKET_NAMES), "doc_id")
            .repartition(parts, "key").sortWithinPartitions("key"))
    unmet = written(look.mapInArrow(_unmet(percent), EDGES).distinct(), "unmet-pairs")
    side = lambda c: signed.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    possible = (unmet.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
                .mapInArrow(_possible(percent), EDGES))
    met = meet.where("run = -2").select("key", "x", "y")
    n_met = met.count()
    if n_met:  # each two runs of a long list to a task
        sides = met.select("key", F.col("x").alias("run"), "x", "y").union(met.where("x <> y").select("key", "y", "x", "y"))
        members = meet.where("run >= 0").select("key", "run", "doc_id", "grp")
        wanted = written(members.select("doc_id").distinct(), "long-list-ids")
        few = wanted.count() <= small
        signs = signed.join(F.broadcast(wanted) if few else wanted, "doc_id", "left_semi")
        pairs = (members.join(signs, "doc_id").join(F.broadcast(sides) if n_met <= small else sides, ["key", "run"])
                 .repartition(parts, "key", "x", "y").sortWithinPartitions("key", "x", "y"))
        possible = possible.union(pairs.mapInArrow(_run_pairs(percent), EDGES))
    for turn in range(BUCKETS):
        possible = possible.union(candidates(turn, group, False))
    more = written(verified(written(possible.distinct(), "last-pairs"), rows, k, percent), "last-links")

    # an id with several texts is one node: it ties the classes of its texts
    mark = F.struct("n", "f1", "f2")
    real = sets.where("n > 0 and doc_id is not null").select("doc_id", "n", "f1", "f2")
    several = real.groupBy("doc_id").agg(F.min(mark).alias("x"), F.max(mark).alias("y")).where("x <> y").select("doc_id")
    same = (real.join(several, "doc_id").distinct().join(classes, ["n", "f1", "f2"])
            .where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    final = written(components(links.union(more).union(same)), "components")
    named = classes.join(final, F.col("rep") == F.col("node"), "left").select(
        "n", "f1", "f2", F.coalesce("component", "rep").alias("of"))
    empty_or_no_id = (F.col("n") == 0) | F.col("doc_id").isNull()
    out = sets.select("doc_id", "n", "f1", "f2")
    return out.where(~empty_or_no_id).join(named, ["n", "f1", "f2"]).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("of").alias("component_id")).union(
        out.where(empty_or_no_id).select("doc_id", "n", "doc_id"))


def op4_signature_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the documents linked at 85 % of their 4-word shingles."""
    return similar_components(table(spark, sf_dir, "documents", "doc_id", "text"), k=4, percent=85)
