"""Nearest neighbours by inner product: a block matrix join.

Vectors are packed into tiles of int8 codes (one scale per vector). A tile of
queries times a tile of candidates is one matrix product of the codes, an
estimate whose error is bounded by Cauchy-Schwarz with the norms of the two
quantisation errors. A pair survives if its upper bound reaches the query's
k-th best lower bound; survivors are recomputed in double precision on the
original vectors and kept in a heap per query. The result is exact.

Query tiles are broadcast one round at a time, a round at most
``round_bytes`` large; candidate tiles stay where they were read. Each task
hands on k rows a query, which a window merges.

Defined cases: a vector that is null, empty, all zero, or holds a null or
non-finite component takes no part, nor does a row without an id. Only vectors
of the same dimension are compared. Repeated candidate rows are separate
candidates; of repeated query ids the smallest vector (in array order) is the
query; rows with the query's id are not its candidates. Ties go to the smaller
id. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayledger.llm.common import batch_of, table, written

TILE = "dim int, n int, ids binary, vectors binary"
FOUND = "query_id long, vec_id long, score double"


def _tiles(rows: int):
    """Arrow batches of (id, vector) to packed tiles of at most ``rows``."""
    schema = pa.schema([("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, vecs = zip(*held.pop(dim), strict=True)
            ids = np.concatenate(ids)
            return batch_of(schema, dim=[dim], n=[len(ids)], ids=[ids.astype("<i8").tobytes()],
                            vectors=[np.concatenate(vecs).astype("<f8").tobytes()])

        for batch in batches:
            ids, col = batch.column(0), batch.column(1)
            ok = ~np.asarray(ids.is_null()) & ~np.asarray(col.is_null())
            offs = np.asarray(col.offsets, dtype=np.int64)
            values = col.values
            nulls = np.asarray(values.is_null())
            flat = np.asarray(values.fill_null(0.0), dtype=np.float64)
            lens = np.diff(offs)
            ids = np.asarray(ids.fill_null(0), dtype=np.int64)
            for dim in np.unique(lens[ok]):
                if dim == 0:
                    continue
                at = np.flatnonzero(ok & (lens == dim))
                where = offs[at][:, None] + np.arange(dim)
                v = flat[where]
                good = np.isfinite(v).all(1) & (v != 0).any(1) & ~nulls[where].any(1)
                for lo in range(0, len(at), rows):
                    g = good[lo:lo + rows]
                    if g.any():
                        held.setdefault(int(dim), []).append((ids[at[lo:lo + rows]][g], v[lo:lo + rows][g]))
                        if sum(len(x[0]) for x in held[int(dim)]) >= rows:
                            yield out(int(dim))
        for dim in list(held):
            yield out(dim)

    return pack


def quantise(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the decoded vectors, norms of the errors."""
    scale = np.abs(v).max(1) / 127
    scale[scale == 0] = 1  # a denormal vector: its codes are all zero
    code = np.clip(np.rint(v / scale[:, None]), -127, 127).astype(np.int8)
    decoded = code * scale[:, None]
    return code, scale, np.linalg.norm(decoded, axis=1), np.linalg.norm(v - decoded, axis=1)


def _search(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[tuple[int, int], list] = {}  # (query id, dim): its k best as (score, -id)
        ready: dict[bytes, tuple] = {}
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                qid, cid = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["ids"], "<i8")
                q = np.frombuffer(row["q_vectors"], "<f8").reshape(-1, dim)
                c = np.frombuffer(row["vectors"], "<f8").reshape(-1, dim)
                key = row["q_ids"]
                if key not in ready:
                    ready.clear()
                    ready[key] = quantise(q)
                (qi, qs, qn, qe), (ci, cs, cn, ce) = ready[key], quantise(c)
                exact_type = np.float32 if dim * 127 * 127 < 2**24 else np.float64
                c_norm = cn + ce
                for lo in range(0, len(qid), 256):
                    part = slice(lo, lo + 256)
                    guess = (qi[part].astype(exact_type) @ ci.T.astype(exact_type)) * (qs[part][:, None] * cs)
                    slack = qe[part][:, None] * c_norm + qn[part][:, None] * ce
                    slack += 1e-7 * np.abs(guess) + 1e-12 * (qn[part] + qe[part])[:, None] * c_norm
                    own = qid[part][:, None] == cid
                    low = np.where(own, -np.inf, guess - slack)
                    floor = np.partition(low, -k, axis=1)[:, -k] if len(cid) > k else np.full(len(low), -np.inf)
                    for i, query in enumerate(qid[part].tolist()):
                        heap = heaps.setdefault((query, dim), [])
                        least = max(floor[i], heap[0][0]) if len(heap) == k else floor[i]
                        at = np.flatnonzero((guess[i] + slack[i] >= least) & ~own[i])
                        if not len(at):
                            continue
                        scores = np.add.accumulate(c[at] * q[lo + i], axis=1)[:, -1]
                        for one in zip(scores.tolist(), (-cid[at]).tolist(), strict=True):
                            if len(heap) < k:
                                heapq.heappush(heap, one)
                            elif one > heap[0]:
                                heapq.heapreplace(heap, one)
        rows = [(query, -neg, score) for (query, _), heap in heaps.items() for score, neg in heap]
        for lo in range(0, len(rows), 50_000):
            a, b, s = zip(*rows[lo:lo + 50_000], strict=True)
            yield batch_of(schema, query_id=a, vec_id=b, score=s)

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id",
            vec_col: str = "embedding", tile_rows: int = 8192, round_bytes: int = 32 << 20) -> DataFrame:
    """The k candidates of largest inner product for each query: query_id, rank
    (from 1), vec_id, score. See the module text for the defined cases."""
    spark = vectors.sparkSession
    shape = [F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")]
    asked = (queries.select(*shape).where("id is not null and v is not null")
             .groupBy("id").agg(F.min("v").alias("v")))
    stats = asked.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    count, dim = stats["n"], max(1, stats["dim"] or 1)
    rounds = max(1, -(-count * (dim + 1) * 8 // round_bytes))
    asked = written(
        asked.withColumn("turn", F.pmod(F.xxhash64("id"), F.lit(rounds)).cast("int"))
        .repartition(rounds, "turn").sortWithinPartitions("turn"), "queries")
    base = vectors.select(*shape).mapInArrow(_tiles(tile_rows), TILE)
    parts = []
    for turn in range(rounds):
        tile = (asked.where(F.col("turn") == turn).select("id", "v")
                .mapInArrow(_tiles(max(1, round_bytes // (8 * dim))), TILE)
                .select("dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")))
        parts.append(base.join(F.broadcast(tile), "dim").mapInArrow(_search(k), FOUND))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose vec_id is divisible by 20, against all rows."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
