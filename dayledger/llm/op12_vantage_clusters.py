"""Clusters of integer vectors around centroids, searched by a vantage-point tree.

A vector's components become floor(scale * x), so all arithmetic is on whole
numbers. Each round builds a vantage-point tree over the centroids: a node holds
one centroid (its vantage point), the other centroids of its part split at the
median of their distance to it, and the range of those distances in each half; a
leaf holds a few centroids. The tree travels with the round's tasks (k centroids
of ``dim`` numbers, a size fixed by the parameters).

A vector looks for its centroid best-first: of the nodes still open it visits
the one of the smallest possible distance, compares exact squared distances with
the centroids found there, and bounds the halves by the triangle inequality. A
half stays open while its bound is at most the best distance (inclusive, and with
a margin above the rounding of the square roots), so a centroid at the same
distance is always compared and the smaller number wins. The searches of a batch
run side by side, one step of each at a time.

Tasks add up their vectors' components by cluster; Spark adds the tasks' sums.
Only k * dim sums reach the driver, which divides them exactly. The input is read
once a round; nothing of its size is kept or shuffled.

Defined cases: a vector takes part if it has exactly ``dim`` components, none of
them null or non-finite; others have no row in the result. Rows that repeat a
vec_id are vectors of their own; a null vec_id hashes as empty text. Equal hashes
start in the vectors' order. With fewer than k vectors each starts a centroid; an
empty table gives no rows. Components of any size are exact (beyond 2**27 at 64
components they are Python's whole numbers, and the search visits every node); a
distance or inertia above the range of long is null. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm.common import batch_of, table, written

LEAF = 2
ROWS = 4096
#: Sums travel in limbs of this many bits where they don't fit 64.
LIMB = 60
LONG = 2**63 - 1


def small(dim: int) -> int:
    """Components up to this size have squared distances below 2**62."""
    return math.isqrt((1 << 62) // max(1, dim)) // 2


def whole(v: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * v) exactly: 64-bit numbers, or Python's where they are large."""
    if not v.size or np.abs(v).max() * scale < small(v.shape[-1]):
        return np.floor(v * scale).astype(np.int64)
    flat = [n * scale // d for n, d in (x.as_integer_ratio() for x in v.ravel().tolist())]
    return np.array(flat, dtype=object).reshape(v.shape)


def squared(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of q to c."""
    return ((q - c) ** 2).sum(1)


class Tree:
    """A vantage-point tree over the rows of ``centroids``."""

    def __init__(self, centroids: list[list[int]], leaf: int = LEAF):
        self.small = max((abs(x) for c in centroids for x in c), default=0) <= small(len(centroids[0]) if centroids else 1)
        self.points = np.array(centroids, dtype=np.int64 if self.small else object)
        self.nodes: list[dict] = []
        self._grow(list(range(len(centroids))), leaf)

    def _grow(self, members: list[int], leaf: int) -> int:
        at = len(self.nodes)
        self.nodes.append(node := {"here": members, "kids": []})
        if len(members) > leaf:
            top, *rest = members
            node["here"] = [top]
            far = dict(zip(rest, squared(self.points[rest], self.points[top]).tolist(), strict=True))
            rest.sort(key=lambda c: (far[c], c))
            for half in (rest[:len(rest) // 2], rest[len(rest) // 2:]):
                if half:
                    low, high = (math.sqrt(far[half[i]]) if self.small else 0.0 for i in (0, -1))
                    node["kids"].append((self._grow(sorted(half), leaf), low, high))
        return at

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of q (whole numbers) the number of its centroid and the
        exact squared distance."""
        bounded = self.small and q.dtype != object
        points = self.points if bounded else self.points.astype(object)
        best = np.zeros(len(q), dtype=q.dtype if bounded else object)
        found = np.full(len(q), len(points), np.int64)
        open_ = np.full((len(q), len(self.nodes)), np.inf)
        open_[:, 0] = 0
        live = np.arange(len(q))
        while len(live):
            node_of = open_[live].argmin(1)
            bound = open_[live, node_of]
            radius = np.sqrt(best[live].astype(np.float64)) if bounded else np.full(len(live), np.inf)
            radius = np.where(found[live] < len(points), radius * (1 + 1e-9) + 1e-6, np.inf)
            go = np.isfinite(bound) & (bound <= radius)
            live, node_of, bound = live[go], node_of[go], bound[go]
            for node in np.unique(node_of).tolist():
                mine = node_of == node
                rows, least = live[mine], bound[mine]
                open_[rows, node] = np.inf
                for c in self.nodes[node]["here"]:
                    far = squared(q[rows], points[c])
                    nearer = (found[rows] == len(points)) | (far < best[rows]) | ((far == best[rows]) & (c < found[rows]))
                    best[rows[nearer]], found[rows[nearer]] = far[nearer], c
                for kid, low, high in self.nodes[node]["kids"]:  # far: to the vantage point
                    if bounded:
                        d = np.sqrt(far.astype(np.float64))
                        inside = np.maximum(d - high, low - d) - 1e-9 * (d + high)
                        open_[rows, kid] = np.maximum(least, inside)
                    else:
                        open_[rows, kid] = 0
        return found, best


def _vectors(batches: Iterator[pa.RecordBatch], dim: int, scale: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and whole-number vectors, some thousand rows at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            part = batch.slice(lo, ROWS)
            yield part.column("vec_id"), whole(np.asarray(part.column("v").flatten()).reshape(-1, dim), scale)


SUMS_DDL = "cluster int, place int, limb int, total long, n long"


def _sums(tree: Tree, dim: int, scale: int):
    """A task's sums of components and its number of vectors, by cluster."""
    schema = pa.schema([("cluster", pa.int32()), ("place", pa.int32()), ("limb", pa.int32()), ("total", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[int]] = {}
        count: dict[int, int] = {}
        for _, q in _vectors(batches, dim, scale):
            cluster, _ = tree.nearest(q)
            for c in np.unique(cluster).tolist():
                mine = q[cluster == c]
                count[c] = count.get(c, 0) + len(mine)
                totals[c] = [x + y for x, y in zip(totals.get(c, [0] * dim), mine.sum(0).tolist(), strict=True)]
        for c, total in totals.items():
            rows = []
            for place, x in enumerate(total):
                limb = 0
                while not -(1 << 62) <= x < 1 << 62:
                    rows.append((c, place, limb, x & ((1 << LIMB) - 1), 0))
                    x, limb = x >> LIMB, limb + 1
                rows.append((c, place, limb, x, 0))
            rows.append((c, -1, 0, 0, count[c]))
            yield batch_of(schema, **dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=True)))

    return run


def _assigned(tree: Tree, dim: int, scale: int):
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, q in _vectors(batches, dim, scale):
            cluster, far = tree.nearest(q)
            yield batch_of(schema, vec_id=ids, cluster=cluster, distance=[x if x <= LONG else None for x in far.tolist()])

    return run


def clustered(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of
    every vector after ``rounds`` rounds. ``vectors``: vec_id, embedding."""
    spark = vectors.sparkSession
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    kept = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
            .where((F.size("v") == dim) & F.forall("v", fine)))
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.orderBy(mark, "v").limit(k).toArrow()["v"].to_pylist()
    centroids = [whole(np.array(v), scale).tolist() for v in first]
    for _ in range(rounds if centroids else 0):
        found = (kept.mapInArrow(_sums(Tree(centroids), dim, scale), SUMS_DDL).groupBy("cluster", "place", "limb")
                 .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).toArrow().to_pylist())
        n = {r["cluster"]: r["n"] for r in found if r["place"] < 0}
        sums = {c: [0] * dim for c in n}
        for r in found:
            if r["place"] >= 0:
                sums[r["cluster"]][r["place"]] += int(r["total"]) << (LIMB * r["limb"])
        was, centroids = centroids, [[s // n[c] for s in sums[c]] if c in n else old for c, old in enumerate(centroids)]
        if was == centroids:  # all further rounds give the same
            break
    rows = written(kept.mapInArrow(_assigned(Tree(centroids), dim, scale), "vec_id long, cluster int, distance long"), "clusters")
    inertia = (rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"),
                                           F.count("*").alias("n"), F.count("distance").alias("known")).toArrow().to_pylist())
    of = {r["cluster"]: int(r["sum"]) if r["n"] == r["known"] else None for r in inertia}
    whole_sum = sum(of.values()) if None not in of.values() else None
    fits = lambda x: x if x is not None and x <= LONG else None
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    told = spark.createDataFrame([(c, fits(x), fits(whole_sum), sha[c]) for c, x in of.items()],
                                 "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_vantage_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all 64-component embeddings around 8 centroids, ten rounds."""
    return clustered(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def _sql(k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """The rounds written out one after another."""
    places = f"range(1, {dim + 1})"
    parts = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT CAST(i - 1 AS INTEGER) AS cluster, q
  FROM (SELECT q, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) AS i FROM kept) WHERE i <= {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, min(struct_pack(distance := d, cluster := cluster)) AS best
  FROM (SELECT v.r, c.cluster,
               CAST(list_sum(list_transform({places}, lambda j: (v.q[j] - c.q[j]) * (v.q[j] - c.q[j]))) AS BIGINT) AS d
        FROM kept v, c{i} c)
  GROUP BY r)""")
        if i < rounds:
            parts.append(f"""
s{i} AS (
  SELECT a.best.cluster AS cluster, j, sum(v.q[j]) AS s, count(*) AS n
  FROM a{i} a JOIN kept v USING (r), (SELECT unnest({places}) AS j) GROUP BY ALL),
c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.q, c.q) AS q
  FROM c{i} c LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS q FROM s{i} GROUP BY cluster) m USING (cluster))""")
    return "WITH" + ",".join(parts) + f"""
SELECT v.vec_id, a.best.cluster AS cluster, a.best.distance AS distance,
       CAST(sum(a.best.distance) OVER (PARTITION BY a.best.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.best.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept v USING (r) JOIN c{rounds} c ON c.cluster = a.best.cluster
"""


SQL = _sql()
