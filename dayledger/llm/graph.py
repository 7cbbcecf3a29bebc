"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.common import written

EDGES = "a long, b long"


class Sets:
    """Disjoint sets over any keys; a set is named by its smallest key."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        up = self.up
        root = x
        while (y := up.get(root, root)) != root:
            root = y
        while (y := up.get(x, x)) != root:
            up[x], x = root, y
        return root

    def join(self, x, y) -> bool:
        """True if two sets became one."""
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as stars: the same components, each node once at most."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    sets = Sets()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sets.join(a, b)
    stars = [(x, sets.find(x)) for x in list(sets.up)]
    for lo in range(0, len(stars), 100_000):
        part = np.array(stars[lo:lo + 100_000], dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1])], schema=schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is its
    smallest node. ``edges`` has long columns a and b.

    Tasks first contract their own edges, so that a node has one smaller neighbour
    a task at most. Then, until the whole is stars: every node's larger neighbours
    are tied to its smallest one, and the edges of a node, dealt by their larger end,
    are contracted in one task. The smallest neighbours come from a partial aggregate
    and also tell whether anything is left to do, so a finished table costs one
    shuffle, not a round of them. Each step is written to the shared folder."""
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    now = written(edges.where("a <> b").mapInArrow(_contract, EDGES), "stars")
    node, other = F.col("node"), F.col("other")
    while True:
        both = now.toDF("node", "other").union(now.select("b", "a"))
        # of a node: a smaller and a larger neighbour; several smaller ones
        low = written(both.groupBy("node").agg(F.min("other").alias("m"), F.max("other").alias("top"), F.max(F.when(other < node, other)).alias("near"))
                      .select("node", F.least("node", "m").alias("component"), ((F.col("m") < node) & (F.col("top") > node)).alias("between"),
                              F.coalesce(F.col("near") > F.col("m"), F.lit(False)).alias("several")), "smallest")
        if low.where("between or several").isEmpty():
            return low.select("node", "component")
        up = low.where("between").select(F.col("node").alias("b"), F.col("component").alias("m"))
        tied = now.join(up, "b", "left").select("a", F.coalesce("m", "b").alias("b"))
        now = written(tied.repartition(parts, "a").mapInArrow(_contract, EDGES), "stars")
