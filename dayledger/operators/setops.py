"""Set operations (SET-01, SET-02)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """SET-01: ``UNION ALL`` of typed branches, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def symmetric_difference(a: DataFrame, b: DataFrame, side_col: str | None = None) -> DataFrame:
    """SET-02: ``(a EXCEPT ALL b) UNION ALL (b EXCEPT ALL a)`` — rows whose
    multiplicity differs, as many times as it differs. Empty means the two
    relations are equal as multisets. With ``side_col`` each row says which
    side holds the surplus ('left' / 'right')."""
    left = a.exceptAll(b)
    right = b.exceptAll(a)
    if side_col:
        left = left.withColumn(side_col, F.lit("left"))
        right = right.withColumn(side_col, F.lit("right"))
    return left.unionAll(right)
