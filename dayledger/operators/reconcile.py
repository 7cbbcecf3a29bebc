"""Reconciliation of frames that should agree (DQ-12..18, DQ-25..27).

``reconcile`` puts any number of frames side by side by key and measure;
``multiset_differences`` finds rows that one of two frames has more often. Both
work on one tagged union, so nothing is joined and a hot key is reduced by
partial aggregates before it moves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.operators.setops import symmetric_difference, union_all

#: How a measure of a leg's rows is folded.
FOLDS = {"count": lambda c: F.sum(c).cast("bigint"), "sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max}


def reconcile(legs: Mapping[str, DataFrame], keys: Sequence[str],
              measures: Mapping[str, tuple[str, Mapping[str, Column]]]) -> DataFrame:
    """Keys whose measures differ between legs, with every leg's value.

    ``measures`` gives for each measure its fold (``FOLDS``) and each leg's
    input column; a leg without the measure is left out of its comparison. Columns of
    the result: the keys and ``<measure>_<leg>``. A key that a leg lacks is a
    difference (its value is NULL there). Without keys the legs' totals are compared."""
    parts = []
    for leg, frame in legs.items():
        own = [(inputs[leg] if leg in inputs else F.lit(None)).alias(f"__{m}") for m, (_, inputs) in measures.items()]
        parts.append(frame.select(*keys, F.lit(leg).alias("__leg"), *own))
    folded, equal = [], F.lit(True)
    for m, (fold, inputs) in measures.items():
        names = [f"{m}_{leg}" for leg in legs if leg in inputs]
        folded += [FOLDS[fold](F.when(F.col("__leg") == leg, F.col(f"__{m}"))).alias(f"{m}_{leg}") for leg in legs if leg in inputs]
        for other in names[1:]:
            equal = equal & F.col(names[0]).eqNullSafe(F.col(other))
    both = union_all(parts)
    return (both.groupBy(*keys) if keys else both.groupBy()).agg(*folded).where(~equal)


def _fingerprint(columns: Sequence[str]) -> Column:
    # a NULL leaves a hash unchanged, so that it is told by a flag of its own
    return F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def multiset_differences(left: DataFrame, right: DataFrame, columns: Sequence[str], buckets: int = 4096,
                         side_col: str | None = None) -> DataFrame:
    """Rows (by ``columns``) that one side holds more often than the other, as
    often as it does: SET-02 for frames that agree almost everywhere.

    One aggregate folds both sides into ``buckets`` fingerprints (the difference
    of the counts and of the sums of row hashes); only rows of buckets that differ
    are compared. Equal frames cost one pass and ``buckets`` rows; one bucket's rows
    are as few as its share."""
    own, cols = _fingerprint(columns), list(columns)
    place = F.pmod(F.col("__h"), F.lit(buckets)).cast("int").alias("__bucket")
    marked = [f.select(*cols, own.alias("__h")).select("*", place) for f in (left, right)]
    signed = [m.select("__bucket", F.lit(s).alias("__s"), (F.col("__h").cast("decimal(20,0)") * s).alias("__d")) for m, s in zip(marked, (1, -1), strict=True)]
    differing = (union_all(signed).groupBy("__bucket").agg(F.sum("__s").alias("n"), F.sum("__d").alias("d"))
                 .where((F.col("n") != 0) | (F.col("d") != 0)).select("__bucket"))
    near = [m.join(differing, "__bucket", "left_semi").select(*cols) for m in marked]
    return symmetric_difference(*near, side_col=side_col)
