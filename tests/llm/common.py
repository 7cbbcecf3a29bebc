"""Inputs of the operator tests: a small table with odd rows added, extra
columns whose names clash with the operators' own, and plain-Python words."""

from __future__ import annotations

import re

import pyspark.sql.functions as F

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(30))
ODD = [
    (900000, ""), (900001, None), (900002, "  \n"), (900003, "a b"), (900004, "A b"), (900005, "a b c"),
    (900006, LONG), (900007, LONG), (900007, LONG), (900007, "x " + LONG), (900008, "q " + LONG + " z"),
    (900009, " ".join(["a b"] * 20)), (900010, " ".join(["a b"] * 60)), (900011, "日本語 " + LONG),
    (900012, "it's DON'T 'S  a<|endoftext|>b <|startoftext|>"), (900013, "a\x1cb x y  z\n\n x \n"),
    (900014, "é ½ ²3 12 Σσς ΑΣ İstanbul ﬁ é tail "), (900015, "word " * 30000), (900016, "x" * 3000),
    (None, LONG), (None, "a b c"),
]
CLASH = ("n", "grp", "h", "row", "part", "name", "rank", "shard", "mark", "bits", "spans", "quality", "score", "a", "b")


def odd_documents(spark, sample: bool = True):
    """Documents of the smallest table (all of them) with the odd rows."""
    rows = spark.createDataFrame(ODD, "doc_id long, text string")
    if sample:
        rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(rows)
    return rows.withColumns({c: F.lit(1) for c in CLASH})


def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def words(text, lower=False):
    text = text or ""
    if lower:
        text = text.translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", text)
