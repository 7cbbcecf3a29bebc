"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again as the next one's input.

1. quality classifier: documents that the model of the trusted labels rejects go;
2. near duplicates: of documents linked by 80 % of their 5-word shingles the one
   of the smallest doc_id stays;
3. substring dedup: words covered by 50-word windows that an earlier document
   holds are cut from the text (which may leave it empty);
4. benchmark decontamination: documents that hold a benchmark item go;
5. BPE: ids of every document, and the digest of what they decode to.

Every stage works on all rows of its input. Rows without a doc_id pass stages 1
to 4 by their text alone: they are linked with nothing and lose no words. Of
rows that repeat a doc_id one stays after stage 2 (the smallest by its columns).
Null texts count as empty. Columns other than those of ``documents`` are dropped
at the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayledger.llm.common import small_batches, table, written
from dayledger.llm.op1_quality import good_documents
from dayledger.llm.op4_signature_tree import similar_components
from dayledger.llm.op5_substring_dedup import cut_documents
from dayledger.llm.op7_decontaminate import without_benchmark
from dayledger.llm.op10_bpe import encode

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Ids up to this number are broadcast to drop rows in place; beyond, a join moves the rows.
SMALL = 1_000_000


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the (written) ids."""
    return docs.join(F.broadcast(ids) if ids.count() <= SMALL else ids, "doc_id", "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)  # for all stages of the session
    return good_documents(docs.select(*COLUMNS), table(spark, sf_dir, "labels", "doc_id", "quality"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    found = written(similar_components(docs, k=5, percent=80).where("doc_id is not null")
                    .groupBy("doc_id").agg(F.min("component_id").alias("of"), F.count("*").alias("n")), "near-duplicates")
    first = Window.partitionBy("doc_id").orderBy(*[c for c in COLUMNS if c != "doc_id"])
    repeated = written(found.where("of = doc_id and n > 1").select("doc_id"), "repeated-ids")
    one_each = (docs.join(repeated, "doc_id", "left_semi").withColumn("rank", F.row_number().over(first))
                .where("rank = 1").select(*COLUMNS))
    return _without(docs, written(found.where("of <> doc_id or n > 1").select("doc_id"), "dropped-ids")).select(*COLUMNS).union(one_each)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    cut = written(cut_documents(docs.select("doc_id", "text"), window=50).select("doc_id", "mark", "kept_text"), "cut-texts")
    rest = docs.select("doc_id", "lang", "source", F.xxhash64("text").alias("mark")).join(cut, ["doc_id", "mark"])
    changed = rest.select("doc_id", F.col("kept_text").alias("text"), "lang", "source",
                          F.length("kept_text").cast(docs.schema["n_chars"].dataType).alias("n_chars"))
    marks = written(cut.select("doc_id", "mark"), "cut-marks")
    kept = docs.withColumn("mark", F.xxhash64("text")).join(
        F.broadcast(marks) if marks.count() <= SMALL else marks, ["doc_id", "mark"], "left_anti")
    return kept.select(*COLUMNS).union(changed)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_benchmark(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark", "item_id", "text"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), text=False, cache_entries=50_000)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", bpe),
]
#: The classifier's training has no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
