"""The corpus pipeline: quality, toxicity, exact and near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result to the shared folder and reads it back as the next one's
docs, so a lost executor costs no earlier stage. All but the last return the
columns they were given. NULLs, empty and very long texts, repeated rows and
empty tables have the results that the operators define.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import exact_dedup, packing, quality, simhash, toxicity
from meterline.llm.common import fold, small_batches, table, written

#: Documents scoring below this quality, or from this toxicity on, go.
THRESHOLD = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the line field finds good (op 3)."""
    small_batches(spark)
    labels, corpus = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    field = quality.train(corpus, labels, fold(F.col("doc_id"), 5) != 0)
    return quality.keep_good(docs, field, THRESHOLD)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without offending sentences (op 10)."""
    small_batches(spark)
    labels, corpus = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    model = toxicity.train(corpus, labels, fold(F.col("doc_id"), 4) != 2)
    return toxicity.keep_clean(docs, model, THRESHOLD)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id (op 6)."""
    return exact_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, the smallest doc_id (op 7)."""
    small_batches(spark)
    return simhash.drop_near_copies(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens (op 8)."""
    small_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash", near_dedup_stage),
    ("packing", packing_stage),
]

#: Fitted models, fingerprints and token ids have no SQL form; the tests hold
#: run()'s rows against a plain Python version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
