"""The corpus pipeline: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet in the shared folder and read again as the next stage's
documents.  All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ordertide.llm import common, op1_mixing, op3_exact_dedup, op5_packing, op7_toxicity, op9_near_dedup


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, accepts."""
    return op7_toxicity.clean_documents(docs, common.table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the row with the largest doc_id."""
    return op3_exact_dedup.distinct_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % of their five-word shingles the smallest doc_id."""
    return op9_near_dedup.distinct_documents(docs, width=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights: a row for every copy taken."""
    return op1_mixing.mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and place of every row of the mix."""
    return op5_packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# A trained classifier can't be expressed in SQL; tests/llm checks run()
# against a brute-force version of the other stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last one's result."""
    docs = common.table(spark, sf_dir, "documents")
    folder = common.scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
