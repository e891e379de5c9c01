"""Corpus pipeline: quality classifier, exact dedup, near-dedup by SimHash and exact Jaccard similarity, substring dedup, packing.

Each stage takes what the one before kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lagwatch.llm import exact_dedup, near_copies, packing, quality_classifier, substring_dedup
from lagwatch.llm.common import read_table
from lagwatch.llm.queries import WORD_BPE
from lagwatch.session import scratch_path


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_classifier.keep_good(docs, read_table(spark, sf_dir, "labels"))


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash (2 differing bits) or a Jaccard similarity of 4/5 over 5-word shingles."""
    return near_copies.keep_one(docs)


def dedup_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document holds; all rows stay."""
    return substring_dedup.rewrite(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.pack_documents(docs, WORD_BPE)


STAGES = [
    ("quality_classifier", classify),
    ("exact_dedup", dedup_exact),
    ("simhash_near_dedup", dedup_near),
    ("substring_dedup", dedup_substrings),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: A trained classifier cannot be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None
