"""The corpus pipeline: five stages over ``documents``, each on what the one before it kept.

A stage is a function (spark, docs, sf_dir) -> DataFrame. Its result is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents; the last returns one row per document that is left with
what the mix takes of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from grainline.llm import decontaminate, exact_dedup, mixing, ngram_join, toxicity
from grainline.llm.common import settle
from grainline.session import load


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from ``labels``, does not reject."""
    return toxicity.reject(docs, load(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more over shingles of five words."""
    return ngram_join.keep_one(docs, size=5, num=80, den=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not cover half of a benchmark item."""
    return decontaminate.decontaminate(docs, load(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document that is left."""
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
]

# Boosted trees and string tiling cannot be written in SQL; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
