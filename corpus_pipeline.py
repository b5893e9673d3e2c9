"""From documents to shards: five stages, each of which works on what the one before it kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import decontaminate, jaccard, mixing, sharding, toxicity
from kerbside.llm.store import documents, materialize, ship, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labelled ones among them, does not reject."""
    ship(spark)
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word Jaccard similarity 0.8 or more."""
    ship(spark)
    return jaccard.drop_copies(docs, k=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    ship(spark)
    return mixing.mixed_documents(docs)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their slot and shard."""
    ship(spark)
    return sharding.place(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("source mix", mix_sources),
    ("sharding", place_in_shards),
]
ORACLE_SQL = None  # classifiers and alignments have no SQL form; the tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage's result is written and read again."""
    return reduce(lambda docs, stage: materialize(stage[1](spark, docs, sf_dir), "stage"), STAGES, documents(spark, sf_dir))
