"""Registered queries of this subpackage, each over its whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import bpe, collocations, conversations, decontaminate, extract, jaccard, language, mixing, quality, sharding, suffixes, surrogates, toxicity
from kerbside.llm.store import documents, table


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a test item it has a copy of."""
    return decontaminate.find_leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace(documents(spark, sf_dir))


def toxic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_groups(documents(spark, sf_dir), k=4, percent=85)


def repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffixes.remove_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_text(table(spark, sf_dir, "pages"))


def shard_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.place(documents(spark, sf_dir).select("doc_id", "text"))
    return placed.select("doc_id", "slot", "shard", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(documents(spark, sf_dir))


def token_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.tokenize(documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    repaired = conversations.repair(conversations.damage(rows))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    parts = [rows.select("conv_id").distinct(), repaired.report, conversations.digests(repaired.rows).withColumnRenamed("sha256", "repaired_sha256")]
    found = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).groupBy("conv_id")
    found = found.agg(*(F.coalesce(F.max(c), F.lit(0)).alias(c) for c in counts), F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.max("repaired_sha256").alias("repaired_sha256"))
    return found.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": decontamination,
    "op2_mixing": source_mixing,
    "op3_pii": personal_data,
    "op4_toxicity": toxic_scores,
    "op5_language": languages,
    "op6_ngram_join": ngram_join,
    "op7_suffix_dedup": repeated_strings,
    "op8_quality": quality_rules,
    "op9_html_extraction": page_texts,
    "op10_sharding": shard_places,
    "op11_collocations": phrase_collocations,
    "op12_bpe": token_digests,
    "op13_conversation_repair": conversation_repair,
}

ORACLE_SQL: dict[str, str] = {"op10_sharding": sharding.sharding_sql(), "op11_collocations": collocations.collocations_sql()}
