"""One query per operator, over the whole tables in ``sf_dir``, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart.llm import (
    bpe,
    hard_negatives,
    language,
    licences,
    neighbours,
    packing,
    periodic_runs,
    quality_ranker,
    quality_rules,
    secret_scan,
    segment_search,
    simhash,
    unit_dedup,
)
from starmart.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]

BPE_RANKS = "byte_bpe_50k.tiktoken"
BPE_TOKENIZER = "byte_bpe_50k.json"


def op1_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ranker.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_dedup.digest(unit_dedup.deduplicated(table(spark, sf_dir, "documents")))


def op3_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("_doc.doc_id", *quality_rules.MEASURES, "base_failed", "kept")


def op4_simhash_balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_licence_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.digest(licences.licensed(table(spark, sf_dir, "documents")))


def op6_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


def op7_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scanned(table(spark, sf_dir, "documents")))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BPE_TOKENIZER)
    return packing.pack_documents(table(spark, sf_dir, "documents"), path, keep_ids=False)


def op9_distinct_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BPE_RANKS)
    return bpe.digested(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op10_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_segment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_search.searched(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text", periodic_runs.planted(F.col("doc_id"), F.col("text")))
    return periodic_runs.digest(periodic_runs.collapsed(docs))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_bradley_terry,
        op2_unit_dedup,
        op3_risk_controlled_rules,
        op4_simhash_balls,
        op5_licence_sentences,
        op6_language_filters,
        op7_randomness_battery,
        op8_best_fit_packing,
        op9_distinct_word_bpe,
        op10_nn_descent,
        op11_segment_search,
        op12_periodic_runs,
        op13_hard_negatives,
    )
}

ORACLES: dict[str, str] = {
    "op2_unit_dedup": unit_dedup.ORACLE,
    "op11_segment_search": segment_search.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
