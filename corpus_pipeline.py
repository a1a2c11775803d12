"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but
the last return documents with the columns they got, whatever the names of further columns. Empty tables give empty
tables, whole texts are worked on however long they are, and no stage asks for anything in columns other than id and text, but for
the language by which the rules are certified.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starmart.llm import packing, quality_rules, secret_scan, simhash, unit_dedup
from starmart.llm.queries import BPE_TOKENIZER
from starmart.llm.shared import Staging, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go: always those of under 10 words, so NULL and empty texts too.

    Rows that repeat are judged alike and stay or go together. Without labels only the fixed rules hold.
    """
    return quality_rules.good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Of rows with the same id one stays; rows without an id all stay. Texts without a word, NULL too, are copies of each other.
    """
    return simhash.one_per_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines and sentences that an earlier document, or an earlier place of the same one, has are taken out of the text.

    All rows stay; a NULL text stays NULL. Rows that repeat both id and text are one document.
    """
    return unit_dedup.cleaned(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text are replaced by a mark. All rows stay; a NULL or empty text stays as it is."""
    return secret_scan.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids and their places in sequences.

    A NULL or empty text is one piece of the end id alone. Rows that repeat are packed like different ones.
    """
    return packing.pack_documents(docs, public_tokenizers.path(BPE_TOKENIZER))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("secrets", secrets),
    ("packing", packing_stage),
]

# Calibrated rules, hashes of shingles and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    staging = Staging(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staging.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
