"""From raw documents to packed training sequences: five stages, each on all that the one before kept.

Every stage's result is written as Parquet to the shared folder and read again by the
next one, so a lost executor repeats a part of one stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from provenlake.llm import (
    op1_sum_of_squares_packing,
    op2_language_crf,
    op3_pii_crf,
    op6_multi_index_hamming,
    op10_quality_rules,
)
from provenlake.llm.staging import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go from the texts, rejected documents go."""
    return op10_quality_rules.clean_documents(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a clear language go; a missing language is filled in."""
    return op2_language_crf.recognized(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return op6_multi_index_hamming.deduplicated(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    return op3_pii_crf.redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their sequences."""
    return op1_sum_of_squares_packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("packing", packing),
]

#: Fields, graphs and packing cannot be said in SQL; tests/llm/test_corpus_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
