"""The corpus pipeline: stages over ``documents``, each written and read back before the next.

A stage takes (spark, docs, sf_dir) and returns the rows that it keeps, with the columns of
``documents``; the last one returns token ids. Empty tables pass through; rows with null columns,
repeated rows and extra columns are treated as each operator documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketloom.llm import (
    decontamination,
    language_id,
    ngram_jaccard,
    piece_codec,
    substring_dedup,
)
from basketloom.llm.shared import documents, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language a model recognises."""
    return language_id.keep_identified(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group with similar shingles."""
    return ngram_jaccard.keep_one(docs)


def no_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has."""
    return substring_dedup.replace_repeats(docs)


def no_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontamination.drop_leaks(docs, documents(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text decoded from them."""
    path = piece_codec.default_model()
    return piece_codec.decode(piece_codec.encode(docs, path), path)


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard", no_near_copies),
    ("substring_dedup", no_repeated_passages),
    ("decontamination", no_benchmark_text),
    ("sentencepiece", token_ids),
]

# Trained models and Viterbi searches have no SQL; tests hold the stages against direct versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents`` of the folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
