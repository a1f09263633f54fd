"""Corpus preparation: documents through the stages below, each stored as Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerwatch.llm import jaccard, language, mixing, pieces, quality, vocabulary
from ledgerwatch.llm.base import read, small_batches, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language."""
    small_batches(spark)
    return language.keep_identified(docs, language.learn(docs))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier does not find good."""
    small_batches(spark)
    return quality.keep_good(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: those whose sets of five words' shingles overlap by 0.8."""
    small_batches(spark)
    return jaccard.keep_one(docs, jaccard.JaccardConfig(words=5, share=80, over=100))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document, once for each round."""
    small_batches(spark)
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what was mixed: doc_id, piece_ids, n_pieces, round_trip."""
    small_batches(spark)
    return pieces.encode_and_check(docs, vocabulary.load())


STAGES: list[tuple[str, Stage]] = [
    ("language", identify),
    ("quality", keep_quality),
    ("jaccard", keep_one_of_each),
    ("mixing", mix),
    ("pieces", encode),
]

# Learned models and pseudorandom draws have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
