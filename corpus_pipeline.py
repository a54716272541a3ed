"""From raw documents to token ids: quality, exact duplicates, near duplicates, benchmark passages, sampled segmentation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import exact_dedup, minhash, quality, segmentation, spaced_seeds
from ledgerlake.llm.common import prepare, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones among them, does not reject."""
    prepare(spark)
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    prepare(spark)
    return exact_dedup.without_duplicates(docs)


def distinct_contents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more."""
    prepare(spark)
    return minhash.without_near_duplicates(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    prepare(spark)
    return spaced_seeds.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (a sampled segmentation of the whole text) and lossless (whether decoding gives the text again)."""
    prepare(spark)
    return segmentation.encode(docs, check=True)


STAGES: list[tuple[str, Stage]] = [
    ("good_quality", good_quality),
    ("distinct_texts", distinct_texts),
    ("distinct_contents", distinct_contents),
    ("no_benchmark", no_benchmark),
    ("token_ids", token_ids),
]
# The classifier, the signatures and the sampled segmentation have no SQL form; tests/llm holds the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
