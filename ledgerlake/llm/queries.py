"""The registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake.llm import (
    alignment, exact_dedup, hard_negatives, host_paths, minhash, pii, quality, quotation, secret_scan, segmentation, spaced_seeds, toxic_segments, warc,
)
from ledgerlake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentation of every document, and whether it decodes to the document's bytes."""
    return segmentation.encode(table(spark, sf_dir, "documents"), check=True)


@query
def op2_chat_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without quotations, with the message it replies to, its place in a thread and its marked-up text."""
    return quotation.reply_ordered(table(spark, sf_dir, "conversations"))


@query
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near duplicates: three-word shingles, similarity of 0.85 or more."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, threshold=85)


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every confirmed overlap of a document with a benchmark item."""
    return spaced_seeds.findings(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its equal texts that stays."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as the archives, written first, give it back."""
    return warc.resolved(warc.archive(table(spark, sf_dir, "pages"), spark))


@query
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: the base spans, and those that the learned formats add."""
    found = secret_scan.secrets(table(spark, sf_dir, "documents"))
    # Base spans stand in their order already; an added one goes where it starts.
    every = F.sort_array(
        F.transform(
            F.concat("base", "added"),
            lambda s: F.struct(s["start"], F.array_position(F.array(*map(F.lit, (*secret_scan.KINDS, "format"))), s["kind"]).alias("k"), s["end"], s["kind"]),
        )
    )
    return found.select(
        "doc_id",
        *[secret_scan.number(F.col("base"), kind).alias(f"n_{kind}") for kind in secret_scan.KINDS],
        F.sha2(secret_scan.joined(F.col("base")), 256).alias("base_sha256"),
        secret_scan.joined(every).alias("spans"),
    )


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of a quarter of the ids are held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = toxic_segments.remainder("doc_id", 4) == 2
    model = toxic_segments.train(docs, labels, usable=~held_out)
    return toxic_segments.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.array_join(F.transform("passages", lambda p: F.concat_ws(":", p["start"], p["end"])), ",").alias("passages"),
    )


@query
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id",
        *[pii.number(F.col("spans"), kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(pii.joined(base), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of a third of the ids are held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = quality.remainder("doc_id", 3) == 1
    model = quality.train(docs, labels, "quality", usable=~held_out)
    return quality.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth row; the labels of every seventh row are shifted first."""
    rows = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label").cast("bigint") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", shifted), F.col("id") % 50 == 0)


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of aligned tokens of every document, and how common its links are in all documents."""
    return alignment.align(table(spark, sf_dir, "documents"))


@query
def op13_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = host_paths.main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))
