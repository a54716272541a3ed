"""Loan-status model: features, training, parameter search and batch scoring."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.functions.money import ratio
from ledgerlake.functions.rules import complete
from ledgerlake.plans import network
from ledgerlake.plans.network import Network
from ledgerlake.schemas import LOAN_SCORES

FEATURES = ["amount", "duration", "payments"]

# The parameter grid, in search order, and the passes over the rows.
HIDDEN = (16, 32, 64)
LEARNING_RATES = (1e-3, 5e-4)
EPOCHS = 10


class Trained(NamedTuple):
    hidden: int
    learning_rate: float
    accuracy: float
    model: Network


def loan_features(loans: DataFrame, limit: int | None = None) -> DataFrame:
    """Loans with every feature and a status; ``limit`` takes those with the lowest ids."""
    rows = complete(loans.select("loan_id", *FEATURES, "status"), [*FEATURES, "status"])
    return rows.orderBy("loan_id").limit(limit) if limit else rows


def numeric_only(df: DataFrame, columns=FEATURES) -> DataFrame:
    """Rows whose feature text is numeric, as DOUBLE."""
    typed = df.withColumns({name: F.col(name).try_cast("double") for name in columns})
    return complete(typed, columns)


def labelled(features: DataFrame) -> tuple[DataFrame, list[str]]:
    """Features with a numeric ``label``; classes are numbered in alphabetical order."""
    labels = label_model(features)
    return labels.transform(features), list(labels.labels)


def label_model(features: DataFrame) -> StringIndexerModel:
    return StringIndexer(
        inputCol="status", outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep"
    ).fit(features.select("status"))


def train(
    training: DataFrame, labels: list[str], hidden: int, learning_rate: float, epochs: int = EPOCHS, seed: int = 7
) -> Network:
    """Fit scaling and network; the result turns features into a predicted status."""
    return network.fit(training, "loan_id", FEATURES, labels, [(hidden, learning_rate)], epochs, seed)[0]


def is_held_out(seed: int = 7) -> Column:
    """A fifth of the loans, by their id: the same ones however the rows are partitioned or read again."""
    return F.pmod(F.xxhash64("loan_id", F.lit(seed)), F.lit(5)) == 0


def search(features: DataFrame, max_runs: int | None = None, epochs: int = EPOCHS, seed: int = 7) -> list[Trained]:
    """Train every combination (or the first ``max_runs``) on four fifths, all in the same passes, and measure each on the rest."""
    rows, labels = labelled(features)
    rows = rows.withColumn("held_out", is_held_out(seed)).persist()
    training, held_out = rows.where("NOT held_out"), rows.where("held_out")
    grid = [(h, rate) for h in HIDDEN for rate in LEARNING_RATES][:max_runs]
    models = network.fit(training, "loan_id", FEATURES, labels, grid, epochs, seed)
    runs = [Trained(*run, accuracy(model.transform(held_out)), model) for run, model in zip(grid, models, strict=True)]
    rows.unpersist()
    return runs


def accuracy(predicted: DataFrame) -> float:
    """Share of rows whose status was predicted; 0 without rows."""
    return predicted.agg(F.mean((F.col("pred_status") == F.col("status")).cast("double"))).first()[0] or 0.0


def best(runs: list[Trained]) -> Trained:
    return max(runs, key=lambda r: r.accuracy)


def leaderboard(spark, runs: list[Trained]) -> DataFrame:
    rows = [(i, r.hidden, r.learning_rate, r.accuracy) for i, r in enumerate(runs)]
    return spark.createDataFrame(rows, "run INT, hidden_dim INT, learning_rate DOUBLE, val_accuracy DOUBLE")


def score(model: Network, features: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    """Actual and predicted status of every loan, with the class probabilities as JSON."""
    names = F.array(*[F.lit(x) for x in model.labels])
    return model.transform(features).select(
        F.col("loan_id").cast("bigint").alias("loan_id"),
        (F.current_timestamp() if at is None else at).alias("score_timestamp"),
        F.lit(run_id).alias("run_id"),
        F.col("status").alias("actual_status"),
        "pred_status",
        F.to_json(F.map_from_arrays(names, "probability")).alias("probabilities_json"),
    ).select(*LOAN_SCORES.names)


def run_accuracy(scores: DataFrame) -> DataFrame:
    """Share of correct predictions per scoring run."""
    hits = F.sum(F.when(F.col("actual_status") == F.col("pred_status"), 1).otherwise(0))
    counted = scores.groupBy("run_id").agg(F.count("*").alias("scored"), hits.cast("bigint").alias("correct"))
    return counted.select("run_id", "scored", "correct", ratio(F.col("correct"), F.col("scored")).alias("accuracy"))
