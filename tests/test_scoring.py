import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import network, scoring


@pytest.fixture(scope="module")
def loans(spark):
    risky = F.col("id") % 4 == 0
    return spark.range(400, numPartitions=2).select(
        F.col("id").alias("loan_id"),
        F.when(risky, 900.0).otherwise(100.0).alias("amount"),
        F.when(risky, 60).otherwise(12).alias("duration"),
        F.when(F.col("id") != 7, F.when(risky, 15.0).otherwise(8.0)).alias("payments"),
        F.when(risky, "B").otherwise("A").alias("status"),
    )


def test_features_are_complete_and_labels_alphabetical(loans):
    features = scoring.loan_features(loans)
    assert features.count() == 399
    rows, labels = scoring.labelled(features)
    assert labels == ["A", "B"]
    assert {(r.status, r.label) for r in rows.collect()} == {("A", 0.0), ("B", 1.0)}
    assert [r.loan_id for r in scoring.loan_features(loans, 3).collect()] == [0, 1, 2]


def test_search_and_score(spark, loans):
    features = scoring.loan_features(loans)
    runs = scoring.search(features, epochs=30)
    assert [(r.hidden, r.learning_rate) for r in runs] == [(h, rate) for h in (16, 32, 64) for rate in (1e-3, 5e-4)]
    assert scoring.leaderboard(spark, runs).count() == 6
    assert len(scoring.search(features, max_runs=1, epochs=1)) == 1
    assert scoring.best(runs).accuracy > 0.9  # the larger class is three quarters
    best = scoring.best(runs)
    scores = scoring.score(best.model, features, "r1", F.lit("2025-01-01").cast("timestamp")).collect()
    assert len(scores) == 399
    odds = json.loads(scores[0].probabilities_json)
    assert set(odds) == {"A", "B"} and sum(odds.values()) == pytest.approx(1)
    assert all(max(json.loads(r.probabilities_json).items(), key=lambda x: x[1])[0] == r.pred_status for r in scores)


def test_model_learns(loans):
    rows, labels = scoring.labelled(scoring.loan_features(loans))
    for rate in (0.01, 0.005):
        model = scoring.train(rows, labels, scoring.HIDDEN[0], rate, epochs=12)
        assert model.transform(rows).where("pred_status = status").count() == rows.count()


@pytest.fixture(scope="module")
def ringed(spark):
    """Three classes that no plane separates: by the distance from the middle, and the sign of a third feature; some rows repeated."""
    x, y, z = (F.randn(seed) for seed in (1, 2, 3))
    rows = spark.range(3000, numPartitions=3).select("id", x.alias("amount"), y.alias("duration"), z.alias("payments")).withColumn(
        "status", F.when(F.expr("amount * amount + duration * duration > 2"), "C").when(F.col("payments") > 0, "B").otherwise("A")
    )
    rows = rows.withColumn("id", F.when(F.col("id") % 10 == 0, 0).otherwise(F.col("id"))).withColumnRenamed("id", "loan_id")
    return spark.createDataFrame(rows.collect() + rows.where("loan_id = 7").collect() * 50, rows.schema)


def by_numpy(rows, labels, hidden, rate, epochs, seed, steps):
    """The same training without Spark: the same batches, dealt by hand."""
    data = rows.toPandas()
    x = data[scoring.FEATURES].to_numpy(float)
    scaled = (x - x.mean(0)) / x.std(0, ddof=1)
    y = data["label"].to_numpy(int)
    blocks = -(-len(data) // network.BATCH_SIZE)
    width = max(1, -(-len(data) // (network.BATCH_SIZE * steps)))
    hashed = rows.select(F.pmod(F.xxhash64("loan_id", *scoring.FEATURES, F.col("label").cast("int"), F.lit(seed)), F.lit(blocks)).alias("b"))
    step = hashed.toPandas()["b"].to_numpy() // width
    weights, adam = network.drawn([3, hidden, hidden, len(labels)], seed), network.Adam(rate)
    order = np.random.default_rng(seed)
    known = sorted(set(step), key=lambda s: f"step={s}")  # as folders are listed
    for _ in range(epochs):
        for i in order.permutation(len(known)):
            own = step == known[i]
            weights = adam.step(weights, network.gradient(weights, scaled[own], y[own], np.ones(own.sum())) / own.sum())
    return weights, scaled


@pytest.mark.parametrize("steps", [12, 1000])
def test_training_equals_plain_numpy(ringed, monkeypatch, steps):
    """Batches of one block and of several side by side."""
    monkeypatch.setattr(network, "STEPS", steps)
    rows, labels = scoring.labelled(ringed)
    epochs = 6 if steps == 12 else 1
    model = scoring.train(rows, labels, 16, 0.01, epochs=epochs, seed=3)
    weights, scaled = by_numpy(rows, labels, 16, 0.01, epochs, 3, steps)
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(model.weights, weights, strict=True))
    found = model.transform(rows).toPandas()
    assert (found["prediction"] == network.chances(weights, scaled)[0].argmax(1)).mean() > 0.999
    if steps == 12:
        assert scoring.accuracy(model.transform(rows)) > ringed.groupBy("status").count().agg(F.max("count")).first()[0] / ringed.count() + 0.1


def test_training_does_not_depend_on_partitions(ringed, monkeypatch):
    rows, labels = scoring.labelled(ringed)
    one = network.fit(rows.coalesce(1), "loan_id", scoring.FEATURES, labels, [(16, 0.01), (8, 0.1)], 2, 5)
    monkeypatch.setattr(network, "FAN", 2)  # sums added up by a tree
    other = network.fit(rows.repartition(8), "loan_id", scoring.FEATURES, labels, [(16, 0.01), (8, 0.1)], 2, 5)
    for a, b in zip(one, other, strict=True):
        assert np.allclose(a.mean, b.mean) and all(np.allclose(x, y, atol=1e-9) for x, y in zip(a.weights, b.weights, strict=True))
    alone = scoring.train(rows, labels, 8, 0.1, epochs=2, seed=5)  # next to another network or not
    assert all(np.allclose(x, y, atol=1e-9) for x, y in zip(alone.weights, one[1].weights, strict=True))


def test_gradient_by_differences():
    rng = np.random.default_rng(1)
    weights, x, y, w = network.drawn([3, 5, 5, 4], 2), rng.normal(size=(9, 3)), rng.integers(0, 4, 9), rng.uniform(1, 3, 9)
    flat = np.concatenate([a.ravel() for a in weights])

    def loss(vector):
        return -(w * np.log(network.chances(network.shaped(vector, weights), x)[0][np.arange(9), y])).sum()

    near = [(loss(flat + d) - loss(flat - d)) / 2e-6 for d in np.eye(len(flat)) * 1e-6]
    assert np.allclose(network.gradient(weights, x, y, w), near, atol=1e-6)


def test_nothing_to_learn_from(spark, ringed):
    rows, _ = scoring.labelled(ringed)
    model = scoring.train(rows.where("false"), ["A", "B"], 4, 0.1)
    assert model.transform(rows).where("pred_status IN ('A', 'B')").count() == rows.count()


def test_held_out_rows_do_not_depend_on_partitions(loans):
    rows = scoring.loan_features(loans)
    held = {r.loan_id for r in rows.where(scoring.is_held_out()).collect()}
    assert held == {r.loan_id for r in rows.repartition(7).where(scoring.is_held_out()).collect()}
    assert 40 < len(held) < 120


def test_saved_model_scores_alike(loans, tmp_path):
    features = scoring.loan_features(loans)
    rows, labels = scoring.labelled(features)
    model = scoring.train(rows, labels, 16, 0.1)
    model.save(str(tmp_path / "model"))
    again = network.Network.load(str(tmp_path / "model"))
    at = F.lit("2025-01-01").cast("timestamp")
    assert scoring.score(model, features, "r", at).exceptAll(scoring.score(again, features, "r", at)).count() == 0


def test_non_numeric_rows_are_dropped(spark):
    rows = [("1", "2", "3"), ("x", "2", "3"), (None, "1", "1")]
    raw = spark.createDataFrame(rows, "amount STRING, duration STRING, payments STRING")
    assert scoring.numeric_only(raw).count() == 1
