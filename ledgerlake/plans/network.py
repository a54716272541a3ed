"""A network of two hidden layers with rectified linear units, trained by distributed mini-batch Adam.

The rows are dealt into blocks of about ``BATCH_SIZE`` by a hash and stored once, a folder per step. A step takes one block, or several side by side where the
rows would need more than ``STEPS`` steps per pass: every task sums the gradients of its blocks, the sums are added up by a tree, and the driver, which
holds the weights and the two moment vectors, makes one step. Sums are fixed-point numbers, so they do not depend on how rows are partitioned, and neither does the
model. Each pass takes the steps in another order. Several networks that read the same batches are trained in the same jobs.

Equal rows are one row with a weight. Without rows the weights stay as they were drawn.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake.session import scratch
from ledgerlake.sinks import overwrite
from ledgerlake.sources.tables import matching, remove

# The batch size, and the constants of Adam.
BATCH_SIZE = 64
BETAS, EPSILON = (0.9, 0.999), 1e-8

STEPS = 12  # per pass over the rows, at most
FAN = 32  # partial sums added up by one task, or by the driver
UNIT = 2.0**-30  # of fixed-point sums

Weights = list[np.ndarray]  # matrix and bias of each layer


def drawn(sizes: Sequence[int], seed: int) -> Weights:
    """First weights: uniform within the inverse root of a layer's inputs."""
    rng, out = np.random.default_rng(seed), []
    for n, m in zip(sizes, sizes[1:], strict=False):
        reach = n**-0.5
        out += [rng.uniform(-reach, reach, (n, m)), rng.uniform(-reach, reach, m)]
    return out


def chances(weights: Weights, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Class chances of rows, and the inputs of each layer."""
    inputs = [x]
    for k in range(0, len(weights), 2):
        x = x @ weights[k] + weights[k + 1]
        if k < len(weights) - 2:
            x = np.maximum(x, 0)
            inputs.append(x)
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True), inputs


def gradient(weights: Weights, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The gradient of the weighted cross-entropy, summed over the rows, as one vector."""
    back, inputs = chances(weights, x)
    back[np.arange(len(y)), y] -= 1
    back *= w[:, None]
    out: list[np.ndarray] = []
    for k in range(len(weights) - 2, -1, -2):
        layer = inputs[k // 2]
        out = [(layer.T @ back).ravel(), back.sum(axis=0), *out]
        if k:
            back = (back @ weights[k].T) * (layer > 0)
    return np.concatenate(out)


def shaped(vector: np.ndarray, like: Weights) -> Weights:
    ends = np.cumsum([x.size for x in like])[:-1]
    return [part.reshape(x.shape) for part, x in zip(np.split(vector, ends), like, strict=True)]


@dataclass
class Adam:
    rate: float
    steps: int = 0
    moments: list = field(default_factory=lambda: [0.0, 0.0])

    def step(self, weights: Weights, mean_gradient: np.ndarray) -> Weights:
        self.steps += 1
        for k, power in enumerate((mean_gradient, mean_gradient**2)):
            self.moments[k] = BETAS[k] * self.moments[k] + (1 - BETAS[k]) * power
        first, second = (m / (1 - b**self.steps) for m, b in zip(self.moments, BETAS, strict=True))
        return [x - d for x, d in zip(weights, shaped(self.rate * first / (np.sqrt(second) + EPSILON), weights), strict=True)]


@dataclass
class Network:
    """Scaling, weights and class names. ``transform`` adds probability (by class), prediction and pred_status."""

    columns: list[str]
    labels: list[str]
    mean: list[float]
    scale: list[float]
    weights: Weights

    def transform(self, df: DataFrame) -> DataFrame:
        mean, scale, weights = np.array(self.mean), np.array(self.scale), self.weights

        @F.pandas_udf("array<double>")
        def probability(rows: pd.DataFrame) -> pd.Series:
            found, _ = chances(weights, (rows.to_numpy(float) - mean) / scale)
            return pd.Series(list(found))

        found = df.withColumn("probability", probability(F.struct(*[F.col(c).cast("double") for c in self.columns])))
        at = F.array_position("probability", F.array_max("probability"))
        names = F.array(*map(F.lit, self.labels))
        return found.withColumns({"prediction": (at - 1).cast("double"), "pred_status": F.get(names, (at - 1).cast("int"))})

    def save(self, path: str) -> None:
        plain = {**self.__dict__, "weights": [x.tolist() for x in self.weights]}
        overwrite(SparkSession.active().createDataFrame([(json.dumps(plain),)], "network STRING").coalesce(1), path)

    @classmethod
    def load(cls, path: str) -> Network:
        plain = json.loads(SparkSession.active().read.schema("network STRING").parquet(path).first()[0])
        return cls(**{**plain, "weights": [np.array(x) for x in plain["weights"]]})


def _blocks(rows: DataFrame, key: str, columns: list[str], blocks: int, seed: int, width: int) -> DataFrame:
    """step, block, x (features row by row), y and w (weights) of all blocks; a block's rows in a fixed order."""
    values = [F.col(c).cast("double").alias(c) for c in columns]
    single = rows.select(F.col(key).alias("_key"), *values, F.col("label").cast("int").alias("label"))
    single = single.groupBy(*single.columns).agg(F.count("*").cast("double").alias("w"))
    block = F.pmod(F.xxhash64("_key", *columns, "label", F.lit(seed)), F.lit(blocks))
    line = F.struct("_key", F.array(*columns).alias("x"), F.col("label").alias("y"), "w")
    found = single.groupBy(block.alias("block")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    return found.select(
        (F.col("block") / width).cast("int").alias("step"),
        "block",
        F.flatten("lines.x").alias("x"),
        F.col("lines.y").alias("y"),
        F.col("lines.w").alias("w"),
    )


def _summed(networks: list[Weights], mean: np.ndarray, scale: np.ndarray):
    """Of a task's blocks: the rows' weight, and every network's gradient, in fixed-point numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0.0, None
        for batch in batches:
            for flat, y, w in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                x = (np.array(flat).reshape(len(y), -1) - mean) / scale
                one = np.concatenate([gradient(weights, x, np.array(y), np.array(w)) for weights in networks])
                one = np.rint(one / UNIT).astype(np.int64)
                total = one if total is None else total + one
                rows += sum(w)
        if total is not None:
            yield _partial(rows, total)

    return run


def _partial(rows: float, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([total.tobytes()])], names=["rows", "total"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, total = 0.0, None
    for batch in batches:
        for n, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            one = np.frombuffer(part, np.int64)
            rows, total = rows + n, one if total is None else total + one
    if total is not None:
        yield _partial(rows, total)


def _mean_gradient(blocks: DataFrame, tasks: int, networks: list[Weights], mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Gradients over all rows of a step: summed per task, then by a tree until the driver gets at most FAN sums."""
    schema = "rows DOUBLE, total BINARY"
    partial = blocks.select("x", "y", "w").mapInArrow(_summed(networks, mean, scale), schema)
    while tasks > FAN:
        tasks = -(-tasks // FAN)
        partial = partial.repartition(tasks).mapInArrow(_added, schema)
    found = partial.collect()
    return sum(np.frombuffer(p.total, np.int64) for p in found) * UNIT / sum(p.rows for p in found)


def fit(
    rows: DataFrame, key: str, columns: list[str], labels: list[str], runs: Sequence[tuple[int, float]], epochs: int, seed: int
) -> list[Network]:
    """Train a network per (hidden width, learning rate) on rows with ``key``, ``columns`` and a numeric ``label``."""
    spark = rows.sparkSession
    about = rows.agg(
        F.count("*"), *[F.mean(F.col(c).cast("double")) for c in columns], *[F.stddev(F.col(c).cast("double")) for c in columns]
    ).first()
    n, k = about[0], len(columns)
    mean = [x or 0.0 for x in about[1 : 1 + k]]
    scale = [x or 1.0 for x in about[1 + k :]]
    networks = [drawn([k, hidden, hidden, max(len(labels), 1)], seed) for hidden, _ in runs]
    width = max(1, -(-n // (BATCH_SIZE * STEPS)))
    path = scratch(spark, "blocks")
    if n:
        _blocks(rows, key, columns, -(-n // BATCH_SIZE), seed, width).write.partitionBy("step").parquet(path)
    schema = "block BIGINT, x ARRAY<DOUBLE>, y ARRAY<INT>, w ARRAY<DOUBLE>"
    # Kept in memory; what a lost executor held is read from the stored blocks again.
    steps = [spark.read.schema(schema).parquet(at).persist() for at in sorted(matching(spark, f"{path}/step=*"))]
    tasks = [df.rdd.getNumPartitions() for df in steps]
    optimizers = [Adam(rate) for _, rate in runs]
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(steps)):
            found = _mean_gradient(steps[i], tasks[i], networks, np.array(mean), np.array(scale))
            parts = np.split(found, np.cumsum([sum(x.size for x in weights) for weights in networks])[:-1])
            networks = [a.step(weights, g) for a, weights, g in zip(optimizers, networks, parts, strict=True)]
    for df in steps:
        df.unpersist()
    remove(spark, path)
    return [Network(list(columns), list(labels), mean, scale, weights) for weights in networks]
