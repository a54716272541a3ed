"""Scores by subset sums against plain products; negatives against a search by hand; rows that take no part."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import hard_negatives as hn
from ledgerlake.llm.hard_negatives import hard_negatives, padded, planes, scores, subset_sums

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, id string, v string, bin string"


def wanted(rows, every, positives=5, negatives=3):
    base = {}
    for i, vector, label in rows:
        if i is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            whole = [math.floor(256 * float(np.float32(x))) for x in vector]
            base[i] = min(base.get(i, (label, whole)), (label, whole))
    out = []
    for a, (label, u) in base.items():
        if a % every:
            continue
        ranked = sorted((-sum(x * y for x, y in zip(u, v, strict=False)), i, other) for i, (other, v) in base.items() if i != a)
        for s, p, _ in [r for r in ranked if r[2] == label][:positives]:
            near = [(t, n) for t, n, other in ranked if other != label and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(a, p, k, n, -s, -t) for k, (t, n) in enumerate(near[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, every, **more):
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)
    return sorted(map(tuple, hard_negatives(df, F.col("id") % every == 0, **more).collect()))


@pytest.mark.parametrize("kind", [np.int32, np.int64])
def test_scores_are_exact(kind):
    rng = np.random.default_rng(3)
    a, b = rng.integers(-200, 200, (7, 16)), rng.integers(-256, 256, (1300, 16))
    assert np.array_equal(scores(subset_sums(a, kind), planes(b, 10)), a @ b.T)
    big = rng.integers(-(1 << 24), 1 << 24, (4, 8))
    assert np.array_equal(scores(subset_sums(big, np.int64), planes(big, 25)), big @ big.T)


@pytest.mark.parametrize(("block", "part"), [(1024, 4096), (3, 17)])
def test_against_search(spark, monkeypatch, block, part):
    monkeypatch.setattr(hn, "BLOCK", block)
    monkeypatch.setattr(hn, "SLICE", part)
    rng = np.random.default_rng(1)
    # Coarse values, so that many scores are equal; one label holds a third of the rows.
    rows = [(i, (rng.integers(-3, 4, 12) / 8).tolist(), int(rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 6]))) for i in range(150)]
    rows += [(200 + i, rows[4][1], int(rng.integers(0, 3))) for i in range(30)]  # one vector many times
    found = mined(spark, rows, 5)
    assert found == wanted(rows, 5) and len(found) > 300


def test_awkward_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=9).tolist(), i % 2) for i in range(40)]
    rows += [
        (None, rows[0][1], 0), (41, None, 0), (42, rows[0][1], None), (43, [1.0, None], 0), (44, [float("nan")] * 9, 0),
        (45, [float("inf")] * 9, 1), (46, [], 0), (47, [3.0], 1), (48, [0.5] * 20, 0), (-10, rows[1][1], 1),
        rows[3], rows[3], (3, rows[5][1], 1), (50, rows[0][1], 77),
    ]
    assert mined(spark, rows, 10) == wanted(rows, 10)
    assert mined(spark, rows, 10, positives=1, negatives=2) == wanted(rows, 10, 1, 2)


def test_nothing_to_find(spark):
    assert mined(spark, [], 5) == []
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 1)], 5) == []
    assert mined(spark, [(5, [1.0], 0), (2, [1.0], 1)], 5) == []


def test_scores_beyond_64_bits_are_refused(spark):
    with pytest.raises(ValueError, match="64 bits"):
        mined(spark, [(5, [1e12], 0), (6, [1.0], 0)], 5)


def test_padding():
    import pyarrow as pa

    assert padded(pa.array([[1], [], [2, 3]], pa.list_(pa.int64())), 4).tolist() == [[1, 0, 0, 0], [0, 0, 0, 0], [2, 3, 0, 0]]
