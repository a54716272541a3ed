import random

import numpy as np
import pytest

from ledgerlake.llm import toxic_segments as T
from tests.llm import awkward


def maximal(scores):
    """All maximal-scoring segments by definition: take the best (the shortest), then both sides of it."""
    if not len(scores) or max(scores) <= 0:
        return []
    total = np.concatenate([[0], np.cumsum(scores)])
    best = max((total[j] - total[i], i - j, -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1))
    i, j = best[3], best[4]
    return maximal(scores[:i]) + [(i, j, best[0])] + [(a + j, b + j, s) for a, b, s in maximal(scores[j:])]


@pytest.mark.parametrize("seed", range(40))
def test_segments(seed):
    rng = np.random.default_rng(seed)
    scores = rng.integers(-6, 7, rng.integers(0, 40)) + rng.random() / 7
    found = T.segments(scores.astype(float))
    want = maximal(list(scores.astype(float)))
    assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in found], [s for *_, s in want])


def corpus(n=600):
    rng = random.Random(12)
    clean = [f"{a}{b}" for a in ("ta", "mo", "le", "su", "ri") for b in ("ner", "lin", "dos", "pak", "vel", "gim")]
    bad = ["idiotic", "scummy", "trashing"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(clean) for _ in range(rng.randrange(20, 200))]
        toxic = i % 8 == 0
        if toxic:
            at = rng.randrange(len(words) - 10)
            for k in range(0, 8, 2):
                words[at + k] = rng.choice(bad).upper()
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out(spark):
    docs, labels = corpus()
    frame, known = awkward.documents(spark, docs + [(d, t) for d, t in awkward.TEXTS if d is None]), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    held = T.remainder("doc_id", 4) == 2
    model = T.train(frame, known, usable=~held)
    assert model.lam > 0 and model.k > 0
    rows = T.score(frame, model).select("*", held.alias("held")).collect()
    assert len(rows) == len(docs) + 2
    tested = [r for r in rows if r.held]
    assert len(tested) > 100
    for r in tested:
        assert (r.score >= 0.3) == (r.doc_id % 8 == 0)
        assert bool(r.passages) == (r.doc_id % 8 == 0)
    texts = dict(docs)
    for r in tested:
        for p in r.passages:
            inside = texts[r.doc_id][p.start : p.end].split()
            assert inside[0].isupper() and inside[-1].isupper()  # the passage runs from the first to the last of them
    assert all(0 <= r.score <= 1 for r in rows)


def test_awkward_rows(spark):
    docs, labels = corpus(200)
    known = spark.createDataFrame([*labels, (5, None), (None, 1), (99_999, 1)], "doc_id bigint, toxic int")
    model = T.train(awkward.documents(spark, docs), known)
    scored = T.score(awkward.documents(spark), model).collect()
    assert len(scored) == len(awkward.TEXTS)
    empty = {r.score for r in scored if r.doc_id in (4, 5, 6)}
    assert len(empty) == 1 and 0 <= empty.pop() < 0.3
    assert T.score(awkward.nothing(spark), model).count() == 0


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = T.train(awkward.documents(spark), none)
    assert {r.score for r in T.score(awkward.documents(spark), model).collect()} == {0.5}


def test_a_repeated_id_is_one_row_of_the_sample(spark, monkeypatch):
    """The sample's bound holds for rows: of 300 rows with one id, one is learned from."""
    docs, labels = corpus(200)
    docs += [(i, f"{t} other {k}") for i, t in docs[:2] for k in range(300)]
    known = spark.createDataFrame([*labels, *labels[:2]], "doc_id bigint, toxic int")
    sizes, stored = [], T.stored
    monkeypatch.setattr(T, "stored", lambda df, label: (out := stored(df, label), sizes.append(out.count()))[0])
    for most in (1, 50, 1000):
        T.train(awkward.documents(spark, docs), known, max_rows=most)
    assert sizes == [1, 50, 200]
