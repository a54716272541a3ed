import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import minhash
from ledgerlake.llm.common import utf8
from ledgerlake.llm.components import connected_components
from tests.llm import awkward


def shingles(text, width):
    w = awkward.split_words(text)
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def wanted(rows, width, threshold):
    """doc_id to (set size, component), by comparing all pairs."""
    sets = {d: shingles(t, width) for d, t in rows if d is not None}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= threshold * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {d: (len(sets[d]), find(d)) for d in ids}


def chain(n, seed=1):
    """A group of near copies, each a few words away from the one before, so that its ends are far apart."""
    rng = random.Random(seed)
    words = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    out = []
    for i in range(n):
        out.append((1000 + i, " ".join(words)))
        words[rng.randrange(120)] = f"new{i}"
    return out


@pytest.mark.parametrize(("width", "threshold"), [(3, 85), (5, 80)])
def test_brute_force(spark, width, threshold):
    rng = random.Random(3)
    rows = awkward.TEXTS + chain(60)
    base = [f"b{rng.randrange(500)}" for _ in range(80)]
    for i in range(60):  # a star: copies of one text with few or many changes
        words = list(base)
        for _ in range(rng.randrange(6)):
            words[rng.randrange(80)] = f"c{rng.randrange(500)}"
        rows.append((2000 + i, " ".join(words)))
    rng.shuffle(rows)
    found = minhash.near_duplicates(awkward.documents(spark, rows), shingle=width, threshold=threshold).collect()
    want = wanted(rows, width, threshold)
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)


def test_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = wanted([(r.doc_id, r.text) for r in docs.collect()], 3, 85)
    found = minhash.near_duplicates(docs, shingle=3, threshold=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want


def test_estimate(spark):
    """The estimate from two bits per minimum is close to the similarity of the sets."""
    rng = random.Random(5)
    rows = []
    for k in (0, 4, 10, 25):
        words = [f"w{i}" for i in range(400)]
        for i in rng.sample(range(400), k):
            words[i] = f"x{i}"
        rows.append((k, " ".join(words)))
    data, offsets = utf8(pa.array([t for _, t in rows]))
    sets, at = minhash.shingle_sets(data, offsets, 5)
    low = minhash.minima(sets, at) & np.uint64(3)
    for i in range(1, len(rows)):
        a, b = shingles(rows[0][1], 5), shingles(rows[i][1], 5)
        agree = (low[0] == low[i]).mean()
        assert abs((agree - 0.25) / 0.75 - len(a & b) / len(a | b)) < 0.08


def test_stage_keeps_columns(spark):
    docs = awkward.documents(spark, chain(20) + [(5, None), (6, "")])
    kept = minhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in wanted(chain(20), 5, 80).values()} | {5, 6})


def test_no_rows(spark):
    assert minhash.near_duplicates(awkward.nothing(spark)).count() == 0


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(40)] + [(7, 7), (None, 3)]
    found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b")
    near = defaultdict(set)
    for a, b in edges:
        if a is not None and a != b:
            near[a].add(b)
            near[b].add(a)
    want = {}
    for start in sorted(near):
        waiting = [] if start in want else [start]
        while waiting:
            x = waiting.pop()
            if x not in want:
                want[x] = start
                waiting += near[x]
    assert {r.node: r.component for r in found.collect()} == want
    assert found.count() == len(want)


@pytest.mark.parametrize(("width", "threshold"), [(3, 85), (5, 80)])
def test_short_pairs_at_the_threshold(spark, width, threshold):
    """Many pairs of 4 to 30 shingles whose similarity is the threshold or little more: none is lost."""
    rows, n_pairs = [], 0
    for n in range(4, 31):
        fewest = -(-threshold * n // 100)  # shingles of the shorter text, the others lie inside the longer one
        if fewest == n:
            continue
        for _ in range(150):
            words = [f"p{n_pairs}w{k}" for k in range(n + width - 1)]
            rows += [(2 * n_pairs, " ".join(words)), (2 * n_pairs + 1, " ".join(words[n - fewest :]))]
            n_pairs += 1
    found = minhash.near_duplicates(awkward.documents(spark, rows), shingle=width, threshold=threshold).collect()
    assert len(found) == 2 * n_pairs
    assert [r.doc_id for r in found if r.component_id != r.doc_id // 2 * 2] == []


def test_floor_follows_the_smaller_set(spark):
    """Few shingles fill few bins, so the margin is wider; many fill all."""
    floors = spark.range(1).select(*[minhash._floor(80, minhash.F.lit(n)) for n in (30, 300, 3000, 10**6)]).first()
    assert list(floors) == sorted(floors)
    agree = 0.25 + 0.75 * 0.8
    assert abs(floors[3] - (0.8 - 5 * (agree * (1 - agree) / minhash.BINS) ** 0.5 / 0.75)) < 1e-9


def crowd(n, seed=2):
    """Short texts around one base, most pairs of them below the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randrange(3, 14)):
            words[rng.randrange(120)] = f"v{rng.randrange(10_000)}"
        out.append((5000 + i, " ".join(words)))
    return out


def test_a_crowd_below_the_threshold_makes_few_candidates(spark, monkeypatch):
    rows, made, across = crowd(500), [], minhash._across

    def counted(mixed, threshold):
        pairs = across(mixed, threshold)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(minhash, "_across", counted)
    found = minhash.near_duplicates(awkward.documents(spark, rows), shingle=3, threshold=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == wanted(rows, 3, 85)
    assert made[0] < 500


def test_bitmaps_refute_no_link():
    """Sets differ in at least as many shingles as their bitmaps in bits, also where the bitmaps are full."""
    rng = np.random.default_rng(6)
    for n in (1, 5, 60, 700, 9000):
        for gone in (0, 1, n // 12, n // 3):
            pool = rng.integers(0, 2**64, n + gone, dtype=np.uint64)
            sets = [np.unique(pool[: n]), np.unique(pool[gone:])]
            a, b = minhash.bitmaps(np.concatenate(sets), np.cumsum([0, *map(len, sets)])).view(np.uint64)
            assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(*sets))
