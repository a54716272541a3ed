import tracemalloc
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from ledgerlake.llm import segmentation as S
from ledgerlake.llm.common import utf8
from tests.llm import awkward


@pytest.fixture(scope="module")
def vocabulary():
    return S.load()


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_file=S.MODEL_FILE)


def encode(v, texts, keys=None, seed=7):
    data, offsets = utf8(pa.array(texts))
    ids, at = S.encode_texts(v, data, offsets, np.arange(len(texts)) if keys is None else np.array(keys), seed)
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


@pytest.mark.parametrize(("word", "alpha"), [("hello", 1.0), ("hello", 0.3), ("aaaa", 0.5), ("xé\nb", 0.4)])
def test_distribution(processor, word, alpha):
    """Frequencies of sampled segmentations against the chances of all segmentations, listed one by one."""
    v = S.load(alpha=alpha)
    ids = {processor.id_to_piece(i): i for i in range(processor.get_piece_size()) if not processor.is_byte(i)}
    text = "▁" + word
    chances = {}
    for cuts in product([0, 1], repeat=len(text) - 1):
        parts, start = [], 0
        for k, cut in enumerate([*cuts, 1], 1):
            if cut:
                parts.append(text[start:k])
                start = k
        weight, out = 1.0, []
        for p in parts:
            if p in ids:
                weight, out = weight * v.weights[ids[p]], [*out, ids[p]]
            elif len(p) == 1:
                weight, out = weight * v.spelled, [*out, *[int(v.byte_ids[b]) for b in p.encode()]]
            else:
                weight = 0.0
        if weight:
            chances[tuple(out)] = chances.get(tuple(out), 0) + weight
    total = sum(chances.values())
    n = 20_000
    found = Counter(map(tuple, encode(v, [word] * n)))
    assert set(found) <= set(chances)
    for out, weight in chances.items():
        p = weight / total
        assert abs(found[out] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-3


def test_reproducible(vocabulary):
    texts = [f"the same sentence number {i % 5} internationalisation" for i in range(200)]
    one = encode(vocabulary, texts)
    order = np.random.default_rng(1).permutation(200)
    other = encode(vocabulary, [texts[i] for i in order], order)
    assert [one[i] for i in order] == other
    assert one != encode(vocabulary, texts, seed=8)
    assert len({tuple(x) for x in one}) > 20  # rows of equal text are cut differently


def test_round_trip(spark, processor):
    docs = awkward.documents(spark)
    encoded = S.encode(docs, check=True).cache()
    rows = encoded.collect()
    assert len(rows) == len(awkward.TEXTS) and all(r.lossless for r in rows)
    by_id = {r.doc_id: r.ids for r in rows if r.doc_id is not None}
    for doc_id, text in awkward.TEXTS:
        if doc_id is not None:
            assert processor.decode(by_id[doc_id]) == (text or "")
    back = S.decode(encoded)
    assert {(r.doc_id, r.text) for r in back.collect()} == {(d, t or "") for d, t in awkward.TEXTS}
    again = {r.doc_id: r.ids for r in S.encode(docs.repartition(5)).collect() if r.doc_id is not None}
    assert again == by_id


def test_no_rows(spark):
    assert S.encode(awkward.nothing(spark), check=True).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>")
    assert [(r.doc_id, r.text) for r in S.decode(nulls).orderBy("doc_id").collect()] == [(1, ""), (2, "")]


def test_windows_and_groups_change_nothing(vocabulary, monkeypatch):
    texts = ["internationalisation" * 150 + "日本" * 200, "some words " * 80, "a" * 700 + " tail", "", " lead  and trail "]
    want = encode(vocabulary, texts)
    for nodes, window in ((400, 100), (50, 17), (1, 16)):
        monkeypatch.setattr(S, "NODES", nodes)
        monkeypatch.setattr(S, "WINDOW", window)
        assert encode(vocabulary, texts) == want


@pytest.mark.parametrize("text", ["one two  three   four é " * 900, " x y" * 900 + " ", "  a" * 800 + "  ", "unbroken" * 900, "a " * 2000])
def test_pieces_of_a_long_text_change_nothing(vocabulary, monkeypatch, text):
    data, offsets = utf8(pa.array([text]))
    want, _ = S.encode_texts(vocabulary, data, offsets, np.array([5]), 7)
    monkeypatch.setattr(S, "PIECE_BYTES", 500)
    found, at = S.encode_long(vocabulary, data, np.array([5]), 7)
    assert np.array_equal(found, want) and list(at) == [0, len(want)]


def test_memory_of_a_long_text(vocabulary):
    rng = np.random.default_rng(4)
    text = " ".join("".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(2, 12, 500_000))
    data, _ = utf8(pa.array([text]))
    assert len(data) > 3_500_000
    tracemalloc.start()
    ids, _ = S.encode_long(vocabulary, data, np.array([5]), 7)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    back, _ = S.decode_ids(vocabulary, ids, np.array([0, len(ids)]))
    assert np.array_equal(back, data)
