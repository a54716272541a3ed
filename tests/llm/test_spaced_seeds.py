import random
from itertools import combinations

import pytest

from ledgerlake.llm import spaced_seeds
from tests.llm import awkward

S = spaced_seeds


def wanted(docs, items):
    """Every alignment of an item with a document that shares some seed and enough words."""
    out = set()
    for d, text in docs:
        w = awkward.split_words(text)
        for i, passage in items:
            item = awkward.split_words(passage)
            if len(item) < S.MIN_WORDS:
                continue
            for start in range(-len(item) + 1, len(w)):
                at = lambda k: 0 <= start + k < len(w) and w[start + k] == item[k]  # noqa: E731, B023
                if len(item) < S.SPAN:
                    hit = all(at(k) for k in range(len(item)))
                else:
                    hit = any(
                        all(at(k + j) for j, one in enumerate(mask) if one == "1")
                        for mask in S.MASKS
                        for k in range(len(item) - S.SPAN + 1)
                        if start + k >= 0 and start + k + S.SPAN <= len(w)
                    )
                if not hit:
                    continue
                same = [at(k) for k in range(len(item))]
                best = max((sum(same[k : k + S.WINDOW]) for k in range(len(same) - S.WINDOW + 1)), default=0)
                if sum(same) * 100 >= S.SHARE * len(item) or best * 100 >= S.SHARE * S.WINDOW:
                    out.add((d, i, start, len(item), sum(same), best))
    return out


def fixture():
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(40)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 6, 9, 15, 30, 60])))) for i in range(24)]
    items += [(90, None), (91, ""), (92, "THE  Quick\tbrown fox jumps over"), (0, items[0][1])]
    docs = [(d, t) for d, t in awkward.TEXTS if len(t or "") < 1000]
    for d in range(100, 190):
        words = [word() for _ in range(rng.randrange(40))]
        if d % 3:
            passage = awkward.split_words(rng.choice(items)[1])
            for _ in range(len(passage) // 12):
                passage[rng.randrange(len(passage))] = "other"
            words[10:10] = passage[rng.randrange(3) :]
        docs.append((d, " ".join(words)))
    docs.append((200, "so the quick BROWN fox jumps over it"))
    return docs, items


@pytest.mark.parametrize("limit", [S.BROADCAST_SEEDS, 0])
def test_brute_force(spark, monkeypatch, limit):
    """With and without the broadcast of the seeds."""
    monkeypatch.setattr(S, "BROADCAST_SEEDS", limit)
    docs, items = fixture()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {tuple(r) for r in S.findings(awkward.documents(spark, docs), bench).collect()}
    want = wanted(docs, items)
    assert found == want and len(want) > 15
    assert any(r[4] < r[3] for r in want)  # some with substituted words


def test_stage(spark):
    docs, items = fixture()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    frame = awkward.documents(spark, docs)
    kept = S.without_benchmark(frame, bench)
    gone = {d for d, *_ in wanted(docs, items)}
    assert kept.columns == frame.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([d for d, _ in docs if d not in gone], key=str)


def test_no_rows(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id bigint, text string")
    assert S.findings(awkward.nothing(spark), some).count() == 0
    assert S.findings(awkward.documents(spark), none).count() == 0
    assert {r.doc_id for r in S.findings(awkward.documents(spark), some).collect()} == {1, 2, 3}


def overlaps(docs, items):
    """Every alignment with enough words, without asking for a seed."""
    out = set()
    for d, text in docs:
        w = awkward.split_words(text)
        for i, passage in items:
            item = awkward.split_words(passage)
            if len(item) < S.MIN_WORDS:
                continue
            for start in range(-len(item) + 1, len(w)):
                same = [0 <= start + k < len(w) and w[start + k] == x for k, x in enumerate(item)]
                best = max((sum(same[k : k + S.WINDOW]) for k in range(len(same) - S.WINDOW + 1)), default=0)
                if sum(same) * 100 >= S.SHARE * len(item) or best * 100 >= S.SHARE * S.WINDOW:
                    out.add((d, i, start, len(item), sum(same), best))
    return out


def test_every_overlap_is_found(spark):
    """Every fifth word replaced, random admissible replacements, passages cut off by an end of the document."""
    rng = random.Random(8)
    items, docs = [], []
    for n in [*range(5, 32), 45, 60, 200]:
        item = [f"i{n}w{k}" for k in range(n)]
        items.append((n, " ".join(item)))
        gone = n // 5
        cases = [range(first, n, 5) for first in range(5) if len(range(first, n, 5)) <= gone]
        cases += [rng.sample(range(n), gone) for _ in range(12)] + [range(gone), range(n - gone, n), range((n - gone) // 2, (n + gone) // 2)]
        for case in cases:
            text = ["other" if k in case else x for k, x in enumerate(item)]
            docs.append((len(docs), " ".join(["before", *text, "after"])))
        docs += [(len(docs), " ".join(item[gone:])), (len(docs) + 1, " ".join(item[: n - gone]))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = [tuple(r) for r in S.findings(awkward.documents(spark, docs), bench).collect()]
    assert len(found) == len(set(found))
    assert set(found) == overlaps(docs, items)
    assert {d for d, *_ in found} == {d for d, _ in docs}


@pytest.mark.parametrize("share", [60, 80, 90, 100])
def test_masks_cover(share):
    """All ways to replace as many words as the share allows, for the short lengths."""
    for n in range(S.MIN_WORDS, 21):
        gone = n * (100 - share) // 100
        if gone > 4:
            continue
        ones = [[first + k for first, width in mask for k in range(width)] for mask in S.masks(n, share)]
        at = [{first + k for k in mask} for mask in ones for first in range(n - mask[-1])]
        for case in combinations(range(n), gone):
            assert any(mask.isdisjoint(case) for mask in at), (n, case)


@pytest.mark.parametrize("longs", [S.BITMAP, 1])
def test_short_items(spark, monkeypatch, longs):
    """Items of one to four words are found word for word; a bitmap too small for its seeds lets all positions through."""
    monkeypatch.setattr(S, "BITMAP", longs)
    items = [(1, "alone"), (2, "two words"), (3, "three words here"), (4, "and now four words"), (5, "five words with one replaced"), (6, "\n ")]
    docs = [
        (1, "quite alone"), (2, "two other words"), (3, "so THREE words\there it says"), (4, "and now four word"), (5, "and now four words"),
        (6, "five words with none replaced"), (7, "words"), (8, None), (9, "two words two words"),
    ]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = sorted((r.doc_id, r.item_id, r.starts_at) for r in S.findings(awkward.documents(spark, docs), bench).collect())
    assert found == [(1, 1, 1), (3, 3, 1), (5, 4, 0), (6, 5, 0), (9, 2, 0), (9, 2, 2)]
    assert set(found) == {r[:3] for r in overlaps(docs, items) if r[1] != 6}
