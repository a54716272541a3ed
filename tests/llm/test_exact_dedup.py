import hashlib
import re
from collections import defaultdict

import pytest

from ledgerlake.llm import exact_dedup
from tests.llm import awkward


def wanted(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((doc_id, len(text or "")))
    out = []
    for bare, members in groups.items():
        ids = [m for m in members if m[0] is not None]
        keep = min(ids, key=lambda m: (-m[1], m[0]))[0] if ids else None
        if ids and max(m[1] for m in members) > max(m[1] for m in ids):
            keep = None  # the longest has no id
        out += [(d, keep, len(members), d == keep, hashlib.sha256(bare.encode()).hexdigest()) for d, _ in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"hash_bits": 2, "capacity": 2}, {"hash_bits": 8, "capacity": 1}])
def test_brute_force(spark, options):
    """Few hash bits make different texts share keys, and a small capacity makes the directory double until its bits run out."""
    found = exact_dedup.exact_duplicates(awkward.documents(spark), **options)
    assert sorted([tuple(r) for r in found.collect()], key=str) == wanted(awkward.TEXTS)


def test_directory(spark):
    rows = [(i, f"text {i}") for i in range(300)]
    index = exact_dedup.build_index(awkward.documents(spark, rows), capacity=10)
    buckets = index.entries.groupBy("bucket", "depth").count().collect()
    assert index.depth > 4 and max(r["count"] for r in buckets) <= 10
    assert sum(r["count"] for r in buckets) == 300


def test_only_overfull_buckets_split(spark):
    """Each bucket has the fewest leading bits with which its keys fit, so depths differ."""
    rows = [(i, f"text {i}") for i in range(400)]
    index = exact_dedup.build_index(awkward.documents(spark, rows), capacity=3)
    found = index.entries.select("bucket", "depth", exact_dedup.prefix("key", index.depth, 64).alias("cell")).collect()
    assert len({r.depth for r in found}) >= 4
    cells = [r.cell for r in found]
    for r in found:
        own = r.cell >> (index.depth - r.depth)
        assert r.bucket == f"{r.depth}/{own}" and sum(c >> (index.depth - r.depth) == own for c in cells) <= 3
        if r.depth:
            assert sum(c >> (index.depth - r.depth + 1) == own >> 1 for c in cells) > 3


def test_rows_are_found_through_the_directory(spark, monkeypatch):
    rows = [(i, f"text {i % 40}") for i in range(120)]
    whole = exact_dedup.exact_duplicates(awkward.documents(spark, rows), capacity=4).collect()
    assert len(whole) == 120
    directory = exact_dedup.directory

    def without_a_cell(*args):
        cells, depth = directory(*args)
        return cells.where(cells["cell"] != cells.agg({"cell": "min"}).first()[0]), depth

    monkeypatch.setattr(exact_dedup, "directory", without_a_cell)
    assert 0 < exact_dedup.exact_duplicates(awkward.documents(spark, rows), capacity=4).count() < 120


def test_ids_of_other_types(spark):
    rows = [("b", "same"), ("a", " s a m e"), ("c", "same "), (None, "same"), ("d", "other")]
    found = exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sorted((str(r.doc_id), r.keep_id, r.group_size) for r in found) == [
        ("None", "a", 4), ("a", "a", 4), ("b", "a", 4), ("c", "a", 4), ("d", "d", 1),
    ]
    least = -(2**63)
    found = exact_dedup.exact_duplicates(awkward.documents(spark, [(least, "x"), (5, "x"), (7, "x ")])).collect()
    assert {r.keep_id for r in found} == {7}
    assert exact_dedup.exact_duplicates(awkward.documents(spark, [(least, "x"), (5, "x")])).first().keep_id == least


def test_stage_leaves_no_copies(spark):
    """Also of rows that share id and text."""
    rows = [(1, "a b"), (1, "a  b"), (1, "a b"), (2, "ab"), (3, "c"), (3, "d"), (None, "e"), (None, "e"), (4, "f")]
    kept = exact_dedup.without_duplicates(awkward.documents(spark, rows)).collect()
    assert sorted([(r.doc_id, r.text) for r in kept], key=str) == sorted(
        [(1, "a  b"), (3, "c"), (3, "d"), (None, "e"), (4, "f")], key=str
    )


def test_stage_keeps_columns(spark):
    docs = awkward.documents(spark)
    kept = exact_dedup.without_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([1, 3, 6, 7, 8, 9, 10, 11, 12, 13, None], key=str)


def test_no_rows(spark):
    assert exact_dedup.exact_duplicates(awkward.nothing(spark)).count() == 0
