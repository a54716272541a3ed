"""Aligned tokens against whole texts encoded at once; fragments composed in any order; counts against a count by hand."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerlake.llm import alignment
from ledgerlake.llm.alignment import Fragment, Fragments, align, compose, compose_all, fragments, identity, segments, whole_texts
from tests.llm.awkward import documents, nothing

ODD = [
    "", "a ▁ b c", " lead", "trail ", "two  blanks\n x", "日本 語é 😀 x  y z", "<|endoftext|> <s> x", "x" * 3000, "\x00 a\x85 b",
    "tab\t x \ty", "don't they're  I'll", "a  b  c", "one. Two, three! 12 345 6789",
]


@pytest.fixture(scope="module")
def both():
    return alignment.tokenizers((alignment.BYTE_MODEL, alignment.PIECE_MODEL))


def wanted(t, text):
    """n_a, n_b, n_groups, hash and linked pairs by encoding the whole text at once, or None."""
    a_model = Tokenizer.from_file(alignment.BYTE_MODEL)
    a_model.encode_special_tokens = True
    a = a_model.encode(f" {text}", add_special_tokens=False).ids if text else []
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_MODEL).encode(text or "")
    whole = f" {text}".encode()
    if not text or any(b"".join(x[i] for i in ids) != whole for x, ids in ((t.a_bytes, a), (t.b_bytes, b))):
        return None
    a_ends, b_ends = (np.cumsum([len(x[i]) for i in ids]).tolist() for x, ids in ((t.a_bytes, a), (t.b_bytes, b)))
    groups, i, j = [], 0, 0
    for end in sorted(set(a_ends) & set(b_ends)):
        k, m = a_ends.index(end) + 1, b_ends.index(end) + 1
        groups.append((a[i:k], b[j:m]))
        i, j = k, m
    names = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
    return len(a), len(b), len(groups), hashlib.sha256(names.encode()).hexdigest(), [(x[-1], y[-1]) for x, y in groups]


def sample(spark, n=25):
    return [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(n).collect()]


def single(f):
    return Fragments(f.a, f.b, f.na, f.nb, *(np.array([0, len(x)]) for x in (f.a, f.b, f.na)))


def test_chunks_give_the_tokens_of_whole_texts(spark, both):
    texts = [t or "" for t in sample(spark) + ODD]
    f, *_ = fragments(both, texts, np.zeros(len(texts), np.int64), 1 << 62)
    numbers, pairs, at = whole_texts(both, f)
    for i, text in enumerate(texts):
        found = tuple(numbers[c][i].as_py() for c in (0, 1, 2, 4))
        links = [divmod(int(p), len(both.b_size)) for p in pairs[at[i] : at[i + 1]]]
        assert (found, links) == ((w[:4], w[4]) if (w := wanted(both, text)) else ((0, 0, 0, ""), []))


@pytest.mark.parametrize("size", [5, 64, 1000])
def test_fragments_compose_in_any_order(spark, both, size):
    rng = random.Random(size)
    opened = 0
    for text in filter(None, sample(spark, 12) + ODD):
        cut = list(segments(text, size))
        assert "".join(f" {body}" for _, body in cut) == f" {text}"
        f, row, at, right = fragments(both, [body for _, body in cut], np.array([x for x, _ in cut]), size)
        assert list(at) == sorted(set(at.tolist()))
        bounds = zip(f.a_at, f.a_at[1:], f.b_at, f.b_at[1:], f.parts_at, f.parts_at[1:], strict=False)
        parts = [Fragment(f.a[p:q], f.b[r:s], f.na[u:v], f.nb[u:v]) for p, q, r, s, u, v in bounds]
        opened += sum(bool(x.na[-1] or x.nb[-1]) for x in parts)
        one = compose_all(parts)
        while len(parts) > 1:
            k = rng.randrange(len(parts) - 1)
            parts[k : k + 2] = [compose(parts[k], parts[k + 1])]
        for x in (one, compose(identity(), parts[0]), compose(parts[0], identity())):
            assert all(np.array_equal(getattr(x, c), getattr(parts[0], c)) for c in ("a", "b", "na", "nb"))
        if not right.all():
            assert wanted(both, text) is None
            continue
        numbers, *_ = whole_texts(both, single(parts[0]))
        assert tuple(numbers[c][0].as_py() for c in (0, 1, 2, 4)) == wanted(both, text)[:4]
    assert opened  # ranges do end within groups


@pytest.mark.parametrize(("size", "hot"), [(1 << 16, 1 << 20), (300, 40), (50, 0)])
def test_documents_and_corpus_counts(spark, both, size, hot):
    rows = [(i, t) for i, t in enumerate(sample(spark, 20) + ODD)]
    rows += [(500, None), (None, "one two"), (3, rows[3][1]), (3, rows[3][1]), (501, rows[3][1])]
    expected = [(i, wanted(both, t)) for i, t in rows]
    count = Counter(p for _, w in expected if w for p in w[4])
    highest = {}
    for (_, b), n in count.items():
        highest[b] = max(highest.get(b, 0), n)
    found = align(documents(spark, rows), size=size, fan=2, hot=hot).collect()
    assert Counter(map(tuple, found)) == Counter(
        (i, w[0], w[1], w[2], w[2], sum(count[p] == highest[p[1]] for p in w[4]), sum(count[p] for p in w[4]), w[3])
        if w
        else (i, 0, 0, 0, 0, 0, 0, "")
        for i, w in expected
    )


def test_tasks_hold_one_python_worker_each(spark):
    # Every worker holds the models and its chunks: two in a task would double an executor's memory for them.
    found = alignment.aligned(documents(spark, [(1, "one two three " * 50), (2, "one")]), size=64, fan=2)
    above, python = [], 0
    for line in found._jdf.queryExecution().executedPlan().toString().splitlines():
        mark = re.match(r"[ :+*-]*", line).end()
        node = re.sub(r"^\(\d+\) ", "", line[mark:])
        depth = len(re.match(r"[ :]*([:+]- ?)?", line).group())
        above = [(d, n) for d, n in above if d < depth]
        stage = [n for _, n in above]
        last = max((i for i, n in enumerate(stage) if "Exchange" in n.split("(")[0].split(" ")[0]), default=-1)
        if "InArrow" in node.split(" ")[0]:
            python += 1
            assert not [n for n in stage[last + 1 :] if "InArrow" in n.split(" ")[0]], line
        above.append((depth, node))
    assert python > 5  # short texts, segments, fragments, several levels


def test_awkward_and_empty_tables(spark):
    rows = align(documents(spark), size=1 << 14).collect()
    assert len(rows) == documents(spark).count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1][1:] == by_id[2][1:] and by_id[5].groups_sha256 == by_id[4].groups_sha256 == ""
    assert by_id[12].n_a == 0  # holds a blank sign of its own
    assert by_id[11].n_groups > 0 and by_id[9].n_links > 30_000
    assert align(nothing(spark)).collect() == []


def test_forgetting_chunks_changes_nothing(spark, both, monkeypatch):
    texts = [t or "" for t in sample(spark)]
    before = both.read(texts)
    monkeypatch.setattr(alignment, "CHUNKS", 0)
    after = [both.read([t]) for t in texts]
    assert np.array_equal(before[0], np.concatenate([x[0] for x in after]))
    assert np.array_equal(before[2], np.concatenate([x[2] for x in after]))
