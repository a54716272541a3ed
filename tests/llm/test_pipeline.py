"""The pipeline over the smallest sample, stage by stage, against versions that compare everything with everything."""

import re

import pytest

import corpus_pipeline
from ledgerlake.llm import quality, spaced_seeds
from ledgerlake.llm.common import stored, table
from tests.llm import awkward
from tests.llm.test_minhash import wanted as near_wanted
from tests.llm.test_spaced_seeds import wanted as leaks_wanted

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "good_quality", "distinct_texts", "distinct_contents", "no_benchmark", "token_ids",
    ]


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_stay(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_quality(spark, stages):
    docs = stages[0]
    model = quality.train(docs, table(spark, SF, "labels"), "quality")
    good = {r.doc_id for r in quality.score(docs, model).where("score >= 0.5").collect()}
    assert set(texts(stages[1])) == good
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    assert not [d for d, q in labels.items() if q == 1 and d not in good]


def test_exact(stages):
    best = {}
    for d, t in texts(stages[1]).items():
        bare = re.sub("[\x20\x09-\x0d]", "", t)
        best[bare] = min(best.get(bare, (0, 0)), (-len(t), d)) if bare in best else (-len(t), d)
    assert set(texts(stages[2])) == {d for _, d in best.values()}


def test_near(stages):
    want = near_wanted(list(texts(stages[2]).items()), 5, 80)
    assert set(texts(stages[3])) == {c for _, c in want.values()}


def test_benchmark(spark, stages):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    before = texts(stages[3])
    vocabulary = {w for _, t in items for w in awkward.split_words(t)}
    some = [(d, t) for d, t in before.items() if len(awkward.split_words(t)) < 600 and vocabulary & set(awkward.split_words(t))][:60]
    gone = {d for d, *_ in leaks_wanted(some, items)}
    kept = set(texts(stages[4]))
    assert {d for d, _ in some} - gone == {d for d, _ in some} & kept
    assert len(before) - len(kept) == spaced_seeds.findings(stages[3], table(spark, SF, "benchmark")).select("doc_id").distinct().count()


def test_tokens(stages):
    rows = stages[5].collect()
    assert {r.doc_id for r in rows} == set(texts(stages[4])) and all(r.lossless for r in rows)


def test_run(spark, stages):
    found = corpus_pipeline.run(spark, SF)
    assert {(r.doc_id, tuple(r.ids)) for r in found.collect()} == {(r.doc_id, tuple(r.ids)) for r in stages[5].collect()}


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
    assert all(r.lossless for r in docs.collect())
    docs = awkward.nothing(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
    assert docs.count() == 0
