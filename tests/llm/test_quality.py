import random

from ledgerlake.llm import quality
from tests.llm import awkward


def corpus(n=400):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(["an", "the", "re", "ing", "tion", "ou"]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 80))]
        good = i % 4 != 0
        if not good:
            words = rng.choice([lambda w: [x.upper() + "!!" for x in w], lambda w: [x + "%%%" for x in w], lambda w: [w[0]] * len(w)])(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(good)))
    return docs, labels


def test_held_out(spark):
    docs, labels = corpus()
    frame, known = awkward.documents(spark, docs), spark.createDataFrame(labels, "doc_id bigint, quality int")
    held = quality.remainder("doc_id", 3) == 1
    model = quality.train(frame, known, "quality", usable=~held)
    rows = quality.score(frame, model).select("*", held.alias("held")).where("held").collect()
    right = sum((r.score >= 0.5) == (r.doc_id % 4 != 0) for r in rows)
    assert len(rows) > 100 and right >= 0.97 * len(rows)
    again = quality.train(frame.repartition(7), known.repartition(3), "quality", usable=~held)
    assert (again.gain == model.gain).all() and again.base == model.base


def test_labels_of_held_out_rows_do_not_count(spark):
    docs, labels = corpus(60)
    frame = awkward.documents(spark, docs)
    held = quality.remainder("doc_id", 3) == 1
    import zlib

    turned = [(d, 1 - q if zlib.crc32(str(d).encode()) % 3 == 1 else q) for d, q in labels]
    one, other = (
        quality.train(frame, spark.createDataFrame(x, "doc_id bigint, quality int"), "quality", usable=~held) for x in (labels, turned)
    )
    assert (one.gain == other.gain).all()


def test_awkward_rows(spark):
    docs, labels = corpus(100)
    known = spark.createDataFrame([*labels, (5, None), (None, 1), (99_999, 1)], "doc_id bigint, quality int")
    model = quality.train(awkward.documents(spark, docs), known, "quality")
    scored = quality.score(awkward.documents(spark), model).collect()
    assert len(scored) == len(awkward.TEXTS) and all(0 <= r.score <= 1 for r in scored)
    assert {round(r.score, 6) for r in scored if r.doc_id in (4, 5, 6)} == {round(model.prior, 6)}
    assert quality.score(awkward.nothing(spark), model).count() == 0


def test_stage(spark):
    docs, labels = corpus()
    frame = awkward.documents(spark, docs)
    kept = quality.good_documents(frame, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    assert kept.columns == frame.columns
    ids = {r.doc_id for r in kept.collect()}
    assert len(ids ^ {d for d, q in labels if q}) <= 4


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    model = quality.train(awkward.documents(spark), none, "quality")
    assert {r.score for r in quality.score(awkward.documents(spark), model).collect()} == {0.5}


def test_a_repeated_id_is_one_row_of_the_sample(spark, monkeypatch):
    docs = awkward.documents(spark, [(1, f"text number {i}") for i in range(300)] + [(2, "another")])
    known = spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "doc_id bigint, quality int")
    seen, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda rows, buckets: (seen.append(len(rows)), fit(rows, buckets))[1])
    for most in (1, 2):
        quality.train(docs, known, "quality", max_rows=most)
    assert seen == [1, 2]
