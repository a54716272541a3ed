"""What operators leave on disk and exchange: no more than their next step needs."""

import hashlib
import os
import time
from glob import glob

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import exact_dedup, minhash
from ledgerlake.llm.common import CLEANUP, apart, stored
from tests.llm import awkward


def shuffled(spark) -> dict[str, int]:
    """Spark's shuffle files and their sizes."""
    found = {}
    for folder in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs():
        for path in glob(f"{folder.toString()}/*/shuffle_*.data"):
            try:
                found[path] = os.path.getsize(path)
            except FileNotFoundError:  # removed meanwhile
                pass
    return found


def test_stored_copies_leave_no_shuffle_files(spark, conf):
    before, setting = set(shuffled(spark)), spark.conf.get(CLEANUP)
    sums = spark.range(100_000).groupBy(F.xxhash64("id").alias("k")).agg(F.max("id").alias("m"))
    copies = [stored(sums, "disk-test") for _ in range(2)]
    until = time.time() + 20  # they are removed in the background
    while (left := set(shuffled(spark)) - before) and time.time() < until:
        time.sleep(0.5)
    assert not left and spark.conf.get(CLEANUP) == setting
    assert [df.count() for df in copies] == [100_000] * 2 and sums.count() == 100_000
    conf(**{CLEANUP.removeprefix("spark.sql.").replace(".", "__"): "true"})
    stored(sums, "disk-test")
    assert spark.conf.get(CLEANUP) == "true"


@pytest.mark.parametrize("kind", ["bigint", "string", "double"])
def test_apart(spark, kind):
    """All rows whose id is asked for are of the second kind, and few others; no row is lost or repeated."""
    docs = spark.range(20_000).select(F.when(F.col("id") > 0, F.col("id").cast(kind)).alias("doc_id"), F.lit("t").alias("part"))
    docs = docs.union(docs.where("doc_id < 100"))
    ids = stored(docs.where("doc_id IS NULL OR doc_id % 100 = 0").select("doc_id").distinct(), "disk-test")
    stay, maybe = apart(docs, "doc_id", ids)
    assert stay.columns == maybe.columns == docs.columns
    assert stay.union(maybe).exceptAll(docs).isEmpty() and docs.exceptAll(stay.union(maybe)).isEmpty()
    assert stay.where("doc_id IS NULL OR doc_id % 100 = 0").isEmpty()
    assert 200 <= maybe.count() < 200 + 0.06 * 20_000
    stay, maybe = apart(docs, "doc_id", ids.limit(0))
    assert maybe.isEmpty() and stay.count() == docs.count()


def test_apart_beyond_the_most_bits(spark, monkeypatch):
    monkeypatch.setattr("ledgerlake.llm.common.MOST_BITS", 64)
    docs = spark.range(1000).withColumnRenamed("id", "doc_id")
    stay, maybe = apart(docs, "doc_id", stored(docs.where("doc_id < 20"), "disk-test"))
    assert stay.count() + maybe.count() == 1000 and maybe.where("doc_id < 20").count() == 20


@pytest.mark.parametrize("stage", [exact_dedup.without_duplicates, minhash.without_near_duplicates])
def test_texts_that_stay_are_not_exchanged(spark, conf, stage):
    rows = [(i, " ".join(hashlib.sha256(f"{i % 600} {k}".encode()).hexdigest() for k in range(60))) for i in range(612)]
    docs = stored(awkward.documents(spark, rows), "disk-test")
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    kept = stage(docs)
    before = shuffled(spark)
    found = {r.doc_id for r in kept.collect()}
    assert found == set(range(600))
    sent = sum(size for path, size in shuffled(spark).items() if path not in before)
    assert 0 < sent < 0.2 * sum(len(t) for _, t in rows) / 2  # hexadecimal digits take half their length


def test_sketches_go_before_buckets_are_dealt(spark, monkeypatch):
    alive, at, keep, drop = {}, {}, minhash.stored, minhash.discard

    def kept(df, label):
        at[label] = set(alive.values())
        out = keep(df, label)
        alive[out.stored_at] = label
        return out

    def dropped(*copies):
        for df in copies:
            alive.pop(df.stored_at, None)
        drop(*copies)

    monkeypatch.setattr(minhash, "stored", kept)
    monkeypatch.setattr(minhash, "discard", dropped)
    assert minhash.near_duplicates(awkward.documents(spark)).where("kept").count() > 0
    assert "near-sketch" in at["near-about"] and "near-sketch" not in at["near-buckets"]
