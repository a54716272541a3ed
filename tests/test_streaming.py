import datetime as dt
import os
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException

from ledgerlake.plans import customer360
from ledgerlake.schemas import CUSTOMER_360
from ledgerlake.sources.events import event_stream, parse_events
from ledgerlake.sources.tables import FrameGold, fact_segments, read_current_version
from ledgerlake.streaming import customer360_stream as cs
from ledgerlake.streaming import fact_stream as fs
from ledgerlake.streaming import rollup, ticker
from ledgerlake.streaming.compaction import compact_facts
from ledgerlake.streaming.runner import run_stream, wait_all
from tests.test_events import accounts, topic, trans


def publish(spark, base, documents):
    topic(spark, documents).coalesce(1).write.mode("append").parquet(f"{base}/trans")


def catch_up(spark, base, stream_id="main", checkpoint="cp", districts=None, **options):
    def load_accounts(session):
        if districts is None:
            return accounts(session)
        return session.createDataFrame([(5, districts[0], True)], accounts(session).schema)

    wait_all([
        fs.start_fact_stream(
            event_stream(spark, "trans", path=base, **options), "trans", load_accounts,
            f"{base}/silver", f"{base}/gold", f"{base}/{checkpoint}", stream_id=stream_id, until_caught_up=True,
        )
    ])
    return fs.read_facts(spark, f"{base}/gold", "trans")


def test_stream_equals_batch(spark, tmp_path):
    base = str(tmp_path)
    publish(spark, base, [trans(trans_id=n) for n in range(1, 8)] + ["{bad", trans(trans_id=9, amount=0)])
    gold = catch_up(spark, base)
    assert sorted(r.trans_id for r in gold.collect()) == list(range(1, 8))
    assert fs.read_facts(spark, f"{base}/silver", "trans", "silver").count() == 7


def test_micro_batches_and_restart(spark, tmp_path):
    base = str(tmp_path)
    for n in (1, 2, 3):
        publish(spark, base, [trans(trans_id=n)])
    catch_up(spark, base, maxFilesPerTrigger=1)
    publish(spark, base, [trans(trans_id=4)])
    rows = catch_up(spark, base, maxFilesPerTrigger=1).collect()
    assert sorted((r.trans_id, r.batch_id) for r in rows) == [(1, 0), (2, 1), (3, 2), (4, 3)]


def test_replay_leaves_one_copy(spark, tmp_path):
    base = str(tmp_path)
    publish(spark, base, [trans(trans_id=n) for n in range(5)])
    catch_up(spark, base, checkpoint="first")
    assert catch_up(spark, base, checkpoint="second").count() == 5


def test_streams_do_not_replace_each_other(spark, tmp_path):
    base = str(tmp_path)
    publish(spark, base, [trans()])
    catch_up(spark, base, "north", "first")
    assert catch_up(spark, base, "south", "second").count() == 2


def test_dimension_is_read_anew_for_each_batch(spark, tmp_path):
    base, districts = str(tmp_path), [1]
    publish(spark, base, [trans(trans_id=1)])
    catch_up(spark, base, districts=districts)
    districts[0] = 2
    publish(spark, base, [trans(trans_id=2)])
    rows = catch_up(spark, base, districts=districts).collect()
    assert {r.trans_id: r.account_dim_district_id for r in rows} == {1: 1, 2: 2}


def test_failure_is_raised_and_stops_the_rest(spark, tmp_path):
    base = str(tmp_path)
    publish(spark, base, [trans()])

    def fail(batch, batch_id):
        raise ValueError("no")

    events = event_stream(spark, "trans", path=base)
    healthy = run_stream(events, lambda b, i: b.count(), f"{base}/a", trigger_seconds=1)
    broken = run_stream(events, fail, f"{base}/b", until_caught_up=True)
    with pytest.raises(StreamingQueryException):
        wait_all([healthy, broken])
    assert not healthy.isActive


def test_event_stream_needs_one_source(spark):
    with pytest.raises(ValueError):
        event_stream(spark, "trans")


def test_customer360_log_merge_and_compaction(spark, tmp_path):
    base = str(tmp_path)

    def reference(session):
        clients = session.createDataFrame(
            [(7, "born", 70, True)], "client_id BIGINT, birth_number STRING, district_id BIGINT, is_current BOOLEAN"
        )
        return cs.Reference(clients, accounts(session))

    def catch_up_360():
        wait_all([
            cs.start_customer360_stream(
                event_stream(spark, "trans", path=base), "trans", reference, f"{base}/log", f"{base}/cp",
                until_caught_up=True,
            )
        ])

    publish(spark, base, [trans(trans_id=1, amount=1.0), trans(trans_id=2, amount=2.0, ingest_ts="2025-02-04T00:00:00Z")])
    catch_up_360()
    assert cs.customer360(spark, f"{base}/log").first().last_trans_amount == 2.0
    cs.compact(spark, f"{base}/log", f"{base}/table")
    # A late event, and one of an unknown client.
    publish(spark, base, [trans(trans_id=3, amount=3.0, ingest_ts="2025-01-01T00:00:00Z"), trans(trans_id=4, client_id=8)])
    catch_up_360()
    rows = {r.client_id: r for r in cs.customer360(spark, f"{base}/log", f"{base}/table").collect()}
    assert rows[7].last_trans_id == 2 and rows[7].birth_number == "born" and rows[7].account_district_id == 50
    assert rows[8].birth_number is None and rows[8].last_trans_id == 4
    before = sorted(cs.customer360(spark, f"{base}/log", f"{base}/table").collect())
    cs.compact(spark, f"{base}/log", f"{base}/table")
    assert read_current_version(spark, f"{base}/table", CUSTOMER_360).count() == 2
    # A lookup reads one bucket, and of the log only what the table lacks.
    found = cs.find_client(spark, f"{base}/log", f"{base}/table", 7)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.first().last_trans_id == 2 and "bucket" in plan.split("PartitionFilters:")[1][:60]
    assert cs.find_client(spark, f"{base}/log", f"{base}/table", 99).count() == 0
    # Batches that two versions hold are removed, and nothing changes.
    assert cs.trim_log(spark, f"{base}/log", f"{base}/table") == 1
    cs.compact(spark, f"{base}/log", f"{base}/table")
    assert cs.trim_log(spark, f"{base}/log", f"{base}/table") == 1
    assert sorted(cs.customer360(spark, f"{base}/log", f"{base}/table").collect()) == before


def test_files_of_a_batch_do_not_depend_on_cores(spark, tmp_path):
    """A small batch is one file per table and date, however many tasks read it."""
    base = str(tmp_path)
    topic(spark, [trans(trans_id=n) for n in range(64)]).repartition(16).write.parquet(f"{base}/trans")
    catch_up(spark, base)
    for layer in ("silver", "gold"):
        assert len(list((tmp_path / layer).rglob("part-*.parquet"))) == 1


def test_a_batch_over_many_dates_is_a_few_files(spark, tmp_path):
    base = str(tmp_path)
    days = [(dt.date(2020, 1, 1) + dt.timedelta(days=n)).isoformat() for n in range(400)]
    publish(spark, base, [trans(trans_id=n, date=day) for n, day in enumerate(days)] + [trans(trans_id=999, date=None)])
    gold = catch_up(spark, base)
    assert gold.count() == 401 and gold.where("trans_date IS NULL").count() == 1
    assert len(list((tmp_path / "gold").rglob("part-*.parquet"))) < 20
    recent = gold.where("trans_date >= DATE '2021-02-01'")
    assert recent.count() == sum(d >= "2021-02-01" for d in days)
    assert "trans_date" in recent._jdf.queryExecution().executedPlan().toString().split("PushedFilters:")[1]


def batch_of(spark, ids, day="2025-01-01"):
    rows = spark.createDataFrame([(n,) for n in ids], "trans_id BIGINT")
    schema = fs.GOLD_FACTS["fact_trans"]
    values = {"trans_id": "trans_id", "trans_date": f"date_add(DATE '{day}', CAST(trans_id % 700 AS INT))"}
    return rows.selectExpr(*[f"CAST({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema if f.name != "batch_id"])


def ids(spark, base):
    return sorted(r.trans_id for r in fs.read_facts(spark, base, "trans").collect())


def test_compaction_folds_finished_batches(spark, tmp_path):
    base = f"{tmp_path}/fact_trans"

    def put(stream, batch, rows):
        fs.write_gold_batch(batch_of(spark, rows), base, "trans", stream, batch)

    for n in range(3):
        put("a", n, range(10 * n, 10 * n + 10))
    put("b/c d", 0, [100])
    assert compact_facts(spark, base, "trans", fan=2) == 2  # not the newest of either stream
    assert ids(spark, base) == [*range(30), 100]
    # Replayed after it was folded, replayed while it was not, and new ones.
    put("a", 1, [77])
    put("a", 2, range(20, 25))
    put("a", 3, [])
    put("a", 4, [40])
    assert ids(spark, base) == [*range(25), 40, 100]
    levels = []
    for n in range(5, 9):
        put("a", n, [n * 10])
        assert compact_facts(spark, base, "trans", fan=2) >= 1
        levels.append(sorted(fact_segments(spark, base).levels))
    assert ids(spark, base) == [*range(25), 40, 50, 60, 70, 80, 100]
    assert all(len(set(at)) == len(at) for at in levels) and max(map(max, levels)) >= 2
    assert compact_facts(spark, base, "trans", all_batches=True) == 2 and compact_facts(spark, base, "trans", all_batches=True) == 0
    assert ids(spark, base) == [*range(25), 40, 50, 60, 70, 80, 100]
    # Of what was folded only the state before the newest is kept.
    assert len(list((tmp_path / "fact_trans_clustered" / "manifest").glob("version=*"))) == 2
    assert len(list(tmp_path.glob("fact_trans/stream_id=a/batch_id=*"))) <= 2


def test_a_compaction_that_failed_changes_nothing(spark, tmp_path):
    base = f"{tmp_path}/fact_trans"
    for n in range(3):
        fs.write_gold_batch(batch_of(spark, [n]), base, "trans", "a", n)
    compact_facts(spark, base, "trans")
    before = ids(spark, base)
    # A segment without a manifest, and a manifest that was not completed.
    batch_of(spark, [55]).write.parquet(f"{base}_clustered/segment=9")
    (tmp_path / "fact_trans_clustered" / "manifest" / "version=2").mkdir()
    assert ids(spark, base) == before
    fs.write_gold_batch(batch_of(spark, [3]), base, "trans", "a", 3)
    compact_facts(spark, base, "trans")
    assert ids(spark, base) == [*before, 3]


def test_dated_reads_touch_a_small_share_of_a_compacted_table(spark, tmp_path):
    base = f"{tmp_path}/fact_trans"
    for n in range(4):  # each batch holds all dates
        fs.write_gold_batch(batch_of(spark, range(7000 * n, 7000 * n + 7000)), base, "trans", "a", n)
    compact_facts(spark, base, "trans", all_batches=True, **{"parquet.block.size": "4096", "parquet.block.size.row.check.min": "100"})
    groups = [
        (group.total_byte_size, group.column(list(fs.GOLD_FACTS["fact_trans"].names).index("trans_date")).statistics.max)
        for file in (tmp_path / "fact_trans_clustered").rglob("segment=*/part-*.parquet")
        for meta in [pq.ParquetFile(file).metadata]
        for group in map(meta.row_group, range(meta.num_row_groups))
    ]
    late = dt.date(2026, 11, 1)  # the last 31 of 700 days
    assert len(groups) > 10
    assert sum(size for size, most in groups if most >= late) < 0.2 * sum(size for size, _ in groups)
    found = fs.read_facts(spark, base, "trans").where(f"trans_date >= DATE '{late}'")
    assert found.count() == 4 * 10 * sum(dt.date(2025, 1, 1) + dt.timedelta(days=n) >= late for n in range(700))
    assert "trans_date" in found._jdf.queryExecution().executedPlan().toString().split("PushedFilters:")[1]


def clicks(spark, base, *rows):
    df = spark.createDataFrame([(dt.datetime.fromisoformat(t), a) for t, a in rows], "ingest_ts TIMESTAMP, amount DOUBLE")
    df.coalesce(1).write.mode("append").parquet(f"{base}/clicks")


def tick(spark, base, checkpoint):
    events = spark.readStream.schema("ingest_ts TIMESTAMP, amount DOUBLE").parquet(f"{base}/clicks")
    wait_all([ticker.start_ticker(events, f"{base}/out", f"{base}/{checkpoint}", until_caught_up=True)])


def windows(spark, base):
    found = ticker.read_ticker(spark, f"{base}/out", f"{base}/table").collect()
    return {r.window_start.strftime("%H:%M"): (r.events, r.volume) for r in found}


def test_ticker_over_two_checkpoints_with_late_events(spark, tmp_path):
    base = str(tmp_path)
    clicks(spark, base, ("2025-01-01T00:01:00", 1.0), ("2025-01-01T00:06:00", 7.0))
    tick(spark, base, "first")
    clicks(spark, base, ("2025-01-09T00:06:00", 5.0))
    tick(spark, base, "first")
    # Eight days late, and counted.
    clicks(spark, base, ("2025-01-01T00:02:00", 2.0))
    tick(spark, base, "first")
    want = {"00:00": (2, 3.0), "00:05": (1, 5.0)}
    rows = {(r.window_start, r.events, r.volume) for r in ticker.read_ticker(spark, f"{base}/out").collect()}
    assert (dt.datetime(2025, 1, 1, 0, 0), 2, 3.0) in rows and (dt.datetime(2025, 1, 1, 0, 5), 1, 7.0) in rows and len(rows) == 3
    # Compaction changes nothing, neither does trimming what two versions hold.
    for removed in (0, 3):
        ticker.compact(spark, f"{base}/out", f"{base}/table")
        assert ticker.trim(spark, f"{base}/out", f"{base}/table") == removed
        assert windows(spark, base)["00:00"] == want["00:00"]
    # A fresh checkpoint whose source no longer has the first window's events: that window stays, the other is the newer one.
    (tmp_path / "later").mkdir()
    clicks(spark, f"{base}/later", ("2025-01-01T00:07:00", 99.0))
    events = spark.readStream.schema("ingest_ts TIMESTAMP, amount DOUBLE").parquet(f"{base}/later/clicks")
    wait_all([ticker.start_ticker(events, f"{base}/out", f"{base}/second", until_caught_up=True)])
    rows = {(r.window_start, r.events, r.volume) for r in ticker.read_ticker(spark, f"{base}/out", f"{base}/table").collect()}
    assert (dt.datetime(2025, 1, 1, 0, 0), 2, 3.0) in rows and (dt.datetime(2025, 1, 1, 0, 5), 1, 99.0) in rows


def test_ticker_from_a_restored_checkpoint(spark, tmp_path):
    """A copy of a checkpoint goes on where the first left off; what was counted before stays."""
    base = str(tmp_path)
    clicks(spark, base, *[("2025-01-01T00:01:00", amount) for amount in (1.0, 2.0, 4.0)])
    tick(spark, base, "first")
    shutil.copytree(tmp_path / "first", tmp_path / "restored")
    os.utime(tmp_path / "restored" / "metadata", (4e9, 4e9))
    clicks(spark, base, ("2025-01-01T00:02:00", 8.0))
    tick(spark, base, "restored")
    assert [(r.events, r.volume) for r in ticker.read_ticker(spark, f"{base}/out").collect()] == [(4, 15.0)]


def test_monthly_sums(spark, tmp_path):
    base = str(tmp_path)
    log, table = f"{base}/log", f"{base}/table"

    def rows(*found):
        return spark.createDataFrame([(d, dt.date.fromisoformat(t), a) for d, t, a in found], "district_id BIGINT, trans_date DATE, amount DOUBLE")

    names = spark.createDataFrame([(1, "one", True), (2, "one", True), (3, "three", True)], "district_id BIGINT, district_name STRING, is_current BOOLEAN")

    def report():
        found = rollup.monthly_by_branch(FrameGold({"dim_district": names}), spark, log, table).collect()
        return {(r.branch, r.month.isoformat()[:7]): (r.trans_count, r.volume) for r in found}

    first = rows((1, "2025-01-03", 1.1), (2, "2025-01-09", 2.2), (3, "2025-02-01", 5.0))
    rollup.write_part(rollup.sums(first), log, "a", 0)
    rollup.write_part(rollup.sums(rows((1, "2025-02-03", 7.0))), log, "a", 1)
    rollup.write_part(rollup.sums(rows((1, "2025-02-03", 7.0))), log, "a", 1)  # replayed
    want = {("one", "2025-01"): (2, 3.3), ("one", "2025-02"): (1, 7.0), ("three", "2025-02"): (1, 5.0)}
    assert report() == want
    rollup.fold(spark, log, table)
    for batch in (0, 1):  # older parts are not read any more
        shutil.rmtree(tmp_path / "log" / "stream_id=a" / f"batch_id={batch}")
    assert report() == want
    rollup.write_part(rollup.sums(rows((3, "2025-01-31", 4.0))), log, "a", 2)  # late
    corrected = rows((1, "2025-01-03", 1.0), (2, "2025-01-09", 2.2), (3, "2025-03-01", 5.0))
    rollup.write_part(rollup.difference(first, corrected), log, "fixes", 0)
    want = {("one", "2025-01"): (2, 3.2), ("one", "2025-02"): (1, 7.0), ("three", "2025-03"): (1, 5.0), ("three", "2025-01"): (1, 4.0)}
    assert report() == want
    rollup.fold(spark, log, table)
    rollup.fold(spark, log, table)
    assert report() == want


def test_parse_is_usable_on_streams(spark, tmp_path):
    publish(spark, str(tmp_path), [trans()])
    parsed = parse_events(event_stream(spark, "trans", path=str(tmp_path)), "trans")
    assert parsed.isStreaming
    assert customer360.activity(event_stream(spark, "trans", path=str(tmp_path)), "trans").isStreaming
