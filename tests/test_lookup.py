"""Looking a client up reads no rows where the client is not."""

from ledgerlake.plans import customer360 as C
from ledgerlake.schemas import CUSTOMER_360
from ledgerlake.sources.tables import matching
from ledgerlake.streaming import customer360_stream as cs
from tests.test_events import accounts, trans
from tests.test_streaming import publish, wait_all
from ledgerlake.sources.events import event_stream


def records(spark, ids):
    """A record of every client, with a transaction whose id is the client's."""
    known = {"client_id": "id", "last_trans_id": "id", "last_trans_amount": "id / 2", "last_trans_ts": "TIMESTAMP '2025-01-01 00:00:00'"}
    return ids.selectExpr(*[f"CAST({known.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in CUSTOMER_360])


def rows_read(df):
    """Result and the rows that scans gave out (without adaptive execution)."""
    found = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return found, sum(s.metrics().apply("numOutputRows").value() for s in scans if s.metrics().contains("numOutputRows"))


def test_an_absent_client_reads_no_rows(spark, conf, tmp_path):
    log, table = f"{tmp_path}/log", f"{tmp_path}/table"
    even = spark.range(0, 40_000, 2)
    cs.append_records(records(spark, even), log, "trans", "main", 0)
    cs.compact(spark, log, table)
    cs.append_records(records(spark, spark.range(0, 40_000, 4)), log, "trans", "main", 1)
    conf(adaptive__enabled="false")
    # Odd ids lie between those stored, so that least and greatest values tell nothing.
    missed = [rows_read(cs.find_client(spark, log, table, id)) for id in range(20_001, 20_041, 2)]
    assert not any(found for found, _ in missed)
    # A bloom filter errs now and then; a page is what it costs.
    assert sum(n == 0 for _, n in missed) >= 15
    found, read = rows_read(cs.find_client(spark, log, table, 20_000))
    assert [r.last_trans_id for r in found] == [20_000] and 2 <= read < 41_000
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.filter.bloom.enabled", "false")
    try:
        without = [rows_read(cs.find_client(spark, log, table, id))[1] for id in range(20_001, 20_011, 2)]
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.filter.bloom.enabled")
    assert all(without)


def test_a_replayed_batch_leaves_one_copy(spark, tmp_path):
    log = f"{tmp_path}/log"
    for _ in range(2):
        cs.append_records(records(spark, spark.range(50)), log, "trans", "main", 0)
    assert cs.read_log(spark, log).count() == 50
    assert C.merge(cs.read_log(spark, log)).count() == 50


def test_an_empty_batch_looks_nothing_up(spark, tmp_path):
    base, asked = str(tmp_path), []

    def reference(session):
        asked.append(1)
        clients = session.createDataFrame([(7, "born", 70, True)], "client_id BIGINT, birth_number STRING, district_id BIGINT, is_current BOOLEAN")
        return cs.Reference(clients, accounts(session))

    def catch_up():
        events = event_stream(spark, "trans", path=base)
        wait_all([cs.start_customer360_stream(events, "trans", reference, f"{base}/log", f"{base}/cp", until_caught_up=True)])

    publish(spark, base, [trans(trans_id=1)])
    catch_up()
    assert asked == [1]
    spark.read.parquet(f"{base}/trans").limit(0).coalesce(1).write.mode("append").parquet(f"{base}/trans")
    catch_up()
    assert asked == [1] and len(matching(spark, f"{base}/log/stream_id=*/kind=*/batch_id=*")) == 1
    publish(spark, base, [trans(trans_id=2)])
    catch_up()
    assert asked == [1, 1]
