import datetime as dt
import json

from ledgerlake.plans import facts
from ledgerlake.sources.events import parse_events, to_envelope


def topic(spark, documents):
    rows = [(bytearray((d if isinstance(d, str) else json.dumps(d)).encode()),) for d in documents]
    return spark.createDataFrame(rows, "value BINARY")


def trans(**fields):
    base = {
        "trans_id": 1, "account_id": 5, "district_id": 9, "client_id": 7, "disp_id": 3, "date": "2025-02-03",
        "type": "VYDAJ", "operation": "VYBER", "amount": 10.5, "balance": 1.0, "k_symbol": "", "bank": "AB",
        "account": "1", "ingest_ts": "2025-02-03T04:05:06Z",
    }
    return base | fields


def accounts(spark):
    rows = [(5, 50, True), (5, 49, False), (6, 60, False)]
    return spark.createDataFrame(rows, "account_id BIGINT, district_id BIGINT, is_current BOOLEAN")


def test_malformed_and_mistyped(spark):
    rows = parse_events(topic(spark, ["{oops", "", trans(amount="much"), trans(extra=1)]), "trans").collect()
    assert rows[0].trans_id is None and rows[1].trans_id is None
    assert rows[2].trans_id == 1 and rows[2].amount is None and rows[2].operation == "VYBER"
    assert rows[3].amount == 10.5


def test_named_columns_only(spark):
    assert parse_events(topic(spark, [trans()]), "trans", "trans_id", "amount").columns == ["trans_id", "amount"]


def test_document_is_decoded_once(spark):
    silver = facts.silver_fact(topic(spark, [trans()]), "trans", 1)
    plan = silver._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_validity_by_kind(spark):
    documents = [trans(trans_id=n, amount=a) for n, a in enumerate([5.0, 0.0, -5.0, None], 1)]
    documents.append(trans(trans_id=None))
    kept = facts.silver_fact(topic(spark, documents), "trans", 0).collect()
    assert sorted(r.trans_id for r in kept) == [1, 3]
    orders = [{"order_id": n, "amount": a} for n, a in enumerate([5.0, 0.0, -5.0, None], 1)]
    assert [r.order_id for r in facts.silver_fact(topic(spark, orders), "order", 0).collect()] == [1]


def test_typing_and_enrichment(spark):
    events = [trans(), trans(trans_id=2, account_id=6), trans(trans_id=3, account_id=None, date="soon", ingest_ts="x")]
    silver, gold = facts.fact_batch(topic(spark, events), accounts(spark), "trans", 4)
    rows = {r.trans_id: r for r in gold.collect()}
    assert rows[1].trans_date == dt.date(2025, 2, 3) and rows[1].ingest_ts == dt.datetime(2025, 2, 3, 4, 5, 6)
    assert [rows[n].account_dim_district_id for n in (1, 2, 3)] == [50, None, None]
    assert rows[3].trans_date is None and rows[3].ingest_ts is None and rows[3].batch_id == 4
    assert silver.count() == gold.count() == 3


def test_envelope_round_trip(spark):
    sent = spark.createDataFrame([(1, 2.5)], "order_id BIGINT, amount DOUBLE")
    assert parse_events(to_envelope(sent), "order", "order_id", "amount").collect() == sent.collect()
