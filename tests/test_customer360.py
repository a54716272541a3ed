import datetime as dt
import itertools

from ledgerlake.plans import customer360 as C
from ledgerlake.schemas import CUSTOMER_360
from tests.test_events import accounts, topic, trans


def ts(day):
    return dt.datetime(2025, 1, day)


def records(spark, *rows):
    return spark.createDataFrame([tuple(r.get(n) for n in CUSTOMER_360.names) for r in rows], CUSTOMER_360)


LOAN = {"client_id": 1, "birth_number": "b", "account_id": 5, "account_district_id": 50, "account_ts": ts(2),
        "loan_id": 9, "last_loan_amount": 10.0, "last_loan_status": "A", "last_loan_ts": ts(2)}
ORDER_OLD = {"client_id": 1, "account_id": 6, "account_district_id": 60, "account_ts": ts(1), "last_order_id": 3,
             "last_order_amount": 1.0, "last_order_k_symbol": "SIPO", "last_order_ts": ts(1)}
ORDER_NEW = {"client_id": 1, "last_order_id": 4, "last_order_amount": 2.0, "last_order_ts": ts(3)}
STRANGER = {"client_id": None, "last_order_id": 5, "last_order_ts": ts(9)}


def test_null_cells_do_not_overwrite(spark):
    row = C.merge(records(spark, LOAN, ORDER_OLD, ORDER_NEW, STRANGER)).collect()
    assert len(row) == 1
    row = row[0]
    assert (row.last_order_id, row.last_order_amount, row.last_order_k_symbol) == (4, 2.0, "SIPO")
    assert (row.account_id, row.account_district_id, row.last_loan_status) == (5, 50, "A")
    assert row.last_trans_ts is None


def test_merge_order_does_not_matter(spark):
    parts = [LOAN, ORDER_OLD, ORDER_NEW]
    want = C.merge(records(spark, *parts)).collect()
    for a, b, c in itertools.permutations(parts):
        first = C.merge_latest(records(spark, a), records(spark, b))
        assert C.merge_latest(first, records(spark, c)).collect() == want


def test_merging_again_changes_nothing(spark):
    once = C.merge(records(spark, LOAN, ORDER_OLD, ORDER_NEW))
    assert C.merge_latest(once, records(spark, LOAN, ORDER_NEW)).collect() == once.collect()


def test_same_second_goes_to_the_greater_id(spark):
    events = C.activity(topic(spark, [trans(trans_id=n, amount=float(n)) for n in (2, 3, 1)]), "trans")
    assert [r.trans_id for r in C.latest_activity(events, "trans").collect()] == [3]


def test_unknown_client_and_missing_client(spark):
    clients = spark.createDataFrame([], "client_id BIGINT, birth_number STRING, district_id BIGINT, is_current BOOLEAN")
    events = C.activity(topic(spark, [trans(client_id=77), trans(trans_id=2, client_id=None)]), "trans")
    rows = C.shape(events, "trans", clients, accounts(spark)).collect()
    assert [(r.client_id, r.birth_number, r.account_id) for r in rows] == [(77, None, 5)]


def test_scores_are_optional(spark):
    loans = [{"loan_id": 1, "client_id": 7, "account_id": 5, "amount": 3.0, "status": "B",
              "ingest_ts": "2025-02-03T04:05:06Z"}]
    clients = spark.createDataFrame(
        [(7, "b", 70, True)], "client_id BIGINT, birth_number STRING, district_id BIGINT, is_current BOOLEAN")
    events = C.activity(topic(spark, loans), "loan")
    assert C.shape(events, "loan", clients, accounts(spark)).first().last_default_pred_status is None
    scores = spark.createDataFrame([(7, "A", ts(1))], "client_id BIGINT, pred_status STRING, score_timestamp TIMESTAMP")
    assert C.shape(events, "loan", clients, accounts(spark), scores).first().last_default_pred_status == "A"


def test_a_move_to_a_smaller_district(spark):
    """The newer value counts, not the greater one, in whatever order records are merged."""
    old = {"client_id": 1, "birth_number": "z", "client_district_id": 9, "client_ts": ts(1), "last_order_id": 1, "last_order_ts": ts(1)}
    new = {"client_id": 1, "birth_number": "a", "client_district_id": 3, "client_ts": ts(2), "last_trans_id": 1, "last_trans_ts": ts(2)}
    for parts in itertools.permutations([old, new]):
        row = C.merge(records(spark, *parts)).first()
        assert (row.birth_number, row.client_district_id, row.client_ts) == ("a", 3, ts(2))
        row = C.merge_latest(C.merge(records(spark, parts[0])), records(spark, parts[1])).first()
        assert (row.birth_number, row.client_district_id) == ("a", 3)


def test_lookup(spark):
    table = C.merge(records(spark, LOAN))
    assert C.point_lookup(table, 1).count() == 1 and C.point_lookup(table, 2).count() == 0
