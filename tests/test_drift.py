"""Fields that silver has no column for."""

import json

from ledgerlake.plans import facts
from ledgerlake.streaming import fact_stream as fs
from ledgerlake.streaming.runner import wait_all
from ledgerlake.sources.events import event_stream
from tests.test_events import accounts, topic, trans
from tests.test_streaming import publish


def kept(spark, documents):
    rows = facts.drifted_fields(topic(spark, documents), "trans").selectExpr("event_id", "field", "known", "to_json(value) AS value")
    return sorted((r.event_id, r.field, r.known, r.value) for r in rows.collect())


def test_unknown_and_mistyped_fields(spark):
    nested = {"to": ["a", {"b": 1.5}]}
    assert kept(spark, [
        trans(),
        trans(trans_id=2, channel="app", route=nested, note=None),
        trans(trans_id=3, account_id="none", balance={"x": 1}, bank=None),
        trans(trans_id=4, amount=0, channel="rejected"),
        trans(trans_id=None, channel="rejected"),
        '{"trans_id":5,"amount":1,"channel":1,"channel":"last"}',
        "{broken", "", "[1]", "{}",
    ]) == [
        (2, "channel", False, '"app"'),
        (2, "route", False, json.dumps(nested, separators=(",", ":"))),
        (3, "account_id", True, '"none"'),
        (3, "balance", True, '{"x":1}'),
        (5, "channel", False, '"last"'),
    ]


def test_a_field_is_typed_later(spark, tmp_path):
    """A stream keeps what it does not know; a replay leaves one copy; the field becomes a column afterwards, rows and values else unchanged."""
    base = str(tmp_path)

    def catch_up(checkpoint):
        wait_all([
            fs.start_fact_stream(
                event_stream(spark, "trans", path=base), "trans", lambda session: accounts(session), f"{base}/silver", f"{base}/gold",
                f"{base}/{checkpoint}", drift_path=f"{base}/drift", until_caught_up=True,
            )
        ])

    sent = [trans(), trans(trans_id=2, fee={"cents": 120}), trans(trans_id=3, fee={"cents": "much"}), trans(trans_id=2, fee={"cents": 120})]
    publish(spark, base, sent)
    for checkpoint in ("a", "b"):  # the second replays batch 0
        catch_up(checkpoint)
    silver = fs.read_facts(spark, f"{base}/silver", "trans", "silver")
    drift = fs.read_drift(spark, f"{base}/drift")
    assert drift.count() == 3
    wide = facts.with_drifted(silver, drift, "trans", "fee", "BIGINT", "$.cents")
    assert wide.columns == [*silver.columns, "fee"]
    assert sorted((r.trans_id, r.fee) for r in wide.collect() if r.fee is not None) == [(2, 120), (2, 120)]
    assert sorted(map(str, wide.drop("fee").collect())) == sorted(map(str, silver.collect()))
