"""Values that fit no type, and the order of sorted results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.checks.queries import REGISTRY
from ledgerlake.plans import dimensions, facts, marts
from ledgerlake.schemas import BRONZE, GOLD
from ledgerlake.sources.tables import FrameGold
from tests.test_events import topic, trans

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(dimensions.DIMENSIONS))
def test_keys_too_long_for_a_number_are_rejected(spark, name):
    fine = {"type": "OWNER" if name == "disp" else "gold"}
    rows = []
    for column in [None, *[n for n in BRONZE[name].names if n.endswith("_id") or n == "A1"]]:
        rows.append(tuple("9" * 20 if n == column else fine.get(n, "1") for n in BRONZE[name].names))
    parents = {"district": spark.createDataFrame([(1,)], "district_id BIGINT")}
    parts = dimensions.split(name, spark.createDataFrame(rows, BRONZE[name]), F.lit(dt.date(2025, 1, 1)), parents)
    assert parts.accepted.count() == 1 and parts.rejected.count() == len(rows) - 1
    assert dimensions.silver(name, parts.accepted).where(F.col(dimensions.DIMENSIONS[name].key).isNull()).count() == 0


def test_amounts_that_do_not_fit_are_rejected(spark):
    events = topic(spark, [trans(trans_id=n, amount=a) for n, a in enumerate([1.5, 1e17, -1e17, 0, None, float("nan"), 1e15])] + ["{bad"])
    silver = facts.silver_fact(events, "trans", 0)
    rejected = facts.rejected_events(events, "trans")
    assert sorted(r.trans_id for r in silver.collect()) == [0, 6]
    assert silver.count() + rejected.count() == 8
    assert "{bad" in {r.document for r in rejected.collect()}


def test_one_event_cannot_stop_a_mart(spark):
    rows = [(n, 1, 1, 1, 1, dt.date(2025, 1, 1), a, 12, 1.0, "A", None, 1, 0) for n, a in enumerate([10.0, 1e17, float("nan"), None])]
    gold = FrameGold({"fact_loan": spark.createDataFrame([dict(zip(GOLD["fact_loan"].names, r)) for r in []], GOLD["fact_loan"])})
    gold.frames["fact_loan"] = spark.createDataFrame(
        [tuple({"loan_id": r[0], "loan_date": r[5], "amount": r[6], "duration": r[7], "status": r[9]}.get(n) for n in GOLD["fact_loan"].names) for r in rows],
        GOLD["fact_loan"],
    )
    row = marts.monthly_loans(gold).first()
    assert row.loan_count == 4 and row.total_loan_amount == 10.0


def test_a_loan_without_duration_is_in_the_last_segment(spark):
    loans = spark.createDataFrame([(None, 10.0, "A"), (12, 10.0, "A"), (13, None, "A")], "duration INT, amount DOUBLE, status STRING")
    found = {(r.duration_bucket, r.amount_bucket): r.loan_count for r in marts.loan_segments(FrameGold({"fact_loan": loans})).collect()}
    assert found == {("60m+", "<50k"): 1, ("0-12m", "<50k"): 1, ("13-36m", "300k+"): 1}


ORDERED = {
    "so_multi_key": lambda r: (r.account_id, -r.client_id, r.is_current),
    "bi_s3_daily_trans": lambda r: tuple(-ord(x) for x in r.trans_date),
    "bi_m1_loans_by_district": lambda r: (-r.total_loan_amount, r.region, r.district_name),
    "bi_m2_top_outgoing": lambda r: (-r.outgoing_amount, r.account_id),
    "bi_m3_monthly_loans": lambda r: r.loan_month,
    "bi_m4_orders_by_purpose": lambda r: (-r.total_amount, r.k_symbol),
    "bi_m5_card_penetration": lambda r: (-r.card_penetration_ratio, r.region, r.district_name),
    "bi_c2_rolling_range": lambda r: (r.region, r.trans_date),
    "bi_c3_active_districts": lambda r: (-r.active_loan_clients, r.region, r.district_name),
    "bi_c4_loan_segments": lambda r: (r.duration_bucket, r.amount_bucket, r.status),
    "bi_c5_profitability": lambda r: (-r.profitability_proxy, r.client_id),
    "so_top_k": lambda r: (-r.amount, r.loan_id),
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_rows_come_in_order(spark, name):
    rows = REGISTRY[name](spark, SF).collect()
    assert rows and rows == sorted(rows, key=ORDERED[name])


def test_card_share_counts_without_expanding(spark):
    plan = REGISTRY["bi_m5_card_penetration"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
