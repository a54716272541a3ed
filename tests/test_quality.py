import pytest
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.plans import dimensions


def day():
    return F.lit("2025-01-01").cast("date")


def frame(spark, name, rows):
    return spark.createDataFrame(rows, schemas.BRONZE[name])


ACCOUNTS = [
    ("1", "10", "MONTHLY", "930101"),
    ("x2", "10", "MONTHLY", "930101"),
    (None, "10", "MONTHLY", "930101"),
    ("4", "", "MONTHLY", "930101"),
    ("5", "10", "", "930101"),
    ("6", "10", None, "930101"),
    ("7", "10", "WEEKLY", ""),
    ("8", "10", "WEEKLY", None),
    ("9", "10", "WEEKLY", "259931"),
]


def test_every_row_is_accepted_or_rejected(spark):
    parts = dimensions.split("account", frame(spark, "account", ACCOUNTS), day())
    assert {r.account_id for r in parts.accepted.collect()} == {"1", "7", "8", "9"}
    assert [r.account_id for r in parts.rejected.orderBy("account_id").collect()] == [None, "4", "5", "6", "x2"]
    assert parts.accepted.count() + parts.rejected.count() == len(ACCOUNTS)


def test_missing_date_warns_but_is_accepted(spark):
    parts = dimensions.split("account", frame(spark, "account", ACCOUNTS), day())
    assert {r.account_id for r in parts.warned.collect()} == {"7", "8"}
    opened = {r.account_id: r.open_date for r in dimensions.silver("account", parts.accepted).collect()}
    assert opened[7] is None and opened[9] is None and str(opened[1]) == "2093-01-01"


def test_strict_rejects_missing_date(spark):
    parts = dimensions.split("account", frame(spark, "account", ACCOUNTS), day(), strict=True)
    assert {r.account_id for r in parts.accepted.collect()} == {"1", "9"}
    assert parts.warned.count() == 0


def test_unknown_parent_rejects(spark):
    clients = frame(spark, "client", [("1", "b", "10"), ("2", "b", "11"), ("3", "b", None), ("4", None, "10")])
    districts = spark.createDataFrame([(10,), (10,)], "district_id BIGINT")
    parts = dimensions.split("client", clients, day(), {"district": districts})
    assert [r.client_id for r in parts.accepted.collect()] == ["1"]
    assert parts.rejected.count() == 3


def test_lenient_numbers(spark):
    row = ["1", "Name", "Region", "12", "?", "7.9", "", None, "-3", "100.5", "1e2", "?", "0.43", "5", "?", "99999999999"]
    typed = dimensions.silver("district", frame(spark, "district", [tuple(row)])).first()
    assert (typed.A4, typed.A5, typed.A6, typed.A7, typed.A8, typed.A9) == (12, None, 7, None, None, -3)
    assert (typed.A10, typed.A12, typed.A13, typed.A15, typed.A16) == (100.5, None, 0.43, None, None)


@pytest.mark.parametrize("kind,ok", [("OWNER", 1), ("DISPONENT", 1), ("DISPOSER", 0), (None, 0), ("", 0)])
def test_disposition_domain(spark, kind, ok):
    parts = dimensions.split("disp", frame(spark, "disp", [("1", "2", "3", kind)]), day())
    assert (parts.accepted.count(), parts.rejected.count()) == (ok, 1 - ok)


def test_load_order():
    order = dimensions.load_order()
    assert order[0] == "district" and order[-2:] == ["disp", "card"]
    assert set(order[1:3]) == {"client", "account"}
