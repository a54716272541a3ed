import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerlake.operators import scd2
from ledgerlake.plans import dimensions

FAR = dt.datetime(9999, 12, 31, 23, 59, 59)
SCHEMA = "client_id BIGINT, birth_number STRING, district_id BIGINT"


def at(n: int):
    return F.lit(f"2025-01-0{n} 00:00:00").cast("timestamp")


def snapshot(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def load(dim, snap, n):
    return dimensions.gold("client", dim, snap, at(n))


def state(dim):
    return {(r.client_id, r.scd_version): r for r in dim.collect()}


def run_three(spark):
    one = load(None, snapshot(spark, [(1, "a", 10), (2, "b", 20), (3, "c", None)]), 1)
    two = load(one, snapshot(spark, [(1, "a", 11), (2, "b", 20), (3, "c", 30), (4, "d", 40)]), 2)
    return load(two, snapshot(spark, [(1, "a", 10), (3, "c", None), (4, "d", 40)]), 3)


def test_versions_over_three_loads(spark):
    rows = state(run_three(spark))
    assert set(rows) == {(1, 1), (1, 2), (1, 3), (2, 1), (3, 1), (3, 2), (3, 3), (4, 1)}
    assert [rows[1, v].district_id for v in (1, 2, 3)] == [10, 11, 10]
    assert [rows[1, v].is_current for v in (1, 2, 3)] == [False, False, True]


def test_one_current_row_and_touching_intervals(spark):
    rows = sorted(state(run_three(spark)).values(), key=lambda r: (r.client_id, r.scd_version))
    current = [r.client_id for r in rows if r.is_current]
    assert sorted(current) == [1, 2, 3, 4]
    for a, b in zip(rows, rows[1:]):
        if a.client_id == b.client_id:
            assert a.effective_to == b.effective_from
    assert all(r.effective_to == FAR for r in rows if r.is_current)


def test_missing_key_stays_current(spark):
    row = state(run_three(spark))[2, 1]
    assert row.is_current and row.effective_from == dt.datetime(2025, 1, 1)


def test_same_snapshot_changes_nothing(spark):
    rows = [(1, "a", 10), (2, None, None)]
    one = load(None, snapshot(spark, rows), 1)
    two = load(one, snapshot(spark, rows), 2)
    assert state(one) == state(two)


def test_repeated_keys_give_one_row(spark):
    one = load(None, snapshot(spark, [(1, "a", 10), (1, "b", 5), (1, "a", 10), (None, "z", 1)]), 1)
    assert [(r.client_id, r.birth_number) for r in one.collect()] == [(1, "b")]


def test_step_leaves_closed_history_alone(spark):
    dim = run_three(spark)
    step = scd2.scd2_step(
        scd2.current_rows(dim), snapshot(spark, [(4, "d", 41)]), "client_id", ["birth_number", "district_id"], at(4)
    )
    assert [(r.client_id, r.scd_version) for r in step.closed.collect()] == [(4, 1)]
    assert step.current.count() == 4


ROWS = st.dictionaries(st.integers(1, 6), st.one_of(st.none(), st.integers(0, 2)), max_size=6)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(loads=st.lists(ROWS, min_size=2, max_size=3))
def test_agrees_with_replay(spark, loads):
    dim, expected = None, {}
    for n, rows in enumerate(loads, 1):
        dim = load(dim, snapshot(spark, [(k, "x", v) for k, v in rows.items()]), n)
        for k, v in rows.items():
            versions = expected.setdefault(k, [])
            if not versions or versions[-1] != v:
                versions.append(v)
    found = {}
    for (k, _), r in sorted(state(dim).items()):
        found.setdefault(k, []).append(r.district_id)
        assert r.is_current == (len(found[k]) == len(expected[k]))
    assert found == {k: v for k, v in expected.items()}
