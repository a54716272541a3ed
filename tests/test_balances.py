"""Running totals from stored sums against totals by definition, whatever the order of batches, replays and folds."""

import datetime as dt
import random
import shutil
from collections import Counter

import pytest

from ledgerlake.sources.tables import FrameGold
from ledgerlake.streaming import balances

COLUMNS = "account_id BIGINT, trans_date DATE, trans_id BIGINT, amount DOUBLE"


def key(row):
    account, day, id, amount = row
    return (account is not None, account or 0), (day is not None, day or dt.date.min), id, amount


def wanted(rows):
    out, sums = Counter(), {}
    for row in sorted(rows, key=key):
        sums[row[0]] = round(sums.get(row[0], 0) + (row[3] or 0), 2)
        out[*row, sums[row[0]]] += 1
    return out


def some(n, seed):
    rng = random.Random(seed)
    days = [dt.date(2024, 1, 1) + dt.timedelta(d) for d in range(0, 200, 7)] + [None]
    return [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice(days), i, rng.randrange(-5000, 5000) / 100) for i in range(n)]


class Lake:
    def __init__(self, spark, base):
        self.spark, self.log, self.table, self.rows = spark, f"{base}/log", f"{base}/table", []

    def frame(self, rows):
        return self.spark.createDataFrame(rows, COLUMNS)

    def write(self, rows, stream, batch):
        balances.write_part(balances.sums(self.frame(rows)), self.log, stream, batch)

    def fold(self):
        return balances.fold(self.spark, self.log, self.table)

    def totals(self, rows, first=None, last=None):
        found = balances.account_running_total(FrameGold({"fact_trans": self.frame(rows)}), self.spark, self.log, self.table, first, last, block=5)
        return Counter((r.account_id, r.trans_date, r.trans_id, r.amount, float(r.running)) for r in found.collect())


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


@pytest.mark.parametrize("seed", range(2))
def test_any_order_of_batches(lake, seed):
    rng = random.Random(seed)
    rows = some(160, seed)
    batches = [rows[i::5] for i in range(5)]
    order = rng.sample(range(5), 5)
    for step, b in enumerate(order):
        for _ in range(rng.choice([1, 2])):  # replayed at times
            lake.write(batches[b], f"s{b % 2}", step)
        if rng.random() < 0.5:
            lake.fold()
    assert lake.totals(rows) == wanted(rows)
    lake.fold()
    assert lake.fold() == []
    assert lake.totals(rows) == wanted(rows)
    within = Counter({r: n for r, n in wanted(rows).items() if r[1] is not None and "2024-03" <= r[1].isoformat()[:7] <= "2024-05"})
    assert within and lake.totals(rows, "2024-03", "2024-05") == within


def test_a_late_event_rewrites_its_month_alone(lake, tmp_path):
    rows = some(120, 10)
    lake.write(rows, "main", 0)
    first = lake.fold()
    assert first[0] == balances.NO_DAY and len(first) == 8
    before = balances.state(lake.spark, lake.table)
    late = [(1, dt.date(2024, 2, 3), 900, 12.34)]
    lake.write(late, "main", 1)
    # Neither the parts folded nor the days of another month are there to be read.
    shutil.rmtree(tmp_path / "log" / "stream_id=main" / "batch_id=0")
    for month in first:
        if month != "2024-02":
            (tmp_path / "table" / "days" / "version=1" / f"month={month}").rename(tmp_path / f"away-{month}")
    assert lake.fold() == ["2024-02"]
    after = balances.state(lake.spark, lake.table)
    assert after.months == before.months | {"2024-02": 2} and after.marks == {"main": 1}
    for month in first:
        if month != "2024-02":
            (tmp_path / f"away-{month}").rename(tmp_path / "table" / "days" / "version=1" / f"month={month}")
    assert lake.totals(rows + late) == wanted(rows + late)


def test_a_month_reads_no_days_of_others(lake, tmp_path):
    rows = some(120, 4)
    lake.write(rows, "main", 0)
    for month in lake.fold():
        if month != "2024-06":
            shutil.rmtree(tmp_path / "table" / "days" / "version=1" / f"month={month}")
    june = Counter({r: n for r, n in wanted(rows).items() if r[1] is not None and r[1].isoformat()[:7] == "2024-06"})
    assert june and lake.totals(rows, "2024-06", "2024-06") == june


def test_corrections(lake):
    """Amounts change, rows move to other days and accounts, one to a day and amount that add nothing."""
    rows = some(60, 5)
    lake.write(rows, "main", 0)
    lake.fold()
    fixed = [(a, d, i, x * 2) if i % 3 else (2, dt.date(2024, 12, 24), i, 0.0) for a, d, i, x in rows[:20]]
    balances.write_part(balances.difference(lake.frame(rows[:20]), lake.frame(fixed)), lake.log, "corrections", 0)
    assert lake.totals(fixed + rows[20:]) == wanted(fixed + rows[20:])
    lake.fold()
    assert lake.totals(fixed + rows[20:]) == wanted(fixed + rows[20:])


def test_older_versions_go(lake, tmp_path):
    for batch in range(4):
        lake.write([(1, dt.date(2024, 1, 1 + batch), batch, 1.0)], "main", batch)
        lake.fold()
    left = sorted(p.name for p in (tmp_path / "table" / "days").glob("version=*") if any(p.glob("month=*")))
    assert left == ["version=3", "version=4"]
    assert sorted(p.name for p in (tmp_path / "table" / "manifest").iterdir()) == ["version=3", "version=4"]
    rows = [(1, dt.date(2024, 1, 1 + b), b, 1.0) for b in range(4)]
    assert lake.totals(rows) == wanted(rows)


def test_nothing_yet(lake):
    assert lake.fold() == []
    lake.write([], "main", 0)
    assert lake.fold() == []


def test_running_total_deals_rows_by_no_join(spark, tmp_path, conf):
    """Starts come before the rows of a window, so neither rows nor days are dealt again for a join."""
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    lake = Lake(spark, str(tmp_path))
    rows = some(60, 3)
    lake.write(rows, "main", 0)
    lake.fold()
    frame = balances.account_running_total(FrameGold({"fact_trans": lake.frame(rows)}), spark, lake.log, lake.table, block=5)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert Counter((r.account_id, r.trans_date, r.trans_id, r.amount, float(r.running)) for r in frame.collect()) == wanted(rows)
