import re

from pyspark.sql import functions as F

from ledgerlake.checks.star import Star
from ledgerlake.plans import marts, validation
from ledgerlake.sources.colocated import ColocatedGold, colocate
from ledgerlake.sources.tables import FrameGold

SF = "/root/testdata/sf0.001"
NAMES = ["fact_loan", "fact_order", "fact_trans", "dim_client", "dim_account", "dim_disp"]


def database(spark, tmp_path, gold, buckets, name):
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    colocate(spark, gold, name, buckets, NAMES)
    return ColocatedGold(spark, name)


def skewed(spark):
    """One client with a third of the transactions, and some without a client."""
    star = Star(spark, SF)
    frames = {n: star.table(n) for n in NAMES}
    trans = frames["fact_trans"]
    client = F.when(F.col("trans_id") % 3 == 0, F.lit(7)).when(F.col("trans_id") % 3 == 1, F.lit(None)).otherwise(F.col("client_id"))
    frames["fact_trans"] = trans.withColumn("client_id", client.cast(trans.schema["client_id"].dataType))
    return FrameGold(frames)


def rows(df):
    return sorted(map(str, df.collect()))


def test_heavy_clients_lie_apart(spark, tmp_path):
    """A client in one part only, a file per bucket, all rows kept; results equal those of plain tables."""
    plain = skewed(spark)
    gold = database(spark, tmp_path, plain, 16, "co_heavy")
    usual, heavy = gold.parts("fact_trans", "client_id")
    assert {r[0] for r in heavy.distinct().collect()} == {7, None}
    assert usual.where("client_id IS NULL OR client_id = 7").isEmpty() and not usual.isEmpty()
    assert usual.count() + heavy.count() == plain.table("fact_trans").count()
    assert len(usual.inputFiles()) <= 16
    for mart in (marts.client_summary, marts.profitability, validation.gold_fact_fk):
        assert rows(mart(gold)) == rows(mart(plain))


def test_facts_are_not_exchanged(spark, tmp_path, conf):
    """Above the scan of a bucketed fact stand an aggregate and the join with clients, and no exchange before the sums are complete."""
    gold = database(spark, tmp_path, skewed(spark), 16, "co_plan")
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    for frame in (marts.client_summary(gold), marts.profitability(gold)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.split("\n") if re.search(r"co_plan\.fact_\w+(?<!_heavy)\[", line)]
        assert len(scans) == 3 and all("Bucketed: true" in line for line in scans)
        # A line's depth is where its node stands; its parents are the nearest lines above with less depth.
        lines = plan.split("\n")
        for scan in scans:
            at = lines.index(scan)
            depth = len(re.match(r"[\s:+|-]*", scan)[0])
            above = []
            for line in reversed(lines[:at]):
                here = len(re.match(r"[\s:+|-]*", line)[0])
                if here < depth and line.strip():
                    depth = here
                    above.append(line.strip(" :+-"))
            joined = next(i for i, node in enumerate(above) if "SortMergeJoin" in node)
            assert not any("Exchange" in node for node in above[:joined])
            assert sum("HashAggregate" in node for node in above[:joined]) >= 1


def test_without_rows(spark, tmp_path):
    """Empty tables have no heavy client and give empty results."""
    plain = FrameGold({n: df.limit(0) for n, df in skewed(spark).frames.items()})
    gold = database(spark, tmp_path, plain, 4, "co_empty")
    assert marts.client_summary(gold).count() == 0
    assert {r.bad_fk for r in validation.gold_fact_fk(gold).collect()} == {0}
