"""A third of the rows on one key: results stay whole and the work is split or reduced first."""

import re

from pyspark.sql import functions as F

from ledgerlake.operators import combine, integrity, windows


def hot(spark, n=300_000):
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).cast("bigint")
    return spark.range(n, numPartitions=8).select(
        "id", key.alias("account_id"), F.sha2(F.col("id").cast("string"), 256).alias("payload")
    )


def dim(spark):
    return spark.range(1000).select(F.col("id").alias("account_id"), (F.col("id") * 2).alias("district_id"))


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_lookup_splits_the_hot_key(spark, conf):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        adaptive__advisoryPartitionSizeInBytes="100KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )
    joined = combine.lookup(hot(spark), dim(spark), "account_id", d="district_id")
    rows = joined.collect()
    assert len(rows) == 300_000 and all(r.d == 2 * r.account_id for r in rows)
    assert "skew=true" in final_plan(joined)


def test_small_lookup_is_broadcast_without_a_hint(spark):
    joined = combine.lookup(hot(spark), dim(spark), "account_id", d="district_id")
    plan = joined._jdf.queryExecution()
    assert "BroadcastHashJoin" in plan.executedPlan().toString()
    assert "ResolvedHint" not in plan.analyzed().toString()


def before_first_exchange(df) -> str:
    """The part of the plan that runs before the first shuffle of the leftmost input."""
    lines = final_plan(df).split("== Initial Plan ==")[0].split("\n")
    at = [i for i, line in enumerate(lines) if re.search(r"\bExchange hashpartitioning", line)]
    return "\n".join(lines[at[0] + 1:at[0] + 4])


def test_latest_keeps_one_row_per_key_before_the_shuffle(spark):
    found = windows.latest(hot(spark), "account_id", "id")
    assert "partial_max" in before_first_exchange(found)
    top = {r.account_id: r.id for r in found.collect()}
    assert top[0] == 299_997 and len(top) == 1000


def test_top_per_key_drops_rows_before_the_shuffle(spark):
    found = windows.top_per_key(hot(spark), "account_id", 2, "id")
    before = before_first_exchange(found)
    assert "WindowGroupLimit" in before and "Partial" in before
    rows = [r.id for r in found.where("account_id = 0").collect()]
    assert sorted(rows) == [299_994, 299_997]


def test_fk_check_counts_before_the_shuffle(spark, conf):
    conf(autoBroadcastJoinThreshold="-1")
    child = hot(spark)
    check = integrity.fk_check("x", child, dim(spark).where("account_id > 0"), F.col("account_id"), F.col("account_id"))
    assert "partial_count" in before_first_exchange(check)
    assert check.first().bad_fk == child.where("account_id = 0").count()


def test_null_keys_have_no_parent(spark):
    child = spark.createDataFrame([(1,), (None,), (None,), (5,)], "account_id BIGINT")
    check = integrity.fk_check("x", child, dim(spark), F.col("account_id"), F.col("account_id"))
    assert check.first().bad_fk == 2


def test_fact_fk_reports_zero_for_clean_and_empty_facts(spark):
    fact = spark.createDataFrame([(1, None)], "account_id BIGINT, client_id BIGINT")
    clients = dim(spark).select(F.col("account_id").alias("client_id"))
    parents = {"account": (dim(spark), "account_id"), "client": (clients, "client_id")}
    found = {r.check_name: r.bad_fk for r in integrity.fact_fk("f", fact, parents).collect()}
    assert found == {"f_account": 0, "f_client": 1}
    empty = {r.check_name: r.bad_fk for r in integrity.fact_fk("f", fact.where("false"), parents).collect()}
    assert empty == {"f_account": 0, "f_client": 0}


def test_rolling_frames_differ_on_gaps(spark):
    rows = [("r", "2025-01-01", 1), ("r", "2025-01-02", 2), ("r", "2025-03-01", 4)]
    days = spark.createDataFrame(rows, "region STRING, d STRING, v INT").withColumn("d", F.col("d").cast("date"))
    by_day = [r.s for r in windows.rolling_days(days, "region", "d", "v", 30, "s").orderBy("d").collect()]
    by_row = [r.s for r in windows.rolling_rows(days, "region", "d", "v", 30, "s").orderBy("d").collect()]
    assert by_day == [1, 3, 4] and by_row == [1, 3, 7]
