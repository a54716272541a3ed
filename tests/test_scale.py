"""Sample tables and checks on them read and exchange each large table as often as the job needs, whatever its size."""

import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ledgerlake import sinks
from ledgerlake.checks import fixtures, queries
from ledgerlake.checks.star import Star
from ledgerlake.plans import validation
from ledgerlake.sources.colocated import ColocatedGold, colocate
from ledgerlake.sources.tables import FrameGold
from ledgerlake.streaming import fact_stream

SF = "/root/testdata/sf0.001"


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_in_many_splits_are_not_dealt_again(spark, tmp_path):
    rows = spark.range(1000).withColumn("v", F.col("id") % 3)
    rows.coalesce(1).write.parquet(f"{tmp_path}/one")
    rows.repartition(2 * spark.sparkContext.defaultParallelism).write.parquet(f"{tmp_path}/many")
    one, many = spark.read.parquet(f"{tmp_path}/one"), spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/many")
    assert "RoundRobin" in executed(fixtures.spread(one))
    spark.conf.set("spark.sql.files.openCostInBytes", "1GB")
    try:
        assert "RoundRobin" not in executed(fixtures.spread(many))
        assert sorted(fixtures.spread(many).collect()) == sorted(rows.collect())
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_halves_of_the_events_are_all_events(spark):
    star = Star(spark, SF)
    for kind in ("loan", "order", "trans"):
        both = fixtures.envelopes(star, kind, 0).unionByName(fixtures.envelopes(star, kind, 1))
        whole = fixtures.envelopes(star, kind)
        assert both.exceptAll(whole).isEmpty() and whole.exceptAll(both).isEmpty()


def joins_above(df, table: str) -> int:
    """Joins over the scan of ``table``."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(lines) if line.strip(" :+-").startswith("Relation") and table in line)
    depth, found = len(re.match(r"[\s:+|-]*", lines[at])[0]), 0
    for line in reversed(lines[:at]):
        here = len(re.match(r"[\s:+|-]*", line)[0])
        if here < depth and line.strip():
            depth, found = here, found + ("Join" in line)
    return found


def test_items_are_joined_once_for_client_and_district(spark):
    trans = Star(spark, SF).table("fact_trans", "trans_id", "client_id", "district_id")
    assert joins_above(trans, "l_orderkey") == 1


def test_pairs_are_found_once_for_both_versions(spark):
    star = Star(spark, SF)
    for name, rows, key in (("dim_disp", star.disps(), "disp_id"), ("dim_card", star.cards(), "card_id")):
        found, wanted = star.table(name), star._history(rows, key)
        assert executed(found).split("== Initial Plan ==")[-1].count("l_suppkey#") <= executed(wanted).split("== Initial Plan ==")[-1].count("l_suppkey#") / 2
        assert found.columns == wanted.columns and found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


def test_colocated_facts_share_one_pass_over_parents(spark, tmp_path, conf):
    conf(autoBroadcastJoinThreshold="-1")
    star = Star(spark, SF)
    names = ["fact_loan", "fact_order", "fact_trans", "dim_client", "dim_account", "dim_disp"]
    spark.sql(f"CREATE DATABASE co_once LOCATION '{tmp_path}/co_once'")
    colocate(spark, FrameGold({n: star.table(n) for n in names}), "co_once", 8, names)
    gold = ColocatedGold(spark, "co_once")
    found = validation.gold_fact_fk(gold)
    assert len(re.findall(r"Scan parquet spark_catalog\.co_once\.dim_disp\b", executed(found))) == 1
    assert sorted(found.collect()) == sorted(validation.gold_fact_fk(star).collect())
    # Without heavy clients nothing is read for them.
    assert gold.parts("fact_trans")[1].isEmpty() and gold.table("fact_trans").count() == star.table("fact_trans").count()


def test_a_batch_reads_its_own_folder(spark, monkeypatch):
    plans, write = [], fact_stream.write_gold_batch

    def seen(rows, *args):
        plans.append(executed(rows))
        write(rows, *args)

    monkeypatch.setattr(fact_stream, "write_gold_batch", seen)
    queries.REGISTRY["fact_compacted_trans"](spark, SF)
    assert len(plans) == 9 and all(re.search(r"PartitionFilters: \[isnotnull\(own#\d+L?\), \(own#\d+L? = \d\)\]", p) for p in plans)


def test_exported_tables_are_stored_small(spark, tmp_path):
    sinks.export_tables({"t": spark.range(10)}, str(tmp_path))
    files = list((tmp_path / "t").glob("*.parquet"))
    assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
