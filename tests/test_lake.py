from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlake import schemas, sinks
from ledgerlake.functions import parsing
from ledgerlake.plans import dimensions
from ledgerlake.session import scratch
from ledgerlake.sources.delimited import read_delimited
from ledgerlake.sources.tables import FrameGold, StoredGold, read_current_version, read_history, read_table

DISTRICTS = '''A1;A2;A3;A4;A5;A6;A7;A8;A9;A10;A11;A12;A13;A14;A15;A16
1;"First; town";"North";1204;0;0;0;1;1;100.0;12541;0.29;0.43;167;85677;99107
69;"Other";"South";429;0;0;0;1;1;100.0;8110;?;0.54;100;?;300
'''


def test_delimited(spark, tmp_path):
    path = tmp_path / "district.csv"
    path.write_text(DISTRICTS)
    rows = read_delimited(spark, str(path), schemas.BRONZE["district"]).collect()
    assert [r.A2 for r in rows] == ["First; town", "Other"] and rows[1].A12 == "?" and rows[0].A4 == "1204"


def test_kept_quotes_are_stripped_later(spark, tmp_path):
    path = tmp_path / "card.csv"
    path.write_text('card_id;disp_id;type;issued\n1;2;"gold";251107 00:00:00\n')
    raw = read_delimited(spark, str(path), schemas.BRONZE["card"], keep_quotes=True)
    assert raw.first().type == '"gold"'
    assert parsing.strip_quotes(raw).first().type == "gold"


def test_rejects_of_a_date_are_replaced(spark, tmp_path):
    path = str(tmp_path / "dq")
    first, second = date(2025, 1, 1), date(2025, 1, 2)
    for day, ids in ((first, [1, 2]), (second, [3]), (first, [1])):
        rows = spark.createDataFrame([(i,) for i in ids], "id INT").withColumn("dq_date", F.lit(day))
        sinks.append_rejects(rows, path, day)
    stored = spark.read.schema("id INT, dq_date DATE")
    assert sorted((r.id, r.dq_date) for r in stored.parquet(path).collect()) == [(1, first), (3, second)]
    sinks.append_rejects(spark.createDataFrame([], "id INT, dq_date DATE"), path, first)
    assert [r.id for r in stored.parquet(path).collect()] == [3]


def test_versions_switch_only_when_complete(spark, tmp_path):
    base = str(tmp_path / "dim")
    schema = schemas.struct("id BIGINT")
    assert read_current_version(spark, base, schema) is None
    sinks.write_next_version(spark.range(3), base)
    sinks.write_next_version(read_current_version(spark, base, schema).where("id > 0"), base)
    (tmp_path / "dim" / "version=3").mkdir()
    assert read_current_version(spark, base, schema).count() == 2


def test_history_loads(spark, tmp_path):
    base = str(tmp_path / "dim_client")
    schema = schemas.GOLD["dim_client"]
    assert read_history(spark, base, schema) is None
    want = None
    for n, rows in enumerate(([(1, "a", 1), (2, "b", 1)], [(1, "a", 2), (3, "c", 1)], [(1, "a", 1)]), 1):
        at = F.lit(f"2025-01-0{n}").cast("timestamp")
        snapshot = spark.createDataFrame(rows, schemas.SILVER["client"])
        dimensions.advance(spark, base, "client", snapshot, at)
        want = dimensions.gold("client", want, snapshot, at)
    found = read_history(spark, base, schema)
    assert found.exceptAll(want).count() == 0 and want.exceptAll(found).count() == 0
    assert found.count() == 5 and read_history(spark, base, schema, current_only=True).count() == 3
    # A load that never finished is not seen.
    sinks.write_history_load(spark.createDataFrame([], schema), base)
    (tmp_path / "dim_client" / "load=4" / "_SUCCESS").unlink()
    assert read_history(spark, base, schema).count() == 5


def test_export_and_import(spark, tmp_path):
    base = str(tmp_path)
    tables = {"a": spark.range(3), "b": spark.range(5)}
    sinks.export_tables(tables, f"{base}/out")
    loaded = sinks.import_tables(spark, f"{base}/out", f"{base}/in", {n: df.schema for n, df in tables.items()})
    assert {n: df.count() for n, df in loaded.items()} == {"a": 3, "b": 5}


def test_layers(spark, tmp_path):
    wanted = sinks.layer_tables()
    assert len(wanted["bronze"]) == 8 and "dq_client" in wanted["silver"] and "loan_default_scores" in wanted["gold"]
    sinks.ensure_layers(spark)
    sinks.ensure_layers(spark)
    assert spark.table("gold.dim_client").columns[-1] == "scd_version"
    assert read_table(spark, "silver", "dq_district").columns[-2:] == ["dq_date", "dq_reason"]
    for database in wanted:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_gold_sources_prune_columns(spark, tmp_path):
    frame = spark.range(2).withColumn("x", F.lit(1))
    assert FrameGold({"t": frame}).table("t", "x").columns == ["x"]
    facts = spark.createDataFrame([], schemas.GOLD["fact_order"])
    sinks.overwrite(facts, f"{tmp_path}/gold/fact_order")
    stored = StoredGold(spark, str(tmp_path))
    assert stored.table("fact_order", "order_id").columns == ["order_id"]
    assert stored.table("dim_card").count() == 0


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch(spark, "x"), scratch(spark, "x")
    assert first != second and (shared is None or first.startswith(shared))


def test_a_cluster_has_to_name_the_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        scratch(Session(), "x")


def test_padding(spark):
    padded = parsing.pad_to(spark.range(1), schemas.struct("name STRING, id INT"))
    assert padded.dtypes == [("name", "string"), ("id", "int")] and padded.first().name is None
