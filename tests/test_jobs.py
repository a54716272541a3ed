"""A small bank from delivered files and events to marts, checks, scores and a copy elsewhere."""

import json

import pytest

from ledgerlake import jobs
from ledgerlake.operators import integrity, quality
from ledgerlake.sources.tables import StoredGold, read_table, stored_parts
from tests.test_events import topic, trans

FILES = {
    "district": "A1;A2;A3;A4;A5;A6;A7;A8;A9;A10;A11;A12;A13;A14;A15;A16\n"
    + "".join(f'{n};"Town {n}";"North";1;2;3;4;5;6;7.5;8;?;1.5;9;?;10\n' for n in (1, 2)),
    "client": 'client_id;birth_number;district_id\n1;"700101";1\n2;"800101";2\n3;"";2\nx;"900101";1\n4;"1";77\n9;"900101"\n99999999999999999999;"a;b";2\n',
    "account": 'account_id;district_id;frequency;created_date\n10;1;"MONTHLY";930101\n11;2;"WEEKLY";\n12;2;"";930101\n',
    "disp": 'disp_id;client_id;account_id;type\n100;1;10;"OWNER"\n101;2;11;"DISPONENT"\n102;2;11;"DISPOSER"\n',
    "card": 'card_id;disp_id;type;issued\n1000;100;"gold";931107 00:00:00\n1001;;"gold";931107 00:00:00\n',
}


def loan(n):
    return {"loan_id": n, "account_id": 10 + n % 2, "district_id": 1 + n % 2, "client_id": 1 + n % 2,
            "disp_id": 100 + n % 2, "date": "2025-01-05", "amount": 1000.0 * n, "duration": 12 * n,
            "payments": 80.0, "status": "AB"[n % 2], "ingest_ts": f"2025-01-05T00:00:{n:02d}Z"}


def order(n):
    return {"order_id": n, "account_id": 10, "client_id": 1, "amount": 5.0 * n, "k_symbol": "SIPO",
            "ingest_ts": f"2025-01-06T00:00:{n:02d}Z"}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    for name, text in FILES.items():
        (base / "landing").mkdir(exist_ok=True)
        (base / "landing" / name).write_text(text)
    events = {
        "loan": [loan(n) for n in range(1, 41)],
        "order": [order(n) for n in range(1, 5)],
        "trans": [trans(trans_id=n, account_id=10, client_id=1, disp_id=100, district_id=1) for n in range(1, 6)],
    }
    for kind, documents in events.items():
        topic(spark, documents + ["{bad"]).write.parquet(f"{base}/events/{kind}")

    def job(*argv):
        return jobs.run(spark, jobs.parse_arguments(["--root", f"{base}/lake", "--output", f"{base}/result", *argv]))

    job("bronze", f"{base}/landing")
    job("dimensions")
    job("stream-facts", "--path", f"{base}/events", "--until-caught-up")
    job("stream-customer360", "--path", f"{base}/events", "--until-caught-up")
    job.base = base
    return job


def test_dimensions(spark, lake):
    root = f"{lake.base}/lake"
    assert read_table(spark, "silver", "client_silver", root).count() == 2
    assert spark.read.parquet(f"{root}/silver/dq_client").count() == 4
    assert read_table(spark, "bronze", "client_bronze", root).count() == 2 + 4
    assert spark.read.parquet(f"{root}/silver/account_silver").count() == 2
    counts = lake("mart", "current_counts").first()
    assert (counts.client_count, counts.account_count) == (2, 2)


def test_lines_of_a_wrong_width_are_kept_apart(spark, lake):
    root = f"{lake.base}/lake"
    assert [r[0] for r in read_table(spark, "bronze", "broken_client", root).collect()] == ['9;"900101"']
    clients = {r.client_id: r for r in read_table(spark, "bronze", "client_bronze", root).collect()}
    long = clients["99999999999999999999"]
    assert "9" not in clients and (long.birth_number, long.district_id) == ("a;b", "2")


def test_warned_rows_are_stored(spark, lake):
    warned = spark.read.parquet(f"{lake.base}/lake/silver/warned_account").collect()
    assert [r.account_id for r in warned] == ["11"]


def test_rejected_events_are_stored(spark, lake):
    for kind in ("loan", "order", "trans"):
        rows = spark.read.parquet(f"{lake.base}/lake/silver/dq_fact_{kind}").collect()
        assert [r.document for r in rows] == ["{bad"]


def test_stored_result_has_all_rows(spark, tmp_path, capsys):
    jobs.deliver(spark.range(250), f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 250
    jobs.deliver(spark.range(150), None)
    assert len(capsys.readouterr().out.split()) == 151


def test_a_long_mart_needs_an_output():
    with pytest.raises(SystemExit):
        jobs.parse_arguments(["--root", "r", "mart", "client_summary"])
    assert jobs.parse_arguments(["--root", "r", "mart", "loans_by_status"]).output is None


def test_reader_options(tmp_path):
    file = tmp_path / "secrets"
    file.write_text("# login\nkafka.sasl.jaas.config=user=x password=y\nmaxOffsetsPerTrigger=5\n")
    args = jobs.parse_arguments(
        ["--root", "r", "stream-facts", "--servers", "s", "--option", "maxOffsetsPerTrigger=9", "--options-file", str(file)]
    )
    assert jobs.read_options(args.option, args.options_file) == {
        "kafka.sasl.jaas.config": "user=x password=y", "maxOffsetsPerTrigger": "9",
    }


def test_options_reach_the_reader(spark, lake, monkeypatch):
    seen = {}

    def stream(session, topic, **options):
        seen.update(options)
        raise InterruptedError

    monkeypatch.setattr(jobs, "event_stream", stream)
    with pytest.raises(InterruptedError):
        lake("stream-facts", "--path", "p", "--option", "maxFilesPerTrigger=3")
    assert seen["maxFilesPerTrigger"] == "3" and seen["path"] == "p"


def test_dated_mart_reads_by_date(lake):
    plan = lake("mart", "daily_trans")._jdf.queryExecution().executedPlan().toString()
    assert "trans_date" in plan.split("PushedFilters:")[1].split("]")[0]


def test_counts_come_from_footers(spark, lake):
    session = integrity.footer_session(spark)
    for table in ("fact_trans", "dim_client"):
        [(paths, condition)] = stored_parts(spark, f"{lake.base}/lake/gold/{table}")
        plan = integrity.stored_count(session, paths, condition)._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*)]" in plan


def test_loads_are_measured_while_written(spark, lake):
    flagged = spark.createDataFrame([(1, True, True), (2, True, False), (3, False, False)], "id INT, _ok BOOLEAN, _advised BOOLEAN")
    rows, seen = quality.measured(flagged)
    rows.write.format("noop").mode("overwrite").save()
    assert seen.get == {"accepted": 2, "rejected": 1, "warned": 1}


def test_created_tables_show_what_is_stored(spark, lake):
    lake("create-tables")
    lake("create-tables")
    try:
        assert spark.table("gold.fact_loan").count() == 40
        assert spark.table("gold.dim_client").where("is_current").count() == 2
        assert spark.table("silver.client_silver").count() == 2 and spark.table("silver.dq_client").count() == 4
        assert spark.table("silver.fact_order").count() == 4 and spark.table("bronze.loan_bronze").count() == 0
    finally:
        for database in ("bronze", "silver", "gold"):
            spark.sql(f"DROP DATABASE {database} CASCADE")


def test_compacted_facts_show_the_same(spark, lake):
    before = sorted(map(str, lake("mart", "daily_trans").collect())), sorted(map(str, lake("monthly-by-branch").collect()))
    counted = {r.check_name: r.value for r in lake("checks").collect()}
    trans = StoredGold(spark, f"{lake.base}/lake").table("fact_trans").count()
    lake("compact-facts", "--all-batches")
    lake("create-tables")
    try:
        assert spark.table("gold.fact_loan").count() == 40 and spark.table("gold.fact_trans").count() == trans
    finally:
        for database in ("bronze", "silver", "gold"):
            spark.sql(f"DROP DATABASE {database} CASCADE")
    assert before == (sorted(map(str, lake("mart", "daily_trans").collect())), sorted(map(str, lake("monthly-by-branch").collect())))
    assert counted == {r.check_name: r.value for r in lake("checks").collect()}


def test_running_totals_come_from_stored_balances(lake):
    rows = [r for r in lake("running-totals").collect()]
    wanted, total = {}, {}
    for r in sorted(rows, key=lambda r: (r.account_id, r.trans_date, r.trans_id)):
        total[r.account_id] = total.get(r.account_id, 0) + r.amount
        wanted[r.account_id, r.trans_date, r.trans_id] = round(total[r.account_id], 2)
    assert rows and {(r.account_id, r.trans_date, r.trans_id): r.running for r in rows} == wanted
    month = max(r.trans_date for r in rows).isoformat()[:7]
    newest = lake("running-totals", "--first", month, "--last", month).collect()
    assert sorted(newest) == sorted(r for r in rows if r.trans_date.isoformat()[:7] == month)


def test_marts(lake):
    summary = {r.client_id: r for r in lake("mart", "client_summary").collect()}
    assert (summary[1].loan_count, summary[1].order_count, summary[1].trans_count) == (20, 4, 5)
    assert summary[2].loan_count == 20 and summary[2].account_count == 1
    for name in jobs.MARTS:
        assert lake("mart", name).columns


def test_checks(lake):
    found = {r.check_name: r.value for r in lake("checks").collect()}
    assert found["rows:gold.fact_loan"] == 40 and found["rows:silver.dq_account"] == 1
    assert found["bronze_fk:client_district"] == 1 and found["bronze_fk:card_disp"] == 1
    assert found["silver_pk_rows:district"] == found["silver_pk_distinct:district"] == 2
    assert found["eligible_accounts"] == 1
    assert len(found) == 19 + 5 + 1 + 2 + 5 + 5 + 9
    assert all(v == 0 for k, v in found.items() if k.startswith(("silver_fk", "gold_fk:client", "gold_fk:fact_loan")))
    assert found["gold_fk:fact_order_disp"] == 4


def test_customer_lookup_before_and_after_compaction(lake):
    before = lake("find-client", "1").first()
    assert before.last_loan_amount == 40000.0 and before.last_order_id == 4 and before.birth_number == "700101"
    lake("compact-customer360")
    assert lake("find-client", "1").first() == before
    assert lake("find-client", "99").first() is None


def test_train_score_and_accuracy(spark, lake):
    model = f"{lake.base}/model"
    assert lake("train", model, "--max-runs", "1").count() == 1
    for _ in range(2):
        lake("score", model, "run_1")
    scores = jobs.stored_scores(spark, f"{lake.base}/lake")
    assert scores.count() == 40 and set(json.loads(scores.first().probabilities_json)) == {"A", "B"}
    newest = read_table(spark, "gold", "latest_scores", f"{lake.base}/lake")
    assert {(r.client_id, r.loan_id) for r in newest.collect()} == {(1, 40), (2, 39)}


def test_a_loan_batch_does_not_read_all_loans(spark, lake, monkeypatch):
    """The reference of the loan stream comes from the table of newest scores."""
    seen = []

    def start(events, kind, load_reference, *rest, **options):
        ref = load_reference(spark)
        if kind == "loan":
            seen.append(ref.scores._jdf.queryExecution().toString())
        else:
            assert ref.scores is None

    monkeypatch.setattr(jobs.customer360_stream, "start_customer360_stream", start)
    jobs.stream_customer360(spark, f"{lake.base}/lake", lambda kind: None)
    assert "latest_scores" in seen[0] and "fact_loan" not in seen[0] and "loan_default_scores" not in seen[0]


def test_export_and_import(lake):
    lake("export", f"{lake.base}/out")
    counts = {r.table_name: r.row_count for r in lake("import", f"{lake.base}/out", f"{lake.base}/in").collect()}
    assert counts["fact_loan"] == 40 and counts["dim_client"] == 2 and len(counts) == 8


def test_second_load_changes_one_client(spark, lake):
    text = FILES["client"].replace('1;"700101";1', '1;"700101";2')
    landing = lake.base / "landing2"
    landing.mkdir()
    for name, body in FILES.items():
        (landing / name).write_text(text if name == "client" else body)
    lake("bronze", str(landing))
    lake("dimensions", "--only", "client")
    rows = jobs.StoredGold(spark, f"{lake.base}/lake").table("dim_client").orderBy("client_id", "scd_version").collect()
    assert [(r.client_id, r.scd_version, r.is_current) for r in rows] == [(1, 1, False), (1, 2, True), (2, 1, True)]
