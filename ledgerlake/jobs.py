"""The jobs over a lake stored below one root directory, and a command line to run them.

    landing/<table>                delimited text as delivered
    root/bronze/<table>_bronze     text columns, quotes stripped, version by version; broken_<table> lines of a wrong width
    root/silver/<table>_silver     typed rows, version by version
    root/silver/dq_<table>         the rejects by run date; warned_<table> accepted rows that break an advisory rule
    root/gold/dim_<table>          histories, load by load
    root/silver/fact_<kind>        facts by stream and batch; dq_fact_<kind> the rejected events, drift_fact_<kind> fields without a column
    root/gold/fact_<kind>          facts by stream and batch; fact_<kind>_clustered the folded batches, clustered by date
    root/gold/monthly_sums         sums per district and month; monthly_sums_log what each batch adds
    root/gold/balances             sums per account by day and by month; balances_log what each batch adds
    root/gold/customer360          compacted records by bucket; customer360_log the batches since
    root/gold/loan_default_scores  scores by run; latest_scores the newest of each client
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake import schemas, sinks
from ledgerlake.functions.parsing import strip_quotes
from ledgerlake.operators import quality
from ledgerlake.operators.combine import stack
from ledgerlake.operators.integrity import row_counts, stored_counts
from ledgerlake.plans import customer360, dimensions, marts, scoring, validation
from ledgerlake.plans.dimensions import DIMENSIONS
from ledgerlake.plans.network import Network
from ledgerlake.session import tune
from ledgerlake.sources.colocated import ColocatedGold, colocate
from ledgerlake.sources.delimited import BROKEN, read_delimited
from ledgerlake.sources.events import event_stream
from ledgerlake.sources.tables import StoredGold, exists, read_current_version, read_table, stored_parts
from ledgerlake.streaming import balances, compaction, customer360_stream, fact_stream, rollup
from ledgerlake.streaming.runner import wait_all

KINDS = tuple(schemas.EVENTS)


def load_bronze(spark: SparkSession, landing: str, root: str) -> None:
    """Replace the raw dimension tables by the delivered files. Lines of a wrong width are kept apart, whole."""
    for name in DIMENSIONS:
        # Stored first: a line is known to be of a wrong width only while all its values are read.
        delivered = read_delimited(spark, f"{landing}/{name}", schemas.BRONZE[name], broken=True)
        sinks.write_next_version(delivered, f"{root}/bronze/delivered_{name}")
        raw = read_table(spark, "bronze", f"delivered_{name}", root)
        sinks.write_next_version(raw.where(F.col(BROKEN).isNotNull()).select(BROKEN), f"{root}/bronze/broken_{name}")
        fine = raw.where(F.col(BROKEN).isNull()).drop(BROKEN)
        sinks.write_next_version(strip_quotes(fine), f"{root}/bronze/{name}_bronze")


def refresh_dimension(
    spark: SparkSession,
    root: str,
    name: str,
    run_date: date | None = None,
    as_of: Column | None = None,
    strict: bool = False,
) -> dict[str, int]:
    """Bronze to silver, rejects, warnings and the next history load of one dimension.

    Returns how many rows were accepted, rejected and warned of, counted while they were written.
    """
    parents = {p.table: read_table(spark, "silver", f"{p.table}_silver", root) for p in DIMENSIONS[name].rules().parents}
    day = run_date or datetime.now(timezone.utc).date()
    # The rules look at the raw rows and their parents once; the parts are read from the outcome.
    flagged = dimensions.flag(name, read_table(spark, "bronze", f"{name}_bronze", root), parents, strict)
    flagged, outcome = quality.measured(flagged)
    sinks.write_next_version(flagged, f"{root}/silver/flagged_{name}")
    parts = dimensions.parts(name, read_table(spark, "silver", f"flagged_{name}", root), F.lit(day))
    sinks.append_rejects(parts.rejected, f"{root}/silver/dq_{name}", day)
    sinks.append_rejects(parts.warned, f"{root}/silver/warned_{name}", day)
    sinks.write_next_version(dimensions.silver(name, parts.accepted), f"{root}/silver/{name}_silver")
    snapshot = read_current_version(spark, f"{root}/silver/{name}_silver", schemas.SILVER[name])
    dimensions.advance(spark, f"{root}/gold/dim_{name}", name, snapshot, as_of)
    return outcome.get


def refresh_dimensions(
    spark: SparkSession, root: str, run_date: date | None = None, as_of: Column | None = None, strict: bool = False
) -> None:
    for name in dimensions.load_order():
        refresh_dimension(spark, root, name, run_date, as_of, strict)


def stream_facts(spark: SparkSession, root: str, topics: Callable[[str], DataFrame], **options) -> list[StreamingQuery]:
    """Start one fact stream per kind; ``topics`` gives the envelopes of a kind."""

    def accounts(session: SparkSession) -> DataFrame:
        return StoredGold(session, root).table("dim_account", "account_id", "district_id", "is_current")

    return [
        fact_stream.start_fact_stream(
            topics(kind), kind, accounts, f"{root}/silver/fact_{kind}", f"{root}/gold/fact_{kind}",
            f"{root}/checkpoints/fact_{kind}", rejects_path=f"{root}/silver/dq_fact_{kind}", drift_path=f"{root}/silver/drift_fact_{kind}",
            sums_path=f"{root}/gold/monthly_sums_log" if kind == "trans" else None,
            balances_path=f"{root}/gold/balances_log" if kind == "trans" else None, **options,
        )
        for kind in KINDS
    ]


def stream_customer360(
    spark: SparkSession, root: str, topics: Callable[[str], DataFrame], **options
) -> list[StreamingQuery]:
    """Start the three customer-360 streams. Scores are used once there are any, from the table that scoring keeps."""

    def reference(session: SparkSession, kind: str) -> customer360_stream.Reference:
        gold = StoredGold(session, root)
        scores = read_current_version(session, f"{root}/gold/latest_scores", schemas.CLIENT_SCORES) if kind == "loan" else None
        return customer360_stream.Reference(
            gold.table("dim_client", "client_id", "birth_number", "district_id", "is_current"),
            gold.table("dim_account", "account_id", "district_id", "is_current"),
            None if scores is None else scores.drop("loan_id"),
        )

    return [
        customer360_stream.start_customer360_stream(
            topics(kind), kind, partial(reference, kind=kind), f"{root}/gold/customer360_log", f"{root}/checkpoints/customer360_{kind}",
            **options,
        )
        for kind in KINDS
    ]


def compact_facts(spark: SparkSession, root: str, all_batches: bool = False) -> dict[str, int]:
    """Fold the finished batches of the gold facts into segments clustered by date, and the sums by month and account; how many of each kind."""
    rollup.fold(spark, f"{root}/gold/monthly_sums_log", f"{root}/gold/monthly_sums")
    balances.fold(spark, f"{root}/gold/balances_log", f"{root}/gold/balances")
    return {
        kind: compaction.compact_facts(spark, f"{root}/gold/fact_{kind}", kind, all_batches=all_batches) for kind in KINDS
    }


def running_totals(spark: SparkSession, root: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Transactions of some months (as in 2024-05) with their account's running total, from the balances that the stream keeps."""
    log, table = f"{root}/gold/balances_log", f"{root}/gold/balances"
    summed = balances.account_running_total(StoredGold(spark, root), spark, log, table, first, last)
    return summed.withColumn("running", F.col("running").cast("double"))


def monthly_by_branch(spark: SparkSession, root: str) -> DataFrame:
    """Transactions per branch and month from the sums that the stream keeps."""
    log, table = f"{root}/gold/monthly_sums_log", f"{root}/gold/monthly_sums"
    return rollup.monthly_by_branch(StoredGold(spark, root), spark, log, table)


def compact_customer360(spark: SparkSession, root: str) -> str:
    """Merge the batches since the last time into the table, and remove those that two versions hold."""
    log, table = f"{root}/gold/customer360_log", f"{root}/gold/customer360"
    path = customer360_stream.compact(spark, log, table)
    customer360_stream.trim_log(spark, log, table)
    return path


def find_client(spark: SparkSession, root: str, client_id: int) -> DataFrame:
    """The record of one client from the compacted table and the batches since."""
    return customer360_stream.find_client(spark, f"{root}/gold/customer360_log", f"{root}/gold/customer360", client_id)


def stored_scores(spark: SparkSession, root: str) -> DataFrame | None:
    path = f"{root}/gold/loan_default_scores"
    return spark.read.schema(schemas.LOAN_SCORES).parquet(path) if exists(spark, path) else None


def run_checks(spark: SparkSession, root: str) -> DataFrame:
    """(check_name, value) of every count and key check of the lake."""
    gold = StoredGold(spark, root)
    bronze = {n: read_table(spark, "bronze", f"{n}_bronze", root) for n in DIMENSIONS}
    silver = {n: read_table(spark, "silver", f"{n}_silver", root) for n in DIMENSIONS}
    counted = {f"bronze.{n}_bronze": ("bronze", f"{n}_bronze") for n in DIMENSIONS}
    counted |= {f"silver.{n}_silver": ("silver", f"{n}_silver") for n in DIMENSIONS}
    counted["silver.dq_account"] = ("silver", "dq_account")
    counted |= {f"gold.{n}": ("gold", n) for n in schemas.GOLD}
    parts = {name: stored_parts(spark, f"{root}/{layer}/{table}") for name, (layer, table) in counted.items()}
    keys = validation.silver_pk(silver)

    def named(df: DataFrame, prefix: str, name: str, value: str) -> DataFrame:
        return df.select(F.concat(F.lit(prefix), name).alias("check_name"), F.col(value).alias("value"))

    eligible = dimensions.eligible_accounts(bronze["account"]).agg(F.count("*").alias("value"))
    return stack(
        [
            named(stored_counts(spark, parts), "rows:", "table_name", "row_count"),
            named(validation.bronze_fk(bronze), "bronze_fk:", "check_name", "bad_fk"),
            eligible.select(F.lit("eligible_accounts").alias("check_name"), "value"),
            named(keys, "silver_pk_rows:", "table_name", "total_rows"),
            named(keys, "silver_pk_distinct:", "table_name", "distinct_keys"),
            named(validation.silver_fk(silver), "silver_fk:", "check_name", "bad_fk"),
            named(validation.gold_dim_fk(gold), "gold_fk:", "check_name", "bad_fk"),
            named(validation.gold_fact_fk(gold), "gold_fk:", "check_name", "bad_fk"),
        ]
    )


def export_gold(spark: SparkSession, root: str, target: str) -> None:
    """Write the eight gold tables as plain Parquet for another system."""
    gold = StoredGold(spark, root)
    sinks.export_tables({name: gold.table(name) for name in schemas.GOLD}, target)


def import_gold(spark: SparkSession, staged: str, target: str) -> DataFrame:
    """Load copied gold tables under their declared schemas; returns the loaded row counts."""
    return row_counts(sinks.import_tables(spark, staged, target, schemas.GOLD)).orderBy("table_name")


def train_model(
    spark: SparkSession, root: str, model_path: str, max_runs: int | None = None, max_rows: int | None = None
) -> DataFrame:
    """Search the parameter grid on all complete loans (or the ``max_rows`` with the lowest ids), save the best model,
    return the runs."""
    features = scoring.loan_features(StoredGold(spark, root).table("fact_loan"), max_rows)
    runs = scoring.search(features, max_runs)
    scoring.best(runs).model.save(model_path)
    return scoring.leaderboard(spark, runs)


def score_loans(spark: SparkSession, root: str, model_path: str, run_id: str) -> None:
    """Score every complete loan with numeric features, keep the result under the run's id, and bring the newest score
    of each client up to date, so that no stream has to look for it."""
    loans = StoredGold(spark, root).table("fact_loan")
    features = scoring.numeric_only(scoring.loan_features(loans))
    scores = scoring.score(Network.load(model_path), features, run_id)
    sinks.write_scores(scores, f"{root}/gold/loan_default_scores")
    owned = customer360.owned_scores(stored_scores(spark, root).where(F.col("run_id") == run_id), loans)
    before = read_current_version(spark, f"{root}/gold/latest_scores", schemas.CLIENT_SCORES)
    newest = customer360.newest_scores(owned if before is None else stack([before, owned]))
    sinks.write_next_version(newest, f"{root}/gold/latest_scores")


MARTS = {
    f.__name__: f
    for f in (
        marts.current_counts, marts.loans_by_status, marts.daily_trans, marts.loans_by_district, marts.top_outgoing,
        marts.monthly_loans, marts.orders_by_purpose, marts.card_penetration, marts.client_summary,
        marts.rolling_region_days, marts.rolling_region_rows, marts.active_districts, marts.loan_segments,
        marts.profitability,
    )
}


# Results of a few rows by nature; the others are stored, not printed.
SMALL_MARTS = {"current_counts", "loans_by_status", "daily_trans", "top_outgoing", "loan_segments"}


def read_options(pairs: list[str], file: str | None) -> dict[str, str]:
    """Reader options from ``key=value`` arguments and from a file of such lines (for secrets)."""
    lines = list(pairs)
    if file:
        with open(file) as f:
            lines = [x.strip() for x in f if x.strip() and not x.startswith("#")] + lines
    return dict(x.split("=", 1) for x in lines)


def parse_arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="ledgerlake")
    parser.add_argument("--root", required=True, help="directory of the lake")
    parser.add_argument("--output", help="directory to write a job's result to, all rows, as Parquet")
    jobs = parser.add_subparsers(dest="job", required=True)
    jobs.add_parser("bronze").add_argument("landing")
    load = jobs.add_parser("dimensions")
    load.add_argument("--only", choices=list(DIMENSIONS))
    load.add_argument("--strict", action="store_true", help="reject rows that break an advisory rule")
    for name in ("stream-facts", "stream-customer360"):
        stream = jobs.add_parser(name)
        stream.add_argument("--servers", help="Kafka bootstrap servers")
        stream.add_argument("--path", help="directory of stored envelopes, instead of Kafka")
        stream.add_argument("--topic-prefix", default="")
        stream.add_argument("--stream-id", default="main")
        stream.add_argument("--trigger-seconds", type=int, default=30)
        stream.add_argument("--until-caught-up", action="store_true")
        stream.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="reader option, repeatable")
        stream.add_argument("--options-file", help="file of KEY=VALUE lines, for secrets")
    jobs.add_parser("compact-customer360")
    fold = jobs.add_parser("compact-facts")
    fold.add_argument("--all-batches", action="store_true", help="also the newest batch of each stream; only while no stream runs")
    jobs.add_parser("find-client").add_argument("client_id", type=int)
    by_client = jobs.add_parser("colocate")
    by_client.add_argument("database", help="of the catalog, to store the gold tables in by client")
    by_client.add_argument("--buckets", type=int, help="as many as shuffle partitions if not given")
    mart = jobs.add_parser("mart")
    mart.add_argument("name", choices=list(MARTS))
    mart.add_argument("--by-client", metavar="DATABASE", help="read what colocate stored there")
    jobs.add_parser("monthly-by-branch")
    totals = jobs.add_parser("running-totals")
    totals.add_argument("--first", help="month, as in 2024-05")
    totals.add_argument("--last", help="month")
    jobs.add_parser("checks")
    jobs.add_parser("create-tables")
    jobs.add_parser("export").add_argument("target")
    staged = jobs.add_parser("import")
    staged.add_argument("staged")
    staged.add_argument("target")
    train = jobs.add_parser("train")
    train.add_argument("model")
    train.add_argument("--max-runs", type=int, help="try only the first combinations of the grid")
    train.add_argument("--max-rows", type=int, help="learn from the loans with the lowest ids only")
    score = jobs.add_parser("score")
    score.add_argument("model")
    score.add_argument("run_id")
    args = parser.parse_args(argv)
    if args.job == "mart" and not args.output and args.name not in SMALL_MARTS:
        parser.error(f"{args.name} can have any number of rows; name an --output directory")
    return args


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    """Run one job; those that produce a table return it."""
    root = args.root
    if args.job == "bronze":
        return load_bronze(spark, args.landing, root)
    if args.job == "dimensions":
        if args.only:
            refresh_dimension(spark, root, args.only, strict=args.strict)
            return None
        return refresh_dimensions(spark, root, strict=args.strict)
    if args.job in ("stream-facts", "stream-customer360"):
        start = stream_facts if args.job == "stream-facts" else stream_customer360

        def topics(kind: str) -> DataFrame:
            options = read_options(args.option, args.options_file)
            return event_stream(spark, f"{args.topic_prefix}{kind}", servers=args.servers, path=args.path, **options)

        return wait_all(
            start(
                spark, root, topics, stream_id=args.stream_id, trigger_seconds=args.trigger_seconds,
                until_caught_up=args.until_caught_up,
            )
        )
    if args.job == "compact-customer360":
        compact_customer360(spark, root)
        return None
    if args.job == "compact-facts":
        compact_facts(spark, root, args.all_batches)
        return None
    if args.job == "find-client":
        return find_client(spark, root, args.client_id)
    if args.job == "mart":
        return MARTS[args.name](ColocatedGold(spark, args.by_client) if args.by_client else StoredGold(spark, root))
    if args.job == "colocate":
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {args.database}")
        colocate(spark, StoredGold(spark, root), args.database, args.buckets)
        return None
    if args.job == "running-totals":
        return running_totals(spark, root, args.first, args.last)
    if args.job == "monthly-by-branch":
        return monthly_by_branch(spark, root)
    if args.job == "checks":
        return run_checks(spark, root)
    if args.job == "create-tables":
        return sinks.ensure_layers(spark, root)
    if args.job == "export":
        return export_gold(spark, root, args.target)
    if args.job == "import":
        return import_gold(spark, args.staged, args.target)
    if args.job == "train":
        return train_model(spark, root, args.model, args.max_runs, args.max_rows)
    return score_loans(spark, root, args.model, args.run_id)


def deliver(result: DataFrame, output: str | None) -> None:
    """Write all rows to ``output``; without it, print them (only results that are small by nature come here so)."""
    if output:
        sinks.overwrite(result, output)
        return
    print("\t".join(result.columns))
    for row in result.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None) -> None:
    args = parse_arguments(argv)
    spark = tune(SparkSession.builder.appName(f"ledgerlake-{args.job}").getOrCreate())
    result = run(spark, args)
    if result is not None:
        deliver(result, args.output)


if __name__ == "__main__":
    main()
