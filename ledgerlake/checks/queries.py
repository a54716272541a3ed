"""One query per operator, each over whole sample tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerlake import schemas, sinks
from ledgerlake.checks import fixtures as X
from ledgerlake.checks.star import Star
from ledgerlake.functions import money, parsing, rules
from ledgerlake.operators import combine, integrity, quality, scd2, windows
from ledgerlake.plans import customer360, dimensions, facts, marts, reports, scoring, validation
from ledgerlake.session import scratch, tune
from ledgerlake.sources.colocated import ColocatedGold, colocate
from ledgerlake.sources.delimited import read_delimited
from ledgerlake.sources.events import parse_events
from ledgerlake.sources.tables import FrameGold, stored_parts
from ledgerlake.streaming import balances, compaction, customer360_stream, fact_stream, rollup, ticker
from ledgerlake.streaming.runner import wait_all

c = F.col
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def today():
    """The day the sample data ends, in place of the current date."""
    return F.expr(X.AS_OF)



def plain(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, so that two engines' results compare value by value."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            out.append(F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            out.append(c(f.name).cast("string").alias(f.name))
        else:
            out.append(c(f.name))
    return df.select(*out)


def query(name: str):
    def register(fn: Callable[[Star], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(Star(tune(spark), sf_dir)))

        REGISTRY[name] = run
        return fn

    return register


# --- marts ---

query("bi_s1_current_counts")(marts.current_counts)
query("bi_s2_loans_by_status")(marts.loans_by_status)
query("bi_s3_daily_trans")(lambda s: marts.daily_trans(s, today()))
query("bi_m1_loans_by_district")(marts.loans_by_district)
query("bi_m2_top_outgoing")(marts.top_outgoing)
query("bi_m3_monthly_loans")(marts.monthly_loans)
query("bi_m4_orders_by_purpose")(marts.orders_by_purpose)
query("bi_m5_card_penetration")(marts.card_penetration)
query("bi_c1_client_summary")(marts.client_summary)
query("bi_c2_rolling_range")(lambda s: marts.rolling_region_days(s, today()))
query("bi_c2_rolling_rows")(lambda s: marts.rolling_region_rows(s, today()))
query("bi_c3_active_districts")(lambda s: marts.active_districts(s, today()))
query("bi_c4_loan_segments")(marts.loan_segments)
query("bi_c5_profitability")(marts.profitability)


def _colocated(s: Star, *others: str) -> ColocatedGold:
    """The facts, clients and dispositions stored by client, with other tables, in a database of their own."""
    database = f"by_client_{uuid.uuid4().hex}"
    s.spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch(s.spark, 'by-client')}'")
    columns = {
        "fact_loan": ["amount", "loan_date"], "fact_order": ["amount", "ingest_ts"], "fact_trans": ["amount", "trans_date"],
        "dim_client": ["birth_number", "district_id", "is_current"], "dim_disp": ["disp_id", "account_id", "is_current"],
        "dim_account": ["is_current"],
    }
    keys = {n: ["client_id", "account_id", "disp_id"] if n.startswith("fact") else ["account_id" if n == "dim_account" else "client_id"] for n in columns}
    tables = FrameGold({n: s.table(n, *keys[n], *columns[n]) for n in columns})
    colocate(s.spark, tables, database, names=["fact_loan", "fact_order", "fact_trans", "dim_client", *others])
    return ColocatedGold(s.spark, database)


query("bi_c1_colocated")(lambda s: marts.client_summary(_colocated(s, "dim_disp", "dim_account")))
query("bi_c5_colocated")(lambda s: marts.profitability(_colocated(s)))
query("chk_fact_fk_colocated")(lambda s: validation.gold_fact_fk(_colocated(s, "dim_disp", "dim_account")))


# --- sources and sinks ---


def _delivered(s: Star) -> dict[str, DataFrame]:
    """The eight kinds of delivered files. The events' kinds have a separator inside a value."""
    bronze = X.Bronze(s)
    files = {name: bronze[name] for name in dimensions.DIMENSIONS}
    files["loan"] = s.table("fact_loan", "loan_id", "account_id", "loan_date", "amount", "duration", "status").select(
        "loan_id", "account_id", F.date_format("loan_date", "yyMMdd").alias("date"), money.money(c("amount")).alias("amount"),
        "duration", (c("duration") * 10).alias("payments"), F.concat(c("status"), F.lit(";")).alias("status"),
    )
    files["order"] = s.table("fact_order", "order_id", "account_id", "bank_to", "account_to", "amount", "k_symbol").select(
        "order_id", "account_id", F.concat(F.lit(";"), "bank_to").alias("bank_to"), "account_to",
        money.money(c("amount")).alias("amount"), "k_symbol",
    )
    files["trans"] = s.table(
        "fact_trans", "trans_id", "account_id", "trans_date", "trans_type", "operation", "amount", "balance", "k_symbol", "account"
    ).select(
        "trans_id", "account_id", F.date_format("trans_date", "yyMMdd").alias("trans_date"), c("trans_type").alias("type"),
        F.concat("operation", F.lit(";"), "trans_type").alias("operation"), money.money(c("amount")).alias("amount"),
        F.floor("balance").alias("balance"), "k_symbol", F.lit(None).cast("string").alias("bank"), "account",
    )
    return files


@query("src_delimited")
def _(s):
    """All eight kinds of files, written and read again; a row's values as one text, since the kinds differ in columns."""
    read = []
    for kind, rows in _delivered(s).items():
        path = scratch(s.spark, f"csv-{kind}")
        rows.write.option("sep", ";").option("header", True).csv(path)
        back = read_delimited(s.spark, path, schemas.BRONZE[kind])
        values = [F.coalesce(c(name), F.lit("(null)")) for name in back.columns]
        read.append(back.select(F.lit(kind).alias("kind"), F.concat_ws("|", *values).alias("line")))
    return combine.stack(read)


@query("bronze_strip_quotes")
def _(s):
    quoted = s.accounts().select(
        *[F.concat(F.lit('"'), X.text(c(n)), F.lit('"')).alias(n) for n in schemas.SILVER["account"].names]
    )
    path = scratch(s.spark, "quoted")
    quoted.write.option("sep", ";").option("header", True).option("quote", "").csv(path)
    return parsing.strip_quotes(
        read_delimited(s.spark, path, quoted.schema, keep_quotes=True)
    )


def _gold_tables(s: Star) -> dict[str, DataFrame]:
    names = {
        **schemas.GOLD,
        "dim_district": T.StructType(schemas.GOLD["dim_district"].fields[:3] + schemas.HISTORY.fields),
    }
    return {n: parsing.pad_to(s.table(n, *schema.names), schema) for n, schema in names.items()}


def _exported(s: Star) -> tuple[str, dict[str, T.StructType]]:
    tables = _gold_tables(s)
    base = scratch(s.spark, "export")
    sinks.export_tables(tables, base)
    return base, {n: df.schema for n, df in tables.items()}


@query("export_roundtrip")
def _(s):
    base = scratch(s.spark, "export")
    table = _gold_tables(s)["fact_loan"]
    sinks.export_tables({"fact_loan": table}, base)
    return s.spark.read.parquet(f"{base}/fact_loan")


@query("stage_import")
def _(s):
    tables = {n: df for n, df in _gold_tables(s).items() if n in ("dim_disp", "dim_card")}
    base = scratch(s.spark, "stage")
    sinks.export_tables(tables, base)
    loaded = sinks.import_tables(s.spark, base, f"{base}-loaded", {n: schemas.GOLD[n] for n in tables})
    return loaded["dim_card"].drop("issued_at").unionByName(
        loaded["dim_disp"].select(
            c("disp_id").alias("card_id"), "disp_id", c("disp_type").alias("card_type"), *schemas.HISTORY.names
        )
    )


def _imported(s: Star, name: str) -> DataFrame:
    schema = schemas.GOLD[name]
    base = scratch(s.spark, f"copy-{name}")
    sinks.export_tables({name: parsing.pad_to(s.table(name), schema)}, base)
    return sinks.import_tables(s.spark, base, f"{base}-loaded", {name: schema})[name]


for _name in schemas.GOLD:
    query(f"stage_import_{_name}")(lambda s, n=_name: _imported(s, n))


@query("chk_import_counts")
def _(s):
    base, known = _exported(s)
    return integrity.row_counts(sinks.import_tables(s.spark, base, f"{base}-loaded", known)).orderBy("table_name")


@query("json_parse")
def _(s):
    return parse_events(X.envelopes(s, "loan"), "loan")


@query("json_drift")
def _(s):
    """The loan events with a field that no column is for yet; accounts that are no numbers drift, too."""
    text = F.regexp_replace(c("value").cast("string"), r'^\{"loan_id":(\d+)', r'{"channel":{"no":$1},"loan_id":$1')
    kept = facts.drifted_fields(X.envelopes(s, "loan").select(text.cast("binary").alias("value")), "loan")
    number = F.try_variant_get("value", "$.no", "bigint").alias("number")
    return kept.select(c("event_id").alias("loan_id"), "field", "known", F.to_json("value").alias("value"), number)


# --- cleaning ---


def _silver_district(s: Star) -> DataFrame:
    return dimensions.silver("district", dimensions.split("district", X.Bronze(s)["district"], today()).accepted)


def _split(s: Star, name: str, strict: bool = False) -> quality.Split:
    parents = {"district": _silver_district(s)} if name == "client" else {}
    return dimensions.split(name, X.Bronze(s)[name], today(), parents, strict)


def _silver(s: Star, name: str) -> DataFrame:
    return dimensions.silver(name, _split(s, name).accepted)


for _name in dimensions.DIMENSIONS:
    query(f"silver_{_name}")(lambda s, n=_name: _silver(s, n))
    query(f"dq_{_name}")(lambda s, n=_name: _split(s, n).rejected)
for _name in ("account", "card"):
    query(f"dq_{_name}_warned")(lambda s, n=_name: _split(s, n).warned)


@query("dq_account_strict")
def _(s):
    return _split(s, "account", strict=True).rejected


@query("dq_appended")
def _(s):
    """Rejects of two run dates, the first loaded twice, as the reject table keeps them."""
    path = scratch(s.spark, "rejects")
    for day in (date(2001, 8, 1), date(2001, 8, 2), date(2001, 8, 1)):
        rejected = dimensions.split("account", X.Bronze(s)["account"], F.lit(day)).rejected
        sinks.append_rejects(rejected, path, day)
    stored = T.StructType(schemas.BRONZE["account"].fields + schemas.REJECT_TAIL.fields)
    return s.spark.read.schema(stored).parquet(path)


# --- history ---


def _one_load(s: Star, name: str, column: str, to) -> DataFrame:
    d = dimensions.DIMENSIONS[name]
    rows = parsing.pad_to(s.table(f"dim_{name}").where("is_current"), schemas.SILVER[name])
    before = X.first_load(rows, d.key)
    return dimensions.gold(name, before, X.moved(rows, d.key, column, to), F.expr(X.T1))


def _client_dim(s: Star):
    rows = s.clients()
    return rows, X.first_load(rows, "client_id"), X.moved(rows, "client_id", "district_id", c("district_id") + 1)


_CLIENT = dimensions.DIMENSIONS["client"]


@query("scd2_initial")
def _(s):
    return dimensions.gold("client", None, s.clients(), F.expr(X.T0))


@query("scd2_new_keys")
def _(s):
    _, before, snapshot = _client_dim(s)
    return scd2.new_keys(before, snapshot, "client_id")


@query("scd2_changed")
def _(s):
    _, before, snapshot = _client_dim(s)
    return scd2.changed_keys(before, snapshot, "client_id", _CLIENT.tracked)


@query("scd2_expired")
def _(s):
    _, before, snapshot = _client_dim(s)
    return scd2.scd2_step(before, snapshot, "client_id", _CLIENT.tracked, F.expr(X.T1)).closed


def _third_state(s: Star) -> DataFrame:
    rows, before, snapshot = _client_dim(s)
    second = dimensions.gold("client", before, snapshot, F.expr(X.T1))
    return dimensions.gold("client", second, rows.where("client_id % 9 <> 0"), F.expr(X.T2))


query("scd2_state")(_third_state)
query("scd2_current")(lambda s: scd2.current_rows(_third_state(s)))


def _district_load(s: Star, column: str, to) -> DataFrame:
    """Districts with a value in each of their thirteen numbers."""
    numbers = {
        f.name: (c("district_id") * int(f.name[1:]) + (0.5 if f.dataType == T.DoubleType() else 0)).cast(f.dataType)
        for f in schemas.SILVER["district"].fields[3:]
    }
    rows = s.districts().withColumns(numbers).select(*schemas.SILVER["district"].names)
    before = X.first_load(rows, "district_id")
    return dimensions.gold("district", before, X.moved(rows, "district_id", column, to), F.expr(X.T1))


query("scd2_state_district")(lambda s: _district_load(s, "region", F.lit("MOVED")))
query("scd2_state_district_number")(lambda s: _district_load(s, "A12", F.lit(None).cast("double")))
query("scd2_state_account")(lambda s: _one_load(s, "account", "open_date", F.lit(None).cast("date")))
query("scd2_state_disp")(lambda s: _one_load(s, "disp", "disp_type", F.lit("CLOSED")))
query("scd2_state_card")(lambda s: _one_load(s, "card", "card_type", F.lit(None).cast("string")))


@query("dimensions_end_to_end")
def _(s):
    """Rows of every silver table, reject table and history after two runs of all loads."""
    bronze = X.Bronze(s)
    first = dimensions.run_dimensions(bronze, None, today(), F.expr(X.T0))
    second = dimensions.run_dimensions(bronze, first.gold, today(), F.expr(X.T1))
    tables = {f"{n}_silver": df for n, df in second.silver.items()}
    tables |= {f"dq_{n}": df for n, df in second.rejected.items()}
    tables |= {f"dim_{n}": df for n, df in second.gold.items()}
    return integrity.row_counts(tables)


# --- streams ---


def _fact_stream(s: Star, kind: str) -> DataFrame:
    base = scratch(s.spark, f"stream-{kind}")
    events = X.envelopes(X.StreamingStar(s.spark, s.sf_dir, kind), kind)
    gold_path = f"{base}/gold/fact_{kind}"
    running = fact_stream.start_fact_stream(
        events,
        kind,
        lambda spark: Star(spark, s.sf_dir).table("dim_account", "account_id", "district_id", "is_current"),
        f"{base}/silver/fact_{kind}",
        gold_path,
        f"{base}/checkpoint",
        until_caught_up=True,
    )
    wait_all([running])
    return fact_stream.read_facts(s.spark, gold_path, kind).drop("stream_id", "batch_id")


@query("dq_events")
def _(s):
    """How many events of each kind are rejected."""
    return combine.stack(
        [
            facts.rejected_events(X.envelopes(s, kind), kind).groupBy("dq_reason").agg(F.count("*").alias("rejected"))
            .withColumn("kind", F.lit(kind))
            for kind in facts.FACTS
        ]
    )


for _name in facts.FACTS:
    query(f"stream_fact_{_name}")(lambda s, n=_name: _fact_stream(s, n))
    query(f"batch_fact_{_name}")(
        lambda s, n=_name: facts.fact_batch(
            X.envelopes(s, n), s.table("dim_account", "account_id", "district_id", "is_current"), n
        )[1].drop("batch_id")
    )


@query("fact_compacted_trans")
def _(s):
    """Transactions that came in seven batches, folded into segments twice; one batch is replayed before it is folded, one after."""
    accounts = s.table("dim_account", "account_id", "district_id", "is_current")
    whole, base = scratch(s.spark, "trans"), scratch(s.spark, "trans-batches")
    # Each batch in a folder of its own, so that writing it reads no other.
    own = F.pmod("trans_id", F.lit(7)).alias("own")
    facts.fact_batch(X.envelopes(s, "trans"), accounts, "trans")[1].select("*", own).write.partitionBy("own").parquet(whole)
    stored = T.StructType([*schemas.GOLD_FACTS["fact_trans"].fields, T.StructField("own", T.LongType())])
    rows = s.spark.read.schema(stored).parquet(whole).drop("batch_id")
    for batch in (0, 1, 2, 2, 3, 4, 5, 1, 6):
        fact_stream.write_gold_batch(rows.where(c("own") == batch).drop("own"), base, "trans", "main", batch)
        if batch in (3, 5):
            compaction.compact_facts(s.spark, base, "trans", fan=2)
    return fact_stream.read_facts(s.spark, base, "trans").drop("stream_id", "batch_id")


@query("fact_enrich_account")
def _(s):
    silver = s.table("fact_order", *schemas.SILVER_FACTS["fact_order"].names)
    return facts.gold_fact(silver, s.table("dim_account"), "order").drop("batch_id")


@query("jn_stream_static")
def _(s):
    base = scratch(s.spark, "stream-join")
    moving = X.StreamingStar(s.spark, s.sf_dir, "order").table("fact_order", "order_id", "account_id", "amount")
    joined = combine.left_current(moving, s.table("dim_account"), "account_id", frequency="frequency")
    running = (
        joined.writeStream.format("parquet")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{base}/out")
    )
    wait_all([running])
    return s.spark.read.schema(joined.schema).parquet(f"{base}/out")


# --- customer 360 ---


def _reference(s: Star, with_scores: bool = True) -> customer360_stream.Reference:
    scores = None
    if with_scores:
        scores = customer360.latest_scores(X.scores(s), s.table("fact_loan", "loan_id", "client_id"))
    return customer360_stream.Reference(
        s.table("dim_client", "client_id", "birth_number", "district_id", "is_current"),
        s.table("dim_account", "account_id", "district_id", "is_current"),
        scores,
    )


def _shape(
    s: Star, kind: str, events: DataFrame | None = None, with_scores: bool = True, clients: DataFrame | None = None
) -> DataFrame:
    found = customer360.activity(X.envelopes(s, kind), kind) if events is None else events
    ref = _reference(s, with_scores and kind == "loan")
    return customer360.shape(found, kind, ref.clients if clients is None else clients, ref.accounts, ref.scores)


for _name in customer360.SHAPES:
    query(f"c360_{_name}")(lambda s, n=_name: _shape(s, n))
query("c360_loan_without_scores")(lambda s: _shape(s, "loan", with_scores=False))


@query("c360_latest")
def _(s):
    return customer360.latest_activity(customer360.activity(X.envelopes(s, "trans"), "trans"), "trans")


@query("c360_latest_score")
def _(s):
    return customer360.latest_scores(X.scores(s), s.table("fact_loan", "loan_id", "client_id"))


def _merged(s: Star) -> DataFrame:
    return customer360.merge(combine.stack([_shape(s, k) for k in customer360.SHAPES]))


query("c360_merged")(_merged)
query("c360_lookup")(lambda s: customer360.point_lookup(_merged(s), 7))


def _half(s: Star, rest: int, clients: DataFrame | None = None) -> DataFrame:
    """Records of the events with even or odd numbers."""
    parts = []
    for kind, spec in customer360.SHAPES.items():
        events = customer360.activity(X.envelopes(s, kind, rest), kind)
        parts.append(_shape(s, kind, events.where(c(spec.id) % 2 == rest), clients=clients))
    return combine.stack(parts)


@query("c360_found")
def _(s):
    """Even-numbered events are compacted, odd ones lie in the log; a client is looked up in both."""
    log, table = scratch(s.spark, "records"), scratch(s.spark, "customer360")
    customer360_stream.append_records(customer360.merge(_half(s, 0)), log, "all", "main", 0)
    customer360_stream.compact(s.spark, log, table)
    customer360_stream.append_records(customer360.merge(_half(s, 1)), log, "all", "main", 1)
    return customer360_stream.find_client(s.spark, log, table, 7)


@query("c360_upsert")
def _(s):
    """Even-numbered events as the stored table, odd ones as the next updates."""
    return customer360.merge_latest(customer360.merge(_half(s, 0)), _half(s, 1))


@query("c360_moved")
def _(s):
    """Even-numbered events were looked up before the client moved to a district of a smaller number, odd ones after."""
    clients = s.table("dim_client", "client_id", "birth_number", "district_id", "is_current").withColumns(
        {"birth_number": F.concat("birth_number", F.lit(" (old)")), "district_id": c("district_id") + 100}
    )
    return customer360.merge_latest(customer360.merge(_half(s, 0, clients)), _half(s, 1))


@query("stream_c360")
def _(s):
    base = scratch(s.spark, "c360")
    running = [
        customer360_stream.start_customer360_stream(
            X.envelopes(X.StreamingStar(s.spark, s.sf_dir, kind), kind),
            kind,
            lambda spark, k=kind: _reference(Star(spark, s.sf_dir), k == "loan"),
            f"{base}/log",
            f"{base}/checkpoint/{kind}",
            until_caught_up=True,
        )
        for kind in customer360.SHAPES
    ]
    wait_all(running)
    customer360_stream.compact(s.spark, f"{base}/log", f"{base}/table")
    return customer360_stream.customer360(s.spark, f"{base}/log", f"{base}/table")


# --- joins ---


@query("jn_inner")
def _(s):
    loans = s.table("fact_loan", "loan_id", "district_id")
    return combine.lookup(
        loans, s.table("dim_district").where("is_current"), "district_id", "inner",
        region="region", district_name="district_name",
    )


@query("jn_left_current")
def _(s):
    loans = s.table("fact_loan", "loan_id", "account_id")
    return combine.left_current(loans, s.table("dim_account"), "account_id", frequency="frequency")


@query("jn_anti")
def _(s):
    accounts = s.table("dim_account", "account_id", "is_current").where("is_current")
    return combine.key_not_in(s.table("fact_loan", "loan_id", "account_id"), accounts, "account_id").select("loan_id")


@query("jn_semi")
def _(s):
    disps = s.table("dim_disp", "disp_id", "is_current").where("is_current")
    return combine.key_in(s.table("fact_order", "order_id", "disp_id"), disps, "disp_id").select("order_id")


@query("jn_existence")
def _(s):
    clients = X.Bronze(s)["client"]
    key = parsing.to_long(c("district_id"))
    return quality.has_parent(clients, _silver_district(s), "district_id", key, "known").select("client_id", "known")


@query("jn_star")
def _(s):
    wide = s.table("dim_client", "client_id", "is_current").where("is_current").select("client_id")
    for kind in ("loan", "order", "trans"):
        counted = s.table(f"fact_{kind}", "client_id").groupBy("client_id").agg(F.count("*").alias(f"{kind}s"))
        wide = wide.join(counted, "client_id", "left")
    return wide


@query("jn_bridge")
def _(s):
    def now(name: str, *columns: str) -> DataFrame:
        return s.table(name, *columns, "is_current").where("is_current").select(*columns)

    return (
        now("dim_disp", "disp_id", "client_id")
        .join(now("dim_client", "client_id", "district_id"), "client_id")
        .join(now("dim_card", "disp_id", "card_id"), "disp_id")
        .select("client_id", "district_id", "card_id")
    )


@query("jn_cast_keys")
def _(s):
    bronze = X.Bronze(s)
    key = parsing.to_long(c("client_id"))
    found = integrity.orphans(bronze["disp"], bronze["client"], key, key)
    return found.select(c("key").alias("client_id"), c("rows").alias("orphans"))


@query("jn_scalar")
def _(s):
    def rows(name: str, *columns: str):
        return s.table(name, *columns).agg(F.count("*")).scalar()

    return s.spark.range(1).select(
        rows("fact_loan", "loan_id").alias("loans"),
        rows("fact_order", "order_id").alias("orders"),
        rows("fact_trans", "trans_id").alias("trans"),
    )


# --- aggregates, windows, sorting, unions ---


@query("ag_basic")
def _(s):
    grouped = s.table("fact_trans", "account_id", "amount").groupBy("account_id").agg(
        F.count("*").alias("n"),
        money.total(c("amount")).alias("t"),
        F.max("amount").alias("largest"),
    )
    return grouped.select(
        "account_id",
        "n",
        money.as_double(c("t")).alias("total_amount"),
        money.ratio(c("t"), c("n")).alias("avg_amount"),
        "largest",
    )


@query("ag_count_distinct")
def _(s):
    return (
        s.table("fact_trans", "account_id", "client_id")
        .groupBy("account_id")
        .agg(F.count_distinct("client_id").alias("clients"))
    )


@query("ag_conditional_sum")
def _(s):
    outgoing = c("trans_type") == "VYDAJ"
    return (
        s.table("fact_trans", "trans_date", "trans_type", "amount")
        .groupBy("trans_date")
        .agg(
            money.as_double(money.total_if(outgoing, c("amount"))).alias("outgoing"),
            money.as_double(money.total_if(~outgoing, c("amount"))).alias("incoming"),
        )
    )


@query("ag_having")
def _(s):
    grouped = s.table("fact_order", "client_id", "amount").groupBy("client_id").agg(
        F.count("*").alias("n"), money.as_double(money.total(c("amount"))).alias("total_amount")
    )
    return grouped.where("total_amount > 500")


@query("ag_distinct")
def _(s):
    return s.table("fact_trans", "client_id", "account_id").distinct()


@query("ag_group_expr")
def _(s):
    month = F.trunc("trans_date", "MONTH").alias("month")
    return s.table("fact_trans", "trans_date").groupBy(month).agg(F.count("*").alias("n"))


@query("ag_global_count")
def _(s):
    return s.table("fact_trans", "trans_id").agg(F.count("*").alias("n"))


@query("wn_row_number")
def _(s):
    rows = s.table("fact_trans", "account_id", "ingest_ts", "trans_id", "amount")
    return windows.top_per_key(rows, "account_id", 1, "ingest_ts", "trans_id", "amount")


@query("wn_latest")
def _(s):
    rows = s.table("fact_trans", "account_id", "ingest_ts", "trans_id", "amount")
    return windows.latest(rows, "account_id", "ingest_ts", "trans_id")


def _daily(s: Star) -> DataFrame:
    return (
        s.table("fact_trans", "account_id", "trans_date", "amount")
        .groupBy("account_id", "trans_date")
        .agg(money.total(c("amount")).alias("t"))
    )


def _rolled(df: DataFrame) -> DataFrame:
    return df.select("account_id", "trans_date", money.as_double(c("r")).alias("rolling"))


@query("wn_range_interval")
def _(s):
    return _rolled(windows.rolling_days(_daily(s), "account_id", "trans_date", "t", 30, "r"))


@query("wn_rows")
def _(s):
    return _rolled(windows.rolling_rows(_daily(s), "account_id", "trans_date", "t", 30, "r"))


@query("so_multi_key")
def _(s):
    """Every row with its place in the order."""
    rows = s.table("dim_disp", "account_id", "client_id", "disp_type", "is_current", "scd_version")
    order = [c("account_id"), c("client_id").desc(), c("is_current"), c("disp_type"), c("scd_version")]
    return combine.numbered(rows, *order, label=scratch(s.spark, "numbered")).drop("scd_version")


@query("fn_current_date")
def _(s):
    """Days from the newest transaction of each type to the current day, as the session knows it."""
    newest = s.table("fact_trans", "trans_type", "trans_date").groupBy("trans_type").agg(F.max("trans_date").alias("newest"))
    return newest.select("trans_type", F.date_diff(F.current_date(), "newest").alias("days"), (c("newest") < F.current_timestamp()).alias("past"))


@query("so_top_k")
def _(s):
    return combine.top_k(s.table("fact_loan", "loan_id", "amount"), 20, c("amount").desc(), "loan_id")


@query("so_limit")
def _(s):
    return scoring.loan_features(s.table("fact_loan", "loan_id", *scoring.FEATURES, "status"), limit=1000)


@query("st_union_all")
def _(s):
    return combine.stack(
        [
            s.table(f"fact_{k}", f"{k}_id", "amount").select(
                F.lit(k).alias("kind"), c(f"{k}_id").alias("id"), "amount"
            )
            for k in ("loan", "order", "trans")
        ]
    )


# --- functions ---


@query("fn_cast")
def _(s):
    raw = X.Bronze(s)["district"]
    return raw.select(
        "A1",
        parsing.to_long(c("A1")).alias("as_long"),
        parsing.to_whole(c("A15")).alias("as_int"),
        parsing.to_double(c("A12")).alias("as_double"),
        parsing.iso_date(F.concat(F.lit("2001-01-0"), c("A4"))).alias("as_date"),
    )


@query("fn_string")
def _(s):
    raw = X.Bronze(s)["client"]
    return raw.select(
        "client_id",
        rules.is_digits(c("client_id")).alias("digits"),
        rules.is_key(c("client_id")).alias("is_key"),
        rules.is_present(c("birth_number")).alias("present"),
        F.replace("birth_number", F.lit("#0"), F.lit("")).alias("replaced"),
    )


@query("fn_date")
def _(s):
    raw = X.Bronze(s)["account"]
    day = parsing.compact_date(c("created_date"))
    return raw.select(
        "account_id",
        day.alias("day"),
        F.trunc(day, "MONTH").alias("month"),
        F.date_sub(day, 30).alias("days_before"),
        F.add_months(day, -6).alias("months_before"),
        parsing.compact_timestamp(F.concat(c("created_date"), F.lit(" 23:59:58"))).alias("at"),
        rules.since(day, F.lit("2025-09-30").cast("date"), months=6).alias("recent"),
    )


@query("fn_null")
def _(s):
    rows = s.table("fact_order", "order_id", "k_symbol", "amount")
    return rows.select(
        "order_id",
        F.coalesce("k_symbol", F.lit("(none)")).alias("filled"),
        F.nullif("k_symbol", F.lit("click")).alias("emptied"),
        c("k_symbol").eqNullSafe(F.nullif(c("k_symbol"), F.lit("click"))).alias("same"),
        F.greatest(c("amount"), F.lit(50.0)).alias("at_least_50"),
    )


@query("fn_conditional")
def _(s):
    loans = s.table("fact_loan", "loan_id", "amount", "duration")
    return loans.select(
        "loan_id",
        marts.bucket(c("duration"), marts.DURATION_BUCKETS, marts.DURATION_REST, True).alias("duration_bucket"),
        marts.bucket(c("amount"), marts.AMOUNT_BUCKETS, marts.AMOUNT_REST, False).alias("amount_bucket"),
        F.abs(c("amount") - 100000).alias("distance"),
    )


@query("fn_json")
def _(s):
    packed = s.base("events").select("event_id", c("props").cast("binary").alias("value"))
    body = F.from_json(c("value").cast("string"), "k BIGINT")
    return packed.select("event_id", body.getField("k").alias("k"))


# --- checks ---


def _all_silver(s: Star) -> dict[str, DataFrame]:
    return {n: _silver(s, n) for n in dimensions.DIMENSIONS}


class Misplaced:
    """The sample gold layer with a sixth of the clients in districts that do not exist."""

    def __init__(self, star: Star):
        self.star = star

    def table(self, name: str, *columns: str) -> DataFrame:
        df = self.star.table(name, *columns)
        if name != "dim_client" or "district_id" not in columns:
            return df
        away = F.when(c("district_id") % 6 != 0, c("district_id")).otherwise(c("district_id") + 900)
        return df.withColumn("district_id", away)


query("chk_bronze_fk")(lambda s: validation.bronze_fk(X.Bronze(s)))
query("chk_silver_fk")(lambda s: validation.silver_fk(_all_silver(s)))
query("chk_gold_dim_fk")(lambda s: validation.gold_dim_fk(Misplaced(s)))
query("chk_fact_fk")(validation.gold_fact_fk)


@query("chk_pk")
def _(s):
    district = validation.silver_pk({"district": _silver_district(s)})
    trans = integrity.pk_check(s.table("fact_trans", "trans_id"), "trans_id").withColumn("table_name", F.lit("trans"))
    return combine.stack([district, trans])


@query("chk_eligible_accounts")
def _(s):
    return dimensions.eligible_accounts(X.Bronze(s)["account"]).agg(F.count("*").alias("eligible"))


@query("chk_row_counts")
def _(s):
    bronze = X.Bronze(s)
    tables = {f"bronze.{n}_bronze": bronze[n] for n in dimensions.DIMENSIONS}
    tables |= {f"silver.{n}_silver": _silver(s, n) for n in dimensions.DIMENSIONS}
    tables["silver.dq_account"] = _split(s, "account").rejected
    keys = {n: schema.names[0] for n, schema in schemas.GOLD.items()}
    tables |= {f"gold.{n}": s.table(n, key) for n, key in keys.items()}
    return integrity.row_counts(tables)


@query("chk_stored_counts")
def _(s):
    """The same counts over stored tables, from their files' footers."""
    bronze, base = X.Bronze(s), scratch(s.spark, "counted")
    tables = {f"bronze.{n}_bronze": bronze[n] for n in dimensions.DIMENSIONS}
    tables |= {f"silver.{n}_silver": _silver(s, n) for n in dimensions.DIMENSIONS}
    tables["silver.dq_account"] = _split(s, "account").rejected
    tables |= {f"gold.{n}": s.table(n, schema.names[0]) for n, schema in schemas.GOLD.items()}
    for name, df in tables.items():
        sinks.overwrite(df, f"{base}/{name}")
    return integrity.stored_counts(s.spark, {name: stored_parts(s.spark, f"{base}/{name}") for name in tables})


# --- model ---


@query("ml_features")
def _(s):
    rows, _labels = scoring.labelled(
        scoring.loan_features(s.table("fact_loan", "loan_id", *scoring.FEATURES, "status"))
    )
    return rows


@query("ml_leaderboard")
def _(s):
    """Every combination of the grid, and whether its accuracy is one."""
    features = scoring.loan_features(s.table("fact_loan", "loan_id", *scoring.FEATURES, "status"))
    board = scoring.leaderboard(s.spark, scoring.search(features))
    return board.select("run", "hidden_dim", "learning_rate", c("val_accuracy").between(0, 1).alias("is_accuracy"))


@query("ml_scores")
def _(s):
    features = scoring.loan_features(s.table("fact_loan", "loan_id", *scoring.FEATURES, "status"))
    rows, labels = scoring.labelled(features)
    model = scoring.train(rows, labels, scoring.HIDDEN[0], scoring.LEARNING_RATES[0])
    path = scratch(s.spark, "scores")
    sinks.write_scores(scoring.score(model, features, "run_1", F.expr(X.T1)), path)
    stored = s.spark.read.schema(schemas.LOAN_SCORES).parquet(path)
    # What must hold whatever the model has learned: chances add up to 1, and the status of the greatest is predicted.
    chances = F.from_json("probabilities_json", "map<string,double>")
    total = F.aggregate(F.map_values(chances), F.lit(0.0), lambda a, x: a + x)
    return stored.select(
        "loan_id", "run_id", "actual_status", "score_timestamp",
        (F.abs(total - 1) < 1e-9).alias("adds_up"),
        (chances[c("pred_status")] == F.array_max(F.map_values(chances))).alias("is_likeliest"),
        F.map_keys(chances).cast("string").alias("statuses"),
    )


@query("ml_learned")
def _(s):
    """Statuses that follow from the features: how many loans have each, and whether the model has learned to tell them.

    It has if it predicts at least four fifths of what guessing the most frequent status gets wrong.
    """
    risk = F.when(c("duration") >= 60, "D").when(c("amount") > 200_000, "B").otherwise("A")
    features = scoring.loan_features(s.table("fact_loan", "loan_id", *scoring.FEATURES).withColumn("status", risk))
    rows, labels = scoring.labelled(features)
    path = scratch(s.spark, "learned")
    model = scoring.train(rows.where(~scoring.is_held_out()), labels, 32, 0.02)
    sinks.write_scores(scoring.score(model, features, "run_1", F.expr(X.T1)), path)
    stored = s.spark.read.schema(schemas.LOAN_SCORES).parquet(path)
    per_status = stored.groupBy("actual_status").agg(F.count("*").alias("loans"))
    guess = per_status.agg(F.max("loans").alias("most"), F.sum("loans").alias("all"))
    right = stored.agg(F.count_if(c("actual_status") == c("pred_status")).alias("right"))
    learned = (c("right") - c("most")) * 5 >= (c("all") - c("most")) * 4
    told = right.withColumn("k", F.lit(1)).join(guess.withColumn("k", F.lit(1)), "k").select("k", learned.alias("learned"))
    return per_status.withColumn("k", F.lit(1)).join(told, "k").select("actual_status", "loans", "learned")


@query("ml_run_accuracy")
def _(s):
    return scoring.run_accuracy(X.scores(s))


@query("ml_numeric_only")
def _(s):
    raw = s.table("fact_loan", "loan_id", "amount", "duration", "payments").select(
        "loan_id",
        F.when(c("loan_id") % 7 == 0, "n/a").otherwise(money.money(c("amount")).cast("string")).alias("amount"),
        F.when(c("loan_id") % 11 != 0, X.text(c("duration"))).alias("duration"),
        X.text(c("duration") * 10).alias("payments"),
    )
    return scoring.numeric_only(raw)


# --- reports ---

query("rep_deposits_by_branch")(lambda s: reports.deposits_by_branch(s, today()))
query("rep_daily_by_branch")(reports.daily_by_branch)
query("rep_monthly_by_branch")(reports.monthly_by_branch)
@query("rep_monthly_from_sums")
def _(s):
    """The same from sums that batches add to: one replayed, one late and after the others were folded, one corrected by differences."""
    log, table = scratch(s.spark, "sums"), scratch(s.spark, "folded")
    rows = s.table("fact_trans", "trans_id", "district_id", "trans_date", "amount")

    def part(batch):
        return rows.where(F.pmod("trans_id", F.lit(5)) == batch)

    wrong = part(1).withColumn("amount", c("amount") * 2).withColumn("trans_date", F.date_add("trans_date", 40))
    for batch, found in ((0, part(0)), (1, wrong), (2, part(2)), (2, part(2)), (4, part(4))):
        rollup.write_part(rollup.sums(found), log, "main", batch)
        if batch == 2:
            rollup.fold(s.spark, log, table)
    rollup.write_part(rollup.difference(wrong, part(1)), log, "corrections", 0)
    rollup.fold(s.spark, log, table)
    rollup.write_part(rollup.sums(part(3)), log, "late", 0)
    return rollup.monthly_by_branch(s, s.spark, log, table)


query("rep_daily_by_client")(reports.daily_by_client)
query("rep_volume_by_type")(reports.volume_by_type)
query("rep_clients_by_account_type")(reports.clients_by_account_type)
query("rep_client_features")(lambda s: reports.client_features(s, today()))
query("rep_prediction_drift")(lambda s: reports.prediction_drift(X.scores(s)))


@query("rep_high_value_high_risk")
def _(s):
    ratings = s.base("customer").select(
        c("c_custkey").alias("client_id"),
        c("c_acctbal").alias("credit_score"),
        F.when(c("c_acctbal") < 2000, "High").otherwise("Low").alias("risk_segment"),
    )
    return reports.high_value_high_risk(s, ratings, 500_000)


@query("rep_large_trans")
def _(s):
    return reports.flag_large(s.table("fact_trans", "trans_id", "account_id", "amount"), 40_000)


@query("rep_running_total")
def _(s):
    rows = s.table("fact_trans", "account_id", "trans_date", "trans_id", "amount")
    summed = reports.running_total(
        rows, "account_id", "trans_date", "trans_id", money.money(c("amount")), "running", block=1000
    )
    return summed.withColumn("running", money.as_double(c("running")))


@query("rep_running_from_sums")
def _(s):
    """The same from sums that batches add to: one replayed, one late and after the others were folded, one corrected by differences."""
    log, table = scratch(s.spark, "balances"), scratch(s.spark, "balances-folded")
    rows = s.table("fact_trans", "trans_id", "account_id", "trans_date", "amount")

    def part(batch):
        return rows.where(F.pmod("trans_id", F.lit(4)) == batch)

    wrong = part(1).withColumn("amount", c("amount") * 2).withColumn("trans_date", F.date_add("trans_date", 40))
    for batch, found in ((0, part(0)), (1, wrong), (2, part(2)), (2, part(2))):
        balances.write_part(balances.sums(found), log, "main", batch)
    balances.fold(s.spark, log, table)
    balances.write_part(balances.difference(wrong, part(1)), log, "corrections", 0)
    balances.fold(s.spark, log, table)
    balances.write_part(balances.sums(part(3)), log, "late", 0)
    summed = balances.account_running_total(s, s.spark, log, table, block=1000)
    return summed.withColumn("running", money.as_double(c("running")))


@query("rep_masked_clients")
def _(s):
    return reports.masked_clients(s.clients())


@query("rep_trans_by_month")
def _(s):
    path = scratch(s.spark, "by-month")
    rows = s.table("fact_trans", "trans_id", "amount", "trans_date")
    sinks.replace_partitions(rows.withColumn("month", F.trunc("trans_date", "MONTH")), path, ["month"])
    stored = s.spark.read.schema("trans_id BIGINT, amount DOUBLE, trans_date DATE, month DATE").parquet(path)
    return stored.where(rules.since(c("month"), today(), months=6))


def _disp_expectations():
    return {
        "disp_id is a number": rules.is_key(c("disp_id")),
        "account_id is present": rules.is_present(c("account_id")),
        "type is known": rules.in_domain(c("type"), dimensions.DISP_TYPES),
    }


@query("rep_expectations")
def _(s):
    return quality.expectations(X.Bronze(s)["disp"], _disp_expectations())


@query("rep_expectations_written")
def _(s):
    """The same, counted while the rows are written."""
    found = quality.Measured(X.Bronze(s)["disp"], _disp_expectations())
    sinks.overwrite(found.rows, scratch(s.spark, "measured"))
    return found.expectations(s.spark)


@query("stream_ticker")
def _(s):
    base = scratch(s.spark, "ticker")
    moving = X.StreamingStar(s.spark, s.sf_dir, "order").table("fact_order", "ingest_ts", "amount")
    wait_all([ticker.start_ticker(moving, f"{base}/out", f"{base}/checkpoint", until_caught_up=True)])
    return ticker.read_ticker(s.spark, f"{base}/out")
