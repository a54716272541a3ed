"""Business-intelligence marts over the gold layer.

Each mart asks the gold layer for the columns it needs. Facts are aggregated by their key
before they meet a dimension, so a district, account or client that holds a large share of a fact
crosses the network as one partial row per task. ``as_of`` stands for today.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.functions.money import as_double, money, or_zero, ratio, total, total_if
from ledgerlake.functions.rules import since
from ledgerlake.operators.combine import lookup, top_k
from ledgerlake.operators.windows import rolling_days, rolling_rows
from ledgerlake.sources.colocated import with_sums
from ledgerlake.sources.tables import Gold

c = F.col


def _today(as_of: Column | None) -> Column:
    return F.current_date() if as_of is None else as_of


def _current(gold: Gold, name: str, *columns: str) -> DataFrame:
    return gold.table(name, *columns, "is_current").where("is_current").select(*columns)


def _districts(gold: Gold) -> DataFrame:
    return _current(gold, "dim_district", "district_id", "region", "district_name")


def _at_district(totals: DataFrame, gold: Gold) -> DataFrame:
    """Region and name for rows already reduced to one or few per district."""
    return lookup(
        totals, _districts(gold), "district_id", "inner", region="region", district_name="district_name"
    )


def current_counts(gold: Gold) -> DataFrame:
    """How many clients and accounts are in force, in one row."""
    clients = _current(gold, "dim_client", "client_id")
    accounts = _current(gold, "dim_account", "account_id")
    return clients.sparkSession.range(1).select(
        clients.agg(F.count("*")).scalar().alias("client_count"),
        accounts.agg(F.count("*")).scalar().alias("account_count"),
    )


def loans_by_status(gold: Gold) -> DataFrame:
    grouped = gold.table("fact_loan", "status", "amount", "duration").groupBy("status").agg(
        total(c("amount")).alias("t"), F.count("amount").alias("n"),
        F.sum("duration").alias("d"), F.count("duration").alias("m"),
        F.count("*").alias("loan_count"),
    )
    return grouped.select(
        "status",
        ratio(c("t"), c("n")).alias("avg_loan_amount"),
        ratio(c("d"), c("m")).alias("avg_duration_months"),
        "loan_count",
    ).orderBy("status")


def daily_trans(gold: Gold, as_of: Column | None = None, days: int = 30) -> DataFrame:
    recent = gold.table("fact_trans", "trans_date", "amount").where(since(c("trans_date"), _today(as_of), days=days))
    return (
        recent.groupBy("trans_date")
        .agg(
            F.count("*").alias("transaction_count"),
            as_double(total(c("amount"))).alias("total_amount"),
            as_double(total(F.abs(c("amount")))).alias("total_abs_amount"),
        )
        .orderBy(c("trans_date").desc())
    )


def loans_by_district(gold: Gold) -> DataFrame:
    per_key = gold.table("fact_loan", "district_id", "amount").groupBy("district_id").agg(
        F.count("*").alias("rows"), total(c("amount")).alias("t"), F.count("amount").alias("n")
    )
    named = _at_district(per_key, gold).groupBy("region", "district_name").agg(
        F.sum("rows").alias("loan_count"), F.sum("t").alias("t"), F.sum("n").alias("n")
    )
    return named.select(
        "region",
        "district_name",
        "loan_count",
        as_double(c("t")).alias("total_loan_amount"),
        ratio(c("t"), c("n")).alias("avg_loan_amount"),
    ).orderBy(c("total_loan_amount").desc(), "region", "district_name")


def top_outgoing(gold: Gold, k: int = 10) -> DataFrame:
    """Accounts with the most outgoing money."""
    grouped = gold.table("fact_trans", "account_id", "trans_type", "amount").groupBy("account_id").agg(
        total_if(c("trans_type") == "VYDAJ", c("amount")).alias("outgoing"), F.count("*").alias("txn_count")
    )
    found = grouped.where("outgoing > 0").select(
        "account_id", as_double(c("outgoing")).alias("outgoing_amount"), "txn_count"
    )
    return top_k(found, k, c("outgoing_amount").desc(), "account_id")


def monthly_loans(gold: Gold) -> DataFrame:
    month = F.trunc("loan_date", "MONTH").alias("loan_month")
    grouped = gold.table("fact_loan", "loan_date", "amount").groupBy(month).agg(
        F.count("*").alias("loan_count"), total(c("amount")).alias("t"), F.count("amount").alias("n")
    )
    return grouped.select(
        "loan_month",
        "loan_count",
        as_double(c("t")).alias("total_loan_amount"),
        ratio(c("t"), c("n")).alias("avg_loan_amount"),
    ).orderBy("loan_month")


def orders_by_purpose(gold: Gold) -> DataFrame:
    """Payment orders by purpose. A missing purpose is '(none)', an empty one its own group."""
    purpose = F.coalesce("k_symbol", F.lit("(none)")).alias("k_symbol")
    grouped = gold.table("fact_order", "k_symbol", "amount").groupBy(purpose).agg(
        F.count("*").alias("order_count"), total(c("amount")).alias("t"), F.count("amount").alias("n")
    )
    return grouped.select(
        "k_symbol",
        "order_count",
        as_double(c("t")).alias("total_amount"),
        ratio(c("t"), c("n")).alias("avg_amount"),
    ).orderBy(c("total_amount").desc(), "k_symbol")


def card_penetration(gold: Gold) -> DataFrame:
    """Share of each district's clients who hold a card."""
    cards = _current(gold, "dim_card", "disp_id")
    holders = (
        _current(gold, "dim_disp", "disp_id", "client_id")
        .join(cards, "disp_id", "left_semi")
        .select(c("client_id").alias("holder"))
        .distinct()
    )
    clients = _current(gold, "dim_client", "client_id", "district_id")
    flagged = clients.join(holders, c("client_id") == c("holder"), "left")
    # A current client is one row, and so is a holder: plain counts, reduced per task, are enough.
    per_district = flagged.groupBy("district_id").agg(
        F.count("*").alias("total_clients"), F.count("holder").alias("clients_with_card")
    )
    return _at_district(per_district, gold).select(
        "region",
        "district_name",
        "total_clients",
        "clients_with_card",
        ratio(c("clients_with_card"), c("total_clients")).alias("card_penetration_ratio"),
    ).orderBy(c("card_penetration_ratio").desc(), "region", "district_name")


def client_summary(gold: Gold) -> DataFrame:
    """Every current client with account, loan, order and transaction totals and last activity."""
    clients = _current(gold, "dim_client", "client_id", "birth_number", "district_id")
    accounts = _current(gold, "dim_account", "account_id")
    held = (
        _current(gold, "dim_disp", "client_id", "account_id")
        .join(accounts, "account_id", "left_semi")
        .groupBy("client_id")
        .agg(F.count_distinct("account_id").alias("accounts"))
    )
    wide = clients.join(held, "client_id", "left")
    many, amount = F.count("*"), total(c("amount"))
    wide = with_sums(wide, gold, "fact_loan", ["amount", "loan_date"], loans=many, loaned=amount, last_loan=F.max("loan_date"))
    wide = with_sums(wide, gold, "fact_order", ["amount", "ingest_ts"], orders=many, ordered=amount, last_order=F.max("ingest_ts"))
    wide = with_sums(wide, gold, "fact_trans", ["amount", "trans_date"], trans=many, net=amount, last_trans=F.max("trans_date"))
    zero, never = F.lit(0).cast("bigint"), F.lit("1900-01-01").cast("date")
    return wide.select(
        "client_id",
        "birth_number",
        c("district_id").alias("client_district_id"),
        F.coalesce("accounts", zero).alias("account_count"),
        F.coalesce("loans", zero).alias("loan_count"),
        or_zero(c("loaned")).alias("total_loan_amount"),
        F.coalesce("orders", zero).alias("order_count"),
        or_zero(c("ordered")).alias("total_order_amount"),
        F.coalesce("trans", zero).alias("trans_count"),
        or_zero(c("net")).alias("net_trans_amount"),
        F.greatest(
            F.coalesce("last_loan", never),
            F.coalesce(c("last_order").cast("date"), never),
            F.coalesce("last_trans", never),
        ).alias("last_activity_date"),
    )


def _daily_region(gold: Gold, as_of: Column | None, days: int) -> DataFrame:
    recent = gold.table("fact_trans", "district_id", "trans_date", "amount").where(
        since(c("trans_date"), _today(as_of), days=days)
    )
    per_key = recent.groupBy("district_id", "trans_date").agg(total(c("amount")).alias("t"))
    return _at_district(per_key, gold).groupBy("region", "trans_date").agg(F.sum("t").alias("t"))


def _rolling(daily: DataFrame, frame) -> DataFrame:
    return frame(daily, "region", "trans_date", "t", 30, "r").select(
        "region",
        "trans_date",
        as_double(c("t")).alias("daily_amount"),
        as_double(c("r")).alias("rolling_30d_amount"),
    ).orderBy("region", "trans_date")


def rolling_region_days(gold: Gold, as_of: Column | None = None) -> DataFrame:
    """Regional volume over the 30 calendar days up to each day of the last 120."""
    return _rolling(_daily_region(gold, as_of, 120), rolling_days)


def rolling_region_rows(gold: Gold, as_of: Column | None = None) -> DataFrame:
    """As ``rolling_region_days``, but over the last 30 days that had any volume."""
    return _rolling(_daily_region(gold, as_of, 120), rolling_rows)


def active_districts(gold: Gold, as_of: Column | None = None, k: int = 20) -> DataFrame:
    """Districts with the most distinct borrowers in the last six months."""
    recent = gold.table("fact_loan", "client_id", "district_id", "loan_date").where(
        since(c("loan_date"), _today(as_of), months=6)
    )
    borrowers = recent.groupBy("district_id").agg(F.count_distinct("client_id").alias("active_loan_clients"))
    named = _at_district(borrowers, gold).select("region", "district_name", "active_loan_clients")
    return top_k(named, k, c("active_loan_clients").desc(), "region", "district_name")


# Upper bounds and labels of the loan segments.
DURATION_BUCKETS = [(12, "0-12m"), (36, "13-36m"), (60, "37-60m")]
DURATION_REST = "60m+"
AMOUNT_BUCKETS = [(50000, "<50k"), (150000, "50k-150k"), (300000, "150k-300k")]
AMOUNT_REST = "300k+"


def bucket(value: Column, bounds, rest: str, inclusive: bool) -> Column:
    """The label of the first bound that ``value`` stays within, or ``rest``."""
    label = F
    for limit, name in bounds:
        label = label.when(value <= limit if inclusive else value < limit, F.lit(name))
    return label.otherwise(F.lit(rest))


def loan_segments(gold: Gold) -> DataFrame:
    loans = gold.table("fact_loan", "duration", "amount", "status").select(
        bucket(c("duration"), DURATION_BUCKETS, DURATION_REST, True).alias("duration_bucket"),
        bucket(c("amount"), AMOUNT_BUCKETS, AMOUNT_REST, False).alias("amount_bucket"),
        "status",
        "amount",
    )
    keys = ["duration_bucket", "amount_bucket", "status"]
    grouped = loans.groupBy(*keys).agg(
        F.count("*").alias("loan_count"), total(c("amount")).alias("t"), F.count("amount").alias("n")
    )
    return grouped.select(
        *keys,
        "loan_count",
        as_double(c("t")).alias("total_amount"),
        ratio(c("t"), c("n")).alias("avg_amount"),
    ).orderBy(*keys)


def profitability(gold: Gold, k: int = 50) -> DataFrame:
    """Clients with the greatest transaction net less loans and payment orders."""
    wide = _current(gold, "dim_client", "client_id", "birth_number")
    for fact, name in (("fact_loan", "loaned"), ("fact_order", "ordered"), ("fact_trans", "net")):
        wide = with_sums(wide, gold, fact, ["amount"], **{name: total(c("amount"))})
    none = money(F.lit(0))
    loaned, ordered, net = (F.coalesce(c(n), none) for n in ("loaned", "ordered", "net"))
    scored = wide.select(
        "client_id",
        "birth_number",
        as_double(loaned).alias("total_loan_outflow"),
        as_double(ordered).alias("total_order_outflow"),
        as_double(net).alias("net_trans_amount"),
        as_double(net - loaned - ordered).alias("profitability_proxy"),
    )
    return top_k(scored, k, c("profitability_proxy").desc(), "client_id")
