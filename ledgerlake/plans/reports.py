"""Branch, client and model reports beside the marts. A branch is a district."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlake.functions.money import as_double, ratio, total
from ledgerlake.functions.rules import since
from ledgerlake.operators.combine import lookup
from ledgerlake.sources.tables import Gold

c = F.col


def _current(gold: Gold, name: str, *columns: str) -> DataFrame:
    return gold.table(name, *columns, "is_current").where("is_current").select(*columns)


def _branch_totals(rows: DataFrame, gold: Gold, *by: str) -> DataFrame:
    """Count and sum per branch and further columns, reduced by district id before the names join."""
    per_key = rows.groupBy("district_id", *by).agg(F.count("*").alias("n"), total(c("amount")).alias("t"))
    names = _current(gold, "dim_district", "district_id", "district_name")
    named = lookup(per_key, names, "district_id", "inner", branch="district_name")
    return named.groupBy("branch", *by).agg(F.sum("n").alias("trans_count"), as_double(F.sum("t")).alias("volume"))


def deposits_by_branch(gold: Gold, as_of: Column | None = None, days: int = 7) -> DataFrame:
    today = F.current_date() if as_of is None else as_of
    rows = gold.table("fact_trans", "district_id", "trans_type", "trans_date", "amount")
    recent = rows.where((c("trans_type") == "PRIJEM") & since(c("trans_date"), today, days=days))
    return (
        _branch_totals(recent, gold)
        .select("branch", c("trans_count").alias("num_deposits"), c("volume").alias("total_deposited"))
        .orderBy(c("total_deposited").desc(), "branch")
    )


def daily_by_branch(gold: Gold) -> DataFrame:
    return _branch_totals(gold.table("fact_trans", "district_id", "trans_date", "amount"), gold, "trans_date")


def monthly_by_branch(gold: Gold) -> DataFrame:
    """A table to refresh after each load; ``daily_by_branch`` rolled up the same way gives equal sums."""
    rows = gold.table("fact_trans", "district_id", "trans_date", "amount")
    return _branch_totals(rows.withColumn("month", F.trunc("trans_date", "MONTH")), gold, "month")


def daily_by_client(gold: Gold) -> DataFrame:
    rows = gold.table("fact_trans", "client_id", "trans_date", "amount")
    return rows.groupBy("client_id", "trans_date").agg(
        F.count("*").alias("trans_count"), as_double(total(c("amount"))).alias("volume")
    )


def volume_by_type(gold: Gold) -> DataFrame:
    rows = gold.table("fact_trans", "trans_date", "trans_type", "amount")
    return rows.groupBy("trans_date", "trans_type").agg(
        F.count("*").alias("trans_count"), as_double(total(c("amount"))).alias("volume")
    )


def clients_by_account_type(gold: Gold) -> DataFrame:
    """How many distinct clients hold an account of each statement frequency."""
    held = lookup(
        _current(gold, "dim_disp", "client_id", "account_id"),
        _current(gold, "dim_account", "account_id", "frequency"),
        "account_id",
        "inner",
        frequency="frequency",
    )
    return held.groupBy("frequency").agg(F.count_distinct("client_id").alias("clients"))


def high_value_high_risk(gold: Gold, ratings: DataFrame, minimum: float, segment: str = "High") -> DataFrame:
    """Clients above ``minimum`` whose rating (client_id, credit_score, risk_segment), read from
    another system, is in ``segment``."""
    totals = gold.table("fact_trans", "client_id", "amount").groupBy("client_id").agg(
        as_double(total(c("amount"))).alias("total_balance")
    )
    risky = ratings.where(c("risk_segment") == segment).select("client_id", "credit_score", "risk_segment")
    clients = _current(gold, "dim_client", "client_id", "birth_number")
    return totals.where(c("total_balance") > minimum).join(risky, "client_id").join(clients, "client_id")


def flag_large(trans: DataFrame, threshold: float) -> DataFrame:
    return trans.withColumn("is_large", F.coalesce(F.abs("amount") >= threshold, F.lit(False)))


def running_total(
    rows: DataFrame, key: str, day: str, id: str, value: Column, out: str, block: int = 1_000_000, before_days: DataFrame | None = None
) -> DataFrame:
    """Cumulative sum per ``key`` in order of day, id and amount, for keys of any size.

    One window over a key would put a busy account into one task. Here the sums are taken over days,
    over blocks of ids within a day, and over rows within a block, so no task sees more than one
    block of ids, the blocks of one day or the days of one key. Each level takes its start from the one above as the first row of its window. ``before_days`` (key, day, earlier) has the totals before
    the rows' days, if they are stored; the rows then need not be all rows of a key, but all of each of its days among them.
    """
    keyed = rows.withColumns({"_block": F.floor(c(id) / block), "_value": value})
    blocks = keyed.groupBy(key, day, "_block").agg(F.sum("_value").alias("_t"))
    if before_days is None:
        days = blocks.groupBy(key, day).agg(F.sum("_t").alias("_t"))
        before_days = days.withColumn("earlier", F.coalesce(F.sum("_t").over(_preceding([key], day)), F.lit(0)))
    opened = carried(before_days.select(key, day, c("earlier").alias("_start")), blocks, [key, day], "_t", "_block", upto=-1)
    starts = opened.select(key, day, "_block", c("_carried").alias("_start"))
    summed = carried(starts, keyed, [key, day, "_block"], "_value", id, "_value", upto=0)
    return summed.select(*rows.columns, c("_carried").alias(out))


def carried(starts: DataFrame, rows: DataFrame, part: list[str], value: str, *order: str, upto: int) -> DataFrame:
    """``rows`` with ``_carried``: what their part starts with (``part``, _start), plus ``value`` of its rows before (``upto`` -1) or up to and with (0) each.

    The start goes before a part's rows in one window, so rows are dealt once and no join by keys that may be NULL deals them again.
    A part without a start has no rows in the result.
    """
    first = starts.select(*part, "_start", F.lit(False).alias("_row"))
    both = rows.withColumn("_row", F.lit(True)).unionByName(first, allowMissingColumns=True)
    frame = Window.partitionBy(*part).orderBy("_row", *order).rowsBetween(Window.unboundedPreceding, upto)
    start, within = F.max("_start").over(frame), F.coalesce(F.sum(value).over(frame), F.lit(0))
    return both.withColumns({"_carried": start + within}).where(c("_row") & c("_carried").isNotNull()).select(*rows.columns, "_carried")


def _preceding(part: list[str], order: str):
    return Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def client_features(gold: Gold, as_of: Column | None = None) -> DataFrame:
    """Average monthly deposit, number of transactions and age in days of the oldest account."""
    today = F.current_date() if as_of is None else as_of
    rows = gold.table("fact_trans", "client_id", "trans_type", "trans_date", "amount")
    deposit = c("trans_type") == "PRIJEM"
    # One row per client and month first: the distinct months need no second pass over the fact.
    monthly = rows.groupBy("client_id", F.trunc("trans_date", "MONTH").alias("month")).agg(
        F.count("*").alias("n"),
        F.count(F.when(deposit, 1)).alias("deposits"),
        total(F.when(deposit, c("amount"))).alias("deposited"),
    )
    activity = monthly.groupBy("client_id").agg(
        F.sum("n").alias("trans_count"),
        ratio(F.sum("deposited"), F.count(F.when(c("deposits") > 0, 1))).alias("avg_monthly_deposit"),
    )
    opened = lookup(
        _current(gold, "dim_disp", "client_id", "account_id"),
        _current(gold, "dim_account", "account_id", "open_date"),
        "account_id",
        "inner",
        open_date="open_date",
    ).groupBy("client_id").agg(F.datediff(today, F.min("open_date")).alias("account_age_days"))
    clients = _current(gold, "dim_client", "client_id")
    return clients.join(activity, "client_id", "left").join(opened, "client_id", "left")


def masked_clients(clients: DataFrame) -> DataFrame:
    """Clients for readers who may not see personal numbers: the last four characters and a hash."""
    return clients.withColumns(
        {"birth_number": mask_tail(c("birth_number"), 4), "birth_hash": F.sha2(c("birth_number"), 256)}
    )


def mask_tail(value: Column, shown: int) -> Column:
    """All but the last ``shown`` characters replaced by an asterisk."""
    hidden = F.greatest(F.length(value) - shown, F.lit(0))
    return F.concat(F.repeat(F.lit("*"), hidden), F.substring(value, hidden + 1, F.lit(shown)))


def prediction_drift(scores: DataFrame) -> DataFrame:
    """Per scoring run, how often each actual status was predicted as each status."""
    return scores.groupBy("run_id", "actual_status", "pred_status").agg(F.count("*").alias("loans"))
