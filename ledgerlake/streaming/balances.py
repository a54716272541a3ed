"""Running totals per account that need no older facts, kept up to date by what each batch adds.

A batch stores its own sums per account and day. Folding keeps sums of two levels: per account and day, and per account and month. The total before a day
is the sum of the months before its month and of the days before it within the month, so an event that comes late, however late, changes one sum of each
level and shifts every total behind it without a row of later months being read or written. A fold writes the months its batches touch, as they then
are; a manifest says in which version each month is in force, and the last batch folded of each stream. What the manifest before the newest names stays
for readers that have begun. One fold of a table runs at a time.

A replayed batch replaces its part, and changes nothing once it is folded. A correction is a part of its own with signed differences.
Rows without a day come before all days; rows without an account form one of their own. Amounts that are no money count as zero.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

from ledgerlake.functions.money import money, total
from ledgerlake.plans.reports import carried, running_total
from ledgerlake.schemas import struct
from ledgerlake.sinks import replace_partitions
from ledgerlake.sources.tables import Gold, exists, last_committed, matching, remove

BATCH = ["stream_id", "batch_id"]
NO_DAY = "0000-00"  # the month of rows without a day
_SUM = DecimalType(28, 2)


def _with_total(columns: str, *more: str) -> StructType:
    return StructType([*struct(columns).fields, StructField("total", _SUM), *[f for m in more for f in struct(m).fields]])


PART = _with_total("account_id BIGINT, day DATE", "stream_id STRING, batch_id BIGINT")
LEVELS = {"days": _with_total("account_id BIGINT, day DATE", "month STRING"), "months": _with_total("account_id BIGINT", "month STRING")}
MANIFEST = struct("month STRING, written BIGINT, stream_id STRING, mark BIGINT")


class State(NamedTuple):
    """The version in which each month is in force, and the last folded batch of each stream."""

    months: dict[str, int]
    marks: dict[str, int]


def _month(day: Column) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(NO_DAY))


def _added(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.coalesce(F.sum("total"), F.lit(0)).cast(_SUM).alias("total"))


def sums(trans: DataFrame) -> DataFrame:
    """(account_id, day, total) of rows with account_id, trans_date and amount."""
    by_day = trans.groupBy(F.col("account_id").cast("bigint").alias("account_id"), F.col("trans_date").alias("day"))
    return by_day.agg(F.coalesce(total(F.col("amount")), F.lit(0)).cast(_SUM).alias("total"))


def difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """What turns the sums of some rows into those of their corrected versions. A difference of zero stays: its day may be new."""
    minus = sums(before).withColumn("total", (-F.col("total")).cast(_SUM))
    return _added(sums(after).unionByName(minus), "account_id", "day")


def write_part(part: DataFrame, path: str, stream_id: str, batch_id: int) -> None:
    """Store a batch's sums or a correction's differences. The same batch again replaces its part."""
    own = {"stream_id": F.lit(stream_id), "batch_id": F.lit(batch_id).cast("bigint")}
    replace_partitions(part.withColumns(own).select(*PART.names), path, BATCH)


def state(spark: SparkSession, table_path: str, version: int | None = None) -> State:
    """The newest manifest, or the one named: a row per month and one per stream."""
    found = version or last_committed(spark, f"{table_path}/manifest", "version")
    if not found:
        return State({}, {})
    rows = spark.read.schema(MANIFEST).parquet(f"{table_path}/manifest/version={found}").collect()
    return State({r.month: r.written for r in rows if r.month is not None}, {r.stream_id: r.mark for r in rows if r.month is None})


def _since(spark: SparkSession, path: str, now: State) -> DataFrame:
    """Parts that are not folded yet."""
    log = spark.read.schema(PART).parquet(path).select(*PART.names)
    for stream, mark in now.marks.items():
        log = log.where(~((F.col("stream_id") == stream) & (F.col("batch_id") <= mark)))
    return log


def _folded(spark: SparkSession, table_path: str, level: str, months: dict[str, int]) -> DataFrame:
    """Sums of a level in the months given, each in its version. No other month's files are listed or read."""
    schema = LEVELS[level]
    # A month whose sums of a level are all gone has no folder.
    paths = [p for m, v in sorted(months.items()) if exists(spark, p := f"{table_path}/{level}/version={v}/month={m}")]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{table_path}/{level}").parquet(*paths).select(*schema.names)


def fold(spark: SparkSession, path: str, table_path: str) -> list[str]:
    """Add the parts since to the months they touch, and return these."""
    if not exists(spark, path):
        return []
    version = last_committed(spark, f"{table_path}/manifest", "version")
    now = state(spark, table_path, version)
    since = _since(spark, path, now)
    marks = {r.stream_id: r.mark for r in since.groupBy("stream_id").agg(F.max("batch_id").alias("mark")).collect()}
    if not marks:
        return []
    # What arrives meanwhile waits for the next fold.
    upto = F.lit(False)
    for stream, mark in marks.items():
        upto |= (F.col("stream_id") == stream) & (F.col("batch_id") <= mark)
    fresh = since.where(upto).withColumn("month", _month(F.col("day")))
    touched = sorted(r.month for r in fresh.select("month").distinct().collect())  # as many as the calendar has
    number = version + 1
    old = _folded(spark, table_path, "days", {m: now.months[m] for m in touched if m in now.months})
    days = _added(old.unionByName(fresh.select(*old.columns)), "account_id", "day", "month")
    _write(days, f"{table_path}/days/version={number}")
    written = _folded(spark, table_path, "days", dict.fromkeys(touched, number))
    _write(_added(written, "account_id", "month"), f"{table_path}/months/version={number}")
    months = now.months | dict.fromkeys(touched, number)
    listed = [(m, v, None, None) for m, v in months.items()] + [(None, None, s, b) for s, b in (now.marks | marks).items()]
    spark.createDataFrame(listed, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{table_path}/manifest/version={number}")
    _clean(spark, table_path, version, {(v, m) for named in (now.months, months) for m, v in named.items()})
    return touched


def _write(rows: DataFrame, path: str) -> None:
    dealt = rows.hint("rebalance", F.col("month")).sortWithinPartitions("month", "account_id")
    dealt.write.mode("overwrite").partitionBy("month").parquet(path)


def _clean(spark: SparkSession, table_path: str, before: int, needed: set[tuple[int, str]]) -> None:
    """Remove months that neither of the two newest manifests names, and older manifests."""
    for level in LEVELS:
        for at in matching(spark, f"{table_path}/{level}/version=*/month=*"):
            version, month = (part.split("=", 1)[1] for part in at.split("/")[-2:])
            if (int(version), month) not in needed:
                remove(spark, at)
    for at in matching(spark, f"{table_path}/manifest/version=*"):
        if int(at.rsplit("=", 1)[1]) < before:
            remove(spark, at)


def before_days(spark: SparkSession, path: str, table_path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """(account_id, day, earlier): the total before each day with a sum. ``first`` and ``last`` (months, as in 2024-05) bound the days, and what of them is read."""
    now = state(spark, table_path)
    since = _since(spark, path, now).withColumn("month", _month(F.col("day")))

    def wanted(month: str) -> bool:
        return (first is None or month >= first) and (last is None or month <= last)

    of_day = _folded(spark, table_path, "days", {m: v for m, v in now.months.items() if wanted(m)})
    of_month = _folded(spark, table_path, "months", {m: v for m, v in now.months.items() if last is None or m <= last})
    inside = F.lit(True)
    if first is not None:
        inside &= F.col("month") >= first
    if last is not None:
        inside &= F.col("month") <= last
    days = _added(of_day.unionByName(since.where(inside).select(*of_day.columns)), "account_id", "month", "day")
    months = _added(of_month.unionByName(since.select(*of_month.columns)), "account_id", "month")
    # Windows over the months of one account and over the days of one month, which begin with the month's opening.
    opening = F.coalesce(F.sum("total").over(_preceding(["account_id"], "month")), F.lit(0))
    opened = months.withColumn("_start", opening).where(inside).select("account_id", "month", "_start")
    return carried(opened, days, ["account_id", "month"], "total", "day", upto=-1).select("account_id", "day", F.col("_carried").alias("earlier"))


def _preceding(part: list[str], order: str):
    return Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def account_running_total(
    gold: Gold, spark: SparkSession, path: str, table_path: str, first: str | None = None, last: str | None = None, block: int = 1_000_000
) -> DataFrame:
    """Transactions with ``running``, their account's total up to and with them. Of the facts only the months asked for are read.

    The sums must hold the batches that the fact table holds.
    """
    rows = gold.table("fact_trans", "account_id", "trans_date", "trans_id", "amount")
    # Plain comparisons of the date, so that they reach the file statistics.
    if first is not None:
        rows = rows.where(F.col("trans_date") >= F.lit(f"{first}-01").cast("date"))
    if last is not None:
        rows = rows.where(F.col("trans_date") <= F.last_day(F.lit(f"{last}-01").cast("date")))
    earlier = before_days(spark, path, table_path, first, last).withColumnRenamed("day", "trans_date")
    return running_total(rows, "account_id", "trans_date", "trans_id", money(F.col("amount")), "running", block, earlier)
