"""Transaction counts and volumes per branch and month, kept up to date by what each batch adds.

A batch stores its own sums per district and month; a late event adds to the month it belongs to, a replayed batch replaces its part, and a correction is
a part of its own that holds signed differences. Sums are exact, so parts add up in any order. Folding writes one row per stream and key, with the stream's
last folded batch; a load costs its own size and a report the size of the table and the parts since, however many facts lie behind them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

from ledgerlake.functions.money import as_double, total
from ledgerlake.operators.combine import lookup
from ledgerlake.schemas import struct
from ledgerlake.sinks import replace_partitions, write_next_version
from ledgerlake.sources.tables import Gold, exists, last_committed

KEYS = ["district_id", "month"]
BATCH = ["stream_id", "batch_id"]
_SUM = DecimalType(28, 2)
SCHEMA = StructType(
    [
        *struct("district_id BIGINT, month DATE, trans_count BIGINT").fields,
        StructField("volume", _SUM),
        *struct("stream_id STRING, batch_id BIGINT").fields,
    ]
)


def sums(trans: DataFrame) -> DataFrame:
    """(district_id, month, trans_count, volume) of rows with district_id, trans_date and amount."""
    by_month = trans.groupBy("district_id", F.trunc("trans_date", "MONTH").alias("month"))
    return by_month.agg(F.count("*").alias("trans_count"), total(F.col("amount")).cast(_SUM).alias("volume"))


def _added(parts: DataFrame, *keys: str) -> DataFrame:
    return parts.groupBy(*keys).agg(F.sum("trans_count").alias("trans_count"), F.sum("volume").cast(_SUM).alias("volume"))


def difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """What turns the sums of some rows into those of their corrected versions; keys without a change are left out."""
    minus = sums(before).select(*KEYS, (-F.col("trans_count")).alias("trans_count"), (-F.col("volume")).cast(_SUM).alias("volume"))
    changed = (F.col("trans_count") != 0) | (F.coalesce("volume", F.lit(0)) != 0)
    return _added(sums(after).unionByName(minus), *KEYS).where(changed)


def write_part(part: DataFrame, path: str, stream_id: str, batch_id: int) -> None:
    """Store a batch's sums or a correction's differences. The same batch again replaces its part."""
    own = {"stream_id": F.lit(stream_id), "batch_id": F.lit(batch_id).cast("bigint")}
    replace_partitions(part.withColumns(own).select(*SCHEMA.names), path, BATCH)


def _parts(spark: SparkSession, path: str, table_path: str | None) -> DataFrame:
    """The folded table, and the parts that it does not hold."""
    log = spark.read.schema(SCHEMA).parquet(path).select(*SCHEMA.names)
    version = last_committed(spark, table_path, "version") if table_path else 0
    if not version:
        return log
    table = spark.read.schema(SCHEMA).parquet(f"{table_path}/version={version}")
    # A row per stream; its marks become conditions on the parts' directories.
    for stream, mark in table.groupBy("stream_id").agg(F.max("batch_id")).collect():
        log = log.where(~((F.col("stream_id") == stream) & (F.col("batch_id") <= mark)))
    return table.unionByName(log)


def fold(spark: SparkSession, path: str, table_path: str) -> str | None:
    """Write one row per stream and key as the table's next version. Every row carries the last batch of its stream."""
    if not exists(spark, path):
        return None
    parts = _parts(spark, path, table_path)
    marks = parts.groupBy("stream_id").agg(F.max("batch_id").alias("batch_id"))
    return write_next_version(_added(parts, "stream_id", *KEYS).join(marks, "stream_id").select(*SCHEMA.names), table_path)


def monthly_by_branch(gold: Gold, spark: SparkSession, path: str, table_path: str | None = None) -> DataFrame:
    """The report of ``reports.monthly_by_branch`` from the sums; no fact is read."""
    names = gold.table("dim_district", "district_id", "district_name", "is_current").where("is_current")
    named = lookup(_added(_parts(spark, path, table_path), *KEYS), names, "district_id", "inner", branch="district_name")
    by_branch = _added(named, "branch", "month").where("trans_count <> 0")
    return by_branch.select("branch", "month", "trans_count", as_double(F.col("volume")).alias("volume"))
