"""Event streams into silver and gold fact tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerlake.plans.facts import drifted_fields, gold_fact, rejected_events, silver_fact
from ledgerlake.schemas import GOLD_FACTS, SILVER_FACTS
from ledgerlake.sinks import replace_partitions
from ledgerlake.sources.tables import exists, partition_path, read_fact_table, with_stream
from ledgerlake.streaming import balances, rollup
from ledgerlake.streaming.runner import run_stream

# batch_id restarts at 0 with a fresh checkpoint, so stored batches are told apart by stream too.
BATCH_KEYS = ["stream_id", "batch_id"]
# The column that reports select by: gold files are sorted by it.
DATED = {"loan": "loan_date", "order": "ingest_ts", "trans": "trans_date"}


def read_facts(spark: SparkSession, path: str, kind: str, layer: str = "gold") -> DataFrame:
    """A fact table written by ``start_fact_stream``, compacted or not."""
    if layer == "gold":
        return read_fact_table(spark, path, GOLD_FACTS[f"fact_{kind}"])
    return spark.read.schema(_batch_schema(kind)).parquet(path)


def _batch_schema(kind: str) -> StructType:
    return with_stream(SILVER_FACTS[f"fact_{kind}"])


def read_drift(spark: SparkSession, path: str) -> DataFrame:
    """The fields kept beside a silver table, by stream and batch."""
    return spark.read.schema("event_id BIGINT, field STRING, known BOOLEAN, value VARIANT, stream_id STRING, batch_id BIGINT").parquet(path)


def write_gold_batch(gold: DataFrame, path: str, kind: str, stream_id: str, batch_id: int) -> None:
    """Store one batch of gold facts as a unit of its own, a few files sorted by date however many dates it has. A replay replaces it."""
    own = {"stream_id": F.lit(stream_id), "batch_id": F.lit(batch_id).cast("bigint")}
    replace_partitions(gold.withColumns(own), path, BATCH_KEYS, cluster=DATED[kind])


def read_batch(spark: SparkSession, path: str, kind: str, stream_id: str, batch_id: int) -> DataFrame | None:
    """One batch of a silver table. Its directory alone is listed, however many batches there are."""
    at = partition_path(spark, path, stream_id=stream_id, batch_id=batch_id)
    if not exists(spark, at):
        return None
    return spark.read.schema(_batch_schema(kind)).option("basePath", path).parquet(at)


def start_fact_stream(
    events: DataFrame,
    kind: str,
    load_accounts: Callable[[SparkSession], DataFrame],
    silver_path: str,
    gold_path: str,
    checkpoint: str,
    *,
    rejects_path: str | None = None,
    sums_path: str | None = None,
    balances_path: str | None = None,
    drift_path: str | None = None,
    stream_id: str = "main",
    **run_options,
) -> StreamingQuery:
    """Write each batch to silver, then enrich the stored batch into gold; keep its rejects, the fields that silver has no
    column for, and what it adds to the monthly sums and
    account balances of transactions, if given their paths.

    Gold is built from the silver partition just written, so events are decoded once and a lost
    executor costs a read of stored files. All writes replace the batch's own partitions: a replay
    leaves one copy. ``load_accounts`` is called per batch and sees the newest dimension.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = {"stream_id": F.lit(stream_id), "batch_id": F.lit(batch_id).cast("bigint")}
        replace_partitions(silver_fact(batch, kind, batch_id).withColumns(own), silver_path, BATCH_KEYS)
        if rejects_path:
            replace_partitions(rejected_events(batch, kind).withColumns(own), rejects_path, BATCH_KEYS)
        if drift_path:
            replace_partitions(drifted_fields(batch, kind).withColumns(own), drift_path, BATCH_KEYS)
        stored = read_batch(spark, silver_path, kind, stream_id, batch_id)
        if stored is None:
            return
        write_gold_batch(gold_fact(stored, load_accounts(spark), kind), gold_path, kind, stream_id, batch_id)
        if sums_path:
            rollup.write_part(rollup.sums(stored), sums_path, stream_id, batch_id)
        if balances_path:
            balances.write_part(balances.sums(stored), balances_path, stream_id, batch_id)

    return run_stream(events, on_batch, checkpoint, **run_options)
