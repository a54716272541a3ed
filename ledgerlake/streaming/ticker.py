"""Activity in five-minute windows, kept up to date while events arrive."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DecimalType, StructField, StructType

from ledgerlake.functions.money import total
from ledgerlake.schemas import struct
from ledgerlake.sinks import replace_partitions, write_next_version
from ledgerlake.sources.tables import last_committed, make_folder, matching, modified, remove
from ledgerlake.streaming.runner import run_stream

KEYS = ["stream_id", "run", "batch_id"]
_WINDOW = StructType([*struct("window_start TIMESTAMP, events BIGINT").fields, StructField("volume", DecimalType(28, 2))])
SCHEMA = StructType(_WINDOW.fields + struct("stream_id STRING, run BIGINT, batch_id BIGINT").fields)


def windowed(events: DataFrame, width: str = "5 minutes") -> DataFrame:
    """(window_start, events, volume) of rows with ``ingest_ts`` and ``amount``; volume is exact."""
    grouped = events.groupBy(F.window("ingest_ts", width)).agg(
        F.count("*").alias("events"), total(F.col("amount")).cast(DecimalType(28, 2)).alias("volume")
    )
    return grouped.select(F.col("window.start").alias("window_start"), "events", "volume")


def start_ticker(
    events: DataFrame, path: str, checkpoint: str, *, width: str = "5 minutes", stream_id: str = "main", **run_options
) -> StreamingQuery:
    """Write what each batch adds to its windows.

    Parts add up, so there is no state to keep and no event comes too late to count. A replayed batch replaces its own
    part. ``run`` is the time at which the checkpoint was made, kept beside the output under the id that the checkpoint carries: it outlives
    restarts, copies and restored backups, and grows with each new checkpoint.
    """
    known: dict[str, int] = {}

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if stream_id not in known:
            known[stream_id] = _run_of(batch.sparkSession, path, checkpoint)
        run = known[stream_id]
        own = {"stream_id": F.lit(stream_id), "run": F.lit(run).cast("bigint"), "batch_id": F.lit(batch_id).cast("bigint")}
        replace_partitions(windowed(batch, width).withColumns(own), path, KEYS)

    return run_stream(events, on_batch, checkpoint, **run_options)


def _run_of(spark: SparkSession, path: str, checkpoint: str) -> int:
    query = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
    found = matching(spark, f"{path}_runs/{query}/run=*")
    if found:
        return int(found[0].rsplit("=", 1)[1])
    run = modified(spark, f"{checkpoint}/metadata")
    make_folder(spark, f"{path}_runs/{query}/run={run}")
    return run


def _log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def _with_table(spark: SparkSession, path: str, table_path: str | None) -> DataFrame:
    """(stream_id, run, window_start, events, volume, batch_id) of the log after the table's marks, and of the table."""
    log = _log(spark, path)
    version = last_committed(spark, table_path, "version") if table_path else 0
    if not version:
        return log
    table = spark.read.schema(SCHEMA).parquet(f"{table_path}/version={version}")
    held = table.groupBy("stream_id", "run").agg(F.max("batch_id").alias("mark"))
    since = log.join(held, ["stream_id", "run"], "left").where("mark IS NULL OR batch_id > mark")
    return table.unionByName(since.drop("mark"))


def _by_run(parts: DataFrame) -> DataFrame:
    return parts.groupBy("stream_id", "run", "window_start").agg(
        F.sum("events").alias("events"), F.sum("volume").cast(DecimalType(28, 2)).alias("volume"), F.max("batch_id").alias("batch_id")
    )


def read_ticker(spark: SparkSession, path: str, table_path: str | None = None) -> DataFrame:
    """Each window: of every stream what its newest run that has the window makes of it, then all streams together."""
    runs = _by_run(_with_table(spark, path, table_path))
    newest = runs.groupBy("stream_id", "window_start").agg(F.max(F.struct("run", "events", "volume")).alias("u"))
    return newest.groupBy("window_start").agg(F.sum("u.events").alias("events"), F.sum("u.volume").cast("double").alias("volume"))


def compact(spark: SparkSession, path: str, table_path: str) -> str:
    """Write one row per stream, run and window as the table's next version. Every row carries the last batch of its run
    that the table holds."""
    folded = _by_run(_with_table(spark, path, table_path))
    held = folded.groupBy("stream_id", "run").agg(F.max("batch_id").alias("mark"))
    marked = folded.drop("batch_id").join(held, ["stream_id", "run"]).withColumnRenamed("mark", "batch_id")
    return write_next_version(marked.select(*SCHEMA.names), table_path)


def trim(spark: SparkSession, path: str, table_path: str) -> int:
    """Remove the batches that the version before the newest holds; returns their number."""
    version = last_committed(spark, table_path, "version") - 1
    if version < 1:
        return 0
    table = spark.read.schema(SCHEMA).parquet(f"{table_path}/version={version}")
    marks = {(r.stream_id, r.run): r.mark for r in table.groupBy("stream_id", "run").agg(F.max("batch_id").alias("mark")).collect()}
    done = 0
    for at in matching(spark, f"{path}/stream_id=*/run=*/batch_id=*"):
        stream, run, batch = (part.split("=", 1)[1] for part in at.split("/")[-3:])
        if int(batch) <= marks.get((stream, int(run)), -1):
            remove(spark, at)
            done += 1
    return done
