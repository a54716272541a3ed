"""Event streams into the customer-360 log, and the merged view over it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.plans import customer360 as C
from ledgerlake.schemas import CUSTOMER_360, struct
from ledgerlake.sinks import looked_up_by, overwrite, replace_partitions, write_next_version
from ledgerlake.sources.tables import last_committed, matching, read_current_version, remove
from ledgerlake.streaming.runner import run_stream

LOG_KEYS = ["stream_id", "kind", "batch_id"]
LOG_SCHEMA = T.StructType(
    CUSTOMER_360.fields + struct("stream_id STRING, kind STRING, batch_id BIGINT").fields
)
# The compacted table is stored by a hash of the client, so that a lookup reads one directory.
BUCKETS = 64
TABLE_SCHEMA = T.StructType(CUSTOMER_360.fields + struct("bucket INT").fields)
# The last batch of each stream and kind that a version of the table holds.
MARKS = struct("stream_id STRING, kind STRING, mark BIGINT")


class Reference(NamedTuple):
    """What an event is looked up in; ``scores`` may be None."""

    clients: DataFrame
    accounts: DataFrame
    scores: DataFrame | None = None


def start_customer360_stream(
    events: DataFrame,
    kind: str,
    load_reference: Callable[[SparkSession], Reference],
    log_path: str,
    checkpoint: str,
    *,
    stream_id: str = "main",
    **run_options,
) -> StreamingQuery:
    """Append each batch's latest record per client to a log.

    Replaying a batch replaces its partition. Late events do no harm: the merge compares event times. A batch without
    events writes nothing and looks nothing up.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        ref = load_reference(batch.sparkSession)
        records = C.shape(C.activity(batch, kind), kind, ref.clients, ref.accounts, ref.scores)
        append_records(records, log_path, kind, stream_id, batch_id)

    return run_stream(events, on_batch, checkpoint, **run_options)


def append_records(records: DataFrame, log_path: str, kind: str, stream_id: str, batch_id: int) -> None:
    """Store one batch's records, one per client, sorted by client and with a bloom filter. The same batch again replaces them."""
    own = {"stream_id": F.lit(stream_id), "kind": F.lit(kind), "batch_id": F.lit(batch_id).cast("bigint")}
    replace_partitions(records.withColumns(own), log_path, LOG_KEYS, order="client_id", **looked_up_by("client_id"))


def _bucket(client_id: Column) -> Column:
    return F.pmod(F.hash(client_id.cast("bigint")), F.lit(BUCKETS)).cast("int")


def _marks(spark: SparkSession, table_path: str, version: int) -> list[tuple[str, str, int]]:
    """A row per stream and kind."""
    if not version:
        return []
    rows = spark.read.schema(MARKS).parquet(f"{table_path}/marks={version}").collect()
    return [(r.stream_id, r.kind, r.mark) for r in rows]


def _log(spark: SparkSession, log_path: str, marks: list[tuple[str, str, int]] = ()) -> DataFrame:
    """The batches after the marks, selected by directory."""
    col = F.col
    late = [~((col("stream_id") == s) & (col("kind") == k) & (col("batch_id") <= m)) for s, k, m in marks]
    log = spark.read.schema(LOG_SCHEMA).parquet(log_path)
    return log.where(reduce(and_, late)) if late else log


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    return _log(spark, log_path).select(*CUSTOMER_360.names)


def customer360(spark: SparkSession, log_path: str, table_path: str | None = None) -> DataFrame:
    """One row per client: the compacted table, if there is one, merged with the batches since."""
    return _merged(spark, log_path, table_path, None)


def find_client(spark: SparkSession, log_path: str, table_path: str, client_id: int) -> DataFrame:
    """The record of one client, or no row: one bucket of the table, and the batches since.

    Of these, files and row groups that do not hold the client are passed over by their statistics and bloom filters, pages by the page index.
    """
    return _merged(spark, log_path, table_path, client_id)


def _merged(spark: SparkSession, log_path: str, table_path: str | None, client_id: int | None) -> DataFrame:
    version = last_committed(spark, table_path, "version") if table_path else 0
    log = _log(spark, log_path, _marks(spark, table_path, version)).select(*CUSTOMER_360.names)
    table = spark.read.schema(TABLE_SCHEMA).parquet(f"{table_path}/version={version}") if version else None
    if client_id is not None:
        log = C.point_lookup(log, client_id)
        if table is not None:
            table = C.point_lookup(table.where(F.col("bucket") == _bucket(F.lit(client_id))), client_id)
    return C.merge(log) if table is None else C.merge_latest(table.select(*CUSTOMER_360.names), log)


def compact(spark: SparkSession, log_path: str, table_path: str) -> str:
    """Write the table, merged with the batches since its last version, as its next version.

    The marks are written first: a version counts once it is complete, and then its marks are there. Batches are
    taken from one listing of the log, so those that arrive meanwhile are left to the next time.
    """
    version = last_committed(spark, table_path, "version")
    old = _marks(spark, table_path, version)
    since = _log(spark, log_path, old)
    marks = since.groupBy("stream_id", "kind").agg(F.max("batch_id").alias("mark"))
    marks = marks.union(spark.createDataFrame(old, MARKS)).groupBy("stream_id", "kind").agg(F.max("mark").alias("mark"))
    overwrite(marks, f"{table_path}/marks={version + 1}")
    updates = since.select(*CUSTOMER_360.names)
    table = read_current_version(spark, table_path, TABLE_SCHEMA)
    merged = C.merge(updates) if table is None else C.merge_latest(table.select(*CUSTOMER_360.names), updates)
    # A bucket's clients lie in order, so that pages have ranges of them.
    bucketed = merged.withColumn("bucket", _bucket(F.col("client_id"))).hint("rebalance", F.col("bucket"))
    ordered = bucketed.sortWithinPartitions("bucket", "client_id")
    return write_next_version(ordered, table_path, "bucket", **looked_up_by("client_id"))


def trim_log(spark: SparkSession, log_path: str, table_path: str) -> int:
    """Remove the batches that the version before the newest holds already; readers of either version keep
    what they need. Returns the number of batches removed."""
    version = last_committed(spark, table_path, "version") - 1
    marks = {(s, k): m for s, k, m in _marks(spark, table_path, max(version, 0))}
    done = 0
    for path in matching(spark, f"{log_path}/stream_id=*/kind=*/batch_id=*"):
        stream, kind, batch = (part.split("=", 1)[1] for part in path.split("/")[-3:])
        if int(batch) <= marks.get((stream, kind), -1):
            remove(spark, path)
            done += 1
    return done
