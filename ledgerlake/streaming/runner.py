"""Start micro-batch queries and wait for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def run_stream(
    events: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    trigger_seconds: int = 30,
    until_caught_up: bool = False,
    output_mode: str = "append",
) -> StreamingQuery:
    """Call ``on_batch(batch, batch_id)`` for each micro-batch.

    ``until_caught_up`` processes what is there and stops; otherwise a batch starts every
    ``trigger_seconds``.
    """
    writer = (
        events.writeStream.foreachBatch(on_batch).outputMode(output_mode).option("checkpointLocation", checkpoint)
    )
    if until_caught_up:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()


def wait_all(queries) -> None:
    """Wait for every query to end; the failure of any stops the others and is raised."""
    queries = list(queries)
    try:
        for query in queries:
            while not query.awaitTermination(1):
                failed = [q for q in queries if not q.isActive and q.exception()]
                if failed:
                    raise failed[0].exception()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
