"""Folding finished batches of a gold fact table into segments clustered by date.

A stream appends batches; a compaction folds those it has not folded yet into one new segment, whose files are ranges of dates. Segments have levels:
``fan`` segments of a level are folded into one of the next, so that each row is rewritten once per level and the number of segments stays
logarithmic. A manifest lists the segments in force and, per stream, the last batch they hold (the mark); readers take the newest complete manifest
and the batches behind its marks. Nothing is removed that the manifest before the newest needs, so running readers finish. One compaction of a table
runs at a time.

The newest batch of each stream stays out, unless ``all_batches`` is set: a restart may write it again. A batch that is written again after it
was folded changes nothing.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from ledgerlake.schemas import GOLD_FACTS
from ledgerlake.sinks import clustered
from ledgerlake.sources.tables import CLUSTERED, MANIFEST, Segments, fact_segments, last_committed, matching, remove, with_stream
from ledgerlake.streaming.fact_stream import DATED

FAN = 8


def _stored_batches(spark: SparkSession, base: str) -> list[tuple[str, int, str]]:
    """(stream, batch, path) of the batches that lie in the table's folder; their directories alone are listed."""
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found = []
    for at in matching(spark, f"{base}/stream_id=*/batch_id=*"):
        stream, batch = (part.split("=", 1)[1] for part in at.split("/")[-2:])
        found.append((unescape(stream), int(batch), at))
    return found


def compact_facts(
    spark: SparkSession, base: str, kind: str, *, fan: int = FAN, all_batches: bool = False, **writer_options
) -> int:
    """Fold finished batches; returns how many. Files of a segment follow its size; ``writer_options`` go to Spark's Parquet writer."""
    schema = GOLD_FACTS[f"fact_{kind}"]
    version = last_committed(spark, f"{base}{CLUSTERED}/manifest", "version")
    now = fact_segments(spark, base, version) if version else Segments([], [], {})
    done, marks = 0, dict(now.marks)
    batches: dict[str, list[int]] = {}
    for stream, batch, _ in _stored_batches(spark, base):
        batches.setdefault(stream, []).append(batch)
    for stream, stored in batches.items():
        finished = [b for b in stored if b > now.marks.get(stream, -1) and (all_batches or b < max(stored))]
        if finished:
            marks[stream] = max(finished)
            done += len(finished)
    if not done:
        return 0
    fresh = F.lit(False)
    for stream, mark in marks.items():
        fresh |= (F.col("stream_id") == stream) & (F.col("batch_id") > now.marks.get(stream, -1)) & (F.col("batch_id") <= mark)
    rows = spark.read.schema(with_stream(schema)).parquet(base).select(*with_stream(schema).names).where(fresh)

    # As with carrying in addition: a full level is folded into the next one, together with what is new.
    kept, level = list(zip(now.paths, now.levels, strict=True)), 0
    while len(same := [path for path, at in kept if at == level]) + 1 >= fan:
        rows = rows.unionByName(spark.read.schema(rows.schema).parquet(*same))
        kept = [(path, at) for path, at in kept if at != level]
        level += 1
    number = 1 + max([int(p.rsplit("=", 1)[1]) for p in matching(spark, f"{base}{CLUSTERED}/segment=*")], default=0)
    path = f"{base}{CLUSTERED}/segment={number}"
    clustered(rows, DATED[kind]).write.options(**writer_options).parquet(path)

    listed = [(int(p.rsplit("=", 1)[1]), at, None, None) for p, at in [*kept, (path, level)]]
    listed += [(None, None, stream, mark) for stream, mark in marks.items()]
    manifest = f"{base}{CLUSTERED}/manifest/version={version + 1}"
    spark.createDataFrame(listed, MANIFEST).coalesce(1).write.mode("overwrite").parquet(manifest)
    _clean(spark, base, version)
    return done


def _clean(spark: SparkSession, base: str, before: int) -> None:
    """Remove manifests older than ``before``, segments that neither it nor the newest lists, and batches that it holds already."""
    if not before:
        return
    needed = fact_segments(spark, base).paths + fact_segments(spark, base, before).paths
    names = {p.rsplit("/", 1)[1] for p in needed}
    for at in matching(spark, f"{base}{CLUSTERED}/segment=*"):
        if at.rsplit("/", 1)[1] not in names:
            remove(spark, at)
    for at in matching(spark, f"{base}{CLUSTERED}/manifest/version=*"):
        if int(at.rsplit("=", 1)[1]) < before:
            remove(spark, at)
    marks = fact_segments(spark, base, before).marks
    for stream, batch, at in _stored_batches(spark, base):
        if batch <= marks.get(stream, -1):
            remove(spark, at)
