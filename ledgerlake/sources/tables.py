"""Tables of the lake, by layer and name.

A job asks for a gold table and the columns it needs; ``StoredGold`` reads them from
Parquet or the catalog, ``FrameGold`` takes them from DataFrames at hand.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple, Protocol

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerlake.schemas import GOLD, GOLD_DIMENSIONS, struct


class Gold(Protocol):
    def table(self, name: str, *columns: str) -> DataFrame: ...


def read_table(spark: SparkSession, layer: str, name: str, root: str | None = None) -> DataFrame:
    """``layer.name`` from the catalog, or the directory ``root/layer/name``: its newest version if it has any."""
    if root is None:
        return spark.table(f"{layer}.{name}")
    base = f"{root}/{layer}/{name}"
    newest = last_committed(spark, base, "version")
    return spark.read.parquet(f"{base}/version={newest}" if newest else base)


def _at(spark: SparkSession, path: str):
    """The file system of a path, and the path as that file system takes it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def modified(spark: SparkSession, path: str) -> int:
    """When a file was last written, in milliseconds."""
    fs, at = _at(spark, path)
    return fs.getFileStatus(at).getModificationTime()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    fs, at = _at(spark, pattern)
    return [m.getPath().toString() for m in fs.globStatus(at) or []]


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.mkdirs(at)


def partition_path(spark: SparkSession, base: str, **values) -> str:
    """The directory of one partition, its values escaped as Spark's writers do."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join([base, *[f"{k}={escape(str(v))}" for k, v in values.items()]])


def read_staged(spark: SparkSession, base: str, table: str, schema: StructType) -> DataFrame:
    """Copied Parquet files read against a declared schema (no footer inference)."""
    return spark.read.schema(schema).parquet(f"{base}/{table}")


def last_committed(spark: SparkSession, base: str, label: str) -> int:
    """Number of the newest complete ``base/label=N``, or 0.

    A directory counts once its ``_SUCCESS`` marker exists, so a job that died half way leaves the
    previous state in force, and no job writes to the path it reads.
    """
    markers = matching(spark, f"{base}/{label}=*/_SUCCESS")
    return max([int(m.split("/")[-2].split("=")[1]) for m in markers], default=0)


def read_current_version(spark: SparkSession, base: str, schema: StructType) -> DataFrame | None:
    newest = last_committed(spark, base, "version")
    return spark.read.schema(schema).parquet(f"{base}/version={newest}") if newest else None


def read_history(spark: SparkSession, base: str, schema: StructType, current_only: bool = False) -> DataFrame | None:
    """A dimension written by ``write_history_load``: the newest load's current rows and the rows
    closed by any load so far."""
    newest = last_committed(spark, base, "load")
    if not newest:
        return None
    stored = StructType(schema.fields + struct("load INT").fields)
    rows = spark.read.schema(stored).parquet(base)
    in_force = F.col("is_current") & (F.col("load") == newest)
    closed = ~F.col("is_current") & (F.col("load") <= newest)
    return rows.where(in_force if current_only else in_force | closed).select(*schema.names)


# Beside a fact table's batches: what compaction has folded, and the manifests that say which of it counts.
CLUSTERED = "_clustered"
MANIFEST = struct("segment BIGINT, level INT, stream_id STRING, mark BIGINT")


class Segments(NamedTuple):
    """Clustered segments of a fact table in force: their paths, levels, and the last folded batch of each stream."""

    paths: list[str]
    levels: list[int]
    marks: dict[str, int]


def fact_segments(spark: SparkSession, base: str, version: int | None = None) -> Segments | None:
    """What the newest manifest (or the one named) lists: a row per segment and one per stream, however many batches were folded."""
    found = version or last_committed(spark, f"{base}{CLUSTERED}/manifest", "version")
    if not found:
        return None
    rows = spark.read.schema(MANIFEST).parquet(f"{base}{CLUSTERED}/manifest/version={found}").collect()
    parts = sorted((r.segment, r.level) for r in rows if r.segment is not None)
    return Segments(
        [f"{base}{CLUSTERED}/segment={n}" for n, _ in parts],
        [level for _, level in parts],
        {r.stream_id: r.mark for r in rows if r.segment is None},
    )


def with_stream(schema: StructType) -> StructType:
    """A fact table's columns as stored: batches are told apart by stream, too."""
    return StructType(schema.fields + struct("stream_id STRING").fields)


def read_fact_table(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    """A fact table's rows with their stream: clustered segments, and the batches that these do not hold yet."""
    stored = with_stream(schema)
    batches = spark.read.schema(stored).parquet(base)
    segments = fact_segments(spark, base)
    if segments is None:
        return batches.select(*stored.names)
    for stream, mark in segments.marks.items():
        batches = batches.where(~((F.col("stream_id") == stream) & (F.col("batch_id") <= mark)))
    return spark.read.schema(stored).parquet(*segments.paths).select(*stored.names).unionByName(batches.select(*stored.names))


def stored_parts(spark: SparkSession, base: str) -> list[tuple[list[str], str]]:
    """What makes up a stored table's present state: folders, and a condition on their partition columns for the rows that count."""
    if version := last_committed(spark, base, "version"):
        return [([f"{base}/version={version}"], "true")]
    if load := last_committed(spark, base, "load"):
        return [([base], f"is_current AND load = {load} OR NOT is_current AND load <= {load}")]
    parts = []
    segments = fact_segments(spark, base)
    if segments:
        parts.append((segments.paths, "true"))
    if matching(spark, f"{base}/*.parquet") or matching(spark, f"{base}/*/*.parquet") or matching(spark, f"{base}/*/*/*.parquet"):
        held = segments.marks if segments else {}
        names = {s: s.replace("\\", "\\\\").replace("'", "\\'") for s in held}
        since = [f"NOT (CAST(stream_id AS STRING) = '{names[s]}' AND batch_id <= {mark})" for s, mark in held.items()]
        parts.append(([base], " AND ".join(since) or "true"))
    return parts


class StoredGold:
    """Gold tables of the catalog or, given ``root``, of the directory ``root/gold``."""

    def __init__(self, spark: SparkSession, root: str | None = None, layer: str = "gold"):
        self.spark, self.root, self.layer = spark, root, layer

    def table(self, name: str, *columns: str) -> DataFrame:
        df = self._read(name)
        return df.select(*columns) if columns else df

    def _read(self, name: str) -> DataFrame:
        if self.root is None:
            return read_table(self.spark, self.layer, name)
        base = f"{self.root}/{self.layer}/{name}"
        if name not in GOLD_DIMENSIONS:
            return read_fact_table(self.spark, base, GOLD[name]).select(*GOLD[name].names)
        rows = read_history(self.spark, base, GOLD_DIMENSIONS[name])
        return self.spark.createDataFrame([], GOLD_DIMENSIONS[name]) if rows is None else rows


class FrameGold:
    def __init__(self, frames: Mapping[str, DataFrame]):
        self.frames = frames

    def table(self, name: str, *columns: str) -> DataFrame:
        df = self.frames[name]
        return df.select(*columns) if columns else df
