"""JSON events: the envelope, its decoding, and streams of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerlake.schemas import EVENTS

ENVELOPE = "value BINARY"


def event_stream(
    spark: SparkSession, topic: str, *, servers: str | None = None, path: str | None = None, **options
) -> DataFrame:
    """A streaming DataFrame with a binary ``value`` column, from the earliest event on.

    ``servers`` reads a Kafka topic (the connector must be on the class path; pass
    ``maxOffsetsPerTrigger`` to bound a batch). ``path`` reads envelopes stored as Parquet
    under ``path/topic``.
    """
    if (servers is None) == (path is None):
        raise ValueError("give either servers or path")
    if servers is not None:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
        )
        return reader.options(**options).load().select("value")
    return spark.readStream.schema(ENVELOPE).options(**options).parquet(f"{path}/{topic}")


def to_envelope(df: DataFrame) -> DataFrame:
    """One JSON document per row, as the bytes a topic would carry."""
    return df.select(F.to_json(F.struct("*")).cast("binary").alias("value"))


def parse_json(df: DataFrame, schema: StructType) -> DataFrame:
    """Decode ``value``. Malformed documents give a row of NULLs, mistyped fields a NULL.

    ``inline`` yields the fields as columns of one generator, so a document is decoded once however
    many filters and expressions use them; fields of a selected struct would be decoded per use.
    """
    body = F.from_json(F.col("value").cast("string"), schema)
    return df.select(F.inline(F.array(body)))


def parse_events(df: DataFrame, kind: str, *columns: str) -> DataFrame:
    """Events of a kind; naming the columns needed spares decoding the others."""
    schema = EVENTS[kind]
    if columns:
        schema = StructType([schema[name] for name in columns])
    return parse_json(df, schema)
