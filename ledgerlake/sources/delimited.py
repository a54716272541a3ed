"""Semicolon-delimited text with one header line, every column a string."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


BROKEN = "_broken"


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    sep: str = ";",
    keep_quotes: bool = False,
    broken: bool = False,
) -> DataFrame:
    """Read one table. ``keep_quotes`` leaves the quote characters in the values; a separator inside quotes then ends a
    value. ``broken`` adds a column that holds the whole line where it has too few or too many values. Records do
    not span lines, so large files are split between tasks."""
    if broken:
        schema = StructType([*schema.fields, StructField(BROKEN, StringType())])
    reader = spark.read.schema(schema).option("sep", sep).option("header", True)
    if keep_quotes:
        reader = reader.option("quote", "")
    if broken:
        reader = reader.option("columnNameOfCorruptRecord", BROKEN)
    return reader.csv(path)
