"""Lenient parsing. A value that does not parse becomes NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DIGITS = "^[0-9]+$"
SIX_DIGITS = "^[0-9]{6}$"


def to_long(c: Column) -> Column:
    return c.try_cast("bigint")


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def to_whole(c: Column) -> Column:
    """An INT from text; a fraction is cut off, not rounded."""
    return c.try_cast("decimal(38,6)").try_cast("int")


def compact_date(c: Column) -> Column:
    """A DATE from ``yyMMdd``."""
    return F.try_to_date(c, "yyMMdd")


def compact_timestamp(c: Column) -> Column:
    """A TIMESTAMP from ``yyMMdd HH:mm:ss``."""
    return F.try_to_timestamp(c, F.lit("yyMMdd HH:mm:ss"))


def iso_date(c: Column) -> Column:
    return c.try_cast("date")


def iso_timestamp(c: Column) -> Column:
    return c.try_cast("timestamp")


def strip_quotes(df: DataFrame) -> DataFrame:
    """Remove every double quote from every column."""
    return df.select(*[F.replace(F.col(f"`{c}`"), F.lit('"'), F.lit("")).alias(c) for c in df.columns])


def pad_to(df: DataFrame, schema) -> DataFrame:
    """Select the columns of ``schema`` in its order; those that ``df`` lacks become typed NULLs."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
