"""Joins and unions that the jobs have in common."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def stack(frames) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def lookup(
    df: DataFrame, dim: DataFrame, key: str, how: str = "left", *, dim_key: str | None = None, **columns: str
) -> DataFrame:
    """Add dimension columns to rows that may be heavily skewed on ``key``.

    ``columns`` maps new names to columns of ``dim``, whose rows are unique by ``dim_key`` (``key``
    if not given). There is no broadcast hint: Spark broadcasts a dimension measured below the
    session's threshold, and for a larger one splits the skewed partitions of ``df`` at run time.
    """
    side = dim.select(
        F.col(dim_key or key).alias("_dim_key"), *[F.col(c).alias(n) for n, c in columns.items()]
    )
    return df.join(side, F.col(key) == F.col("_dim_key"), how).drop("_dim_key")


def left_current(df: DataFrame, dim: DataFrame, key: str, **columns: str) -> DataFrame:
    """``lookup`` against the rows of ``dim`` now in force."""
    return lookup(df, dim.where("is_current"), key, **columns)


def key_in(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(keys.select(key), key, "left_semi")


def key_not_in(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key, possibly NULL, does not occur in ``keys``."""
    return df.join(keys.select(key), key, "left_anti")


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """The first ``k`` rows; ``order`` must end in a tie-breaker to be repeatable."""
    return df.orderBy(*order).limit(k)


def numbered(df: DataFrame, *order: Column, label: str) -> DataFrame:
    """All rows in a global order with their ``place`` in it, from 1.

    No task sees all rows: the sort deals them by ranges, each range is numbered by itself, and the ranges' sizes (a row each) say where each begins.
    ``label`` is a folder for the sorted rows, so that they are dealt once.
    """
    whole = F.monotonically_increasing_id()
    sizes_by = F.shiftright(whole, 33)
    df.orderBy(*order).select("*", sizes_by.alias("_range"), (whole - F.shiftleft(sizes_by, 33)).alias("_at")).write.parquet(label)
    rows = df.sparkSession.read.parquet(label)
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(starts, "_range").select(*df.columns, (F.col("_before") + F.col("_at") + 1).alias("place"))
