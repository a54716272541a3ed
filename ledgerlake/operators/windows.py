"""Latest row per key and rolling sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def latest(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The row of each key that is greatest by ``order``, NULLs smallest; ties go to the greater of
    the remaining columns, so the result does not depend on row order.

    As an aggregate it reduces every key to one row per task before the shuffle, whatever share of
    the rows a key holds, and needs no sort by the order columns.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    best = df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_best"))
    return best.select(key, "_best.*").select(*df.columns)


def top_per_key(df: DataFrame, key: str, n: int, *order: str) -> DataFrame:
    """The ``n`` greatest rows of each key. A bound on ``row_number()`` lets Spark drop the other
    rows of a key in each task before the shuffle."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def rolling_days(df: DataFrame, part: str, day: str, value: str, days: int, out: str) -> DataFrame:
    """Sum over the calendar ``days`` ending at each row's day, for rows already one per day."""
    w = Window.partitionBy(part).orderBy(F.unix_date(day)).rangeBetween(-(days - 1), 0)
    return df.withColumn(out, F.sum(value).over(w))


def rolling_rows(df: DataFrame, part: str, day: str, value: str, rows: int, out: str) -> DataFrame:
    """Sum over the last ``rows`` rows; differs from ``rolling_days`` where days are missing."""
    w = Window.partitionBy(part).orderBy(day).rowsBetween(-(rows - 1), 0)
    return df.withColumn(out, F.sum(value).over(w))
