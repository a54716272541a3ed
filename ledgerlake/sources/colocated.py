"""Gold tables stored by a hash of the client in the catalog, so that sums and joins per client need no exchange of facts.

A fact is dealt into as many buckets as asked for, each sorted by client. A bucket is read by one task, so a client (or the missing one) that holds more
rows than a bucket's fair share would make one task slow: there are fewer such clients than buckets, and their rows are kept in a
plain table beside it, which any number of tasks read and reduce before the shuffle. A client is in one of the two parts.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlake.schemas import GOLD, GOLD_FACTS
from ledgerlake.sources.tables import Gold

KEY = "client_id"
HEAVY = "_heavy"


def heavy_clients(rows: DataFrame, buckets: int) -> Column:
    """Whether a row's client holds more than one in ``buckets`` of all rows; fewer than ``buckets`` clients reach the driver."""
    # One pass: the number of all rows is the sum of the clients'.
    counted = rows.groupBy(KEY).agg(F.count("*").alias("n"))
    whole = counted.agg(F.sum("n").alias("whole"))
    found = [r[0] for r in counted.join(whole, F.col("n") > F.col("whole") / buckets).select(KEY).collect()]
    if not found:
        return F.lit(False)
    known = F.coalesce(F.col(KEY).isin([k for k in found if k is not None]), F.lit(False))
    return known | F.col(KEY).isNull() if None in found else known


def colocate(spark: SparkSession, gold: Gold, database: str, buckets: int | None = None, names: Iterable[str] = tuple(GOLD)) -> None:
    """Store gold tables in the catalog; those with a client by its hash, facts of heavy clients apart. ``buckets``: as many as shuffle partitions."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in names:
        rows, table = gold.table(name), f"{database}.{name}"
        if KEY not in rows.columns:
            rows.write.mode("overwrite").saveAsTable(table)
            continue
        heavy = heavy_clients(rows, buckets) if name in GOLD_FACTS else F.lit(False)
        if name in GOLD_FACTS:
            rows.where(heavy).write.mode("overwrite").saveAsTable(table + HEAVY)
        # A task a bucket, so that a bucket is one file.
        rows.where(~heavy).repartition(buckets, KEY).write.mode("overwrite").bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(table)


class ColocatedGold:
    """Gold tables as ``colocate`` stores them."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database

    def parts(self, name: str, *columns: str) -> list[DataFrame]:
        """The rows of usual clients and those of heavy ones; other tables are one part."""
        found = [self.spark.table(f"{self.database}.{n}") for n in ([name, name + HEAVY] if name in GOLD_FACTS else [name])]
        return [df.select(*columns) if columns else df for df in found]

    def table(self, name: str, *columns: str) -> DataFrame:
        usual, *heavy = self.parts(name, *columns)
        return usual.unionByName(heavy[0]) if heavy else usual


def parts_of(gold: Gold, name: str, *columns: str) -> list[DataFrame]:
    """Parts of a table between which no client is shared."""
    return gold.parts(name, *columns) if isinstance(gold, ColocatedGold) else [gold.table(name, *columns)]


def with_sums(wide: DataFrame, gold: Gold, name: str, columns: list[str], **sums: Column) -> DataFrame:
    """Add a fact's sums per client to rows of clients; NULL where the client has no rows."""
    usual, *heavy = (df.groupBy(KEY).agg(*[v.alias(k) for k, v in sums.items()]) for df in parts_of(gold, name, KEY, *columns))
    wide = wide.join(usual, KEY, "left")
    for part in heavy:
        # Fewer rows than buckets.
        few = F.broadcast(part.select(KEY, *[F.col(k).alias(f"heavy_{k}") for k in sums]))
        wide = wide.join(few, KEY, "left").withColumns({k: F.coalesce(k, f"heavy_{k}") for k in sums}).drop(*[f"heavy_{k}" for k in sums])
    return wide
