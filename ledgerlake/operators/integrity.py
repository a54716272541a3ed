"""Primary-key, foreign-key and row-count checks, each a small DataFrame."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlake.operators.combine import stack


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet counts come from file footers."""
    session = spark.newSession()
    for name, value in {"sources.useV1SourceList": "", "parquet.aggregatePushdown": "true"}.items():
        session.conf.set(f"spark.sql.{name}", value)
    return session


def stored_count(session: SparkSession, paths: list[str], condition: str) -> DataFrame:
    """row_count of some folders; the condition may use partition columns only, so that no row is read."""
    return session.read.parquet(*paths).where(condition).agg(F.count("*").alias("row_count"))


def stored_counts(spark: SparkSession, tables: Mapping[str, list[tuple[list[str], str]]]) -> DataFrame:
    """(table_name, row_count) of stored Parquet tables by their parts, from footers. One number per part comes to the driver; a part without files has none."""
    session = footer_session(spark)
    found = [(name, sum(stored_count(session, *part).first()[0] or 0 for part in parts)) for name, parts in tables.items()]
    return spark.createDataFrame(found, "table_name STRING, row_count BIGINT")


def orphans(child: DataFrame, parent: DataFrame, child_key: Column, parent_key: Column) -> DataFrame:
    """Distinct child keys without a parent and how many rows carry each.

    Rows are counted per key before the join, so a key that holds most of the table reaches the
    shuffle as one row per task. A NULL key has no parent.
    """
    keys = child.groupBy(child_key.alias("key")).agg(F.count("*").alias("rows"))
    known = parent.select(parent_key.alias("key"))
    return keys.join(known, "key", "left_anti")


def fk_check(name: str, child: DataFrame, parent: DataFrame, child_key: Column, parent_key: Column) -> DataFrame:
    """(check_name, bad_fk): rows of ``child`` whose key has no parent."""
    bad = orphans(child, parent, child_key, parent_key)
    return bad.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("bad_fk")).select(
        F.lit(name).alias("check_name"), "bad_fk"
    )


def fact_fk(name: str, fact: DataFrame, parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per parent: (``name_parent``, bad_fk), from one scan of the fact.

    The keys of a row are unfolded into (parent, key) pairs that are counted before the shuffle;
    one join then settles all checks.
    """
    pairs = key_pairs(name, fact.withColumn("weight", F.lit(1)), {p: key for p, (_, key) in parents.items()})
    return pairs_fk(pairs, parents, [f"{name}_{p}" for p in parents])


def key_pairs(name: str, rows: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """(check_name, parent, key, weight) of each row's keys (parent -> column); a row stands for ``weight`` rows."""
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(f"{name}_{p}").alias("check_name"), F.lit(p).alias("parent"), F.col(key).cast("bigint").alias("key"))
                for p, key in keys.items()
            ]
        )
    )
    return rows.select(pairs.alias("p"), F.col("weight").cast("bigint").alias("weight")).select("p.*", "weight")


def pairs_fk(pairs: DataFrame, parents: Mapping[str, tuple[DataFrame, str]], names: list[str]) -> DataFrame:
    """(check_name, bad_fk) for each of ``names``: weights of the pairs whose key its parent does not have."""
    counted = pairs.groupBy("check_name", "parent", "key").agg(F.sum("weight").alias("rows"))
    known = stack([df.select(F.lit(p).alias("parent"), F.col(key).cast("bigint").alias("key")) for p, (df, key) in parents.items()])
    bad = counted.join(known, ["parent", "key"], "left_anti").select("check_name", "rows")
    # A check without violations still reports its zero.
    listed = F.explode(F.array(*[F.lit(n) for n in names]))
    zeros = pairs.sparkSession.range(1).select(listed.alias("check_name"), F.lit(0).cast("bigint").alias("rows"))
    return bad.unionByName(zeros).groupBy("check_name").agg(F.sum("rows").cast("bigint").alias("bad_fk"))


def pk_check(df: DataFrame, key: str) -> DataFrame:
    """(total_rows, distinct_keys); equal when ``key`` is unique and never NULL."""
    return df.agg(F.count("*").alias("total_rows"), F.count_distinct(F.col(key)).alias("distinct_keys"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table."""
    return stack(
        [
            df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ]
    )
