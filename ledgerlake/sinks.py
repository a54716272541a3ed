"""Writers. Each can be repeated: a second run replaces what the first one wrote."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerlake.schemas import BRONZE, GOLD, LOAN_SCORES, REJECT_TAIL, SILVER, SILVER_FACTS
from ledgerlake.sources.tables import CLUSTERED, exists, fact_segments, last_committed, matching, read_staged, remove


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a whole table."""
    df.write.mode("overwrite").parquet(path)


def clustered(df: DataFrame, column: str, *before: str) -> DataFrame:
    """Rows dealt by ranges of ``column`` and sorted by it within a file, so that statistics of files, row groups and pages tell its values.

    The number of files follows the size; ``before`` are columns that the writer needs sorted first.
    """
    return df.repartitionByRange(F.col(column).asc_nulls_first()).sortWithinPartitions(*before, column)


def looked_up_by(column: str) -> dict[str, str]:
    """Writer options for a table whose rows are found by ``column``, a value of which occurs once in a file: a bloom filter that is as large as the
    file's values need, and no dictionary, which would stand in its place and be as large as the column."""
    return {
        f"parquet.bloom.filter.enabled#{column}": "true",
        "parquet.bloom.filter.adaptive.enabled": "true",
        f"parquet.enable.dictionary#{column}": "false",
    }


def replace_partitions(df: DataFrame, path: str, keys, cluster: str | None = None, order: str | None = None, **writer_options) -> None:
    """Write only the partitions that occur in ``df``, replacing those and leaving the rest.

    A replayed micro-batch or a repeated daily load therefore leaves one copy of its rows. The number of files follows
    the size of a partition, not the number of cores or tasks before it. With ``cluster`` the files are ranges of that column and sorted by it; with ``order`` each
    file is only sorted by it, which spares the pass that finds the ranges.
    """
    dealt = clustered(df, cluster, *keys) if cluster else df.hint("rebalance", *[F.col(k) for k in keys])
    if order:
        dealt = dealt.sortWithinPartitions(*keys, order)
    (
        dealt.write.mode("overwrite")
        .options(partitionOverwriteMode="dynamic", **writer_options)
        .partitionBy(*keys)
        .parquet(path)
    )


def append_rejects(rejected: DataFrame, path: str, run_date: date) -> None:
    """Keep rejected or warned rows by run date; loading the same date again replaces its rows, even by none."""
    overwrite(rejected.drop("dq_date"), f"{path}/dq_date={run_date.isoformat()}")


def write_scores(scores: DataFrame, path: str) -> None:
    """Keep scores by run; scoring the same run again replaces it."""
    replace_partitions(scores, path, ["run_id"])


def export_tables(tables: Mapping[str, DataFrame], base: str) -> None:
    """Write each table as plain Parquet under ``base/name``."""
    for name, df in tables.items():
        overwrite(df, f"{base}/{name}")


def import_tables(
    spark: SparkSession, base: str, target: str, schemas: Mapping[str, StructType]
) -> dict[str, DataFrame]:
    """Load staged Parquet under declared schemas into ``target/name`` and return the result."""
    loaded = {}
    for name, schema in schemas.items():
        overwrite(read_staged(spark, base, name, schema), f"{target}/{name}")
        loaded[name] = read_staged(spark, target, name, schema)
    return loaded


def write_next_version(df: DataFrame, base: str, *partitions: str, **writer_options) -> str:
    """Write ``df`` as the next version; ``df`` may read the current one.

    Readers see the old version until the new one is complete. The version before it stays for those that have begun
    to read; older ones are removed.
    """
    spark = df.sparkSession
    number = last_committed(spark, base, "version") + 1
    path = f"{base}/version={number}"
    df.write.mode("overwrite").options(**writer_options).partitionBy(*partitions).parquet(path)
    for old in matching(spark, f"{base}/version=*"):
        if int(old.rsplit("=", 1)[1]) < number - 1:
            remove(spark, old)
    return path


def write_history_load(rows: DataFrame, base: str) -> str:
    """Write one load's current and newly closed rows, in one job and one commit.

    Earlier closed rows stay in the loads that closed them, so a load costs as much as the rows
    in force, however long the history is.
    """
    path = f"{base}/load={last_committed(rows.sparkSession, base, 'load') + 1}"
    rows.write.mode("overwrite").partitionBy("is_current").parquet(path)
    return path


def layer_tables() -> dict[str, dict[str, StructType]]:
    """Every table of the lake, by database."""
    rejects = {f"dq_{n}": StructType(BRONZE[n].fields + REJECT_TAIL.fields) for n in SILVER}
    return {
        "bronze": {f"{n}_bronze": s for n, s in BRONZE.items()},
        "silver": {**{f"{n}_silver": s for n, s in SILVER.items()}, **rejects, **SILVER_FACTS},
        "gold": {**GOLD, "loan_default_scores": LOAN_SCORES},
    }


def ensure_layers(spark: SparkSession, root: str | None = None) -> None:
    """Create the databases and tables that do not exist yet.

    With ``root`` each table that the jobs have stored there is a view of its present state: the newest version, the
    rows of a history that count, or all partitions. Running this again after a load brings the views up to date.
    """
    for database, tables in layer_tables().items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name, schema in tables.items():
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            stored = root and _stored_state(spark, f"{root}/{database}/{name}", schema)
            if not stored:
                spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")
                continue
            # A table that an earlier call made before there was anything to see.
            if spark.catalog.tableExists(f"{database}.{name}") and spark.catalog.getTable(f"{database}.{name}").tableType != "VIEW":
                spark.sql(f"DROP TABLE {database}.{name}")
            spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {stored}")


def _stored_state(spark: SparkSession, base: str, schema: StructType) -> str | None:
    """The SELECT over what is stored below ``base``, or None."""
    if segments := fact_segments(spark, base):
        names = ",".join(f"segment={s.rsplit('=', 1)[1]}" for s in segments.paths)
        new = " AND ".join(f"NOT (CAST(stream_id AS STRING) = '{s}' AND batch_id <= {m})" for s, m in segments.marks.items())
        columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
        folded = f"SELECT {columns} FROM parquet.`{base}{CLUSTERED}/{{{names}}}`"
        # The batches' folder may have become empty, which says nothing of its columns.
        since = matching(spark, f"{base}/stream_id=*/batch_id=*/*.parquet")
        return folded + (f" UNION ALL SELECT {columns} FROM parquet.`{base}` WHERE {new}" if since else "")
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
    if version := last_committed(spark, base, "version"):
        return f"SELECT {columns} FROM parquet.`{base}/version={version}`"
    if load := last_committed(spark, base, "load"):
        return f"SELECT {columns} FROM parquet.`{base}` WHERE is_current AND load = {load} OR NOT is_current AND load <= {load}"
    return f"SELECT {columns} FROM parquet.`{base}`" if exists(spark, base) else None


def with_tags(df: DataFrame, **tags) -> DataFrame:
    """Add constant columns such as a batch id."""
    return df.withColumns({name: F.lit(value) for name, value in tags.items()})
