"""Session settings the jobs rely on, and shared scratch space."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings only, so they can be applied to a session somebody else created.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A partition this large that also exceeds its peers is split between tasks.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    # Split a hot key even when a later aggregate then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Stored tables take less room than with the default, and are read as fast.
    "spark.sql.parquet.compression.codec": "zstd",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings that results (UTC, ANSI) and skewed joins (AQE) depend on."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "ledgerlake", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    partitions = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh directory path below the shared folder the cluster names.

    ``spark.checkpoint.dir`` is the folder every executor can reach. Only where driver and executors
    are one process may it be unset: there, any local folder is shared. A cluster has to name one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        shared = tempfile.mkdtemp(prefix="ledgerlake-")
        spark.conf.set("spark.checkpoint.dir", shared)  # one folder per session
    return f"{shared.rstrip('/')}/ledgerlake/{label}-{uuid.uuid4().hex}"
