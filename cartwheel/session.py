"""Session settings shared by tests, bench and the build job.

Library code never creates a session; callers pass one in.  ``configure``
applies the SQL settings the models rely on to an existing session.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every model assumes: UTC day boundaries, ANSI arithmetic (so the
# models must use try_divide for safe division), adaptive execution with skew
# splitting.  Broadcast joins are left to Spark's size-checked planner.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    # a join on (user, month) may keep a partitioning on user alone (cohort grid)
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


#: Most shuffled bytes that adaptive execution puts into one task.  Rows of ids and money take 5 to 10 times
#: their shuffled size in sorts and hash tables, so a task of Spark's 64 MB holds gigabytes where several meet.
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
TASK_MB = 16
#: Partitions an exchange begins with, which adaptive execution then merges up to TASK_MB.  With the few that
#: ``spark.sql.shuffle.partitions`` may name, a task's share would grow with the input: merging never splits.
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITIONS = 1024


def size_mb(size: str) -> float:
    """Megabytes of a Spark byte size such as ``64MB``, ``16m``, ``64k`` or ``67108864b``."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)i?b?", size.strip().lower()).groups()
    return int(number) * 1024.0 ** (" kmgtp".index(unit or " ") - 2)


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    if size_mb(spark.conf.get(ADVISORY)) > TASK_MB:  # a smaller size that the caller set is kept
        spark.conf.set(ADVISORY, f"{TASK_MB}m")
    if int(spark.conf.get(INITIAL, None) or 0) < PARTITIONS:  # a larger number that the caller set is kept
        spark.conf.set(INITIAL, str(PARTITIONS))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: the cluster's ``spark.checkpoint.dir``.

    Only a ``local`` session that names none (tests) gets a scratch folder; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current and not sc.master.startswith("local"):
        raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
    if not current:
        current = tempfile.mkdtemp(prefix="cartwheel-ckpt-")
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cartwheel") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    shuffle_partitions = shuffle_partitions or cores
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.driver.memory", os.environ.get("CARTWHEEL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32m")
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark
