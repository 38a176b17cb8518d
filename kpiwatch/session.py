"""Local session for tests, tools and the benchmark.  On a cluster, use the
session the platform provides; nothing in the library creates one."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  scratch: str | None = None, app: str = "kpiwatch") -> SparkSession:
    """``local[cores]`` session with AQE on, UTC, no UI.

    The warehouse directory goes to a fresh scratch folder.  The checkpoint
    folder is the one the installation names in ``spark.checkpoint.dir``; only
    when none is named is a scratch one set, as tests need one.
    """
    scratch = scratch or tempfile.mkdtemp(prefix="kpiwatch-")
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               # Percentile merges are CPU-heavy for their few bytes; with the
               # 1 MB default AQE packs a small backfill's merge into one task.
               .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", os.environ.get("KPIWATCH_DRIVER_MEMORY", "8g"))
               .config("spark.sql.warehouse.dir", f"{scratch}/warehouse"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        spark.sparkContext.setCheckpointDir(named or f"{scratch}/checkpoints")
    return spark
