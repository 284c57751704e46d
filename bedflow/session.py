"""Session helpers for tests, the bench and local runs.

On a cluster the session is created by the platform; the library only reads
its settings (for example ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "bedflow") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BEDFLOW_DRIVER_MEMORY", "16g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by the session in
    ``spark.checkpoint.dir``.  Only a local session without one gets a scratch
    folder; a cluster without one fails here instead of writing to local disks."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by driver and executors")
        folder = tempfile.mkdtemp(prefix="bedflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")
