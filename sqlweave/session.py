"""Session and scratch-location helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "sqlweave",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every job here assumes.

    AQE stays on: it coalesces the many small shuffle partitions of the per-statement
    jobs and splits skewed join partitions at run time.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage; it is read from the session.
    Only when it is unset (local tests) a folder of our own is made and registered.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="sqlweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location below the shared folder (one per run)."""
    return f"{shared_dir(spark)}/sqlweave/{name}-{uuid.uuid4().hex}"
