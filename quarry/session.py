"""Session helpers: a sane local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session or build a local one (tests, bench).

    On a cluster the session already exists and nothing here overrides it.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName("quarry")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir`` (or the context's
    checkpoint dir).  Only when neither is set and Spark runs in one process
    (``local[...]``: tests, bench) is a temporary folder created and registered
    as the checkpoint dir; on a cluster, where executors could not see it, that
    is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        ctx_dir = spark.sparkContext.getCheckpointDir()
        base = ctx_dir
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/quarry/{purpose}-{uuid.uuid4().hex}"
