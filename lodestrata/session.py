"""Sessions for tests and benchmarks, and the shared folder long jobs cut their lineage in."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "lodestrata", cores: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session; a cluster brings its own and needs none of these settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str | None:
    """The checkpoint folder the cluster names, or None where it names none."""
    return spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder name every executor can reach; a machine-local one only where there is one machine."""
    base = shared_folder(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/lodestrata-{uuid.uuid4().hex}"
