"""Spark session helpers.

On a cluster the session is created by the platform; ``get_spark`` only fills
in settings that are still unset, so cluster-level choices always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings this library relies on. Only applied when the session leaves them unset.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, partitions: int | None = None,
              app: str = "parley", driver_memory: str | None = None) -> SparkSession:
    """Return the active session, creating a local one when there is none."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and stream state.

    Read from ``spark.checkpoint.dir``; a temporary folder is only chosen when
    the setting is absent (local runs and tests), never on a configured cluster.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="parley-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Per-query checkpoint location under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "streams", name)
