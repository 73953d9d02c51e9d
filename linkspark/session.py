"""SparkSession construction with settings suited to both local tests and clusters."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings applied only when the session does not already define them.  On a
# cluster the deployment's spark-defaults win; locally these keep tests fast.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "linkspark") -> SparkSession:
    """Return the active session or build a local one for tests / benchmarks."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or os.environ.get("LINKSPARK_MASTER", "local[*]"))
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions",
                             str(shuffle_partitions or os.environ.get("LINKSPARK_SHUFFLE_PARTITIONS", "8")))
    builder = builder.config("spark.driver.memory", os.environ.get("LINKSPARK_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; where it is unset, make a scratch one for a local
    master (tests) and refuse on a cluster, whose machines share no temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="linkspark-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
