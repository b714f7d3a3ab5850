"""Spark session settings used by tests, the bench and the examples.

On a cluster the session is created by the platform; everything in the
library only *reads* settings from it. ``checkpoint_dir`` follows that rule:
it returns the shared folder named by ``spark.checkpoint.dir`` and only
creates a scratch one when the setting is absent (local tests).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for every plan in the library: AQE re-plans joins and
# coalesces small shuffle partitions at run time, skew-join splits hot keys,
# UTC keeps timestamps comparable with parquet's TIMESTAMP_NTZ.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# Suggested settings for a large cluster (the library never sets them; it
# reads the session it is given). Shuffle partitions are an upper bound that
# AQE coalesces to ~256 MB each; skewed partitions (a key with a third of the
# rows) are split by the skew-join rule; files are read in 256 MB splits.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediate tables.

    This is the folder that the cluster names in ``spark.checkpoint.dir``. A
    session on a cluster must name one: a folder made here would be on one
    machine only. Only a local master, as in tests, gets a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
