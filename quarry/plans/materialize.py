"""Materialise an intermediate result as a parquet table in the shared
checkpoint folder and read it back.

Workflows with several data-dependent steps run many small statistics jobs
over the same intermediate frame; without a cut each job would recompute the
joins and aggregates below it. A parquet table (rather than an RDD
checkpoint) keeps column pruning and filter pushdown for the jobs that read
it, survives the loss of executors, and is written by every executor in
parallel. Its size is known to the planner, which so broadcasts only what is
below Spark's byte limit. The folder is the cluster's ``spark.checkpoint.dir``.

A table lives as long as the frames that may read it, which the driver cannot
know; all of them are deleted when it ends.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from quarry.session import checkpoint_dir

_TABLES: dict[str, SparkSession] = {}


@atexit.register
def _drop_tables() -> None:
    for path, spark in list(_TABLES.items()):
        with contextlib.suppress(Exception):
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/quarry-tables/{name}-{uuid.uuid4().hex}"
    _TABLES[path] = spark
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
