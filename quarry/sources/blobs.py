"""Synthetic Gaussian blobs as a Spark source (test fixture for k-means)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def make_blobs(spark: SparkSession, n: int = 300, centers: int = 4, std: float = 0.7,
               dims: int = 2, seed: int = 0, box: tuple[float, float] = (-10.0, 10.0),
               partitions: int = 4) -> DataFrame:
    """``n`` points around ``centers`` random centres drawn uniformly in
    ``box``; columns ``id, x0..x{dims-1}, true_cluster``. Generated on the
    executors from ``spark.range``; deterministic for a fixed ``partitions``."""
    lo, hi = box
    cen = spark.range(0, centers, 1, 1).select(
        F.col("id").cast("int").alias("true_cluster"),
        *[(F.rand(seed * 1000 + d) * (hi - lo) + lo).alias(f"c{d}") for d in range(dims)])
    pts = spark.range(0, n, 1, partitions).withColumn(
        "true_cluster", F.pmod(F.col("id"), F.lit(centers)).cast("int"))
    out = pts.join(F.broadcast(cen), "true_cluster")
    return out.select(
        "id", *[(F.col(f"c{d}") + F.randn(seed * 1000 + 500 + d) * std).alias(f"x{d}")
                for d in range(dims)], "true_cluster")
