"""Parquet table access for the driver's star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register tables as temp views so ``spark.sql`` text can name them."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a Structured Streaming file source (schema taken from
    the batch table; a glob over the file with ``basePath`` lets the stream
    source read a single-file table)."""
    path = table_path(sf_dir, name)
    schema = spark.read.parquet(path).schema
    return (spark.readStream.schema(schema).option("basePath", sf_dir.rstrip("/"))
            .parquet(path[:-1] + "[" + path[-1] + "]"))
