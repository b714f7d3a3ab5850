"""File sources and sinks: CSV in/out and the read-through snapshot."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             index_col: bool = False, header: bool = True) -> DataFrame:
    """Read CSV (local path or any Hadoop-compatible URI). Declare ``schema``
    for large inputs; inference costs an extra pass. ``index_col`` drops the
    leading row-label column that a pandas ``to_csv`` writes."""
    reader = spark.read.option("header", header)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    if index_col:
        df = df.drop(df.columns[0])
    return df


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on any Hadoop-compatible file system."""
    try:
        spark.read.text(path).limit(0).collect()
        return True
    except AnalysisException:
        return False


def snapshot(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read-through cache: read the parquet dataset at ``path`` if it was
    written completely (its ``_SUCCESS`` marker exists), else build it, write
    it and read it back. A folder left by a failed build has no marker and is
    rebuilt.

    Parquet keeps the types that a CSV round trip loses.
    """
    if _exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        return spark.read.parquet(path)
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
