"""SQL sources: run a query over catalog/temp views, or over JDBC.

``run_sql`` is the Spark form of "run any SQL against a named database and get
a table": the text is planned by Catalyst over registered views. For a remote
database, ``read_jdbc`` builds a parallel JDBC read; credentials come from
Spark configuration (``spark.quarry.jdbc.user`` / ``spark.quarry.jdbc.password``),
never from the URL text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, sql: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    for name, frame in (views or {}).items():
        frame.createOrReplaceTempView(name)
    return spark.sql(sql)


def db_url(db_name: str, host: str, dialect: str = "mysql", port: int | None = None) -> str:
    """JDBC URL for a database (no credentials in the text)."""
    hostport = f"{host}:{port}" if port else host
    return f"jdbc:{dialect}://{hostport}/{db_name}"


def read_jdbc(spark: SparkSession, url: str, query: str | None = None, table: str | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetch_size: int = 10_000,
              options: Mapping[str, str] | None = None) -> DataFrame:
    """Read from a JDBC database.

    With ``table`` and a numeric ``partition_column`` the read is split into
    ``num_partitions`` parallel range queries and Spark pushes filters and
    column pruning into them; a free-form ``query`` is read as one subquery.
    """
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query / table")
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetch_size))
    user = spark.conf.get("spark.quarry.jdbc.user", None)
    password = spark.conf.get("spark.quarry.jdbc.password", None)
    if user:
        reader = reader.option("user", user)
    if password:
        reader = reader.option("password", password)
    if query is not None:
        reader = reader.option("query", query)
    else:
        reader = reader.option("dbtable", table)
        if partition_column:
            reader = (reader.option("partitionColumn", partition_column)
                      .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                      .option("numPartitions", str(num_partitions or 8)))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()
