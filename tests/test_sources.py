"""Sources and sinks: SQL over views, CSV round trip, snapshot, JDBC options."""

import os
import tempfile

import pytest

from quarry.sources import files, sql, tables

from conftest import SF001


def _scratch():
    return tempfile.mkdtemp(prefix="quarry-test-")


def test_run_sql_over_views(spark):
    tables.register_views(spark, SF001, ["customer", "nation"])
    df = sql.run_sql(spark, "SELECT n_name, count(*) AS n FROM customer "
                            "JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
    assert df.agg({"n": "sum"}).first()[0] == tables.read_table(spark, SF001, "customer").count()


def test_csv_roundtrip_with_index_column(spark):
    path = os.path.join(_scratch(), "data.csv")
    df = spark.createDataFrame([(0, 1, "a", None), (1, 2, "", "2017-01-02")],
                               "idx int, k int, s string, d string")
    files.write_csv(df.coalesce(1), path)
    back = files.read_csv(spark, path, index_col=True)
    assert back.columns == ["k", "s", "d"]
    rows = sorted(back.collect(), key=lambda r: r["k"])
    assert rows[0]["s"] == "a" and rows[1]["s"] is None          # '' reads back as NULL
    assert str(back.schema["d"].dataType) == "DateType()"


def test_snapshot_builds_once(spark):
    path = os.path.join(_scratch(), "snap")
    calls = []

    def build():
        calls.append(1)
        return tables.read_table(spark, SF001, "region")

    a = files.snapshot(spark, path, build)
    b = files.snapshot(spark, path, build)
    assert len(calls) == 1 and a.count() == b.count() == 5
    assert os.path.exists(os.path.join(path, "_SUCCESS"))


def test_jdbc_reader_arguments(spark):
    assert sql.db_url("analytics", "db.example", port=3306) == "jdbc:mysql://db.example:3306/analytics"
    with pytest.raises(ValueError):
        sql.read_jdbc(spark, "jdbc:mysql://h/db", query="select 1", table="t")


def test_snapshot_rebuilds_incomplete_folder(spark):
    path = os.path.join(_scratch(), "partial")
    tables.read_table(spark, SF001, "nation").write.parquet(path)
    os.remove(os.path.join(path, "_SUCCESS"))            # as if the job died before commit
    out = files.snapshot(spark, path, lambda: tables.read_table(spark, SF001, "region"))
    assert out.count() == 5 and os.path.exists(os.path.join(path, "_SUCCESS"))


def test_materialize_writes_under_checkpoint_dir(spark):
    from quarry.plans.materialize import materialize
    from quarry.session import checkpoint_dir
    def norm(p):
        return "/" + p.replace("file:", "").lstrip("/")

    base = norm(checkpoint_dir(spark)).rstrip("/")
    df = materialize(tables.read_table(spark, SF001, "region"), "region_copy")
    paths = df.inputFiles()
    assert df.count() == 5 and paths
    assert all(norm(p).startswith(base + "/quarry-tables/region_copy-") for p in paths)
