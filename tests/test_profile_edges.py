"""Hand-made edge frames: NULL vs NaN, all-missing and constant columns,
empty frames, half-to-even rounding, bin conventions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from quarry.functions.missing import is_missing, nan_to_null
from quarry.operators import profile

SCHEMA = StructType([StructField("k", LongType()), StructField("v", DoubleType()),
                     StructField("s", StringType()), StructField("z", DoubleType()),
                     StructField("c", DoubleType())])
ROWS = [(1, 1.0, "a", None, 5.0), (2, float("nan"), None, None, 5.0), (3, None, "", None, 5.0),
        (4, 4.0, "b", None, 5.0)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_nan_counts_as_missing(spark, edge):
    rows = {r["column_name"]: r for r in profile.missing_by_column(edge).collect()}
    assert rows["v"]["missing_values"] == 2          # NULL and NaN
    assert rows["s"]["missing_values"] == 1          # '' is a value
    assert rows["z"]["missing_values"] == 4 and rows["z"]["pct_missing"] == 100.0
    assert "c" not in rows and "k" not in rows
    order = [r["column_name"] for r in profile.missing_by_column(edge).collect()]
    assert order == ["z", "v", "s"]                   # by pct desc


def test_nan_to_null(spark, edge):
    out = nan_to_null(edge).filter(F.col("v").isNull()).count()
    assert out == 2


def test_missing_by_row(spark, edge):
    got = {r["num_cols_missing"]: (r["percent_cols_missing"], r["num_rows"])
           for r in profile.missing_by_row(edge).collect()}
    assert got == {1: (20.0, 2), 3: (60.0, 1), 2: (40.0, 1)}


def test_half_to_even_rounding(spark):
    # 1 missing of 8 rows = 12.5 % -> 12.0 (half to even), not 12.5 -> 13
    df = spark.createDataFrame([(None,)] + [(1.0,)] * 7, "x double")
    assert profile.missing_by_column(df).first()["pct_missing"] == 12.5
    df2 = spark.createDataFrame([(None,)] * 1 + [(1.0,)] * 15, "x double")  # 6.25 %
    assert profile.missing_by_column(df2).first()["pct_missing"] == 6.2


def test_empty_frame(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert profile.missing_by_column(df).count() == 0
    assert profile.missing_by_row(df).count() == 0
    assert profile.shape(df).first()["n_rows"] == 0


def test_count_unique_ignores_missing(spark, edge):
    got = {r["column_name"]: r["n_unique"] for r in profile.count_unique(edge).collect()}
    assert got == {"k": 4, "v": 2, "s": 3, "z": 0, "c": 1}


def test_value_counts_dropna(spark, edge):
    assert profile.value_counts(edge, "s").count() == 3
    assert profile.value_counts(edge, "s", dropna=False).count() == 4


def _np_right_bins(x, bins=10):
    mn, mx = x.min(), x.max()
    w = (mx - mn) / bins
    edges = [mn + i * w for i in range(1, bins)]
    return [1 + sum(v > e for e in edges) for v in x]


def test_binned_counts_match_numpy_edges(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.uniform(0, 0.1, 500), 2)          # values sitting on edges
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = {r["bin"]: r["count"] for r in profile.binned_counts(df, ["x"]).collect()}
    want = {b: 0 for b in range(1, 11)}
    for b in _np_right_bins(x):
        want[b] += 1
    assert got == want
    hist = {r["bin"]: r["count"] for r in profile.histogram(df, ["x"]).collect()}
    counts, _ = np.histogram(x, bins=10)
    assert [hist[b] for b in range(10)] == list(counts)


def test_binned_counts_constant_column(spark):
    df = spark.createDataFrame([(3.0,)] * 7, "x double")
    got = [r["count"] for r in profile.binned_counts(df, ["x"]).orderBy("bin").collect()]
    assert len(got) == 10 and sum(got) == 7 and sorted(got)[-1] == 7


def test_describe_matches_pandas(spark):
    x = [1.0, 2.0, 4.0, 10.0, 3.5]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    r = profile.describe(df).first()
    arr = np.array(x)
    assert r["count"] == 5
    assert math.isclose(r["std"], arr.std(ddof=1))
    assert [r["q25"], r["q50"], r["q75"]] == list(np.quantile(arr, [0.25, 0.5, 0.75]))


def test_table_info(spark, edge):
    rows = {r["column_name"]: r for r in profile.table_info(edge).collect()}
    assert rows["v"]["non_null"] == 2 and rows["v"]["dtype"] == "double"


def test_is_missing_on_strings(spark, edge):
    assert edge.filter(is_missing(edge, "s")).count() == 1


def test_few_values_gate_is_exact(spark):
    rows = [(i % 9, i % 10, i, "x" if i % 2 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "a int, b int, c int, s string")
    assert profile.columns_with_few_values(df, 10) == ["a", "s"]
    assert profile.columns_with_few_values(df, 11) == ["a", "b", "s"]


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_profiles_independent_of_partitioning(spark, parts):
    from conftest import SF001
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").repartition(parts)
    base = spark.read.parquet(f"{SF001}/lineitem.parquet")
    for fn in (profile.count_unique, profile.missing_by_row,
               lambda d: profile.binned_counts(d, ["l_quantity", "l_discount"])):
        assert sorted(map(tuple, fn(li).collect())) == sorted(map(tuple, fn(base).collect()))


def test_univariate_panel(spark):
    from conftest import SF001
    from quarry.operators.plotdata import univariate_panel
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").select("l_quantity", "l_discount")
    panel = univariate_panel(li)
    assert panel["box"].count() == 2 and panel["hist"].count() == 20
    assert panel["kde"].count() == 400
    # the density integrates to about one over the grid
    rows = panel["kde"].filter("column_name = 'l_quantity'").orderBy("grid_x").collect()
    step = rows[1]["grid_x"] - rows[0]["grid_x"]
    assert abs(sum(r["density"] for r in rows) * step - 1.0) < 0.02


def test_overview_sorted(spark):
    from conftest import SF001
    part = spark.read.parquet(f"{SF001}/part.parquet")
    by_value = [r["value"] for r in profile.overview(part, sort="value").collect()
                if r["kind"] == "bin"]
    assert by_value == [str(i) for i in range(1, 11)]
    counts = [r["count"] for r in profile.overview(part, sort="count").collect()
              if r["column_name"] == "p_type"]
    assert counts == sorted(counts, reverse=True)


def test_statistics_on_all_missing_column(spark):
    from quarry.operators import plotdata
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, float("nan"))], "a double, b double")
    d = {r["column_name"]: r for r in profile.describe(df).collect()}
    assert d["b"]["count"] == 0 and d["b"]["q50"] is None and d["a"]["q50"] == 2.0
    b = {r["column_name"]: r for r in plotdata.box_stats(df, ["a", "b"]).collect()}
    assert b["b"]["median"] is None and b["b"]["n_outliers"] == 0
    assert profile.binned_counts(df, ["b"]).count() == 0
