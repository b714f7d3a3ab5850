"""Cleaning operators on hand-made frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions.scalar import FIPS_COUNTIES, SINGLE_UNIT_LANDUSE, recode
from quarry.operators import clean, columns


def test_drop_missing_thresholds(spark):
    # 4 rows; col thresh round(0.75*4)=3: 'b' (2 present) goes
    rows = [(1, 1.0, None, 1.0), (2, 2.0, None, None), (3, None, 3.0, 3.0), (4, 4.0, 4.0, 4.0)]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double")
    out = clean.drop_missing(df, 0.75, 0.75)
    assert out.columns == ["k", "a", "c"]
    # row thresh = round(0.75*3) = 2 present of (k, a, c): every row keeps >= 2
    assert sorted(r["k"] for r in out.collect()) == [1, 2, 3, 4]
    strict = clean.drop_missing(df, 0.75, 1.0)       # needs all 3
    assert sorted(r["k"] for r in strict.collect()) == [1, 4]


def test_drop_missing_column_exactly_at_threshold_is_kept(spark):
    rows = [(1, 1.0), (2, 2.0), (3, 3.0), (4, None)]
    df = spark.createDataFrame(rows, "k long, a double")
    assert clean.drop_missing(df, 0.75, 0.0).columns == ["k", "a"]


def test_drop_rows_low_percent_strict(spark):
    # 'a' misses 1 of 100 = exactly 1 % -> not below the limit -> rows kept
    rows = [(i, None if i == 0 else 1.0, None if i < 2 else "x") for i in range(100)]
    df = spark.createDataFrame(rows, "k long, a double, s string")
    assert clean.drop_rows_low_percent(df, 0.01).count() == 100
    rows2 = [(i, None if i == 0 else 1.0) for i in range(101)]
    df2 = spark.createDataFrame(rows2, "k long, a double")
    assert clean.drop_rows_low_percent(df2, 0.01).count() == 100


def test_remove_outliers_sequential_and_bounds(spark):
    x = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 100.0]
    y = [5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0]
    df = spark.createDataFrame(list(zip(range(9), x, y)), "k long, x double, y double")
    out = clean.remove_outliers(df, 1.5, ["x"])
    q1, q3 = np.quantile(x, [0.25, 0.75])
    want = [v for v in x if q1 - 1.5 * (q3 - q1) < v < q3 + 1.5 * (q3 - q1)]
    assert sorted(r["x"] for r in out.collect()) == want
    # constant column: iqr 0 -> strict bounds remove everything
    assert clean.remove_outliers(df, 1.5, ["y"]).count() == 0


def test_remove_outliers_value_on_bound_dropped(spark):
    # q1=2, q3=4, iqr=2, k=0.5 -> bounds (1, 5): 1 and 5 are dropped
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5]], "x double")
    got = sorted(r["x"] for r in clean.remove_outliers(df, 0.5, ["x"]).collect())
    assert got == [2.0, 3.0, 4.0]


def test_remove_outliers_drops_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert clean.remove_outliers(df, 1.5, ["x"]).count() == 3


def test_joint_mode_differs_from_sequential(spark):
    rows = [(float(i), float(i if i < 18 else 1000)) for i in range(20)]
    rows += [(1000.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    seq = clean.remove_outliers(df, 1.5, ["a", "b"]).count()
    joint = clean.remove_outliers(df, 1.5, ["a", "b"], mode="joint").count()
    assert seq >= 0 and joint >= 0


def test_impute_strategies(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (None, None), (10.0, "b")],
                               "x double, s string")
    assert sorted(r["x"] for r in clean.impute(df, ["x"], "mean").collect()) == \
        [1.0, 2.0, 13.0 / 3, 10.0]
    assert sorted(r["x"] for r in clean.impute(df, ["x"], "median").collect()) == \
        [1.0, 2.0, 2.0, 10.0]
    assert [r["s"] for r in clean.impute(df, ["s"], "mode").collect()].count("a") == 3


def test_drop_absent_column_raises(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(KeyError):
        columns.drop_columns(df, ["nope"])
    assert columns.drop_columns(df, ["nope"], missing_ok=True).columns == ["a"]


def test_fill_constant_covers_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (2.0,)], "poolcnt double")
    assert sorted(r[0] for r in columns.fill_pool(df).collect()) == [0.0, 0.0, 2.0]


def test_recode_pass_through(spark):
    df = spark.createDataFrame([(6037.0,), (6059.0,), (6111.0,), (1234.0,), (None,)],
                               "fips double")
    got = [r[0] for r in df.select(recode("fips", FIPS_COUNTIES)).collect()]
    assert got == ["LA", "Orange", "Ventura", "1234", None]


def test_single_homes_isin_and_unit(spark):
    rows = [("Condominium", 1.0), ("Condominium", None), ("Condominium", 2.0),
            ("Duplex", 1.0), (None, 1.0), ("Mobile Home", None)]
    df = spark.createDataFrame(rows, "propertylandusedesc string, unitcnt double")
    out = columns.single_homes(df).collect()
    assert len(out) == 3
    assert all(r[0] in SINGLE_UNIT_LANDUSE for r in out)


def test_parse_date_strict_and_lenient(spark):
    df = spark.createDataFrame([("2017-01-02",), ("bad",)], "transactiondate string")
    lenient = columns.parse_date_column(df, strict=False).collect()
    assert lenient[0][0].year == 2017 and lenient[1][0] is None
    with pytest.raises(Exception):
        columns.parse_date_column(df, strict=True).collect()


def test_parse_date_of_datetimes_and_dates(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2017-01-02 03:04:05' AS a, TIMESTAMP '2017-01-02 03:04:05' AS b, DATE '2017-01-02' AS c")
    for c in ("a", "b"):
        assert columns.parse_date_column(df, c).schema == df.schema
    parsed = columns.parse_date_column(df, "c")
    assert parsed.schema["c"].dataType.simpleString() == "timestamp" and parsed.first()["c"].day == 2


def test_rename_and_kind(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, c double")
    assert columns.rename_columns(df, ["x", "y", "z"]).columns == ["x", "y", "z"]
    assert columns.columns_by_kind(df, "string") == ["b"]
    assert columns.columns_by_kind(df, "other") == ["a", "c"]
    assert F is not None
