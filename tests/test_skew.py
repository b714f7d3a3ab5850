"""One key holding a third of all rows: results stay exact and whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import joins, plotdata, split
from quarry.operators.quantiles import grouped_quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    # key 0 holds a third of the rows, with many dates and a tie on its last date
    n = 6000
    df = (spark.range(n).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(0))
                                     .otherwise(F.col("id") % 500 + 1))
          .withColumn("d", F.date_add(F.lit("2017-01-01").cast("date"), (F.col("id") % 97).cast("int")))
          .withColumn("x", F.sin(F.col("id")) * 100 + F.when(F.col("k") == 0, 1000).otherwise(0))
          .withColumn("g", F.when(F.col("k") == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("k") % 4).cast("string")))))
    return df.repartition(7).persist()


def test_latest_per_key_hot_key(spark, skewed):
    rows = skewed.select("id", "k", "d").collect()
    best = {}
    for r in rows:
        best[r["k"]] = max(best.get(r["k"], r["d"]), r["d"])
    want = sorted(r["id"] for r in rows if r["d"] == best[r["k"]])
    got = sorted(r["id"] for r in joins.latest_per_key(skewed.select("id", "k", "d"), "k", "d").collect())
    assert got == want
    first = joins.latest_per_key(skewed.select("id", "k", "d"), "k", "d", "first", "id").collect()
    assert len(first) == len(best)


def test_grouped_quantiles_hot_group(spark, skewed):
    got = {r["g"]: r for r in grouped_quantiles(skewed, "g", "x", [0.25, 0.5, 0.75]).collect()}
    rows = skewed.select("g", "x").collect()
    for g in got:
        vals = np.array([r["x"] for r in rows if r["g"] == g])
        assert np.allclose([got[g]["q0"], got[g]["q1"], got[g]["q2"]],
                           np.quantile(vals, [0.25, 0.5, 0.75]), rtol=1e-12)


def test_box_stats_by_hot_group(spark, skewed):
    out = {r["g"]: r for r in plotdata.box_stats_by(skewed, "g", "x").collect()}
    assert out["hot"]["n"] == 2000
    assert sum(r["n"] for r in out.values()) == 6000


def test_stratified_sample_hot_group(spark, skewed):
    s = split.stratified_sample(skewed, "g", 7, "id", seed=3)
    counts = {r["g"]: r["count"] for r in s.groupBy("g").count().collect()}
    assert counts["hot"] == 7 and all(v == 7 for v in counts.values())


def test_split_with_hot_key_is_exact(spark, skewed):
    s = split.three_way_split(skewed, "id")
    got = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert (got["train"], got["validate"], got["test"]) == split.split_sizes(6000)


@pytest.mark.parametrize("missing_rows", [3, 700, 9000])
def test_a_missing_category_is_left_out(spark, missing_rows):
    """Small, heavy and the largest: the other groups stay as they are."""
    rows = [("a", float(i % 37)) for i in range(800)] + [("b", float(i)) for i in range(20)] + [("c", float("nan")), ("c", None)]
    full = spark.createDataFrame([(i, *r) for i, r in enumerate(rows + [(None, float(i)) for i in range(missing_rows)])], "id long, g string, x double").repartition(4)
    q = {r["g"]: (r["n"], r["q0"]) for r in grouped_quantiles(full, "g", "x", [0.5]).collect()}
    assert q == {"a": (800, float(np.median([i % 37 for i in range(800)]))), "b": (20, 9.5)}
    assert {r["g"]: r["n"] for r in plotdata.box_stats_by(full, "g", "x").collect()} == {"a": 800, "b": 20}
    assert {r["g"]: r["count"] for r in split.stratified_sample(full, "g", 2, "id").groupBy("g").count().collect()} == {"a": 2, "b": 2, "c": 2}
    assert {r["g"]: r["count"] for r in plotdata.kde_by(full, "g", "x", gridsize=5).groupBy("g").count().collect()} == {"a": 5, "b": 5}
    assert plotdata.kde_by(full.withColumn("g", F.col("id") % 1200), "g", "x", gridsize=3).select("g").distinct().count() <= 1200


def test_missing_values_do_not_poison(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 2.0, "u"), (2.0, 4.0, "u"), (3.0, 6.5, "v"), (nan, 1.0, "v"), (5.0, nan, None)], "x double, y double, g string")
    from quarry.operators import cluster, profile, scale, stats
    assert plotdata.box_stats(df, ["x"]).first()["n_outliers"] == 0
    assert sum(r["count"] for r in plotdata.histogram_2d(df, "x", "y").collect()) == 3
    assert plotdata.pair_regression(df, ["x", "y"]).first()["n"] == 3
    assert all(r["density"] == r["density"] for r in plotdata.kde_grid(df, "x", gridsize=4).collect())
    assert scale.fit_scaler(df, ["x"], "minmax").scale == (4.0,)
    assert scale.fit_scaler(df, ["y"], "standard").scale[0] == pytest.approx(np.std([2, 4, 6.5, 1]))
    assert stats.anova_oneway(df, "g", "x").first()["n"] == 3
    assert {r["g"]: r["x"] for r in cluster.cluster_means(df, "g", ["x"]).collect()}["v"] == 3.0
    labels = cluster.assign_nearest(df, ["x", "y"], [[0.0, 0.0], [3.0, 6.0]]).collect()
    assert [r["cluster"] for r in labels] == [0, 1, 1, None, None]
    assert [r["dist2"] for r in labels][3:] == [None, None]
    both = spark.createDataFrame([(nan,), (None,), (1.0,)], "x double")
    assert {r["x"]: r["count"] for r in profile.value_counts(both, "x", dropna=False).collect()} == {None: 2, 1.0: 1}


def test_constant_and_empty_columns_in_histograms(spark):
    from quarry.operators import profile
    df = spark.createDataFrame([(7.0, None), (7.0, None)], "x double, y double")
    got = {r["bin"]: (r["count"], r["lo"], r["hi"]) for r in profile.histogram(df, ["x"]).collect()}
    counts, edges = np.histogram([7.0, 7.0], bins=10)
    assert [got[b][0] for b in range(10)] == counts.tolist()
    assert got[0][1] == edges[0] and got[9][2] == edges[10]
    assert plotdata.histogram_2d(df, "x", "y").collect() == []
    assert [r["bin_x"] for r in plotdata.histogram_2d(df.withColumn("y", F.lit(1.0)), "x", "y").collect()] == [5]


def test_anova_of_large_close_values(spark):
    from quarry.operators import stats
    df = spark.range(20_000).select((F.col("id") % 4).alias("g"), (F.lit(1e9) + (F.col("id") % 4) * 1e-4 + F.col("id") % 3).alias("x"))
    rows = df.collect()
    x, g = np.array([r["x"] for r in rows]) - 1e9, np.array([r["g"] for r in rows])
    want = sum((g == k).sum() * (x[g == k].mean() - x.mean()) ** 2 for k in range(4))
    assert stats.anova_oneway(df, "g", "x").first()["ss_between"] == pytest.approx(want, rel=1e-3)
