"""Joins, scaling and k-means properties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import cluster, joins
from quarry.operators.scale import apply_scaler, fit_scaler, inverse_scaler
from quarry.sources.blobs import make_blobs


def test_latest_per_key_ties(spark):
    rows = [(1, 10, "2017-01-01"), (1, 11, "2017-03-01"), (1, 12, "2017-03-01"),
            (2, 20, "2016-05-05"), (3, 30, "2017-02-02")]
    tx = spark.createDataFrame(rows, "k long, id long, d string").withColumn("d", F.to_date("d"))
    keep = sorted(r["id"] for r in joins.latest_per_key(tx, "k", "d", "keep").collect())
    assert keep == [11, 12, 20, 30]
    first = sorted(r["id"] for r in joins.latest_per_key(tx, "k", "d", "first", "id").collect())
    assert first == [11, 20, 30]
    cols = joins.latest_per_key(tx, "k", "d", "first", "id").columns
    assert cols == ["k", "id", "d"]


def test_lookup_chain_left_and_dead(spark):
    fact = spark.createDataFrame([(1, 7), (2, 8), (3, None)], "k long, dim_id int")
    dim = spark.createDataFrame([(7, "seven")], "dim_id int, dim_desc string")
    out = joins.lookup_chain(fact, [joins.Lookup(dim, "dim_id", "dim_id", ["dim_desc"]),
                                    joins.Lookup(dim, "dim_id", "dim_id", [])])
    got = sorted((r["k"], r["dim_desc"]) for r in out.collect())
    assert got == [(1, "seven"), (2, None), (3, None)]
    assert out.columns == ["dim_id", "k", "dim_desc"] or "dim_desc" in out.columns


def test_scaler_inverse_roundtrip_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0), (10.0, 5.0)], "a double, b double")
    for kind in ("minmax", "standard"):
        st = fit_scaler(df, ["a", "b"], kind)
        sc = apply_scaler(df, st)
        assert all(r["b"] == 0.0 for r in sc.collect())        # constant -> 0
        back = inverse_scaler(sc, st).collect()
        assert [r["a"] for r in back] == pytest.approx([1.0, 2.0, 4.0, 10.0])
    z = apply_scaler(df, fit_scaler(df, ["a"], "standard")).first()["a"]
    assert z == pytest.approx(-0.9309, abs=1e-4)              # population std


def test_assign_nearest_ties_lowest_id(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "x double")
    out = cluster.assign_nearest(df, ["x"], [[0.0], [2.0]]).orderBy("x").collect()
    assert [r["cluster"] for r in out] == [0, 0, 1]
    assert [r["dist2"] for r in out] == [0.0, 1.0, 0.0]


@pytest.fixture(scope="module")
def blobs(spark):
    return make_blobs(spark, n=400, centers=4, std=0.5, seed=3).persist()


def test_blobs_shape(spark, blobs):
    assert blobs.count() == 400
    assert blobs.select("true_cluster").distinct().count() == 4


def test_kmeans_recovers_blobs_and_properties(spark, blobs):
    feats = ["x0", "x1"]
    model = cluster.fit_kmeans(blobs, feats, 4, seed=1, n_init=3)
    centers = cluster.centers_of(model)
    lab = cluster.assign_nearest(blobs, feats, centers)
    pred = cluster.predict(model, blobs, feats)
    # labels from our assignment equal MLlib's predictions
    a = sorted((r["id"], r["cluster"]) for r in lab.select("id", "cluster").collect())
    b = sorted((r["id"], r["cluster"]) for r in pred.select("id", "cluster").collect())
    assert a == b
    # inertia = sum of squared distances
    inertia = lab.agg(F.sum("dist2")).first()[0]
    assert inertia == pytest.approx(model.summary.trainingCost, rel=1e-6)
    # each centre is the mean of its members
    means = {r["cluster"]: (r["x0"], r["x1"]) for r in cluster.cluster_means(lab, "cluster", feats).collect()}
    for i, c in enumerate(centers):
        assert means[i] == pytest.approx(tuple(c), abs=1e-3)
    # purity against the true blobs
    ct = cluster.contingency(lab, "true_cluster", "cluster").collect()
    purity = sum(max(r["count"] for r in ct if r["cluster"] == c) for c in range(4)) / 400
    assert purity >= 0.9


def test_lloyd_matches_mllib_from_same_start(spark, blobs):
    from pyspark.mllib.clustering import KMeans as OldKMeans, KMeansModel as OldModel
    feats = ["x0", "x1"]
    init = [list(map(float, r)) for r in blobs.select(*feats).orderBy("id").limit(3).collect()]
    ours = cluster.lloyd(blobs, feats, init, iterations=5)
    rdd = blobs.select(*feats).rdd.map(lambda r: [float(r[0]), float(r[1])])
    old = OldKMeans.train(rdd, 3, maxIterations=5, initialModel=OldModel(init), epsilon=0.0)
    got = np.array(sorted(map(tuple, ours)))
    want = np.array(sorted(tuple(map(float, c)) for c in old.clusterCenters))
    assert np.allclose(got, want, rtol=0, atol=1e-9)


def test_elbow_decreasing(spark, blobs):
    e = cluster.elbow(blobs, ["x0", "x1"], ks=range(2, 6), seed=5).orderBy("k").collect()
    costs = [r["inertia"] for r in e]
    assert costs[0] > costs[2] and [r["k"] for r in e] == [2, 3, 4, 5]


def test_create_cluster_outputs(spark, blobs):
    res = cluster.create_cluster(blobs, "id", ["x0", "x1"], 4, scaler="minmax", seed=713)
    labels = {r["cluster"] for r in res.rows.select("cluster").distinct().collect()}
    assert labels <= {f"cluster_{i}" for i in range(4)}
    assert res.centroids.count() == 4 and res.rows.count() == 400
    # unscaled centroids lie in the data range
    rng = blobs.agg(F.min("x0"), F.max("x0")).first()
    assert all(rng[0] <= r["x0"] <= rng[1] for r in res.centroids.collect())


def test_k_grid_long(spark, blobs):
    g = cluster.k_grid(blobs, "id", ["x0", "x1"], ks=range(2, 4), seed=1)
    assert g.count() == 800 and set(g.columns) == {"id", "k", "cluster"}
    assert np is not None


def test_anova_and_pairs_degenerate_inputs(spark):
    from quarry.operators import plotdata, stats
    one = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "g string, v double")
    r = stats.anova_oneway(one, "g", "v").first()
    assert r["n_groups"] == 1 and r["f_stat"] is None
    two = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0), ("b", 7.0)], "g string, v double")
    f = stats.anova_oneway(two, "g", "v").first()["f_stat"]
    # scipy.stats.f_oneway([1, 2], [5, 7]) = 16.2
    assert f == pytest.approx(16.2)
    empty = spark.createDataFrame([(None, 1.0), (2.0, None)], "x double, y double")
    p = plotdata.pair_regression(empty, ["x", "y"]).first()
    assert p["n"] == 0 and p["slope"] is None
