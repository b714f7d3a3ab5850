"""K-means fits with hashed starts, and the nearest-centre kernel."""

import hashlib
import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators import cluster, distance, kmeans
from quarry.sources.blobs import make_blobs


def plain_starts(points, k, seed):
    """{key: vector}"""
    def u(step, key):
        return (int(hashlib.md5(f"{seed}:{step}:{key}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
    chosen = [min((u(1, key), key) for key in points)[1]]
    while len(chosen) < k:
        weights = {key: min(sum((a - b) ** 2 for a, b in zip(v, points[c])) for c in chosen) for key, v in points.items()}
        races = [(-math.log(u(len(chosen) + 1, key)) / w, key) for key, w in weights.items() if w > 0]
        if not races:
            break
        chosen.append(min(races)[1])
    return [points[c] for c in chosen]


def plain_lloyd(x, centers, tol):
    centers = np.array(centers, float)
    rest = tol * x.var(axis=0).mean()
    for _ in range(300):
        label = ((x[:, None] - centers) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[label == i].mean(axis=0) if (label == i).any() else c for i, c in enumerate(centers)])
        shift, centers = ((new - centers) ** 2).sum(), new
        if shift <= max(rest, 1e-26 * (centers ** 2).sum()):
            break
    return centers, ((x[:, None] - centers) ** 2).sum(axis=2).min(axis=1).sum()


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    return {str(i): rng.normal(size=3).round(3).tolist() for i in range(200)}


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(k, *v, v) for k, v in rows.items()], "id string, a double, b double, c double, v array<double>").repartition(parts)


def test_starts_and_fits_whatever_the_partitions(spark, rows):
    x = np.array(list(rows.values()))
    want = plain_starts(rows, 5, 7)
    centers, inertia = plain_lloyd(x, want[:4], 1e-4)
    for parts, features in ((1, ["a", "b", "c"]), (7, "v")):
        points = kmeans.points_of(frame(spark, rows, parts), features, "id")
        assert kmeans.hashed_starts(points, 5, [7, 8]) == {7: want, 8: plain_starts(rows, 5, 8)}
        fit = kmeans.fit(frame(spark, rows, parts), features, 4, key="id", seed=7)
        assert np.allclose(fit.centers, centers) and fit.inertia == pytest.approx(inertia) and fit.converged
        assert sum(fit.sizes) == 200 and fit.iterations > 1


def test_sweep_shares_the_starts(spark, rows):
    fits = kmeans.sweep(frame(spark, rows), ["a", "b", "c"], [4, 2], key="id", seed=7)
    for k, fit in fits.items():
        alone = kmeans.fit(frame(spark, rows), ["a", "b", "c"], k, key="id", seed=7)
        assert np.allclose(fit.centers, alone.centers) and fit.iterations == alone.iterations
    best = kmeans.sweep(frame(spark, rows), "v", [3], key="id", seed=7, n_init=3)[3]
    assert best.inertia <= min(kmeans.fit(frame(spark, rows), "v", 3, key="id", seed=7 + i).inertia for i in range(3)) + 1e-9


def test_blobs_are_found(spark):
    fit = kmeans.fit(make_blobs(spark, n=400, centers=4, std=0.3, seed=3), ["x0", "x1"], 4, key="id", seed=1, n_init=3, tol=0)
    assert fit.converged and sorted(fit.sizes) == [100] * 4


def test_few_points_and_missing_features(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.0, 1.0), (3, 5.0, 1.0), (4, None, 1.0), (5, float("nan"), 1.0)], "id long, x double, y double")
    fit = kmeans.fit(df, ["x", "y"], 4, key="id", tol=0)
    assert sorted(fit.centers) == [[0.0, 1.0], [5.0, 1.0]] and fit.inertia == 0 and fit.converged
    none = kmeans.fit(df.where("id > 3"), ["x", "y"], 2, key="id")
    assert none.centers == [] and none.sizes == []
    kept = kmeans.fit(df, ["x", "y"], 3, start=[[0, 1], [5, 1], [100, 1]])
    assert kept.centers[2] == [100, 1] and kept.sizes == [2, 1, 0]  # a centre without members stays
    stopped = kmeans.fit(df, ["x", "y"], 2, start=[[0, 1], [1, 1]], max_iter=1, tol=0)
    assert not stopped.converged and stopped.iterations == 1
    assert kmeans.fit(df, ["x"], 2).sizes != []  # without a key the features stand for it


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 6), st.integers(1, 5), st.sampled_from([1.0, 1e8, 1e-8]))
def test_kernel_breaks_ties_exactly(seed, k, d, scale):
    rng = np.random.default_rng(seed)
    x, c = rng.integers(-2, 3, (50, d)) * scale, rng.integers(-2, 3, (k, d)) * scale
    label, d2 = distance.nearest_rows(x, c)
    plain = ((x[:, None] - c) ** 2).sum(axis=2)
    assert (label == plain.argmin(axis=1)).all() and np.array_equal(d2, plain.min(axis=1))


def test_array_rows_without_a_cluster(spark):
    nan = float("nan")
    rows = [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [2.0, 1.0]), (4, None), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [1.0]), (8, []), (9, [1e200, -1e200])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = {r.id: (r.cluster, r.dist2) for r in cluster.assign_nearest(df, "v", [[0.0, 1.0], [2.0, 1.0]]).collect()}
    assert got == {1: (0, 0.0), 2: (0, 1.0), 3: (1, 0.0), 9: (0, math.inf), **{i: (None, None) for i in (4, 5, 6, 7, 8)}}
    assert cluster.assign_nearest(df.limit(0), "v", [[0.0, 1.0]]).count() == 0


def test_create_cluster_from_starts(spark, rows):
    df = frame(spark, rows)
    res = cluster.create_cluster(df, "id", ["a", "b", "c"], 2, start=[[-1, 0, 0], [1, 0, 0]], tol=0)
    assert res.model.converged
    got = res.rows.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in "abc"]).collect()
    means = {r["cluster"]: [r.a, r.b, r.c] for r in got}
    for r in res.centroids.collect():  # at rest, centres are their members' means
        assert means[f"cluster_{r.cluster}"] == pytest.approx([r.a, r.b, r.c])


def test_matching_and_agreement(spark):
    rng = np.random.default_rng(0)
    for k in range(1, 6):
        table = rng.integers(0, 9, (k, k))
        cells = [(a, b, int(table[a, b])) for a in range(k) for b in range(k)]
        got = cluster.match_labels(cells, k)
        assert sorted(got) == list(range(k))
        assert sum(table[a, got[a]] for a in range(k)) == max(sum(table[a, p[a]] for a in range(k)) for p in itertools.permutations(range(k)))
    pairs = spark.createDataFrame([("x", 1, 3), ("x", 2, 1), ("y", 2, 4), ("y", None, 9)], "a string, b int, count long")
    row = cluster.adjusted_rand(pairs, "a", "b").first()
    labels = [("x", 1)] * 3 + [("x", 2)] + [("y", 2)] * 4
    both = sum(p == q for p, q in itertools.combinations(labels, 2))
    in_a, in_b = (sum(p[i] == q[i] for p, q in itertools.combinations(labels, 2)) for i in (0, 1))
    assert (row.n_rows, row.n_pairs_both) == (8, both)
    assert row.adjusted_rand == pytest.approx((both - in_a * in_b / 28) / ((in_a + in_b) / 2 - in_a * in_b / 28))
    assert cluster.adjusted_rand(pairs.limit(0), "a", "b").first().adjusted_rand is None
    one = spark.createDataFrame([(0, 0, 5)], "a int, b int, count long")
    assert cluster.adjusted_rand(one, "a", "b").first().adjusted_rand == 1.0
