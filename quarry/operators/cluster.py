"""Clustering workflows: scale, fit and label, elbow sweeps, label grids,
comparisons of clusterings, summaries, and ``pyspark.ml`` fits.

The fits are those of ``kmeans``, centres and labels those of ``distance``; a
workflow's input is written once, since a fit reads it many times. ``fit_kmeans``
and ``fit_bisecting`` are ``pyspark.ml``'s own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import BisectingKMeans, KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from quarry.functions.scalar import label_concat
from quarry.operators import kmeans
from quarry.operators.distance import assign_nearest, nearest_of
from quarry.operators.quantiles import clean
from quarry.operators.scale import ScalerStats, apply_scaler, fit_scaler, forward_values, inverse_values
from quarry.plans.materialize import materialize


# ------------------------------------------------------------- summaries


def inertia(df: DataFrame, features, centers: list[list[float]]) -> float:
    """Sum of squared distances to the nearest centre."""
    return assign_nearest(df, features, centers).agg(F.sum("dist2")).first()[0]


def cluster_means(df: DataFrame, cluster_col: str, features: list[str]) -> DataFrame:
    """Mean of the members of each cluster (unscaled centroids)."""
    return (df.groupBy(cluster_col)
            .agg(*[F.avg(clean(df, c)).alias(c) for c in features],
                 F.count(F.lit(1)).alias("n_members")))


def lloyd(df: DataFrame, features, init_centers: list[list[float]], iterations: int = 300,
          tol: float = 0.0) -> list[list[float]]:
    """Centres after Lloyd iterations from fixed initial ones, until they rest (see
    ``kmeans``) or after ``iterations``."""
    return kmeans.fit(df, features, len(init_centers), start=init_centers, max_iter=iterations, tol=tol).centers


# ----------------------------------------------------------- MLlib fits


def _assemble(df: DataFrame, features, out: str = "__features") -> DataFrame:
    if isinstance(features, str):
        from pyspark.ml.functions import array_to_vector
        return df.withColumn(out, array_to_vector(F.col(features).cast("array<double>")))
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


def mean_feature_variance(data: DataFrame, col: str = "__features") -> float | None:
    """Mean population variance of the assembled features (one job)."""
    from pyspark.ml.stat import Summarizer
    row = data.select(Summarizer.metrics("variance", "count").summary(F.col(col)).alias("s")).first()
    var = row["s"]["variance"].toArray()
    n = row["s"]["count"]
    if n <= 1 or len(var) == 0:
        return None
    return float(sum(var) / len(var)) * (n - 1) / n


def sklearn_tol(data: DataFrame, k: int, tol: float = 1e-4, col: str = "__features",
                mean_var: float | None = None) -> float:
    """Spark's k-means stops when every centre moved at most ``tol_spark``;
    scikit-learn stops when the *sum* of squared centre shifts is at most
    ``tol * mean feature variance``. ``sqrt(tol * mean_var / k)`` makes
    Spark stop only where scikit-learn would."""
    mv = mean_var if mean_var is not None else mean_feature_variance(data, col)
    if not mv:
        return tol
    return max((tol * mv / k) ** 0.5, 1e-12)


def fit_kmeans(df: DataFrame, features, k: int, seed: int = 713, max_iter: int = 300,
               tol: float | str = "sklearn", n_init: int = 1,
               assembled: bool = False) -> KMeansModel:
    """``pyspark.ml`` k-means (k-means|| init); best of ``n_init`` seeds by
    training cost. ``tol='sklearn'`` translates scikit-learn's relative
    default (1e-4) into Spark's absolute per-centre criterion."""
    data = df if assembled else _assemble(df, features)
    if tol == "sklearn":
        tol = sklearn_tol(data, k)
    best = None
    for i in range(n_init):
        model = KMeans(k=k, seed=seed + i, maxIter=max_iter, tol=tol,
                       featuresCol="__features", predictionCol="cluster").fit(data)
        if best is None or model.summary.trainingCost < best.summary.trainingCost:
            best = model
    return best


def predict(model: KMeansModel, df: DataFrame, features) -> DataFrame:
    return model.transform(_assemble(df, features)).drop("__features")


def centers_of(model) -> list[list[float]]:
    return [list(map(float, c)) for c in model.clusterCenters()]


def centers_frame(spark: SparkSession, centers: list[list[float]], cols: list[str],
                  cluster_col: str = "cluster") -> DataFrame:
    schema = StructType([StructField(cluster_col, IntegerType())]
                        + [StructField(c, DoubleType()) for c in cols])
    return spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(centers)], schema)


@dataclass
class ClusterResult:
    rows: DataFrame          # input rows + ``cluster`` label text
    scaled: DataFrame        # key + scaled features + integer cluster
    scaler: ScalerStats
    model: kmeans.Fit
    centroids: DataFrame     # unscaled centres, one row per cluster


def create_cluster(df: DataFrame, key: str, features: list[str], k: int,
                   scaler: str = "minmax", seed: int = 713, max_iter: int = 300,
                   prefix: str = "cluster_", start: list[list[float]] | None = None,
                   n_init: int = 1, tol: float = kmeans.TOL) -> ClusterResult:
    """Scale, fit k-means, label rows ``cluster_<i>``, unscale the centres.
    ``start`` gives start centres in the features' own units; without it they are
    drawn (best of ``n_init`` draws)."""
    table = materialize(df, "cluster-input")
    stats = fit_scaler(table, features, scaler)
    scaled = apply_scaler(table.select(key, *features), stats)
    model = kmeans.fit(scaled, features, k, key=key, seed=seed, n_init=n_init, max_iter=max_iter, tol=tol,
                       start=None if start is None else forward_values(stats, start))
    labelled = assign_nearest(scaled, features, model.centers, dist_col=None)
    # label the original rows directly (scaled copies of the features are a
    # projection of the same row): no join back on the key, no shuffle
    sfx = "__scaled"
    rows = assign_nearest(apply_scaler(table, stats, suffix=sfx), [c + sfx for c in features],
                          model.centers, dist_col=None)
    rows = rows.drop(*[c + sfx for c in features]) \
        .withColumn("cluster", label_concat(prefix, F.col("cluster")))
    centroids = centers_frame(df.sparkSession, inverse_values(stats, model.centers), features)
    return ClusterResult(rows, labelled, stats, model, centroids)


def elbow(df: DataFrame, features, ks=range(2, 12), seed: int = 713, max_iter: int = 300,
          scaler: str | None = None, key: str | list[str] | None = None, n_init: int = 1) -> DataFrame:
    """Inertia for each k (the elbow curve), ``(k, inertia, drop)`` where
    ``drop`` is the relative decrease from the previous k. All fits share their
    scans."""
    names = [features] if isinstance(features, str) else list(features)
    keys = [key] if isinstance(key, str) else list(key or [])
    data = materialize(df.select(*dict.fromkeys([*keys, *names])), "elbow-input")
    if scaler and not isinstance(features, str):
        data = apply_scaler(data, fit_scaler(data, features, scaler))
    fits = kmeans.sweep(data, features, list(ks), key=key, seed=seed, n_init=n_init, max_iter=max_iter)
    rows, prev = [], None
    for k, fit in fits.items():
        rows.append((k, float(fit.inertia), None if not prev else (prev - fit.inertia) / prev))
        prev = fit.inertia
    schema = StructType([StructField("k", IntegerType()), StructField("inertia", DoubleType()),
                         StructField("drop", DoubleType())])
    return df.sparkSession.createDataFrame(rows, schema)


def k_grid(df: DataFrame, key: str, features, ks=range(2, 6), seed: int = 713,
           max_iter: int = 300, n_init: int = 1) -> DataFrame:
    """Labels of every row for each k: long frame ``(key, k, cluster)``."""
    labels = materialize(df.select(key, *([features] if isinstance(features, str) else features)), "grid-input")
    fits = kmeans.sweep(labels, features, list(ks), key=key, seed=seed, n_init=n_init, max_iter=max_iter)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), nearest_of(features, fit.centers)["cluster"].alias("cluster")) for k, fit in fits.items()]))
    return labels.select(key, each.alias("s")).select(key, "s.k", "s.cluster")  # one scan labels every k


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of each (a, b) pair (clusters vs known class, or two labelings)."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))


def adjusted_rand(counts: DataFrame, a: str, b: str, n: str = "count") -> DataFrame:
    """The adjusted Rand index of two labelings from their contingency table
    ``(a, b, count)``: ``(n_rows, n_pairs_both, adjusted_rand)``. Rows without one
    of the labels take no part; two labelings of one cluster each agree (1)."""
    t = counts.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("a"), F.col(b).alias("b"), F.col(n).alias("n"))
    pairs = lambda c: F.sum(F.col(c) * (F.col(c) - 1) / 2)
    cells = t.agg(F.sum("n").alias("n_rows"), pairs("n").alias("both"))
    one = t.groupBy("a").agg(F.sum("n").alias("n")).agg(pairs("n").alias("in_a"))
    other = t.groupBy("b").agg(F.sum("n").alias("n")).agg(pairs("n").alias("in_b"))
    n_rows, both, in_a, in_b = (*cells.first(), *one.first(), *other.first())
    index = None
    if n_rows:
        total = n_rows * (n_rows - 1) / 2
        by_chance = in_a * in_b / total if total else 0.0
        most = (in_a + in_b) / 2
        index = 1.0 if most == by_chance else (both - by_chance) / (most - by_chance)
    return counts.sparkSession.createDataFrame([(int(n_rows or 0), int(both or 0), index)], "n_rows long, n_pairs_both long, adjusted_rand double")


def match_labels(cells: list[tuple[int, int, int]], k: int) -> list[int]:
    """For each label of the first labeling the one of the second that it stands
    for: the one-to-one matching with the most rows in common (``cells`` are
    (a, b, count)), found by augmenting along shortest paths."""
    cost = [[0] * k for _ in range(k)]
    for a, b, n in cells:
        cost[a][b] = -n
    row_of, potential, shadow = [-1] * (k + 1), [0] * (k + 1), [0] * (k + 1)
    for a in range(k):
        row_of[k], at = a, k
        least, via, used = [float("inf")] * k, [k] * k, [False] * (k + 1)
        while row_of[at] >= 0:
            used[at], row = True, row_of[at]
            for b in range(k):
                if not used[b]:
                    gap = cost[row][b] - potential[row] - shadow[b]
                    if gap < least[b]:
                        least[b], via[b] = gap, at
            step, after = min((least[b], b) for b in range(k) if not used[b])
            for b in range(k + 1):
                if used[b]:
                    potential[row_of[b]] += step
                    shadow[b] -= step
                elif b < k:
                    least[b] -= step
            at = after
        while at != k:
            row_of[at], at = row_of[via[at]], via[at]
    matched = [0] * k
    for b in range(k):
        matched[row_of[b]] = b
    return matched


@dataclass
class Comparison:
    crosstab: DataFrame      # cluster_raw, cluster_scaled, count
    agreement: DataFrame     # n_rows, n_pairs_both, adjusted_rand
    profile: DataFrame       # run, cluster, matched, n_members, then center_, mean_, min_, max_ of each feature
    raw: kmeans.Fit
    scaled: kmeans.Fit


def compare_scaling(df: DataFrame, key: str, features: list[str], k: int = 2, seed: int = 713, max_iter: int = 300,
                    scaler: str = "minmax", start: list[list[float]] | None = None, n_init: int = 1) -> Comparison:
    """The same k-means on raw and on scaled features, from the same starts (the
    given ones, in the features' units, or each run's own draws): how far the
    two labelings agree, and the centres, sizes and profiles of both. ``matched`` is the
    other run's cluster that stands for a cluster. Rows with a missing feature have
    no cluster and are left out."""
    data = materialize(df.select(key, *features), "compare-input")
    stats = fit_scaler(data, features, scaler)
    sfx = "__scaled"
    both = apply_scaler(data, stats, suffix=sfx)
    raw = kmeans.fit(data, features, k, key=key, seed=seed, n_init=n_init, max_iter=max_iter, start=start)
    scaled = kmeans.fit(both, [c + sfx for c in features], k, key=key, seed=seed, n_init=n_init, max_iter=max_iter,
                        start=None if start is None else forward_values(stats, start))
    # both labelings are projections of the same rows: one pass, no join
    both = assign_nearest(both, features, raw.centers, cluster_col="cluster_raw", dist_col=None)
    both = assign_nearest(both, [c + sfx for c in features], scaled.centers, cluster_col="cluster_scaled", dist_col=None)
    both = both.where(F.col("cluster_raw").isNotNull() & F.col("cluster_scaled").isNotNull())
    crosstab = contingency(both, "cluster_raw", "cluster_scaled")
    cells = [tuple(r) for r in crosstab.collect()]  # k x k counts
    size = max(len(raw.centers), len(scaled.centers))
    to_scaled = match_labels(cells, size)
    centers = {"raw": raw.centers, "scaled": inverse_values(stats, scaled.centers)}
    facts = [(run, i, to_scaled[i] if run == "raw" else to_scaled.index(i), *map(float, c)) for run, cs in centers.items() for i, c in enumerate(cs)]
    schema = "run string, c int, matched int, " + ", ".join(f"`center_{f}` double" for f in features)
    facts = df.sparkSession.createDataFrame(facts, schema)
    runs = F.explode(F.array(*[F.struct(F.lit(r).alias("run"), F.col(f"cluster_{r}").alias("cluster")) for r in centers]))
    profile = (both.select(runs.alias("s"), *features).groupBy("s.run", "s.cluster")
               .agg(F.count(F.lit(1)).alias("n_members"), *[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in features for n, f in (("mean", F.avg), ("min", F.min), ("max", F.max))]))
    profile = facts.join(profile.withColumnRenamed("cluster", "c"), ["run", "c"], "left").withColumnRenamed("c", "cluster")
    profile = profile.fillna(0, ["n_members"])
    return Comparison(crosstab, adjusted_rand(crosstab, "cluster_raw", "cluster_scaled"), profile, raw, scaled)


def scaled_vs_unscaled(df: DataFrame, key: str, features: list[str], k: int = 2, seed: int = 713, max_iter: int = 300,
                       start: list[list[float]] | None = None, n_init: int = 1) -> DataFrame:
    """The same k-means on raw and on min-max scaled features: crosstab of
    the two labelings ``(cluster_raw, cluster_scaled, count)``."""
    return compare_scaling(df, key, features, k, seed, max_iter, start=start, n_init=n_init).crosstab


def fit_bisecting(df: DataFrame, features, k: int, seed: int = 713, max_iter: int = 20):
    """Divisive hierarchical clustering (``pyspark.ml`` BisectingKMeans)."""
    return BisectingKMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="__features",
                           predictionCol="cluster").fit(_assemble(df, features))
