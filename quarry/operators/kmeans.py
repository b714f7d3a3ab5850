"""K-means fits that don't depend on partitioning.

Starts are drawn by k-means++ with hashes for dice: a row's number in (0, 1) is a
digest of (seed, step, row key), and the row with the least -ln(u) / weight wins,
which draws rows in proportion to their weight, the squared distance to the
nearest start so far. A draw is one minimum with partial aggregation, so it
is the same in any partitioning and SQL can repeat it. The first starts of a
draw are the draw for any smaller k.

Several fits (of several k, seeds or given starts) run together: an iteration
labels each row for all of them in one scan and sums by (fit, cluster) in one
aggregation; a fit leaves when its centres have come to rest. Rows are labelled by
the blocked kernel of ``distance`` over Arrow batches, and each task sums its own
rows, so a task sends k rows a fit to the shuffle. (As column expressions the
centres would be constants in generated code, which Spark would have to compile
anew in each iteration.)

A fit rests when the squared shifts of its centres add up to ``tol`` x the mean
variance of the features at most (``tol`` 1e-4 is scikit-learn's default), or
after ``max_iter`` iterations; ``Fit`` says which. A centre without members stays
where it is. Rows with a missing feature (or key) take no part in fits. With
fewer different points than k there are fewer centres; without any point, none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.distance import nearest_of, nearest_rows, rows_of

TOL, MAX_ITER = 1e-4, 300


@dataclass
class Fit:
    centers: list[list[float]]
    inertia: float              # of the final centres
    sizes: list[int]            # members of the final centres
    iterations: int
    converged: bool


def die(key: Column, seed: int, step: int) -> Column:
    """A row's number in (0, 1) for one draw: 52 bits of a digest."""
    text = F.concat(F.lit(f"{seed}:{step}:"), key)
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def points_of(df: DataFrame, features, key: str | list[str] | None) -> DataFrame:
    """(key text, v): the features of rows that have all of them, as one array of
    doubles. Without a key a row's features stand for it."""
    names = [features] if isinstance(features, str) else list(features)
    keys = [key] if isinstance(key, str) else list(key or names)
    text = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys])
    v = F.col(features).cast("array<double>") if isinstance(features, str) else F.array(*[F.col(c).cast("double") for c in names])
    return df.select(text.alias("key"), v.alias("v")).where(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)))


def hashed_starts(points: DataFrame, k: int, seeds: list[int]) -> dict[int, list[list[float]]]:
    """``k`` starts for each seed, in the order drawn; one job a step."""
    starts: dict[int, list[list[float]]] = {s: [] for s in seeds}
    for step in range(1, k + 1):
        going = [s for s in seeds if len(starts[s]) == step - 1]
        if not going:
            break
        weights = [] if step == 1 else [nearest_of("v", starts[s])["d2"].alias(f"w{s}") for s in going]
        races = {}
        for s in going:
            u, w = die(F.col("key"), s, step), F.col(f"w{s}")
            races[s] = F.struct(u.alias("race"), "key", "v") if step == 1 else F.when(w > 0, F.struct((-F.log(u) / w).alias("race"), "key", "v"))
        best = points.select("*", *weights).agg(*[F.min(r).alias(f"b{s}") for s, r in races.items()]).first()
        for s in going:
            if best[f"b{s}"] is not None:
                starts[s].append(list(best[f"b{s}"]["v"]))
    return starts


def cluster_sums(points: DataFrame, runs: dict[int, list[list[float]]]) -> dict[int, dict[int, tuple[int, float, list[float]]]]:
    """For each run, the clusters with members: (members, squared distances, mean).
    One scan for all runs; k x d numbers a run reach the driver."""
    centers = {r: np.array(c, float) for r, c in runs.items()}
    width = len(next(iter(runs.values()))[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {r: np.zeros((len(c), width + 2)) for r, c in centers.items()}
        for batch in batches:
            _, x = rows_of(batch.column("v"), width)
            for r, c in centers.items():
                label, d2 = nearest_rows(x, c)
                for col, w in ((0, None), (1, d2)):
                    sums[r][:, col] += np.bincount(label, w, len(c))
                order = np.argsort(label, kind="stable")
                found, first = np.unique(label[order], return_index=True)
                if len(found):
                    sums[r][found, 2:] += np.add.reduceat(x[order], first, axis=0)
        rows = [(r, i, s[i]) for r, s in sums.items() for i in np.flatnonzero(s[:, 0])]
        yield pa.RecordBatch.from_arrays([pa.array([r for r, _, _ in rows], pa.int32()), pa.array([i for _, i, _ in rows], pa.int32()),
                                          pa.array([s for *_, s in rows], pa.list_(pa.float64()))], names=["run", "cluster", "s"])

    parts = points.select("v").mapInArrow(run, "run int, cluster int, s array<double>").select("run", "cluster", F.posexplode("s").alias("i", "x"))
    out: dict[int, dict[int, tuple[int, float, list[float]]]] = {r: {} for r in runs}
    totals: dict[tuple[int, int], np.ndarray] = {}
    for row in parts.groupBy("run", "cluster", "i").agg(F.sum("x").alias("x")).collect():
        totals.setdefault((row["run"], row["cluster"]), np.zeros(width + 2))[row["i"]] = row["x"]
    for (r, i), t in totals.items():
        out[r][i] = (int(t[0]), float(t[1]), (t[2:] / t[0]).tolist())
    return out


def mean_variance(points: DataFrame) -> float:
    """Mean population variance of the features."""
    each = points.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.var_pop("x").alias("s"))
    return float(each.agg(F.avg("s")).first()[0] or 0.0)


def fit_many(points: DataFrame, starts: dict[int, list[list[float]]], max_iter: int = MAX_ITER, tol: float = TOL) -> dict[int, Fit]:
    """Lloyd iterations from each of ``starts``, together."""
    centers = {r: [list(map(float, c)) for c in s] for r, s in starts.items()}
    iterations, resting = dict.fromkeys(centers, 0), {r for r, c in centers.items() if not c}
    rest = tol * mean_variance(points) if tol else 0.0
    for _ in range(max_iter):
        going = {r: c for r, c in centers.items() if r not in resting}
        if not going:
            break
        new = {r: [list(x) for x in c] for r, c in going.items()}
        for r, clusters in cluster_sums(points, going).items():
            for i, (_n, _d2, mean) in clusters.items():
                new[r][i] = mean
        for r, c in going.items():
            iterations[r] += 1
            shift = sum((a - b) ** 2 for x, y in zip(c, new[r]) for a, b in zip(x, y))
            # means of the same members differ in their last digits at most
            size = sum(a * a for x in c for a in x)
            if shift <= max(rest, 1e-26 * size):
                resting.add(r)
            centers[r] = new[r]
    some = {r: c for r, c in centers.items() if c}
    final = cluster_sums(points, some) if some else {}
    return {r: Fit(c, sum(d2 for _, d2, _ in final.get(r, {}).values()), [final[r][i][0] if i in final[r] else 0 for i in range(len(c))], iterations[r], r in resting)
            for r, c in centers.items()}


def fit(df: DataFrame, features, k: int, key: str | list[str] | None = None, seed: int = 713, start: list[list[float]] | None = None,
        n_init: int = 1, max_iter: int = MAX_ITER, tol: float = TOL) -> Fit:
    """One k-means fit: from ``start``, or the best of ``n_init`` drawn ones."""
    points = points_of(df, features, key).persist()
    try:
        if start is not None:
            return fit_many(points, {0: start}, max_iter, tol)[0]
        seeds = [seed + i for i in range(max(1, n_init))]
        fits = fit_many(points, hashed_starts(points, k, seeds), max_iter, tol)
        return min(fits.values(), key=lambda f: f.inertia)
    finally:
        points.unpersist()


def sweep(df: DataFrame, features, ks: list[int], key: str | list[str] | None = None, seed: int = 713, n_init: int = 1,
          max_iter: int = MAX_ITER, tol: float = TOL) -> dict[int, Fit]:
    """The best fit for each k, all fits in the same scans; the starts for a
    smaller k are the first of the largest one's."""
    ks = sorted(set(ks))
    points = points_of(df, features, key).persist()
    try:
        seeds = [seed + i for i in range(max(1, n_init))]
        drawn = hashed_starts(points, ks[-1], seeds)
        fits = fit_many(points, {k * len(seeds) + i: drawn[s][:k] for k in ks for i, s in enumerate(seeds)}, max_iter, tol)
        return {k: min((fits[k * len(seeds) + i] for i in range(len(seeds))), key=lambda f: f.inertia) for k in ks}
    finally:
        points.unpersist()
