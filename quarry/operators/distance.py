"""Nearest centres.

Centres are O(k x d) numbers held on the driver and inlined into the plan, so
assignment is a projection (no join, no shuffle). Feature columns are compared by
column expressions inside generated code. An array column goes to a blocked
kernel by Arrow batches: |x|^2 - 2 x.C + |C|^2 is one matrix product for all
centres, and rows whose two best centres lie within its rounding error are
compared again by plain differences, so that ties go to the lowest id exactly.

A row with a missing feature (a null array, a null or NaN component, or an array
of another length than the centres) has no cluster and no distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 4096


def sq_distance(features: list[str], center: list[float]) -> Column:
    terms = [(F.col(c).cast("double") - F.lit(float(v))) * (F.col(c).cast("double") - F.lit(float(v)))
             for c, v in zip(features, center)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def sq_distance_array(array_col: str, center: list[float]) -> Column:
    """Squared distance between an ARRAY<float|double> column and a centre."""
    cen = F.array(*[F.lit(float(v)) for v in center])
    diffs = F.zip_with(F.col(array_col), cen,
                       lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x)


def nearest(dists: list[Column]) -> Column:
    """struct(d2, cluster) of the nearest centre; ties go to the lowest id. A
    row with a missing feature (NULL or NaN) has no distance and no cluster."""
    best = F.array_min(F.array(*[F.struct(d.alias("d2"), F.lit(i).alias("cluster"))
                                 for i, d in enumerate(dists)]))
    return F.when(dists[0].isNotNull() & ~F.isnan(dists[0]), best)


def rows_of(arrays: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, matrix) of the list rows of a width without nulls or NaN."""
    lengths = np.asarray(arrays.value_lengths().fill_null(-1))
    right = lengths == width
    if not right.any():
        return np.empty(0, np.int64), np.empty((0, width))
    flat = arrays.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if not right.all():
        flat = flat[np.repeat(right[lengths >= 0], lengths[lengths >= 0])]
    matrix = flat.reshape(-1, width)
    good = ~np.isnan(matrix).any(axis=1)
    return np.flatnonzero(right)[good], matrix[good]


def nearest_rows(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each row of ``x``."""
    cluster = np.empty(len(x), np.int32)
    squares, largest = (centers ** 2).sum(axis=1), np.abs(centers).max(initial=0.0)
    for low in range(0, len(x), BLOCK):
        part = x[low:low + BLOCK]
        with np.errstate(all="ignore"):
            d2 = squares - 2 * (part @ centers.T)
            d2 += (own := (part ** 2).sum(axis=1))[:, None]
            slack = 1e-12 * (own + squares.max()) * max(4, x.shape[1])
            best = d2.argmin(axis=1)
            unsure = ~((d2 <= (d2[np.arange(len(part)), best] + slack)[:, None]).sum(axis=1) == 1)
        unsure |= ~(np.abs(part).max(axis=1, initial=0.0) + largest < 1e150)
        for i in np.flatnonzero(unsure):
            with np.errstate(all="ignore"):
                best[i] = ((centers - part[i]) ** 2).sum(axis=1).argmin()
        cluster[low:low + BLOCK] = best
    with np.errstate(all="ignore"):
        return cluster, ((x - centers[cluster]) ** 2).sum(axis=1)


def _nearest_array(array_col: str, centers: list[list[float]]) -> Column:
    points = np.array(centers, float)

    @F.arrow_udf("struct<d2:double,cluster:int>")
    def run(arrays: pa.Array) -> pa.Array:
        at, x = rows_of(arrays, points.shape[1])
        cluster, d2 = nearest_rows(x, points)
        missing = np.ones(len(arrays), bool)
        missing[at] = False
        all_d2, all_cluster = np.zeros(len(arrays)), np.zeros(len(arrays), np.int32)
        all_d2[at], all_cluster[at] = d2, cluster
        return pa.StructArray.from_arrays([pa.array(all_d2), pa.array(all_cluster)], ["d2", "cluster"], mask=pa.array(missing))

    return run(F.col(array_col).cast("array<double>"))


def nearest_of(features: list[str] | str, centers: list[list[float]]) -> Column:
    """struct(d2, cluster) of the nearest of ``centers``, null for a row with a
    missing feature. ``features``: numeric columns, or one array column."""
    if isinstance(features, str):
        return _nearest_array(features, centers)
    return nearest([sq_distance(list(features), c) for c in centers])


def assign_nearest(df: DataFrame, features, centers: list[list[float]],
                   cluster_col: str = "cluster", dist_col: str | None = "dist2") -> DataFrame:
    """Label every row with its nearest centre (``cluster`` INT, and the
    squared distance). ``features`` is a list of numeric columns or the name
    of one array column."""
    out = df.withColumn("__best", nearest_of(features, centers)).withColumn(cluster_col, F.col("__best.cluster"))
    if dist_col:
        out = out.withColumn(dist_col, F.col("__best.d2"))
    return out.drop("__best")
