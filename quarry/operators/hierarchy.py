"""Hierarchical clustering over summaries, to suggest a number of clusters.

Agglomerative merging compares all pairs, so it runs over a bounded number of
summaries and not over rows: ``leaves`` rows drawn by hash order become leaf
points, each row joins its nearest leaf, and one partially aggregated pass turns
the leaves into clustering features (count, sum of each feature). These are merged
on the driver by Ward's criterion, the growth of the squared distances to
the means, along chains of nearest neighbours: Ward's distance is reducible, so
clusters that are nearest to each other may merge at once, and the merges sorted
by height are those of the step-by-step search. With at least as many leaves as
different rows the dendrogram is that of the rows.

Heights grow along the dendrogram; the largest relative jump between two heights
suggests where to cut. A cut labels rows by their leaf's cluster. Rows with a
missing feature take no part and get no label; equal rows are one leaf. Ties go to
the leaf drawn first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import kmeans
from quarry.operators.distance import assign_nearest

LEAVES = 256


def ward(counts: list[float], means: np.ndarray) -> list[tuple[int, int, float]]:
    """(a, b, height) of each merge in order of height. Nodes 0.. are the leaves,
    merge i makes node len(counts) + i."""
    n, x = np.array(counts, float), np.array(means, float)
    alive, found, chain = np.ones(len(n), bool), [], []
    members = list(range(len(n)))  # a slot's cluster, by the merge that made it
    while alive.sum() > 1:
        if not chain:
            chain.append(int(np.flatnonzero(alive)[0]))
        while True:
            i = chain[-1]
            gap = n * n[i] / (n + n[i]) * ((x - x[i]) ** 2).sum(axis=1)
            gap[i], gap[~alive] = np.inf, np.inf
            j = int(gap.argmin())
            if len(chain) > 1 and gap[chain[-2]] <= gap[j]:
                j = chain[-2]
                break
            chain.append(j)
        a, b = min(i, j), max(i, j)
        found.append((float(gap[j]), members[a], members[b], len(found)))
        x[a] = (n[a] * x[a] + n[b] * x[b]) / (n[a] + n[b])
        n[a] += n[b]
        alive[b] = False
        members[a] = -len(found)  # the merge's own number, until merges are sorted
        chain = chain[:-2]
    order = sorted(range(len(found)), key=lambda k: (found[k][0], k))
    node = {-(k + 1): len(counts) + at for at, k in enumerate(order)}
    out = []
    for k in order:
        height, a, b, _ = found[k]
        a, b = (node[m] if m < 0 else m for m in (a, b))
        out.append((min(a, b), max(a, b), height))
    return out


@dataclass
class Hierarchy:
    leaves: list[list[float]]        # leaf points, in the order drawn
    counts: list[int]                # rows of each leaf
    merges: list[tuple[int, int, float]]

    def suggested_k(self, most: int = 20) -> int:
        """Clusters left before the merge that is relatively highest above the one
        before it, among the last ``most`` merges; 1 without any jump."""
        heights = [h for *_, h in self.merges]
        jumps = [(heights[i] / heights[i - 1] if heights[i - 1] > 0 else float("inf"), len(heights) - i + 1)
                 for i in range(max(1, len(heights) - most + 1), len(heights)) if heights[i] > heights[i - 1]]
        return min(jumps, key=lambda j: (-j[0], j[1]))[1] if jumps else 1

    def cut(self, k: int) -> list[int]:
        """Each leaf's cluster when ``k`` clusters are left, numbered by their first leaf."""
        group = list(range(len(self.leaves) + len(self.merges)))
        for i, (a, b, _) in enumerate(self.merges[:max(0, len(self.leaves) - k)]):
            group[a] = group[b] = len(self.leaves) + i
        tops = []
        for leaf in range(len(self.leaves)):
            at = leaf
            while group[at] != at:
                at = group[at]
            tops.append(at)
        number = {t: i for i, t in enumerate(dict.fromkeys(tops))}
        return [number[t] for t in tops]

    def to_frame(self, spark) -> DataFrame:
        """(step, n_clusters, height, n_rows, n_leaves): a row per merge."""
        rows, size, leaves = [], list(self.counts), [1] * len(self.counts)
        for i, (a, b, height) in enumerate(self.merges):
            size.append(size[a] + size[b])
            leaves.append(leaves[a] + leaves[b])
            rows.append((i + 1, len(self.leaves) - i - 1, height, size[-1], leaves[-1]))
        return spark.createDataFrame(rows, "step int, n_clusters int, height double, n_rows long, n_leaves int")


def fit(df: DataFrame, features, key: str | list[str] | None = None, leaves: int = LEAVES, seed: int = 713) -> Hierarchy:
    """The dendrogram of all rows over ``leaves`` summaries."""
    points = kmeans.points_of(df, features, key).persist()
    try:
        drawn = points.select(F.md5(F.concat(F.lit(f"{seed}:"), "key").cast("binary")).alias("h"), "key", "v").orderBy("h", "key", "v").limit(leaves).collect()
        centers = [list(v) for v in dict.fromkeys(tuple(r["v"]) for r in drawn)]
        if not centers:
            return Hierarchy([], [], [])
        sums = kmeans.cluster_sums(points, {0: centers})[0]
    finally:
        points.unpersist()
    used = sorted(sums)
    means = np.array([sums[i][2] for i in used])
    counts = [sums[i][0] for i in used]
    return Hierarchy([centers[i] for i in used], counts, ward(counts, means))


def label(df: DataFrame, features, hierarchy: Hierarchy, k: int, cluster_col: str = "cluster") -> DataFrame:
    """Rows with the cluster of their leaf when ``k`` clusters are left."""
    out = assign_nearest(df, features, hierarchy.leaves, cluster_col="__leaf", dist_col=None)
    of = F.array(*[F.lit(c) for c in hierarchy.cut(k)])
    return out.withColumn(cluster_col, F.get(of, F.col("__leaf"))).drop("__leaf")
