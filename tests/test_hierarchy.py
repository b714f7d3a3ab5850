"""Agglomerative clustering over summaries against the step-by-step search."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import hierarchy
from quarry.sources.blobs import make_blobs


def plain_ward(counts, means):
    nodes = {i: (n, np.array(m, float)) for i, (n, m) in enumerate(zip(counts, means, strict=True))}
    out = []
    while len(nodes) > 1:
        def gap(pair):
            (n, x), (m, y) = nodes[pair[0]], nodes[pair[1]]
            return n * m / (n + m) * ((x - y) ** 2).sum()
        a, b = min(itertools.combinations(sorted(nodes), 2), key=gap)
        height = gap((a, b))
        (n, x), (m, y) = nodes.pop(a), nodes.pop(b)
        nodes[len(counts) + len(out)] = (n + m, (n * x + m * y) / (n + m))
        out.append((a, b, height))
    return out


def test_chains_find_the_step_by_step_merges():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 60):
        counts, means = rng.integers(1, 20, n).tolist(), rng.normal(size=(n, 3))
        got, want = hierarchy.ward(counts, means), plain_ward(counts, means)
        assert [m[:2] for m in got] == [m[:2] for m in want]
        assert [m[2] for m in got] == pytest.approx([m[2] for m in want])
        assert all(a[2] <= b[2] * (1 + 1e-12) for a, b in itertools.pairwise(got))


def test_blobs_suggest_their_number(spark):
    df = make_blobs(spark, n=600, centers=4, std=0.3, seed=3)
    tree = hierarchy.fit(df, ["x0", "x1"], key="id", leaves=50)
    assert sum(tree.counts) == 600 and tree.suggested_k() == 4
    rows = tree.to_frame(spark).collect()
    assert len(rows) == len(tree.leaves) - 1 and rows[-1].n_rows == 600 and rows[-1].n_clusters == 1
    labelled = hierarchy.label(df, ["x0", "x1"], tree, 4)
    pairs = labelled.groupBy("true_cluster", "cluster").count().collect()
    assert len(pairs) == 4 and len({p.cluster for p in pairs}) == 4
    assert labelled.columns == [*df.columns, "cluster"]


def test_rows_as_leaves_missing_values_and_ties(spark):
    rows = [(1, 0.0), (2, 0.0), (3, 1.0), (4, 10.0), (5, None), (6, float("nan"))]
    df = spark.createDataFrame(rows, "id long, x double")
    tree = hierarchy.fit(df, ["x"], key="id")
    assert sorted(zip([v[0] for v in tree.leaves], tree.counts, strict=True)) == [(0.0, 2), (1.0, 1), (10.0, 1)]
    assert [h for *_, h in tree.merges] == pytest.approx([2 / 3, 3 / 4 * (10 - 1 / 3) ** 2])
    got = {r.id: r.cluster for r in hierarchy.label(df, ["x"], tree, 2).collect()}
    assert got[1] == got[2] == got[3] != got[4] and got[5] is None and got[6] is None
    assert len(set(tree.cut(3))) == 3 and set(tree.cut(1)) == {0} and set(tree.cut(9)) == {0, 1, 2}
    none = hierarchy.fit(df.where("id > 4"), ["x"])
    assert none.leaves == [] and none.suggested_k() == 1 and none.to_frame(spark).count() == 0
    one = hierarchy.fit(df.where("id = 4"), ["x"])
    assert one.merges == [] and one.cut(1) == [0]


def test_partitions_don_t_matter(spark):
    df = make_blobs(spark, n=300, centers=3, std=1.0, seed=5)
    trees = [hierarchy.fit(df.repartition(p), ["x0", "x1"], key="id", leaves=30) for p in (1, 7)]
    assert trees[0].leaves == trees[1].leaves and trees[0].counts == trees[1].counts
    assert [m[:2] for m in trees[0].merges] == [m[:2] for m in trees[1].merges]


def test_pair_cells_and_densities(spark):
    from quarry.operators import plotdata
    rng = np.random.default_rng(0)
    rows = [("a" if i % 3 else None, float(x), None if i % 5 == 0 else float(y), 2.0) for i, (x, y) in enumerate(rng.normal(size=(90, 2)))]
    df = spark.createDataFrame(rows, "g string, x double, y double, c double")
    cells = plotdata.histogram_2d_by(df, "g", ["x", "y", "c"]).collect()
    assert {(r.x, r.y) for r in cells} == {("x", "y"), ("x", "c"), ("y", "c")} and {r.g for r in cells} == {"a"}
    assert sum(r["count"] for r in cells if (r.x, r.y) == ("x", "y")) == sum(g is not None and y is not None for g, _, y, _ in rows)
    assert plotdata.histogram_by(df, "g", ["x"]).where(F.col("g").isNull()).count() == 0
    with pytest.raises(ValueError):
        plotdata.histogram_2d_by(df, "g", ["x"])
    every = {(r.column_name, round(r.grid_x, 9)): r.density for r in plotdata.kde_grids(df, ["x", "y", "c"], gridsize=20).collect()}
    alone = {(r.column_name, round(r.grid_x, 9)): r.density for c in ("x", "y") for r in plotdata.kde_grid(df, c, gridsize=20).collect()}
    assert every.keys() == alone.keys() and all(every[k] == pytest.approx(alone[k]) for k in every)
    assert plotdata.kde_grids(df, ["c"]).count() == 0


def test_overview_bins_dates_and_times(spark):
    from quarry.operators import profile
    df = spark.range(40).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"),
                                F.timestamp_seconds(F.col("id") * 3600).alias("t"),
                                F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("z"), (F.col("id") % 2 == 0).alias("b"))
    rows = profile.overview(df).collect()
    for c, low, high in (("d", 1577836800.0, 1577836800.0 + 39 * 86400), ("t", 0.0, 39 * 3600.0), ("z", 0.0, 39 * 3600.0)):
        bins = [r for r in rows if r.column_name == c and r.kind == "bin"]
        assert len(bins) == 10 and sum(r["count"] for r in bins) == 40 and min(r.lo for r in bins) == low and max(r.hi for r in bins) == high
    assert {r.value for r in rows if r.column_name == "b" and r.kind == "value"} == {"true", "false"}
