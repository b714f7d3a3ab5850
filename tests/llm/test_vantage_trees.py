"""Vantage-point trees against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import vantage_trees as vt
from quarry.llm.common import Scratch, table
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def plain(rows, queries, k):
    ids = np.array(sorted(rows))
    m = np.array([rows[i] for i in ids], float)
    out = {}
    for q in queries:
        scores = np.einsum("ij,ij->i", np.broadcast_to(np.array(rows[q], float), m.shape), m)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_query_recall(spark):
    rows = {r.vec_id: r.embedding for r in table(spark, SF, "embeddings").collect()}
    want = plain(rows, [i for i in rows if i % 20 == 0], 20)
    got = results(QUERIES["op2_vantage_trees"](spark, SF))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    for q, found in got.items():
        assert all(s == pytest.approx(np.dot(np.array(rows[q], float), np.array(rows[i], float)), abs=1e-12) for i, s in found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0])) and q not in dict(found)


def test_factor_one_is_exact(spark, monkeypatch):
    """Lengths differ, so the largest product is not the nearest vector."""
    monkeypatch.setattr(vt, "SHARD_ROWS", 300)
    monkeypatch.setattr(vt, "BLOCK_ROWS", 20)
    rng = np.random.default_rng(3)
    rows = {int(i): (rng.normal(size=6) * rng.uniform(0.1, 5)).round(1).tolist() for i in rng.permutation(1000) - 200}
    for i in range(0, 200, 7):
        rows[5000 + i] = rows[i]  # ties
    frame = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    got = results(vt.nearest(frame, F.col("vec_id") % 5 == 0, Scratch(spark, "t2"), k=9, factor=1.0))
    want = plain(rows, [i for i in rows if i % 5 == 0], 9)
    assert {q: [i for i, _ in f] for q, f in got.items()} == {q: [i for i, _ in f] for q, f in want.items()}


def test_pruning_saves_work_and_keeps_the_best():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(4000, 3))
    tree = vt.build(points, leaf=20)
    assert sorted(tree.order) == list(range(4000))
    ids, q = np.arange(4000), points[:50] + 0.01
    exact = vt.Search(tree, points, ids, q, np.arange(50) - 100, 10, 1.0)
    who, at = exact.run()
    assert exact.evaluated < 0.5 * 50 * 4000
    away = np.sqrt(((q[:, None] - points) ** 2).sum(axis=2))
    for i in range(50):
        assert set(np.argsort(away[i])[:10]) <= set(tree.order[at[who == i]])
    relaxed = vt.Search(tree, points, ids, q, np.arange(50) - 100, 10, 3.0)
    relaxed.run()
    assert relaxed.evaluated < exact.evaluated


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0 * i, 2.0, -1.0], "l", 0) for i in range(1, 45)] + [(20, [20.0, 2.0, -1.0], "again", 0), (100, None, None, None), (120, [0.0, 0.0, 0.0], None, 1), (140, [1.0, nan, 0.0], None, 1),
            (160, [1.0, inf, 0.0], None, 1), (180, [1.0, None, 0.0], None, 1), (200, [1.0], None, 1), (220, [], None, 1), (None, [9.0, 9.0, 9.0], None, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string, rank int")
    got = results(vt.nearest(frame, F.col("vec_id") % 20 == 0, Scratch(spark, "t2"), factor=1.0))
    assert got == plain({i: v for i, v, *_ in rows[:44]}, [20, 40], 20)
    assert vt.nearest(frame.limit(0), F.col("vec_id") % 20 == 0, Scratch(spark, "t2")).collect() == []
    one = frame.where("vec_id = 40")
    assert vt.nearest(one, F.col("vec_id") % 20 == 0, Scratch(spark, "t2")).collect() == []


@pytest.mark.parametrize("kind", ["one of norm 10", "one of norm 1000", "lognormal", "one of 1e160", "clusters"])
def test_recall_with_unequal_norms(spark, monkeypatch, kind):
    monkeypatch.setattr(vt, "SHARD_ROWS", 1000)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 16))
    if kind == "clusters":
        x = rng.normal(size=(10, 16))[rng.integers(10, size=3000)] + 0.1 * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "lognormal":
        x *= rng.lognormal(sigma=1.0, size=(3000, 1))
    elif kind.startswith("one"):
        x[17] *= {"10": 10.0, "1000": 1e3, "1e160": 1e160}[kind.split()[-1]]
    rows = {i: v for i, v in enumerate(x.tolist())}
    frame = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    want = plain(rows, range(0, 3000, 60), 20)
    got = results(vt.nearest(frame, F.col("vec_id") % 60 == 0, Scratch(spark, "t2")))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 20 * len(want)
