"""Cross-polytope near-duplicates against all pairs."""

import numpy as np

from quarry.llm import cross_polytope as cp
from quarry.llm.common import Scratch, table
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def plain(rows, threshold=0.95):
    ids = [i for i, _ in rows]
    v = np.array([x for _, x in rows], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    close = v @ v.T >= threshold
    np.fill_diagonal(close, False)
    label = list(ids)
    changed = True
    while changed:
        changed = False
        for a, b in zip(*np.nonzero(close), strict=True):
            if label[a] > label[b]:
                label[a], changed = label[b], True
    return {i: (int(close[k].sum()), label[k], i == label[k]) for k, i in enumerate(ids)}


def groups(rng, d, sizes, noise):
    out = []
    for size in sizes:
        base = rng.normal(size=d)
        base /= np.linalg.norm(base)
        for _ in range(size):
            out.append((base + noise * rng.uniform(0.2, 1) * rng.normal(size=d) / np.sqrt(d)).round(4).tolist())
    return out


def as_dict(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    want, got = plain(rows), as_dict(QUERIES["op7_cross_polytope"](spark, SF))
    assert got == want


def test_groups_over_many_tiles(spark):
    """Each pair is counted once however many buckets and tiles it shares."""
    rng = np.random.default_rng(2)
    vectors = groups(rng, 64, [150, 40] + [1] * 60 + [3] * 20, 0.2)
    vectors += [vectors[0]] * 5 + [vectors[200]] * 2 + [(2 * np.array(vectors[3])).tolist()]
    rows = [(int(i), v) for i, v in zip(rng.permutation(len(vectors)) * 3 - 100, vectors, strict=True)]
    frame = spark.createDataFrame([(*r, None) for r in rows], "vec_id long, embedding array<double>, n_links string").repartition(4)
    want = plain(rows)
    got = as_dict(cp.near_duplicates(frame, Scratch(spark, "t7"), part_rows=16))
    assert got == want
    assert got == as_dict(cp.near_duplicates(frame, Scratch(spark, "t7"), part_rows=10_000))


def test_recall_at_the_threshold():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    g = rng.normal(size=a.shape)
    g -= (g * a).sum(axis=1, keepdims=True) * a
    g /= np.linalg.norm(g, axis=1, keepdims=True)
    b = 0.95 * a + np.sqrt(1 - 0.95 ** 2) * g
    x, y = cp.buckets(a), cp.buckets(b)
    met = (x[:, :, :1] == y).any(axis=2) | (y[:, :, :1] == x).any(axis=2)
    assert met.any(axis=1).mean() > 0.998


def test_hadamard():
    x = np.random.default_rng(1).normal(size=(3, 8))
    h = np.array([[1.0]])
    for _ in range(3):
        h = np.block([[h, h], [h, -h]])
    assert np.allclose(cp.hadamard(x), x @ h)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0]), (3, [2.0, 4.0, 6.0]), (4, None), (5, [0.0, 0.0, 0.0]), (6, [nan, 1.0, 1.0]), (7, [1.0, None, 1.0]), (8, [inf, 1.0, 1.0]), (9, []),
            (10, [1.0, 2.0]), (11, [-1.0, -2.0, -3.0]), (None, [1.0, 2.0, 3.0]), (None, None), (12, [5.0]), (13, [7.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = cp.near_duplicates(frame, Scratch(spark, "t7")).collect()
    assert len(got) == len(rows)
    want = {i: (0, i, True) for i in range(1, 14)} | {1: (2, 1, True), 2: (2, 1, False), 3: (2, 1, False), 12: (1, 12, True), 13: (1, 12, False)}
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None} == want
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)] * 2
    assert cp.near_duplicates(frame.limit(0), Scratch(spark, "t7")).collect() == []


def test_extreme_sizes(spark):
    """Vectors of any finite size: no square overflows or vanishes."""
    base, other = [1.0, 2.0, -1.0, 0.5], [1.0, -2.0, 1.0, 0.5]
    rows = [(i, [x * s for x in v]) for i, (v, s) in enumerate((v, s) for s in (1e-170, 1e160, 1e307, 1.0) for v in (base, other))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = as_dict(cp.near_duplicates(frame, Scratch(spark, "t7")))
    assert got == {i: (3, i % 2, i < 2) for i in range(8)}
