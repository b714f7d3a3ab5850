"""Hard negatives against a plain search, Strassen against plain products."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.llm import hard_negatives as hn
from quarry.llm.common import Scratch, table
from quarry.llm.queries import QUERIES

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, is_anchor, k=5, scale=256.0):
    """(id, label, vector) rows."""
    taken = []
    for i, label, v in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(scale * float(x)) if abs(scale * float(x)) < 1e300 else 1 << 60 for x in v]
        if sum(x * x for x in v) <= 1 << 56:
            taken.append((i, label, v))
    out = []
    key = lambda found: (-found[0], found[1] is None, found[1])
    for a, (i, label, v) in enumerate(taken):
        if i is None or not is_anchor(i):
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, other) for b, (j, other, w) in enumerate(taken) if a != b]
        best = sorted((s for s in scored if s[2] == label), key=key)[:k]
        others = sorted((s for s in scored if s[2] != label), key=key)
        for score, j, _ in best:
            window = [s for s in others if 80 * score <= 100 * s[0] <= 100 * score][:k]
            out += [(i, j, rank, s[1], score, s[0]) for rank, s in enumerate(window, 1)]
    return sorted(out, key=str)


def moved(i, label):
    return label if i is None or label is None or i % 7 else (label + 1) % 10


def rows_of(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


def test_query(spark):
    got = rows_of(QUERIES["op11_hard_negatives"](spark, "/root/testdata/sf0.01"))
    rows = [(r.vec_id, moved(r.vec_id, r.label), r.embedding) for r in table(spark, "/root/testdata/sf0.01", "embeddings").collect()]
    assert got and got == plain(rows, lambda i: i % 100 == 0)


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 40), st.integers(1, 40), st.integers(1, 40), st.integers(0, 1000), st.integers(1, 5))
def test_strassen(m, k, n, seed, leaf):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-1 << 27, 1 << 27, (m, k)), rng.integers(-1 << 27, 1 << 27, (k, n))
    assert np.array_equal(hn.strassen(a, b, leaf), a @ b)


def test_heaps_cut_ties_by_column():
    scores = np.array([[3, 9, 9, 9, 1], [0, 0, 0, 0, 0]])
    allowed = np.array([[True, True, False, True, True], [False] * 5])
    r, c = hn.heaps(scores, allowed, 2)
    assert r.tolist() == [0, 0] and c.tolist() == [1, 3]
    r, c = hn.heaps(np.zeros((2, 6), int), np.ones((2, 6), bool), 2)
    assert c.tolist() == [0, 1, 0, 1]
    assert len(hn.heaps(scores[:, :2], allowed[:, :2], 5)[0]) == 2


def mined(spark, rows, schema="vec_id long, label int, embedding array<double>", every=3, **settings):
    frame = spark.createDataFrame(rows, schema)
    return hn.mine(frame, F.col("vec_id") % every == 0, Scratch(spark, "t11"), **settings)


def test_many_tiles_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(hn, "TILE_VALUES", 160)
    monkeypatch.setattr(hn, "BLOCK_VALUES", 80)
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(3)), rng.integers(-2, 3, 5).astype(float).tolist()) for i in range(-30, 120)]
    rows += [(i, 1, [1.0, 1.0, 0.0, 0.0, 1.0]) for i in range(200, 260)]  # a third are copies
    rows += [(9, 1, [1.0] * 5), (9, 2, [1.0] * 5), (9, 2, [1.0] * 5), (None, 0, [2.0] * 5), (None, 1, [2.0] * 5)]
    got = rows_of(mined(spark, rows, every=10))
    assert got and got == plain(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (3, 1, [0.5]), (1, 1, [1.0, 0.25, 3.0]), (2, 2, [0.4, 0.1]), (4, 2, [0.0, 0.0]), (6, 2, []), (5, None, [1.0, 1.0]),
            (7, 2, None), (8, 2, [nan, 1.0]), (9, 2, [inf]), (10, 2, [None, 1.0]), (11, 2, [1e300]), (12, 1, [1e308, 1.0]), (13, 3, [0.9, 0.5]), (15, 1, [-1.0, -1.0])]
    assert rows_of(mined(spark, rows)) == plain(rows, lambda i: i % 3 == 0)
    wide = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, label int, embedding array<double>, row long, tile int, x int")
    assert rows_of(hn.mine(wide, F.col("vec_id") % 3 == 0, Scratch(spark, "t11"))) == plain(rows, lambda i: i % 3 == 0)
    assert mined(spark, []).count() == 0
    assert mined(spark, [(1, 1, [1.0]), (2, 1, [1.0])]).count() == 0


def test_settings(spark):
    rows = [(i, i % 2, [float(i)]) for i in range(1, 12)]
    got = mined(spark, rows, positives=2, negatives=1, low=0).collect()
    assert {(r.anchor_id, r.positive_rank, r["rank"]) for r in got} == {(a, p, 1) for a in (3, 6, 9) for p in (1, 2)}
    assert all(r.positive_score == 256 * r.anchor_id * 256 * r.positive_id for r in got)


@pytest.mark.parametrize("length", [3000])
def test_very_long_vectors(spark, length):
    rng = np.random.default_rng(1)
    rows = [(i, i % 2, rng.normal(size=length).tolist()) for i in range(40)]
    assert rows_of(mined(spark, rows, every=5, low=0)) != []
