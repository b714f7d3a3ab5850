"""Exact split sizes / determinism and exact quantile selection."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators import split
from quarry.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("n", [1, 2, 7, 35, 1000])
def test_split_exact_sizes(spark, n):
    df = spark.range(n).withColumnRenamed("id", "key")
    s = split.three_way_split(df, "key", seed=713)
    got = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    train, val, test = split.split_sizes(n)
    assert got.get("train", 0) == train and got.get("validate", 0) == val
    assert got.get("test", 0) == test
    assert s.select("key").distinct().count() == n


def test_split_sizes_follow_ceil():
    # test = ceil(0.2 * n), validate = ceil(0.3 * rest)
    assert split.split_sizes(35) == (19, 9, 7)
    assert split.split_sizes(1) == (0, 0, 1)
    assert split.split_sizes(15000) == (8400, 3600, 3000)


def test_split_independent_of_partitioning(spark):
    a = split.three_way_split(spark.range(0, 3000, 1, 1).withColumnRenamed("id", "k"), "k")
    b = split.three_way_split(spark.range(0, 3000, 1, 13).withColumnRenamed("id", "k"), "k")
    ra = sorted((r["k"], r["split"]) for r in a.collect())
    rb = sorted((r["k"], r["split"]) for r in b.collect())
    assert ra == rb


def test_split_multi_level_refinement(spark, monkeypatch):
    monkeypatch.setattr(split, "FETCH_MAX", 3)
    monkeypatch.setattr(split, "PREFIX_STEP", 1)
    df = spark.range(500).withColumnRenamed("id", "k")
    s = split.three_way_split(df, "k")
    got = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert (got["train"], got["validate"], got["test"]) == split.split_sizes(500)


def test_split_matches_global_rank(spark):
    df = spark.range(200).withColumnRenamed("id", "k")
    s = {r["k"]: r["split"] for r in split.three_way_split(df, "k").collect()}
    import hashlib
    order = sorted(range(200), key=lambda k: (hashlib.md5(f"713:{k}".encode()).hexdigest(), str(k)))
    train, val, test = split.split_sizes(200)
    want = {k: ("test" if i < test else "validate" if i < test + val else "train")
            for i, k in enumerate(order)}
    assert s == want


def test_stratified_sample(spark):
    rows = [(i, "hot" if i % 3 else "cold") for i in range(3000)] + [(5000, "tiny")]
    df = spark.createDataFrame(rows, "k long, g string")
    out = split.stratified_sample(df, "g", 5, "k")
    got = {r["g"]: r["count"] for r in out.groupBy("g").count().collect()}
    assert got == {"hot": 5, "cold": 5, "tiny": 1}


def test_sample_n_exact_and_deterministic(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = [r["k"] for r in split.sample_n(df, 15, "k", seed=1).collect()]
    b = [r["k"] for r in split.sample_n(df.repartition(7), 15, "k", seed=1).collect()]
    assert len(a) == 15 and sorted(a) == sorted(b)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(min_value=-5, max_value=5), min_size=1, max_size=60),
       st.sampled_from([1, 3, 20_000]))
def test_quantiles_match_numpy(spark, values, fetch):
    df = spark.createDataFrame([(float(v) / 3,) for v in values], "x double")
    got = exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.75, 1.0], fetch_values=fetch)["x"]
    want = np.quantile(np.array(values, dtype=float) / 3, [0.0, 0.25, 0.5, 0.75, 1.0])
    assert np.allclose(got, want, rtol=0, atol=1e-12)


def test_quantiles_heavy_duplicates_and_tails(spark):
    rng = np.random.default_rng(7)
    x = np.concatenate([np.full(3000, 42.0), rng.lognormal(0, 3, 6000)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(5)
    got = exact_quantiles(df, ["x"], [0.1, 0.25, 0.5, 0.75, 0.99], fetch_values=50)["x"]
    assert np.allclose(got, np.quantile(x, [0.1, 0.25, 0.5, 0.75, 0.99]), rtol=1e-12)


def test_quantiles_all_missing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert exact_quantiles(df, ["x"], [0.5])["x"] == [None]


def test_grouped_quantiles_heavy_and_light(spark):
    from quarry.operators.quantiles import grouped_quantiles
    rng = np.random.default_rng(11)
    hot = rng.lognormal(0, 2, 3000)
    rows = [("hot", float(v)) for v in hot] + [("hot", 7.0)] * 500
    rows += [("small", float(v)) for v in rng.normal(0, 1, 40)] + [("one", 3.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    probs = [0.25, 0.5, 0.75]
    out = {r["g"]: r for r in grouped_quantiles(df, "g", "x", probs).collect()}
    for g in ("hot", "small", "one"):
        vals = np.array([v for gg, v in rows if gg == g])
        want = np.quantile(vals, probs)
        got = [out[g][f"q{i}"] for i in range(3)]
        assert np.allclose(got, want, rtol=1e-12), g
        assert out[g]["n"] == len(vals)


@pytest.mark.parametrize("fetch", [5, 20_000])
def test_quantiles_with_infinities(spark, fetch):
    x = np.concatenate([np.random.default_rng(2).normal(size=3000), [np.inf, -np.inf, np.inf]])
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(3)
    got = exact_quantiles(df, ["x"], [0.25, 0.5, 0.75], fetch_values=fetch)["x"]
    assert np.allclose(got, np.quantile(x, [0.25, 0.5, 0.75]), rtol=1e-12)


def test_split_keys_are_unambiguous_and_complete(spark):
    df = spark.createDataFrame([("1|2", "3"), ("1", "2|3"), ("1\\", "|2|3"), ("1\\|2", "3")], "a string, b string")
    texts = [r[0] for r in df.select(split.key_text(["a", "b"])).collect()]
    assert len(set(texts)) == 4
    with pytest.raises(ValueError, match="no complete split key"):
        split.three_way_split(spark.createDataFrame([("1", None), ("2", "3")], df.schema), ["a", "b"])


def test_split_rejects_duplicates_across_a_cut(spark):
    # every key twice: some pair must straddle one of the cuts of 20 rows
    df = spark.createDataFrame([(i // 2,) for i in range(20)], "k long")
    with pytest.raises(ValueError):
        split.three_way_split(df, "k").collect()


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "k long, g string, x double")
    assert split.three_way_split(empty, "k").count() == 0
    assert split.sample_n(empty, 5, "k").count() == 0
    assert split.stratified_sample(empty, "g", 3, "k").count() == 0
    assert exact_quantiles(empty, ["x"], [0.5])["x"] == [None]
    from quarry.operators.quantiles import grouped_quantiles
    assert grouped_quantiles(empty, "g", "x", [0.5]).count() == 0
