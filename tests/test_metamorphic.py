"""Results do not depend on how the input is partitioned."""

import pytest

from quarry.operators import clean, joins, plotdata, profile, split
from quarry.operators.quantiles import exact_quantiles, grouped_quantiles

from conftest import SF001

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def li(spark):
    return spark.read.parquet(f"{SF001}/lineitem.parquet")


@pytest.mark.parametrize("parts", [1, 5, 13])
def test_selection_and_grouping(spark, li, parts):
    re = li.repartition(parts)
    cols = ["l_quantity", "l_extendedprice"]
    assert exact_quantiles(re, cols, [0.1, 0.5, 0.9]) == exact_quantiles(li, cols, [0.1, 0.5, 0.9])
    assert _rows(grouped_quantiles(re, "l_returnflag", "l_extendedprice", [0.5])) == \
        _rows(grouped_quantiles(li, "l_returnflag", "l_extendedprice", [0.5]))
    assert _rows(clean.remove_outliers(re, 1.5, cols)) == _rows(clean.remove_outliers(li, 1.5, cols))


@pytest.mark.parametrize("parts", [1, 7])
def test_split_samples_and_plots(spark, li, parts):
    re = li.repartition(parts)
    assert _rows(split.three_way_split(re, KEY)) == _rows(split.three_way_split(li, KEY))
    assert _rows(split.sample_n(re, 9, KEY)) == _rows(split.sample_n(li, 9, KEY))
    assert _rows(split.stratified_sample(re, "l_returnflag", 4, KEY)) == \
        _rows(split.stratified_sample(li, "l_returnflag", 4, KEY))
    assert _rows(plotdata.histogram_2d(re, "l_quantity", "l_discount")) == \
        _rows(plotdata.histogram_2d(li, "l_quantity", "l_discount"))
    assert _rows(profile.value_counts_strings(re)) == _rows(profile.value_counts_strings(li))


@pytest.mark.parametrize("parts", [1, 9])
def test_latest_per_key_and_drops(spark, parts):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    re = o.repartition(parts)
    for ties in ("keep", "first"):
        assert _rows(joins.latest_per_key(re, "o_custkey", "o_orderdate", ties, "o_orderkey")) == \
            _rows(joins.latest_per_key(o, "o_custkey", "o_orderdate", ties, "o_orderkey"))
    assert _rows(clean.drop_missing(re)) == _rows(clean.drop_missing(o))
