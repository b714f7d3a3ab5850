"""Registered queries, part 2: overview, outliers, split / sampling, scaling,
plot data, group statistics."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from quarry.operators import clean, plotdata, profile, split, stats
from quarry.operators.scale import apply_scaler, fit_scaler, inverse_scaler
from quarry.plans.acquire import customer_features
from quarry.plans.catalog import GAPPY_LINEITEM_SQL, gappy_lineitem, register
from quarry.sources.tables import read_table

# ------------------------------------------------------------- overview

def _overview_sql(table: str, cols: list[str], numeric: list[str], thresh: int = 10,
                  limit: int = 150, bins: int = 10) -> str:
    """Oracle SQL for ``profile.overview``: the value-count / binned choice is
    made in SQL from the distinct counts, not written in."""
    vals = "\n  UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {table}"
                                 for c in cols)
    parts = [f"""
  SELECT v.column_name, nu.n_unique, 'value' AS kind, v.value,
         CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi, count(*) AS count
  FROM vals v JOIN nu USING (column_name) WHERE nu.n_unique <= {thresh}
  GROUP BY v.column_name, nu.n_unique, v.value""", """
  SELECT v.column_name, nu.n_unique, 'column', NULL, NULL, NULL, count(v.value)
  FROM vals v JOIN nu USING (column_name) GROUP BY v.column_name, nu.n_unique"""]
    for c in numeric:
        st = f"(SELECT CAST(min({c}) AS DOUBLE) AS mn, CAST(max({c}) AS DOUBLE) AS mx FROM {table})"
        w = f"((st.mx - st.mn) / {bins})"
        parts.append(f"""
  SELECT '{c}', nu.n_unique, 'bin', CAST(b.bin AS VARCHAR), b.lo, b.hi, COALESCE(k.n, 0)
  FROM (SELECT r.i + 1 AS bin,
               CASE WHEN r.i = 0 THEN st.mn ELSE st.mn + r.i * {w} END AS lo,
               CASE WHEN r.i = {bins - 1} THEN st.mx ELSE st.mn + (r.i + 1) * {w} END AS hi
        FROM range(0, {bins}) r(i), {st} st) b
  JOIN nu ON nu.column_name = '{c}' AND nu.n_unique > {thresh} AND nu.n_unique < {limit}
  LEFT JOIN (SELECT 1 + (SELECT count(*) FROM range(1, {bins}) e(i)
                         WHERE t.{c} > st.mn + e.i * {w}) AS bin, count(*) AS n
             FROM {table} t, {st} st WHERE t.{c} IS NOT NULL GROUP BY 1) k USING (bin)""")
    return f"""WITH vals AS (
  {vals}),
nu AS (SELECT column_name, count(DISTINCT value) AS n_unique FROM vals GROUP BY column_name)
SELECT column_name, CAST(n_unique AS BIGINT) AS n_unique, kind, value, lo, hi,
       CAST(count AS BIGINT) AS count
FROM ({" UNION ALL ".join(parts)})"""


@register("overview", _overview_sql(
    "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    ["p_partkey", "p_size", "p_retailprice"]))
def overview(spark, sf_dir):
    return profile.overview(read_table(spark, sf_dir, "part"), thresh=10)


@register("overview_events", _overview_sql(
    "events", ["event_id", "ts", "user_id", "event_type", "value", "props"],
    ["event_id", "user_id", "value"]))
def overview_events(spark, sf_dir):
    # user_id has exactly 150 distinct values at sf0.01: not binned (< 150)
    return profile.overview(read_table(spark, sf_dir, "events"), thresh=10)


@register("overview_months", """
WITH o AS (SELECT epoch(date_trunc('month', o_orderdate)) AS x, o_orderstatus FROM orders),
st AS (SELECT min(x)::DOUBLE AS mn, (max(x)::DOUBLE - min(x)::DOUBLE) / 10 AS w, max(x)::DOUBLE AS mx, count(DISTINCT x) AS d, count(x) AS n FROM o),
b AS (SELECT 1 + (SELECT count(*) FROM range(1, 10) e(i) WHERE o.x > st.mn + e.i * st.w) AS bin, count(*) AS n FROM o, st GROUP BY 1)
SELECT 'order_month' AS column_name, d AS n_unique, 'column' AS kind, NULL AS value, NULL::DOUBLE AS lo, NULL::DOUBLE AS hi, n AS count FROM st
UNION ALL
SELECT 'order_month', d, 'bin', CAST(r.i + 1 AS VARCHAR), CASE WHEN r.i = 0 THEN mn ELSE mn + r.i * w END,
       CASE WHEN r.i = 9 THEN mx ELSE mn + (r.i + 1) * w END, coalesce(b.n, 0)
FROM st, range(0, 10) r(i) LEFT JOIN b ON b.bin = r.i + 1
UNION ALL
SELECT 'o_orderstatus', (SELECT count(DISTINCT o_orderstatus) FROM o), 'column', NULL, NULL, NULL, count(o_orderstatus) FROM o
UNION ALL
SELECT 'o_orderstatus', (SELECT count(DISTINCT o_orderstatus) FROM o), 'value', o_orderstatus, NULL, NULL, count(*) FROM o GROUP BY o_orderstatus
""")
def overview_months(spark, sf_dir):
    # a time column with more than 10 and fewer than 150 values is binned
    orders = read_table(spark, sf_dir, "orders")
    return profile.overview(orders.select(F.date_trunc("month", "o_orderdate").alias("order_month"), "o_orderstatus"))


# ------------------------------------------------------------- outliers

_IQR_COLS = ["l_extendedprice", "l_quantity", "l_tax"]


def _iqr_chain_sql(cols, src, k=1.5):
    ctes, prev = [], src
    for i, c in enumerate(cols):
        q = f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {prev})"
        ctes.append(f"""s{i} AS (SELECT * FROM {prev}
  WHERE {c} > (SELECT q1 - {k} * (q3 - q1) FROM {q})
    AND {c} < (SELECT q3 + {k} * (q3 - q1) FROM {q}))""")
        prev = f"s{i}"
    return ctes, prev


_ctes, _last = _iqr_chain_sql(_IQR_COLS, "gappy")


@register("remove_outliers_iqr", "WITH " + GAPPY_LINEITEM_SQL + ",\n" + ",\n".join(_ctes)
          + f"\nSELECT * FROM {_last}")
def remove_outliers_iqr(spark, sf_dir):
    return clean.remove_outliers(gappy_lineitem(spark, sf_dir), 1.5, _IQR_COLS)


# ------------------------------------------------------- split, sampling


def _split_sql(table, key_sql, seed=713, test=0.2, val=0.3, cols="*"):
    return f"""
WITH r AS (SELECT {cols}, row_number() OVER (ORDER BY md5('{seed}:' || {key_sql}), {key_sql}) AS rn,
                  count(*) OVER () AS n FROM {table}),
c AS (SELECT *, CAST(ceil(CAST({test} AS DOUBLE) * n) AS BIGINT) AS n_test FROM r),
d AS (SELECT *, CAST(ceil(CAST({val} AS DOUBLE) * (n - n_test)) AS BIGINT) AS n_val FROM c)
SELECT * EXCLUDE (rn, n, n_test, n_val),
       CASE WHEN rn <= n_test THEN 'test' WHEN rn <= n_test + n_val THEN 'validate'
            ELSE 'train' END AS split
FROM d"""


@register("split_three_way", _split_sql("orders", "CAST(o_orderkey AS VARCHAR)",
                                        cols="o_orderkey, o_custkey"))
def split_three_way(spark, sf_dir):
    df = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return split.three_way_split(df, "o_orderkey", seed=713)


@register("split_sizes", """
SELECT split, count(*) AS n FROM (""" + _split_sql("orders", "CAST(o_orderkey AS VARCHAR)",
                                                   cols="o_orderkey") + """)
GROUP BY split""")
def split_sizes(spark, sf_dir):
    df = read_table(spark, sf_dir, "orders").select("o_orderkey")
    return (split.three_way_split(df, "o_orderkey", seed=713).groupBy("split")
            .agg(F.count(F.lit(1)).alias("n")))


@register("sample_n", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), CAST(o_orderkey AS VARCHAR) LIMIT 15
""")
def sample_n(spark, sf_dir):
    df = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return split.sample_n(df, 15, "o_orderkey", seed=42)


@register("head_n", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderkey LIMIT 5
""")
def head_n(spark, sf_dir):
    df = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return split.head_n(df, 5, "o_orderkey")


# ---------------------------------------------------------------- scaling


@register("scale_standard", """
SELECT l_orderkey, l_linenumber,
       round_even((l_extendedprice - avg(l_extendedprice) OVER ())
                  / stddev_pop(l_extendedprice) OVER (), 6) AS l_extendedprice,
       round_even((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6)
         AS l_quantity
FROM lineitem
""")
def scale_standard(spark, sf_dir):
    df = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber",
                                                      "l_extendedprice", "l_quantity")
    out = apply_scaler(df, fit_scaler(df, ["l_extendedprice", "l_quantity"], "standard"))
    return out.select("l_orderkey", "l_linenumber",
                      F.bround("l_extendedprice", 6).alias("l_extendedprice"),
                      F.bround("l_quantity", 6).alias("l_quantity"))


_SPEND_SQL = """
feat AS (SELECT c.c_custkey, c.c_acctbal, COALESCE(s.total_spend, 0.0) AS total_spend
         FROM customer c LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS total_spend
                                    FROM orders GROUP BY o_custkey) s
           ON s.o_custkey = c.c_custkey)"""


@register("scale_minmax", "WITH " + _SPEND_SQL + """
SELECT c_custkey,
       round_even((c_acctbal - min(c_acctbal) OVER ())
                  / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()), 9) AS c_acctbal,
       round_even((total_spend - min(total_spend) OVER ())
                  / (max(total_spend) OVER () - min(total_spend) OVER ()), 9) AS total_spend
FROM feat
""")
def scale_minmax(spark, sf_dir):
    df = customer_features(spark, sf_dir)
    out = apply_scaler(df, fit_scaler(df, ["c_acctbal", "total_spend"], "minmax"))
    return out.select("c_custkey", F.bround("c_acctbal", 9).alias("c_acctbal"),
                      F.bround("total_spend", 9).alias("total_spend"))


@register("scale_inverse", "WITH " + _SPEND_SQL + """
SELECT c_custkey, round_even(c_acctbal, 6) AS c_acctbal, round_even(total_spend, 6) AS total_spend
FROM feat
""")
def scale_inverse(spark, sf_dir):
    df = customer_features(spark, sf_dir)
    st = fit_scaler(df, ["c_acctbal", "total_spend"], "minmax")
    back = inverse_scaler(apply_scaler(df, st), st)
    return back.select("c_custkey", F.bround("c_acctbal", 6).alias("c_acctbal"),
                       F.bround("total_spend", 6).alias("total_spend"))


# -------------------------------------------------------------- plot data


@register("box_stats", "WITH q AS (" + "\nUNION ALL".join(
    f"""
  SELECT '{c}' AS column_name, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
         quantile_cont({c}, 0.75) AS q3 FROM lineitem""" for c in
    ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]) + ")\n" + """
SELECT q.column_name, q.q1, q.median, q.q3,
       CAST(min(CASE WHEN v.x >= q.q1 - 1.5 * (q.q3 - q.q1) THEN v.x END) AS DOUBLE) AS whisker_lo,
       CAST(max(CASE WHEN v.x <= q.q3 + 1.5 * (q.q3 - q.q1) THEN v.x END) AS DOUBLE) AS whisker_hi,
       count_if(v.x < q.q1 - 1.5 * (q.q3 - q.q1) OR v.x > q.q3 + 1.5 * (q.q3 - q.q1)) AS n_outliers
FROM q JOIN (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
             ON COLUMNS(*) INTO NAME column_name VALUE x) v USING (column_name)
GROUP BY q.column_name, q.q1, q.median, q.q3
""")
def box_stats(spark, sf_dir):
    return plotdata.box_stats(read_table(spark, sf_dir, "lineitem"),
                              ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@register("box_stats_by_category", """
WITH q AS (SELECT l_returnflag, count(l_extendedprice) AS n,
                  quantile_cont(l_extendedprice, 0.25) AS q1,
                  quantile_cont(l_extendedprice, 0.5) AS median,
                  quantile_cont(l_extendedprice, 0.75) AS q3
           FROM lineitem GROUP BY l_returnflag)
SELECT q.l_returnflag, q.n, q.q1, q.median, q.q3,
       min(CASE WHEN l.l_extendedprice >= q.q1 - 1.5 * (q.q3 - q.q1) THEN l.l_extendedprice END)
         AS whisker_lo,
       max(CASE WHEN l.l_extendedprice <= q.q3 + 1.5 * (q.q3 - q.q1) THEN l.l_extendedprice END)
         AS whisker_hi,
       count_if(l.l_extendedprice < q.q1 - 1.5 * (q.q3 - q.q1)
                OR l.l_extendedprice > q.q3 + 1.5 * (q.q3 - q.q1)) AS n_outliers
FROM q JOIN lineitem l USING (l_returnflag)
GROUP BY q.l_returnflag, q.n, q.q1, q.median, q.q3
""")
def box_stats_by_category(spark, sf_dir):
    return plotdata.box_stats_by(read_table(spark, sf_dir, "lineitem"), "l_returnflag",
                                 "l_extendedprice")


def _left_bin_sql(c, st):
    return (f"(SELECT count(*) FROM range(1, 10) e(i) "
            f"WHERE {c} >= {st}.mn_{c} + e.i * (({st}.mx_{c} - {st}.mn_{c}) / 10))")


@register("histogram_2d", """
WITH st AS (SELECT min(l_quantity) AS mn_l_quantity, max(l_quantity) AS mx_l_quantity,
                   min(l_discount) AS mn_l_discount, max(l_discount) AS mx_l_discount
            FROM lineitem)
SELECT bin_x, bin_y, count(*) AS count
FROM (SELECT CAST(""" + _left_bin_sql("l_quantity", "st") + """ AS INT) AS bin_x,
             CAST(""" + _left_bin_sql("l_discount", "st") + """ AS INT) AS bin_y
      FROM lineitem, st)
GROUP BY bin_x, bin_y
""")
def histogram_2d(spark, sf_dir):
    return plotdata.histogram_2d(read_table(spark, sf_dir, "lineitem"), "l_quantity", "l_discount")


@register("histogram_by_class", """
WITH st AS (SELECT min(l_quantity) AS mn_l_quantity, max(l_quantity) AS mx_l_quantity,
                   min(l_discount) AS mn_l_discount, max(l_discount) AS mx_l_discount
            FROM lineitem)
SELECT l_returnflag, column_name, bin, count(*) AS count FROM (
  SELECT l_returnflag, 'l_quantity' AS column_name,
         CAST(""" + _left_bin_sql("l_quantity", "st") + """ AS INT) AS bin FROM lineitem, st
  UNION ALL
  SELECT l_returnflag, 'l_discount', CAST(""" + _left_bin_sql("l_discount", "st") + """ AS INT)
  FROM lineitem, st)
GROUP BY l_returnflag, column_name, bin
""")
def histogram_by_class(spark, sf_dir):
    return plotdata.histogram_by(read_table(spark, sf_dir, "lineitem"), "l_returnflag",
                                 ["l_quantity", "l_discount"])


_PAIR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("pair_plot_by_class", "WITH st AS (SELECT " + ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in _PAIR_COLS) + """ FROM lineitem),
b AS (SELECT l_returnflag, """ + ", ".join(f"CAST({_left_bin_sql(c, 'st')} AS INT) AS b_{c}" for c in _PAIR_COLS) + " FROM lineitem, st)" + "\nUNION ALL".join(
    f"""
SELECT l_returnflag, '{a}' AS x, '{b}' AS y, b_{a} AS bin_x, b_{b} AS bin_y, count(*) AS count FROM b GROUP BY ALL"""
    for i, a in enumerate(_PAIR_COLS) for b in _PAIR_COLS[i + 1:]))
def pair_plot_by_class(spark, sf_dir):
    return plotdata.histogram_2d_by(read_table(spark, sf_dir, "lineitem"), "l_returnflag", _PAIR_COLS)


@register("pair_regression", "\nUNION ALL".join(
    f"""
SELECT '{a}' AS x, '{b}' AS y, CAST(regr_count({b}, {a}) AS BIGINT) AS n,
       round_even(regr_slope({b}, {a}), 6) AS slope,
       round_even(regr_intercept({b}, {a}), 6) AS intercept,
       round_even(corr({a}, {b}), 6) AS r, round_even(regr_r2({b}, {a}), 6) AS r2 FROM lineitem"""
    for i, a in enumerate(_PAIR_COLS) for b in _PAIR_COLS[i + 1:]))
def pair_regression(spark, sf_dir):
    out = plotdata.pair_regression(read_table(spark, sf_dir, "lineitem"), _PAIR_COLS)
    return out.select("x", "y", "n", *[F.bround(c, 6).alias(c)
                                       for c in ("slope", "intercept", "r", "r2")])


@register("kde_grid", """
WITH st AS (SELECT count(l_extendedprice) AS n, stddev_samp(l_extendedprice) AS sd,
                   min(l_extendedprice) AS mn, max(l_extendedprice) AS mx FROM lineitem),
p AS (SELECT n, mn, mx, sd * pow(n, -0.2) AS h, (mx - mn) / 2048 AS w FROM st),
b AS (SELECT p.mn + (least(floor((l.l_extendedprice - p.mn) / p.w), 2047) + 0.5) * p.w AS center,
             count(*) AS c
      FROM lineitem l, p GROUP BY 1),
g AS (SELECT (p.mn - 3.0 * p.h) + r.i * (((p.mx + 3.0 * p.h) - (p.mn - 3.0 * p.h)) / 199) AS grid_x
      FROM range(0, 200) r(i), p)
SELECT 'l_extendedprice' AS column_name, round_even(g.grid_x, 6) AS grid_x,
       round_even(sum(b.c * exp(-0.5 * pow((g.grid_x - b.center) / p.h, 2)))
                  * (1.0 / (p.n * p.h * sqrt(2.0 * pi()))), 15) AS density
FROM g, b, p GROUP BY g.grid_x, p.n, p.h
""")
def kde_grid(spark, sf_dir):
    out = plotdata.kde_grid(read_table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return out.select("column_name", F.bround("grid_x", 6).alias("grid_x"),
                      F.bround("density", 15).alias("density"))


def _panel_sql(c: str) -> str:
    """Box, histogram and density of one column as rows of one shape."""
    return f"""
SELECT * FROM (
  WITH st AS (SELECT count({c}) AS n, stddev_samp({c}) AS sd, min({c}) AS mn_{c}, max({c}) AS mx_{c},
                     quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM lineitem),
  p AS (SELECT *, mn_{c} AS mn, mx_{c} AS mx, sd * pow(n, -0.2) AS h, (mx_{c} - mn_{c}) / 2048 AS w, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM st),
  b AS (SELECT p.mn + (least(floor((l.{c} - p.mn) / p.w), 2047) + 0.5) * p.w AS center, count(*) AS c FROM lineitem l, p GROUP BY 1),
  g AS (SELECT (p.mn - 3.0 * p.h) + r.i * (((p.mx + 3.0 * p.h) - (p.mn - 3.0 * p.h)) / 199) AS grid_x FROM range(0, 200) r(i), p),
  f AS (SELECT {_left_bin_sql(c, 'st')} AS bin, count(*) AS n FROM lineitem, st GROUP BY 1),
  v AS (SELECT min(CASE WHEN l.{c} >= low THEN l.{c} END) AS wl, max(CASE WHEN l.{c} <= high THEN l.{c} END) AS wh, count_if(l.{c} < low OR l.{c} > high) AS no FROM lineitem l, p)
  SELECT '{c}' AS column_name, 'box' AS part, k.name AS name, k.x::DOUBLE AS x, k.y::DOUBLE AS y
  FROM (SELECT unnest([{{'name': 'q1', 'x': q1, 'y': NULL}}, {{'name': 'median', 'x': q2, 'y': NULL}}, {{'name': 'q3', 'x': q3, 'y': NULL}},
                       {{'name': 'whisker_lo', 'x': wl, 'y': NULL}}, {{'name': 'whisker_hi', 'x': wh, 'y': NULL}}, {{'name': 'n_outliers', 'x': NULL, 'y': no}}]) AS k FROM p, v) AS z
  UNION ALL
  SELECT '{c}', 'histogram', CAST(r.i AS VARCHAR), mn + r.i * ((mx - mn) / 10), coalesce(f.n, 0) FROM p, range(0, 10) r(i) LEFT JOIN f ON f.bin = r.i
  UNION ALL
  SELECT '{c}', 'density', NULL, round_even(g.grid_x, 6), round_even(sum(b.c * exp(-0.5 * pow((g.grid_x - b.center) / p.h, 2))) * (1.0 / (p.n * p.h * sqrt(2.0 * pi()))), 12)
  FROM g, b, p GROUP BY g.grid_x, p.n, p.h)"""


@register("univariate_panel", "\nUNION ALL".join(map(_panel_sql, ["l_quantity", "l_extendedprice", "l_discount"])))
def univariate_panel(spark, sf_dir):
    panel = plotdata.univariate_panel(read_table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    null = F.lit(None).cast("double")
    box = panel["box"].select("column_name", F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), (null if n == "n_outliers" else F.col(n)).alias("x"), (F.col(n).cast("double") if n == "n_outliers" else null).alias("y"))
        for n in ("q1", "median", "q3", "whisker_lo", "whisker_hi", "n_outliers")])).alias("s")).select("column_name", F.lit("box").alias("part"), "s.*")
    hist = panel["hist"].select("column_name", F.lit("histogram").alias("part"), F.col("bin").cast("string").alias("name"), F.col("lo").alias("x"), F.col("count").cast("double").alias("y"))
    kde = panel["kde"].select("column_name", F.lit("density").alias("part"), F.lit(None).cast("string").alias("name"), F.bround("grid_x", 6).alias("x"), F.bround("density", 12).alias("y"))
    return box.unionByName(hist).unionByName(kde)


@register("scatter_sample", """
SELECT vec_id, label, x0, x1 FROM (
  SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x0, CAST(embedding[2] AS DOUBLE) AS x1,
         row_number() OVER (PARTITION BY label ORDER BY md5('0:' || CAST(vec_id AS VARCHAR)),
                                                        CAST(vec_id AS VARCHAR)) AS rn
  FROM embeddings)
WHERE rn <= 5
""")
def scatter_sample(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding")[0].cast("double").alias("x0"),
        F.col("embedding")[1].cast("double").alias("x1"))
    return plotdata.scatter_sample(e, "label", 5, "vec_id", ["x0", "x1"], seed=0)


# ----------------------------------------------------------- group stats


def _anova_sql(table: str) -> str:
    return f"""
t AS (SELECT avg(l_extendedprice) AS grand FROM {table} WHERE l_returnflag IS NOT NULL),
g AS (SELECT l_returnflag, count(l_extendedprice) AS n, avg(l_extendedprice) AS m
      FROM {table} WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag),
w AS (SELECT sum((l.l_extendedprice - g.m) * (l.l_extendedprice - g.m)) AS ss_within
      FROM {table} l JOIN g USING (l_returnflag)),
b AS (SELECT count(*) AS n_groups, sum(n) AS n, sum(n * (m - grand) * (m - grand)) AS ss_between FROM g, t)
SELECT n_groups, CAST(n AS BIGINT) AS n, n_groups - 1 AS df_between,
       CAST(n - n_groups AS BIGINT) AS df_within,
       round_even(ss_between / 1e6, 3) AS ss_between_m,
       round_even(ss_within / 1e6, 3) AS ss_within_m,
       round_even((ss_between / (n_groups - 1)) / (ss_within / (n - n_groups)), 6) AS f_stat
FROM b, w
"""


def _anova(df):
    a = stats.anova_oneway(df, "l_returnflag", "l_extendedprice")
    return a.select("n_groups", "n", "df_between", "df_within",
                    F.bround(F.col("ss_between") / 1e6, 3).alias("ss_between_m"),
                    F.bround(F.col("ss_within") / 1e6, 3).alias("ss_within_m"),
                    F.bround("f_stat", 6).alias("f_stat"))


@register("anova_f", "WITH " + _anova_sql("lineitem"))
def anova_f(spark, sf_dir):
    return _anova(read_table(spark, sf_dir, "lineitem"))


@register("anova_f_with_missing", "WITH " + GAPPY_LINEITEM_SQL + "," + _anova_sql("gappy"))
def anova_f_with_missing(spark, sf_dir):
    return _anova(gappy_lineitem(spark, sf_dir))


@register("cluster_profile", """
SELECT l_returnflag, count(*) AS n, round_even(avg(l_quantity), 6) AS avg_l_quantity,
       round_even(avg(l_discount), 6) AS avg_l_discount,
       round_even(avg(l_extendedprice), 6) AS avg_l_extendedprice
FROM lineitem GROUP BY l_returnflag
""")
def cluster_profile(spark, sf_dir):
    p = stats.cluster_profile(read_table(spark, sf_dir, "lineitem"), "l_returnflag",
                              ["l_quantity", "l_discount"], "l_extendedprice")
    return p.select("l_returnflag", "n", *[F.bround(c, 6).alias(c) for c in
                                           ("avg_l_quantity", "avg_l_discount",
                                            "avg_l_extendedprice")])


@register("quartiles_by_category", """
SELECT l_returnflag, count(l_extendedprice) AS n, quantile_cont(l_extendedprice, 0.25) AS q0,
       quantile_cont(l_extendedprice, 0.5) AS q1, quantile_cont(l_extendedprice, 0.75) AS q2
FROM lineitem GROUP BY l_returnflag
""")
def quartiles_by_category(spark, sf_dir):
    # (the one a hot category takes at scale), so the check covers it
    from quarry.operators.quantiles import grouped_quantiles
    return grouped_quantiles(read_table(spark, sf_dir, "lineitem"), "l_returnflag",
                             "l_extendedprice", [0.25, 0.5, 0.75])


@register("violin_kde", """
WITH st AS (SELECT l_returnflag, count(l_extendedprice) AS n, stddev_samp(l_extendedprice) AS sd,
                   min(l_extendedprice) AS mn, max(l_extendedprice) AS mx
            FROM lineitem GROUP BY l_returnflag),
p AS (SELECT l_returnflag, n, mn, mx, sd * pow(n, -0.2) AS h, (mx - mn) / 2048 AS w FROM st
      WHERE sd > 0),
b AS (SELECT l.l_returnflag,
             p.mn + (least(floor((l.l_extendedprice - p.mn) / p.w), 2047) + 0.5) * p.w AS center,
             count(*) AS c
      FROM lineitem l JOIN p USING (l_returnflag) GROUP BY 1, 2),
g AS (SELECT p.l_returnflag, r.i,
             (p.mn - 3.0 * p.h) + r.i * (((p.mx + 3.0 * p.h) - (p.mn - 3.0 * p.h)) / 199) AS grid_x
      FROM p, range(0, 200) r(i))
SELECT g.l_returnflag, round_even(g.grid_x, 6) AS grid_x,
       round_even(sum(b.c * exp(-0.5 * pow((g.grid_x - b.center) / p.h, 2)))
                  * (1.0 / (p.n * p.h * sqrt(2.0 * pi()))), 15) AS density
FROM g JOIN b USING (l_returnflag) JOIN p USING (l_returnflag)
GROUP BY g.l_returnflag, g.i, g.grid_x, p.n, p.h
""")
def violin_kde(spark, sf_dir):
    k = plotdata.kde_by(read_table(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice")
    return k.select("l_returnflag", F.bround("grid_x", 6).alias("grid_x"),
                    F.bround("density", 15).alias("density"))


# ------------------------------------------- more cases for the oracle gate


@register("value_counts_with_missing", "WITH " + GAPPY_LINEITEM_SQL + """
SELECT l_returnflag, count(*) AS count FROM gappy GROUP BY l_returnflag
""")
def value_counts_with_missing(spark, sf_dir):
    return profile.value_counts(gappy_lineitem(spark, sf_dir), "l_returnflag", dropna=False)


_GAPPY_NUM = ["l_quantity", "l_discount", "l_tax"]


@register("describe_with_missing", "WITH " + GAPPY_LINEITEM_SQL + """
SELECT column_name, count, round_even(mean, 6) AS mean, round_even(std, 6) AS std, min,
       q25, q50, q75, max
FROM (""" + "\nUNION ALL".join(
    f"""
  SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
         CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS q25,
         quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75,
         CAST(max({c}) AS DOUBLE) AS max FROM gappy"""
    for c in _GAPPY_NUM) + ")")
def describe_with_missing(spark, sf_dir):
    d = profile.describe(gappy_lineitem(spark, sf_dir), _GAPPY_NUM)
    return d.select("column_name", "count", F.bround("mean", 6).alias("mean"),
                    F.bround("std", 6).alias("std"), "min", "q25", "q50", "q75", "max")


def _gappy_bins_sql():
    from quarry.plans.catalog import _bins_sql
    return ("WITH " + GAPPY_LINEITEM_SQL + "\nSELECT column_name, CAST(bin AS BIGINT) AS bin, lo, hi, "
            "CAST(count AS BIGINT) AS count FROM (" + _bins_sql(_GAPPY_NUM, "gappy", "right") + ")")


@register("binned_counts_with_missing", _gappy_bins_sql())
def binned_counts_with_missing(spark, sf_dir):
    return profile.binned_counts(gappy_lineitem(spark, sf_dir), _GAPPY_NUM, 10, "right")


_JOINT_Q = ",\n".join(
    f"q_{c} AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM gappy)"
    for c in _IQR_COLS)


@register("remove_outliers_joint", "WITH " + GAPPY_LINEITEM_SQL + ",\n" + _JOINT_Q + """
SELECT gappy.* FROM gappy, """ + ", ".join(f"q_{c}" for c in _IQR_COLS) + """
WHERE """ + "\n  AND ".join(
    f"{c} > q_{c}.q1 - 1.5 * (q_{c}.q3 - q_{c}.q1) AND {c} < q_{c}.q3 + 1.5 * (q_{c}.q3 - q_{c}.q1)"
    for c in _IQR_COLS))
def remove_outliers_joint(spark, sf_dir):
    return clean.remove_outliers(gappy_lineitem(spark, sf_dir), 1.5, _IQR_COLS, mode="joint")


# (l_orderkey, l_linenumber) repeats in the driver's lineitem; these four
# columns identify a row
LI_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_LI_KEY_SQL = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in LI_KEY)


@register("sample_per_flag", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag
                               ORDER BY md5('7:' || {_LI_KEY_SQL}), {_LI_KEY_SQL}) AS rn
  FROM lineitem)
WHERE rn <= 20
""")
def sample_per_flag(spark, sf_dir):
    # every flag holds about a third of lineitem: the hot-group path
    li = read_table(spark, sf_dir, "lineitem").select(*LI_KEY, "l_returnflag", "l_extendedprice")
    return split.stratified_sample(li, "l_returnflag", 20, LI_KEY, seed=7)


@register("outlier_sample", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, value FROM events, q
WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)
ORDER BY md5('0:' || CAST(event_id AS VARCHAR)), CAST(event_id AS VARCHAR)
LIMIT 20
""")
def outlier_sample_q(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "value")
    return plotdata.outlier_sample(ev, "value", "event_id", n=20)


# ------------------------- the same operators over a table with missing values

def _on_gappy(name: str, keep: str = "TRUE") -> str:
    """The oracle of ``name`` over the rows of ``gappy`` that ``keep`` names."""
    from quarry.plans.catalog import ORACLE
    sql = re.sub(r"\blineitem\b", "present", ORACLE[name])
    rest = sql[sql.index("WITH") + 4:] if sql.lstrip().startswith("WITH") else None
    head = "WITH " + GAPPY_LINEITEM_SQL + f", present AS (SELECT * FROM gappy WHERE {keep})"
    return head + (", " + rest if rest else "\n" + sql)


@register("box_stats_with_missing", _on_gappy("box_stats"))
def box_stats_with_missing(spark, sf_dir):
    return plotdata.box_stats(gappy_lineitem(spark, sf_dir),
                              ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@register("box_stats_by_category_with_missing", _on_gappy("box_stats_by_category", "l_returnflag IS NOT NULL"))
def box_stats_by_category_with_missing(spark, sf_dir):
    return plotdata.box_stats_by(gappy_lineitem(spark, sf_dir), "l_returnflag", "l_extendedprice")


@register("quartiles_by_category_with_missing", _on_gappy("quartiles_by_category", "l_returnflag IS NOT NULL"))
def quartiles_by_category_with_missing(spark, sf_dir):
    from quarry.operators.quantiles import grouped_quantiles
    return grouped_quantiles(gappy_lineitem(spark, sf_dir), "l_returnflag", "l_extendedprice", [0.25, 0.5, 0.75])


@register("violin_kde_with_missing", _on_gappy("violin_kde", "l_returnflag IS NOT NULL"))
def violin_kde_with_missing(spark, sf_dir):
    k = plotdata.kde_by(gappy_lineitem(spark, sf_dir), "l_returnflag", "l_extendedprice")
    return k.select("l_returnflag", F.bround("grid_x", 6).alias("grid_x"),
                    F.bround("density", 15).alias("density"))


@register("sample_per_flag_with_missing", _on_gappy("sample_per_flag", "l_returnflag IS NOT NULL"))
def sample_per_flag_with_missing(spark, sf_dir):
    li = gappy_lineitem(spark, sf_dir).select(*LI_KEY, "l_returnflag", "l_extendedprice")
    return split.stratified_sample(li, "l_returnflag", 20, LI_KEY, seed=7)


@register("histogram_2d_with_missing", _on_gappy("histogram_2d", "l_quantity IS NOT NULL AND l_discount IS NOT NULL"))
def histogram_2d_with_missing(spark, sf_dir):
    both = gappy_lineitem(spark, sf_dir).filter("l_quantity IS NOT NULL AND l_discount IS NOT NULL")
    return plotdata.histogram_2d(both, "l_quantity", "l_discount")


@register("pair_regression_with_missing", _on_gappy("pair_regression"))
def pair_regression_with_missing(spark, sf_dir):
    out = plotdata.pair_regression(gappy_lineitem(spark, sf_dir), _PAIR_COLS)
    return out.select("x", "y", "n", *[F.bround(c, 6).alias(c)
                                       for c in ("slope", "intercept", "r", "r2")])


@register("kde_grid_with_missing", _on_gappy("kde_grid", "l_quantity IS NOT NULL").replace("l_extendedprice", "l_quantity")
          .replace("l_quantity,\n         CASE", "l_extendedprice,\n         CASE"))
def kde_grid_with_missing(spark, sf_dir):
    out = plotdata.kde_grid(gappy_lineitem(spark, sf_dir), "l_quantity")
    return out.select("column_name", F.bround("grid_x", 6).alias("grid_x"),
                      F.bround("density", 15).alias("density"))


@register("cluster_profile_with_missing", _on_gappy("cluster_profile"))
def cluster_profile_with_missing(spark, sf_dir):
    p = stats.cluster_profile(gappy_lineitem(spark, sf_dir), "l_returnflag",
                              ["l_quantity", "l_discount"], "l_extendedprice")
    return p.select("l_returnflag", "n", *[F.bround(c, 6).alias(c) for c in
                                           ("avg_l_quantity", "avg_l_discount",
                                            "avg_l_extendedprice")])
