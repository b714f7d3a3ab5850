"""Registered queries, part 3: nearest-centre assignment, Lloyd iterations,
centroids, k-means fits, elbow sweeps, label grids, clusters vs classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.scalar import label_concat
from quarry.operators import cluster, hierarchy, kmeans
from quarry.operators.joins import attach_centroids
from quarry.operators.scale import apply_scaler, fit_scaler
from quarry.plans.catalog import register
from quarry.plans.acquire import customer_features
from quarry.plans.materialize import materialize
from quarry.sources.tables import read_table

_FEATS = ["l_quantity", "l_discount"]


def scaled_lineitem(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber",
                                                      "l_returnflag", *_FEATS)
    return apply_scaler(li, fit_scaler(li, _FEATS, "minmax"))


def first_row_centers(df, by: str, order: list[str], feats: list[str]) -> list[list[float]]:
    """Start centres taken from the data: per value of ``by`` (sorted), the
    features of its first row in ``order`` (ties broken by the features).
    One partial aggregate (min of a struct), k rows to the driver."""
    best = F.min(F.struct(*[F.col(c) for c in order], *[F.col(f).alias(f) for f in feats]))
    rows = df.groupBy(by).agg(best.alias("b")).orderBy(by).collect()
    return [[r["b"][f] for f in feats] for r in rows]


_PTS_SQL = """
st AS (SELECT min(l_quantity) AS mnq, max(l_quantity) AS mxq,
              min(l_discount) AS mnd, max(l_discount) AS mxd FROM lineitem),
pts AS (SELECT l_orderkey, l_linenumber, l_returnflag,
               (l_quantity - mnq) / (mxq - mnq) AS f0, (l_discount - mnd) / (mxd - mnd) AS f1
        FROM lineitem, st),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY l_returnflag) - 1 AS INT) AS cluster, f0, f1
       FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag
                                          ORDER BY l_orderkey, l_linenumber, f0, f1) AS rn
             FROM pts)
       WHERE rn = 1)"""


def _wide_centers_sql(src: str, k: int, dims: int) -> str:
    cols = ", ".join(f"max(CASE WHEN cluster = {j} THEN f{i} END) AS c{j}_{i}"
                     for j in range(k) for i in range(dims))
    return f"(SELECT {cols} FROM {src})"


def _dist_sql(j: int, dims: int) -> str:
    return " + ".join(f"(f{i} - c{j}_{i}) * (f{i} - c{j}_{i})" for i in range(dims))


def _argmin_sql(k: int) -> str:
    parts = []
    for j in range(k - 1):
        rest = ", ".join(f"d{m}" for m in range(j + 1, k))
        cond = f"d{j} <= least({rest})" if k - j > 2 else f"d{j} <= {rest}"
        parts.append(f"WHEN {cond} THEN {j}")
    return f"CAST(CASE {' '.join(parts)} ELSE {k - 1} END AS INT)"


def _assign_sql(src_pts: str, centers: str, k: int, dims: int, extra: str = "") -> str:
    dists = ", ".join(f"{_dist_sql(j, dims)} AS d{j}" for j in range(k))
    return f"""(SELECT *, {_argmin_sql(k)} AS cluster
  FROM (SELECT p.*{extra}, {dists} FROM {src_pts} p, {_wide_centers_sql(centers, k, dims)} w))"""


def _d2_sql(a: str, b: str, dims: int) -> str:
    return f"list_sum([({a}[j] - {b}[j]) * ({a}[j] - {b}[j]) FOR j IN range(1, {dims + 1})])"


def kmeans_sql(ctes: str, dims: int, ks: list[int], final: str, seed: int = 713, start: str | None = None,
               tol: float = 1e-4, name: str = "") -> str:
    """CTEs of k-means fits over ``pts<name>(key VARCHAR, v DOUBLE[])``: hash-drawn
    starts (or ``start``, a SELECT of one list of centres), Lloyd iterations until
    the centres rest, then ``fin<name>(k, cen, it)`` and
    ``lab<name>(k, key, v, cluster, d2)``; ``final`` closes the query."""
    p, kmax, n = f"pts{name}", max(ks), name
    die = "(CAST('0x' || substr(md5('{seed}:' || CAST({step} AS VARCHAR) || ':' || key), 1, 13) AS BIGINT) + 0.5)::DOUBLE / 4503599627370496.0"
    means = ", ".join(f"avg(v[{j}])" for j in range(1, dims + 1))
    variance = " + ".join(f"var_pop(v[{j}])" for j in range(1, dims + 1))
    dists = f"[{_d2_sql('p.v', 'c', dims)} FOR c IN {{t}}.cen]"
    draws = "" if start else f"""
draw{n}(step, cen) AS (
  SELECT 1, [list(v ORDER BY {die.format(seed=seed, step=1)}, key)[1]] FROM {p}
  UNION ALL
  SELECT step + 1, list_append(cen, list(v ORDER BY -ln(u) / w, key)[1])
  FROM (SELECT t.step, t.cen, p.key, p.v, list_min({dists.format(t='t')}) AS w, {die.format(seed=seed, step='t.step + 1')} AS u
        FROM draw{n} t, {p} p WHERE t.step < {kmax}) AS x
  WHERE w > 0 GROUP BY step, cen),"""
    first = f"SELECT {ks[0]}, 0, ({start}), 1e300::DOUBLE" if start else f"SELECT step, 0, cen, 1e300::DOUBLE FROM draw{n} WHERE step IN ({', '.join(map(str, ks))})"
    return f"""{ctes},{draws}
rest{n} AS (SELECT {tol!r} * ({variance}) / {dims} AS rest FROM {p}),
run{n}(k, it, cen, shift) AS (
  {first}
  UNION ALL
  SELECT k, it + 1, now, list_sum([{_d2_sql('now[i]', 'cen[i]', dims)} FOR i IN range(1, len(cen) + 1)])
  FROM (SELECT k, it, cen, [coalesce(mm[i], cen[i]) FOR i IN range(1, len(cen) + 1)] AS now
        FROM (SELECT k, it, cen, map(list(c), list(m)) AS mm
              FROM (SELECT k, it, cen, list_position(ds, list_min(ds)) AS c, [{means}] AS m
                    FROM (SELECT t.k, t.it, t.cen, p.v, {dists.format(t='t')} AS ds
                          FROM run{n} t, {p} p, rest{n} WHERE t.shift > rest AND t.it < 300) AS a
                    GROUP BY k, it, cen, c) AS b
              GROUP BY k, it, cen) AS d) AS e),
fin{n} AS (SELECT k, arg_max(cen, it) AS cen, max(it) AS it FROM run{n} GROUP BY k),
lab{n} AS (SELECT k, key, v, CAST(list_position(ds, list_min(ds)) - 1 AS INT) AS cluster, list_min(ds) AS d2
        FROM (SELECT f.k, p.key, p.v, {dists.format(t='f')} AS ds FROM fin{n} f, {p} p) AS a)
{final}"""


@register("assign_nearest", "WITH " + _PTS_SQL + """
SELECT l_orderkey, l_linenumber, cluster, round_even(least(d0, d1, d2), 9) AS dist2
FROM """ + _assign_sql("pts", "c0", 3, 2))
def assign_nearest(spark, sf_dir):
    pts = scaled_lineitem(spark, sf_dir)
    centers = first_row_centers(pts, "l_returnflag", ["l_orderkey", "l_linenumber"], _FEATS)
    out = cluster.assign_nearest(pts, _FEATS, centers)
    return out.select("l_orderkey", "l_linenumber", "cluster", F.bround("dist2", 9).alias("dist2"))


@register("stream_assign_nearest", "WITH " + _PTS_SQL + """
SELECT l_orderkey, l_linenumber, cluster, round_even(least(d0, d1, d2), 9) AS dist2
FROM """ + _assign_sql("pts", "c0", 3, 2))
def stream_assign_nearest(spark, sf_dir):
    # scaler and centres fitted on the table; the rows then arrive through a
    # Structured Streaming source and are scored micro-batch by micro-batch
    # into a parquet sink (exactly-once via the checkpoint), read back here
    import uuid
    from quarry.plans.catalog import _scratch_path
    from quarry.sources.tables import stream_table
    from quarry.streaming.scoring import start_scoring
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber",
                                                      "l_returnflag", *_FEATS)
    stats = fit_scaler(li, _FEATS, "minmax")
    centers = first_row_centers(apply_scaler(li, stats), "l_returnflag",
                                ["l_orderkey", "l_linenumber"], _FEATS)
    base = _scratch_path(spark, "streams", sf_dir) + f"/{uuid.uuid4().hex}"
    stream = stream_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_FEATS)
    q = start_scoring(stream, stats, centers, base + "/out", base + "/checkpoint",
                      available_now=True)
    if not q.awaitTermination(1800):           # availableNow ends by itself; never hang
        q.stop()
        raise TimeoutError("streaming scoring did not finish")
    out = spark.read.parquet(base + "/out")
    return out.select("l_orderkey", "l_linenumber", "cluster", F.bround("dist2", 9).alias("dist2"))


@register("inertia_fixed_centers", "WITH " + _PTS_SQL + """
SELECT round_even(sum(least(d0, d1, d2)), 6) AS inertia FROM """ + _assign_sql("pts", "c0", 3, 2))
def inertia_fixed_centers(spark, sf_dir):
    pts = scaled_lineitem(spark, sf_dir)
    centers = first_row_centers(pts, "l_returnflag", ["l_orderkey", "l_linenumber"], _FEATS)
    return spark.createDataFrame([(cluster.inertia(pts, _FEATS, centers),)], "inertia double").select(
        F.bround("inertia", 6).alias("inertia"))


_START = "SELECT list([f0, f1] ORDER BY cluster) FROM c0"


@register("lloyd_fixed_start", "WITH RECURSIVE " + kmeans_sql(
    _PTS_SQL.replace("pts AS", "raw AS").replace("FROM pts", "FROM raw") + """,
pts AS (SELECT '' AS key, [f0, f1] AS v FROM raw)""", 2, [3], """
SELECT CAST(i - 1 AS INT) AS cluster, round_even(cen[i][1], 6) AS f0, round_even(cen[i][2], 6) AS f1
FROM fin, unnest(range(1, 4)) AS r(i)""", start=_START, tol=1e-12))
def lloyd_fixed_start(spark, sf_dir):
    pts = scaled_lineitem(spark, sf_dir)
    init = first_row_centers(pts, "l_returnflag", ["l_orderkey", "l_linenumber"], _FEATS)
    centers = cluster.lloyd(pts, _FEATS, init, tol=1e-12)
    out = cluster.centers_frame(spark, centers, ["f0", "f1"])
    return out.select("cluster", F.bround("f0", 6).alias("f0"), F.bround("f1", 6).alias("f1"))


# all dimensions of the driver's embeddings
_DIMS = [f"x{i}" for i in range(64)]


def _emb_xy(spark, sf_dir):
    return read_table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(x) for i, x in enumerate(_DIMS)])


_EMB_SQL = ("e AS (SELECT vec_id, label, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {x}" for i, x in enumerate(_DIMS))
            + " FROM embeddings)")


@register("centroid_attach", "WITH " + _EMB_SQL + ", c AS (SELECT label, " + ", ".join(f"avg({x}) AS c{x}" for x in _DIMS)
          + " FROM e GROUP BY label) SELECT e.label, e.vec_id, " + ", ".join(f"e.{x}" for x in _DIMS) + ", "
          + ", ".join(f"round_even(c.c{x}, 9) AS cen_{x}" for x in _DIMS) + " FROM e LEFT JOIN c USING (label)")
def centroid_attach(spark, sf_dir):
    e = _emb_xy(spark, sf_dir)
    cents = cluster.cluster_means(e, "label", _DIMS).select("label", *_DIMS)
    out = attach_centroids(e, cents, key="label")
    return out.select("label", "vec_id", *_DIMS, *[F.bround(f"cen_{x}", 9).alias(f"cen_{x}") for x in _DIMS])


@register("cluster_means", "WITH " + _EMB_SQL + " SELECT label AS cluster, "
          + ", ".join(f"round_even(avg({x}), 9) AS {x}" for x in _DIMS) + ", count(*) AS n_members FROM e GROUP BY label")
def cluster_means_q(spark, sf_dir):
    e = _emb_xy(spark, sf_dir).withColumnRenamed("label", "cluster")
    m = cluster.cluster_means(e, "cluster", _DIMS)
    return m.select("cluster", *[F.bround(x, 9).alias(x) for x in _DIMS], "n_members")


@register("cluster_vs_class", """
WITH e AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v,
                  generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label AS cl, i, avg(v) AS cv FROM e GROUP BY label, i),
d AS (SELECT e.vec_id, e.label, c.cl, sum((e.v - c.cv) * (e.v - c.cv)) AS d2
      FROM e JOIN c USING (i) GROUP BY e.vec_id, e.label, c.cl),
a AS (SELECT vec_id, label, cl AS cluster
      FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cl) AS rn FROM d)
      WHERE rn = 1)
SELECT label, cluster, count(*) AS count FROM a GROUP BY label, cluster
""")
def cluster_vs_class(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings")
    dims = len(emb.select("embedding").first()[0])
    means = (emb.groupBy("label")
             .agg(*[F.avg(F.col("embedding")[j].cast("double")).alias(f"m{j}") for j in range(dims)])
             .orderBy("label").collect())                       # k x d numbers
    labels = [r["label"] for r in means]
    centers = [[r[f"m{j}"] for j in range(dims)] for r in means]
    lab = cluster.assign_nearest(emb, "embedding", centers, dist_col=None)
    lab = lab.withColumn("cluster", F.element_at(F.array(*[F.lit(x) for x in labels]),
                                                 F.col("cluster") + 1))
    return cluster.contingency(lab, "label", "cluster")


# ------------------------------------------------------ fits with drawn starts

_EMB_PTS = "pts AS (SELECT CAST(vec_id AS VARCHAR) AS key, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings)"
_CUST_FEAT = """
feat AS (SELECT c.c_custkey, c.c_mktsegment, c.c_acctbal, COALESCE(s.total_spend, 0.0) AS total_spend
         FROM customer c LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS total_spend
                                    FROM orders GROUP BY o_custkey) s
           ON s.o_custkey = c.c_custkey)"""
_CUST_PTS = _CUST_FEAT + """,
st AS (SELECT min(c_acctbal) AS mna, max(c_acctbal) AS mxa,
              min(total_spend) AS mns, max(total_spend) AS mxs FROM feat),
pts AS (SELECT CAST(c_custkey AS VARCHAR) AS key, [(c_acctbal - mna) / (mxa - mna), (total_spend - mns) / (mxs - mns)] AS v FROM feat, st)"""
_CUST = ["c_acctbal", "total_spend"]


@register("kmeans_fit", "WITH RECURSIVE " + kmeans_sql(_EMB_PTS, 64, [10], """
SELECT cluster, count(*) AS n_members, round_even(sum(d2), 6) AS inertia FROM lab GROUP BY cluster"""))
def kmeans_fit(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings")
    fit = kmeans.fit(emb, "embedding", 10, key="vec_id", seed=713)
    return (cluster.assign_nearest(emb, "embedding", fit.centers).groupBy("cluster")
            .agg(F.count(F.lit(1)).alias("n_members"), F.bround(F.sum("dist2"), 6).alias("inertia")))


@register("cluster_labels", "WITH RECURSIVE " + kmeans_sql(_EMB_PTS, 64, [3], """
SELECT e.vec_id, e.label, 'cluster' || CAST(l.cluster AS VARCHAR) AS cluster
FROM embeddings e JOIN lab l ON l.key = CAST(e.vec_id AS VARCHAR)""", seed=123))
def cluster_labels(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings")
    fit = kmeans.fit(emb, "embedding", 3, key="vec_id", seed=123)
    return (cluster.assign_nearest(emb, "embedding", fit.centers, dist_col=None)
            .select("vec_id", "label", label_concat("cluster", F.col("cluster")).alias("cluster")))


@register("create_cluster", "WITH RECURSIVE " + kmeans_sql(_CUST_PTS, 2, [5], """
SELECT f.c_custkey, f.c_acctbal, round_even(f.total_spend, 4) AS total_spend, 'cluster_' || CAST(l.cluster AS VARCHAR) AS cluster
FROM feat f JOIN lab l ON l.key = CAST(f.c_custkey AS VARCHAR)"""))
def create_cluster(spark, sf_dir):
    res = cluster.create_cluster(customer_features(spark, sf_dir), "c_custkey", _CUST, 5, scaler="minmax", seed=713)
    return res.rows.select("c_custkey", "c_acctbal", F.bround("total_spend", 4).alias("total_spend"), "cluster")


_CENTROIDS = """
SELECT {label} AS cluster,
       round_even(cen[i][1] * (st.mxa - st.mna) + st.mna, 4) AS c_acctbal,
       round_even(cen[i][2] * (st.mxs - st.mns) + st.mns, 4) AS total_spend
FROM fin, st, unnest(range(1, 6)) AS r(i)"""


@register("create_cluster_centroids", "WITH RECURSIVE " + kmeans_sql(_CUST_PTS, 2, [5], _CENTROIDS.format(label="CAST(i - 1 AS INT)")))
def create_cluster_centroids(spark, sf_dir):
    res = cluster.create_cluster(customer_features(spark, sf_dir), "c_custkey", _CUST, 5, scaler="minmax", seed=713)
    return res.centroids.select("cluster", *[F.bround(c, 4).alias(c) for c in _CUST])


# start centres: the first customer of each market segment
_SEGMENTS = """
SELECT list(v ORDER BY c_mktsegment) FROM (
  SELECT f.c_mktsegment, p.v FROM feat f JOIN pts p ON p.key = CAST(f.c_custkey AS VARCHAR)
  QUALIFY row_number() OVER (PARTITION BY f.c_mktsegment ORDER BY f.c_custkey) = 1) AS x"""


def _with_segments(spark, sf_dir):
    df = customer_features(spark, sf_dir).join(
        read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")
    df = materialize(df, "customer-segments")
    return df, first_row_centers(df, "c_mktsegment", ["c_custkey"], _CUST)


@register("create_cluster_fixed_start", "WITH RECURSIVE " + kmeans_sql(
    _CUST_PTS, 2, [5], _CENTROIDS.format(label="'cluster_' || CAST(i - 1 AS VARCHAR)"), start=_SEGMENTS))
def create_cluster_fixed_start(spark, sf_dir):
    df, start = _with_segments(spark, sf_dir)
    res = cluster.create_cluster(df, "c_custkey", _CUST, 5, scaler="minmax", start=start)
    return res.centroids.select(label_concat("cluster_", F.col("cluster")).alias("cluster"),
                                *[F.bround(c, 4).alias(c) for c in _CUST])


@register("elbow", "WITH RECURSIVE " + kmeans_sql(_CUST_PTS, 2, list(range(2, 10)), """
, total AS (SELECT k, sum(d2) AS inertia FROM lab GROUP BY k)
SELECT k, round_even(inertia, 6) AS inertia,
       round_even((lag(inertia) OVER (ORDER BY k) - inertia) / lag(inertia) OVER (ORDER BY k), 6) AS "drop"
FROM total"""))
def elbow(spark, sf_dir):
    out = cluster.elbow(customer_features(spark, sf_dir), _CUST, ks=range(2, 10), seed=713, scaler="minmax", key="c_custkey")
    return out.select("k", F.bround("inertia", 6).alias("inertia"), F.bround("drop", 6).alias("drop"))


@register("k_grid", "WITH RECURSIVE " + kmeans_sql(_EMB_PTS, 64, [2, 3, 4, 5], """
SELECT CAST(key AS BIGINT) AS vec_id, CAST(k AS INT) AS k, cluster FROM lab"""))
def k_grid(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return cluster.k_grid(emb, "vec_id", "embedding", ks=range(2, 6), seed=713)


_RAW_PTS = "pts_raw AS (SELECT CAST(c_custkey AS VARCHAR) AS key, [c_acctbal, total_spend] AS v FROM feat)"
_BOTH = "WITH RECURSIVE " + kmeans_sql(_CUST_PTS, 2, [2], ", " + _RAW_PTS, start=_SEGMENTS.replace("FROM feat f", "FROM (SELECT * FROM feat WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING')) f"))
_BOTH = kmeans_sql(_BOTH, 2, [2], """
, crosstab AS (SELECT r.cluster AS cluster_raw, s.cluster AS cluster_scaled, count(*) AS count
               FROM lab s JOIN lab_raw r ON r.key = s.key GROUP BY ALL)
""", start=_SEGMENTS.replace("pts p", "pts_raw p").replace("FROM feat f", "FROM (SELECT * FROM feat WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING')) f"), name="_raw")


def _compared(spark, sf_dir):
    df, start = _with_segments(spark, sf_dir)
    return cluster.compare_scaling(df, "c_custkey", _CUST, k=2, start=start[:2])


@register("scaled_vs_unscaled", _BOTH + "SELECT * FROM crosstab")
def scaled_vs_unscaled(spark, sf_dir):
    return _compared(spark, sf_dir).crosstab


@register("clustering_agreement", _BOTH + """
SELECT CAST(n AS BIGINT) AS n_rows, CAST(same AS BIGINT) AS n_pairs_both,
       round_even((same - in_a * in_b / (n * (n - 1) / 2)) / ((in_a + in_b) / 2 - in_a * in_b / (n * (n - 1) / 2)), 9) AS adjusted_rand
FROM (SELECT sum(count)::DOUBLE AS n, sum(count * (count - 1) / 2)::DOUBLE AS same,
             (SELECT sum(m * (m - 1) / 2)::DOUBLE FROM (SELECT sum(count) AS m FROM crosstab GROUP BY cluster_raw)) AS in_a,
             (SELECT sum(m * (m - 1) / 2)::DOUBLE FROM (SELECT sum(count) AS m FROM crosstab GROUP BY cluster_scaled)) AS in_b
      FROM crosstab)""")
def clustering_agreement(spark, sf_dir):
    return _compared(spark, sf_dir).agreement.withColumn("adjusted_rand", F.bround("adjusted_rand", 9))


_PROFILE = ", ".join(f"round_even({f}({c}), 4) AS {n}_{c}" for c in _CUST for n, f in (("mean", "avg"), ("min", "min"), ("max", "max")))


@register("clustering_profiles", _BOTH + f"""
, swap AS (SELECT sum(CASE WHEN cluster_raw = cluster_scaled THEN count ELSE -count END) < 0 AS swapped FROM crosstab),
runs AS (SELECT 'raw' AS run, key, cluster FROM lab_raw UNION ALL SELECT 'scaled', key, cluster FROM lab),
prof AS (SELECT run, cluster, count(*) AS n_members, {_PROFILE}
         FROM runs JOIN feat ON key = CAST(c_custkey AS VARCHAR) GROUP BY run, cluster),
cen AS (SELECT 'raw' AS run, CAST(i - 1 AS INT) AS cluster, cen[i][1] AS a, cen[i][2] AS b FROM fin_raw, unnest(range(1, 3)) AS r(i)
        UNION ALL
        SELECT 'scaled', CAST(i - 1 AS INT), cen[i][1] * (mxa - mna) + mna, cen[i][2] * (mxs - mns) + mns FROM fin, st, unnest(range(1, 3)) AS r(i))
SELECT run, cluster, CASE WHEN swapped THEN 1 - cluster ELSE cluster END AS matched, n_members,
       round_even(a, 4) AS center_c_acctbal, round_even(b, 4) AS center_total_spend,
       {", ".join(f"{n}_{c}" for c in _CUST for n in ("mean", "min", "max"))}
FROM prof JOIN cen USING (run, cluster), swap""")
def clustering_profiles(spark, sf_dir):
    out = _compared(spark, sf_dir).profile
    return out.select("run", "cluster", "matched", "n_members", *[F.bround(c, 4).alias(c) for c in out.columns if c.endswith(tuple(_CUST))])


_LEAVES = 40


@register("dendrogram", "WITH RECURSIVE " + _CUST_PTS + f""",
cen AS (SELECT list(v ORDER BY h, key) AS cen FROM (
          SELECT key, v, md5('713:' || key) AS h FROM pts ORDER BY h, key LIMIT {_LEAVES}) AS x),
cf AS (SELECT list_position(ds, list_min(ds)) AS id, count(*)::DOUBLE AS n, [avg(v[1]), avg(v[2])] AS m
       FROM (SELECT p.v, [{_d2_sql('p.v', 'c', 2)} FOR c IN cen.cen] AS ds FROM pts p, cen) AS a GROUP BY id),
merge(step, cs, height, n, leaves) AS (
  SELECT 0, list({{'id': id, 'n': n, 'm': m, 'l': 1}} ORDER BY id), 0.0::DOUBLE, 0.0::DOUBLE, 0 FROM cf
  UNION ALL
  SELECT step + 1, list_append([c FOR c IN cs IF c.id <> a.id AND c.id <> b.id],
           {{'id': 1000 + step, 'n': a.n + b.n, 'm': [(a.n * a.m[j] + b.n * b.m[j]) / (a.n + b.n) FOR j IN range(1, 3)], 'l': a.l + b.l}}),
         height, a.n + b.n, a.l + b.l
  FROM (SELECT step, cs, a, b, a.n * b.n / (a.n + b.n) * {_d2_sql('a.m', 'b.m', 2)} AS height
        FROM (SELECT step, cs, unnest(cs) AS a FROM merge WHERE len(cs) > 1) AS x, unnest(x.cs) AS u(b) WHERE a.id < b.id
        QUALIFY row_number() OVER (ORDER BY height, a.id, b.id) = 1) AS y)
SELECT CAST(step AS INT) AS step, CAST({_LEAVES} - step AS INT) AS n_clusters, round_even(height, 9) AS height,
       CAST(n AS BIGINT) AS n_rows, CAST(leaves AS INT) AS n_leaves
FROM merge WHERE step > 0""")
def dendrogram(spark, sf_dir):
    # all customers, summarised by 40 leaves
    df = customer_features(spark, sf_dir)
    df = materialize(df, "dendrogram-input")
    scaled = apply_scaler(df, fit_scaler(df, _CUST, "minmax"))
    tree = hierarchy.fit(scaled, _CUST, key="c_custkey", leaves=_LEAVES, seed=713)
    return tree.to_frame(spark).withColumn("height", F.bround("height", 9))


@register("bisecting_kmeans")
def bisecting_kmeans(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings")
    model = cluster.fit_bisecting(emb, "embedding", 4, seed=713)
    from quarry.operators.cluster import _assemble
    return (model.transform(_assemble(emb, "embedding")).groupBy("cluster")
            .agg(F.count(F.lit(1)).alias("n_members")))
