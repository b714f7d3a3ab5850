"""The data behind exploratory plots, computed distributed and small.

Figures are not drawn; each function reduces a (possibly huge) table to the
few numbers a plot needs: bins, box statistics, density curves, regression
lines, bounded samples. Results have O(columns x bins) or O(sample) rows.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from quarry.functions.missing import is_missing
from quarry.operators.profile import binned_counts, histogram  # noqa: F401 (re-export)
from quarry.operators.quantiles import clean, column_stats, exact_quantiles, grouped_quantiles
from quarry.operators.split import stratified_sample
from quarry.plans.materialize import materialize


def _left_bin(x, mn: float | None, mx: float | None, bins: int):
    """Bin 0 .. bins - 1 of equal width, left closed, the last with the maximum;
    a constant column is widened by 0.5 on both sides as numpy does."""
    if mn is None:
        return F.lit(None).cast("int")
    start, width = (mn - 0.5, 1.0 / bins) if mn == mx else (mn, (mx - mn) / bins)
    b = F.lit(0)
    for i in range(1, bins):
        b = b + (x >= F.lit(start + i * width)).cast("int")
    return b


def box_stats(df: DataFrame, cols: list[str], whis: float = 1.5) -> DataFrame:
    """Box-plot numbers per column: exact quartiles, whiskers at the most
    extreme values inside ``q1 - whis*iqr`` / ``q3 + whis*iqr`` (inclusive)
    and the number of outliers beyond them. Two jobs plus the quartile
    selection; ``(column_name, q1, median, q3, whisker_lo, whisker_hi,
    n_outliers)``."""
    qs = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    aggs, fences = [], {}
    for i, c in enumerate(cols):
        q1, med, q3 = qs[c]
        if q1 is None:
            continue
        lo, hi = q1 - whis * (q3 - q1), q3 + whis * (q3 - q1)
        fences[c] = (q1, med, q3)
        x = clean(df, c)
        aggs += [F.min(F.when(x >= F.lit(lo), x)).alias(f"wl{i}"),
                 F.max(F.when(x <= F.lit(hi), x)).alias(f"wh{i}"),
                 F.count_if((x < F.lit(lo)) | (x > F.lit(hi))).alias(f"no{i}")]
    row = df.agg(*aggs).first() if aggs else None
    data = []
    for i, c in enumerate(cols):
        if c not in fences:
            data.append((c, None, None, None, None, None, 0))
            continue
        q1, med, q3 = fences[c]
        data.append((c, q1, med, q3, row[f"wl{i}"], row[f"wh{i}"], row[f"no{i}"]))
    schema = StructType([StructField("column_name", StringType())]
                        + [StructField(n, DoubleType()) for n in
                           ("q1", "median", "q3", "whisker_lo", "whisker_hi")]
                        + [StructField("n_outliers", LongType())])
    return df.sparkSession.createDataFrame(data, schema)


def box_stats_by(df: DataFrame, by: str, col: str, whis: float = 1.5) -> DataFrame:
    """Box-plot numbers of ``col`` for each category of ``by`` (box part of
    the category x numeric panel); a missing category is left out. Exact
    per-group quartiles (``grouped_quantiles``); the fences are written and
    joined to the rows for the whisker / outlier pass, so the planner knows
    their size and AQE can split a hot category."""
    df = df.filter(~is_missing(df, by))
    q = grouped_quantiles(df, by, col, [0.25, 0.5, 0.75])
    q = q.select(by, "n", F.col("q0").alias("q1"), F.col("q1").alias("median"),
                 F.col("q2").alias("q3"))
    q = q.withColumns({"__lo": F.col("q1") - F.lit(whis) * (F.col("q3") - F.col("q1")),
                       "__hi": F.col("q3") + F.lit(whis) * (F.col("q3") - F.col("q1"))})
    q = materialize(q, "fences")
    w = (df.select(by, clean(df, col).alias("__x")).join(q.select(by, "__lo", "__hi"), on=by, how="inner")
         .groupBy(by).agg(F.min(F.when(F.col("__x") >= F.col("__lo"), F.col("__x"))).alias("whisker_lo"),
                          F.max(F.when(F.col("__x") <= F.col("__hi"), F.col("__x"))).alias("whisker_hi"),
                          F.count_if((F.col("__x") < F.col("__lo")) | (F.col("__x") > F.col("__hi")))
                          .alias("n_outliers")))
    return (q.join(w, on=by, how="left")
            .select(by, "n", "q1", "median", "q3", "whisker_lo", "whisker_hi", "n_outliers"))


def histogram_2d(df: DataFrame, x: str, y: str, bins: int = 10) -> DataFrame:
    """2-D left-closed binned counts (joint plot / dense scatter):
    ``(bin_x, bin_y, count)`` for non-empty cells."""
    st = column_stats(df, [x, y])
    exprs = []
    for c, name in ((x, "bin_x"), (y, "bin_y")):
        _n, mn, mx = st[c]
        exprs.append(_left_bin(F.col(c).cast("double"), mn, mx, bins).alias(name))
    return (df.filter(~is_missing(df, x) & ~is_missing(df, y)).select(*exprs)
            .groupBy("bin_x", "bin_y").agg(F.count(F.lit(1)).alias("count")))


def histogram_by(df: DataFrame, by: str, cols: list[str], bins: int = 10) -> DataFrame:
    """Per-class histograms on shared (global) edges, for pair-plot
    diagonals: ``(by, column_name, bin, count)`` for non-empty bins. A missing
    class is left out."""
    df = df.filter(~is_missing(df, by))
    st = column_stats(df, cols)
    structs = []
    for c in cols:
        _n, mn, mx = st[c]
        xc = clean(df, c)
        structs.append(F.struct(F.lit(c).alias("column_name"),
                                F.when(xc.isNotNull(), _left_bin(xc, mn, mx, bins)).alias("bin")))
    return (df.select(by, F.explode(F.array(*structs)).alias("s")).select(by, "s.*")
            .filter(F.col("bin").isNotNull())
            .groupBy(by, "column_name", "bin").agg(F.count(F.lit(1)).alias("count")))


def histogram_2d_by(df: DataFrame, by: str, cols: list[str], bins: int = 10) -> DataFrame:
    """Two-dimensional binned counts of every unordered pair of columns per class
    (a pair plot off its diagonal) on shared edges: ``(by, x, y, bin_x, bin_y,
    count)`` for non-empty cells. One grouped job for all pairs: a row's bins are
    worked out once and its cells exploded, with partial aggregation. A missing
    class is left out, and so is a cell with a missing value."""
    df = df.filter(~is_missing(df, by))
    st = column_stats(df, cols)
    binned = df.select(F.col(by).alias("by"), *[F.when(clean(df, c).isNotNull(), _left_bin(clean(df, c), *st[c][1:], bins)).alias(f"b{i}") for i, c in enumerate(cols)])
    cells = [F.struct(F.lit(cols[i]).alias("x"), F.lit(cols[j]).alias("y"), F.col(f"b{i}").alias("bin_x"), F.col(f"b{j}").alias("bin_y"))
             for i in range(len(cols)) for j in range(i + 1, len(cols))]
    if not cells:
        raise ValueError("a pair needs two columns")
    out = binned.select("by", F.explode(F.array(*cells)).alias("s")).select("by", "s.*").filter("bin_x IS NOT NULL AND bin_y IS NOT NULL")
    out = out.groupBy("by", "x", "y", "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("count"))
    return out.withColumnRenamed("by", by)


def pair_regression(df: DataFrame, cols: list[str]) -> DataFrame:
    """Least-squares line and correlation for every unordered column pair:
    ``(x, y, n, slope, intercept, r, r2)`` over the rows where both are
    present (``regr_*`` semantics).

    Two passes of plain sums (whole-stage codegen): the column means, then
    per pair ``count`` and the sums of the mean-shifted values, squares and
    cross products. Shifting by the mean keeps the co-moments numerically
    stable; the finishing arithmetic is a projection of one row.
    """
    pairs = list(combinations(cols, 2))
    x = {c: clean(df, c) for c in cols}
    means = df.agg(*[F.avg(x[c]).alias(c) for c in cols]).first()  # O(columns)
    sh = {c: x[c] - F.lit(means[c] if means[c] is not None else 0.0) for c in cols}
    aggs = []
    for i, (a, b) in enumerate(pairs):
        both = x[a].isNotNull() & x[b].isNotNull()
        xa, yb = F.when(both, sh[a]), F.when(both, sh[b])
        aggs += [F.count(xa).alias(f"n{i}"), F.sum(xa).alias(f"sx{i}"), F.sum(yb).alias(f"sy{i}"),
                 F.sum(xa * xa).alias(f"sxx{i}"), F.sum(yb * yb).alias(f"syy{i}"),
                 F.sum(xa * yb).alias(f"sxy{i}")]
    wide = df.agg(*aggs)
    rows = []
    for i, (a, b) in enumerate(pairs):
        n = F.col(f"n{i}")
        nd = F.when(n > 0, n.cast("double"))      # NULL for an empty pair (ANSI-safe)
        cxx = F.col(f"sxx{i}") - F.col(f"sx{i}") * F.col(f"sx{i}") / nd
        cyy = F.col(f"syy{i}") - F.col(f"sy{i}") * F.col(f"sy{i}") / nd
        cxy = F.col(f"sxy{i}") - F.col(f"sx{i}") * F.col(f"sy{i}") / nd
        mx = F.lit(means[a] or 0.0) + F.col(f"sx{i}") / nd
        my = F.lit(means[b] or 0.0) + F.col(f"sy{i}") / nd
        ok = n > 0
        slope = F.when(ok & (cxx != 0), cxy / cxx)
        r = F.when(ok & (cxx != 0) & (cyy != 0), cxy / F.sqrt(cxx * cyy))
        r2 = F.when(ok & (cxx != 0), F.when(cyy == 0, F.lit(1.0)).otherwise(r * r))
        rows.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), n.alias("n"),
                             slope.alias("slope"), (my - slope * mx).alias("intercept"),
                             r.alias("r"), r2.alias("r2")))
    return wide.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def kde_grid(df: DataFrame, col: str, gridsize: int = 200, cut: float = 3.0,
             bins: int = 2048) -> DataFrame:
    """Gaussian kernel density on a grid (Scott's bandwidth
    ``std * n**(-1/5)``, grid from ``min - cut*h`` to ``max + cut*h``).

    The column is first reduced to ``bins`` fine equal-width bins (one
    partially aggregated job, at most ``bins`` rows); the density at each grid
    point is then a weighted kernel sum over the bin centres, computed as
    ``gridsize`` aggregate expressions over that small frame.
    """
    x = clean(df, col)
    st = df.agg(F.count(x).alias("n"), F.stddev_samp(x).alias("sd"), F.min(x).alias("mn"),
                F.max(x).alias("mx")).first()
    n, sd, mn, mx = st["n"], st["sd"], st["mn"], st["mx"]
    if not n or not sd:
        schema = StructType([StructField("column_name", StringType()),
                             StructField("grid_x", DoubleType()), StructField("density", DoubleType())])
        return df.sparkSession.createDataFrame([], schema)
    h = sd * math.pow(n, -0.2)
    w = (mx - mn) / bins
    b = F.least(F.floor((x - F.lit(mn)) / F.lit(w)), F.lit(bins - 1))
    binned = (df.filter(x.isNotNull()).groupBy(b.alias("b")).agg(F.count(F.lit(1)).alias("c"))
              .select((F.lit(mn) + (F.col("b") + F.lit(0.5)) * F.lit(w)).alias("center"), "c"))
    lo, hi = mn - cut * h, mx + cut * h
    step = (hi - lo) / (gridsize - 1)
    norm = 1.0 / (n * h * math.sqrt(2.0 * math.pi))
    # every (bin, grid point) pair: bins x gridsize rows, fixed by the
    # parameters whatever the data size; one grouped sum per grid point
    i = F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1)))
    pairs = binned.select("center", "c", i.alias("i")).withColumn(
        "grid_x", F.lit(lo) + F.col("i") * F.lit(step))
    kernel = F.exp(F.lit(-0.5) * F.pow((F.col("grid_x") - F.col("center")) / F.lit(h), 2))
    return (pairs.groupBy("i", "grid_x").agg(F.sum(F.col("c") * kernel).alias("__s"))
            .select(F.lit(col).alias("column_name"), "grid_x",
                    (F.col("__s") * F.lit(norm)).alias("density")))


def scatter_sample(df: DataFrame, by: str, n: int, key, cols: list[str], seed: int = 0) -> DataFrame:
    """Up to ``n`` points per category (e.g. per cluster) for a scatter plot,
    chosen deterministically by hash order without ranking whole groups."""
    keys = [key] if isinstance(key, str) else list(key)
    return stratified_sample(df.select(*keys, by, *cols), by, n, key, seed)


def kde_by(df: DataFrame, by: str, col: str, gridsize: int = 200, cut: float = 3.0,
           bins: int = 2048) -> DataFrame:
    """Per-category Gaussian KDE (the violin of a category x numeric panel):
    ``(by, grid_x, density)``, bandwidth and grid per category as in
    ``kde_grid``; a missing category is left out. Per-category statistics
    (partial aggregation, written so the planner knows their size), then fine
    bins per category; a category's bins, at most ``bins`` numbers, become one
    array that each of its grid points sums over, so no bin x grid rows are
    made, for any number of categories."""
    df = df.filter(~is_missing(df, by))
    x = clean(df, col)
    st = (df.filter(x.isNotNull()).groupBy(by)
          .agg(F.count(x).alias("__n"), F.stddev_samp(x).alias("__sd"), F.min(x).alias("__mn"),
               F.max(x).alias("__mx"))
          .filter(F.col("__sd") > 0)
          .withColumn("__h", F.col("__sd") * F.pow(F.col("__n").cast("double"), F.lit(-0.2)))
          .withColumn("__w", (F.col("__mx") - F.col("__mn")) / F.lit(bins))
          .withColumn("__lo", F.col("__mn") - F.lit(cut) * F.col("__h"))
          .withColumn("__step", ((F.col("__mx") + F.lit(cut) * F.col("__h")) - F.col("__lo"))
                      / F.lit(gridsize - 1)))
    st = materialize(st, "kde")
    b = F.least(F.floor((F.col("__x") - F.col("__mn")) / F.col("__w")), F.lit(bins - 1))
    binned = (df.select(by, x.alias("__x")).filter(F.col("__x").isNotNull()).join(st, by)
              .groupBy(by, b.alias("__b")).agg(F.count(F.lit(1)).alias("__c"))
              .groupBy(by).agg(F.collect_list(F.struct("__b", "__c")).alias("__bins")))
    grid = (binned.join(st, by)
            .withColumn("__bins", F.transform("__bins", lambda s: F.struct(
                (F.col("__mn") + (s["__b"] + F.lit(0.5)) * F.col("__w")).alias("at"), s["__c"].alias("c"))))
            .withColumn("__points", F.transform(F.sequence(F.lit(0), F.lit(gridsize - 1)),
                                                lambda i: F.col("__lo") + i * F.col("__step"))))

    def density(point):
        return F.aggregate("__bins", F.lit(0.0), lambda acc, s: acc + s["c"] * F.exp(
            F.lit(-0.5) * F.pow((point - s["at"]) / F.col("__h"), F.lit(2.0))))

    norm = F.lit(1.0) / (F.col("__n") * F.col("__h") * F.lit(math.sqrt(2.0 * math.pi)))
    curve = F.explode(F.transform("__points", lambda p: F.struct(p.alias("grid_x"), (density(p) * norm).alias("density"))))
    return grid.select(by, curve.alias("s")).select(by, "s.grid_x", "s.density")


def kde_grids(df: DataFrame, cols: list[str], gridsize: int = 200, cut: float = 3.0, bins: int = 2048) -> DataFrame:
    """``kde_grid`` of several columns at once: ``(column_name, grid_x, density)``.
    One job for all columns' statistics and one for a stacked table of (column,
    fine bin, count), at most ``bins`` rows a column; each column's bins become one
    array that its grid points sum over. Columns without spread give no rows."""
    xs = [clean(df, c) for c in cols]
    row = df.agg(*[f(x).alias(f"{n}{i}") for i, x in enumerate(xs) for n, f in (("n", F.count), ("s", F.stddev_samp), ("a", F.min), ("b", F.max))]).first()
    facts = [(c, row[f"n{i}"], row[f"s{i}"], row[f"a{i}"], row[f"b{i}"], xs[i]) for i, c in enumerate(cols) if row[f"s{i}"]]
    if not facts:
        return df.sparkSession.createDataFrame([], "column_name string, grid_x double, density double")
    at, consts = [], {}
    for c, n, sd, mn, mx, x in facts:
        h, w = sd * math.pow(n, -0.2), (mx - mn) / bins
        lo, hi = mn - cut * h, mx + cut * h
        consts[c] = (mn, w, h, lo, (hi - lo) / (gridsize - 1), 1.0 / (n * h * math.sqrt(2.0 * math.pi)))
        at.append(F.struct(F.lit(c).alias("c"), F.when(x.isNotNull(), F.least(F.floor((x - F.lit(mn)) / F.lit(w)), F.lit(bins - 1))).alias("b")))
    counts = (df.select(F.explode(F.array(*at)).alias("s")).select("s.*").filter(F.col("b").isNotNull())
              .groupBy("c", "b").agg(F.count(F.lit(1)).alias("n")).groupBy("c").agg(F.collect_list(F.struct("b", "n")).alias("bins")))
    const = F.create_map(*[v for c, k in consts.items() for v in (F.lit(c), F.struct(*[F.lit(float(a)).alias(m) for a, m in zip(k, ("mn", "w", "h", "lo", "step", "norm"))]))])
    rows = counts.select("c", "bins", F.element_at(const, F.col("c")).alias("k"))
    k = F.col("k")
    centers = F.transform("bins", lambda s: F.struct((k["mn"] + (s["b"] + F.lit(0.5)) * k["w"]).alias("at"), s["n"].alias("n")))
    points = F.explode(F.transform(F.sequence(F.lit(0), F.lit(gridsize - 1)), lambda i: k["lo"] + i * k["step"]))
    grid = rows.select("c", "k", centers.alias("bins"), points.alias("grid_x"))
    density = F.aggregate("bins", F.lit(0.0), lambda acc, s: acc + s["n"] * F.exp(F.lit(-0.5) * F.pow((F.col("grid_x") - s["at"]) / k["h"], F.lit(2.0))))
    return grid.select(F.col("c").alias("column_name"), "grid_x", (density * k["norm"]).alias("density"))


def univariate_panel(df: DataFrame, cols: list[str] | None = None, bins: int = 10,
                     gridsize: int = 200) -> dict[str, DataFrame]:
    """Box statistics, histogram and density curve of every numeric column
    (the box + histogram-with-density panel), as three small frames; each is one
    pass for all columns (and their statistics)."""
    from quarry.operators.profile import _numeric_cols
    cols = _numeric_cols(df, cols)
    return {"box": box_stats(df, cols), "hist": histogram(df, cols, bins), "kde": kde_grids(df, cols, gridsize)}


def outlier_sample(df: DataFrame, col: str, key, n: int | None, whis: float = 1.5,
                   seed: int = 0) -> DataFrame:
    """``n`` of the points beyond the box-plot fences (the dots of a box plot)
    in hash order, or all of them for ``n=None``; the number of outliers is in
    ``box_stats``. Exact fences, then a per-task top-n: no full sort."""
    from quarry.operators.split import sample_n
    q1, q3 = exact_quantiles(df, [col], [0.25, 0.75])[col]
    if q1 is None:
        return df.limit(0)
    lo, hi = q1 - whis * (q3 - q1), q3 + whis * (q3 - q1)
    x = clean(df, col)
    beyond = df.filter((x < F.lit(lo)) | (x > F.lit(hi)))
    return beyond if n is None else sample_n(beyond, n, key, seed)
