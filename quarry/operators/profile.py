"""Profiling: missing values, distinct counts, value frequencies, binned
counts, overview, summary statistics, schema info.

Every profile is one (or two) aggregate jobs over *all* requested columns at
once; results are long frames ``(column_name, ...)``. Aggregations use
map-side partial aggregation, so a hot value or key costs nothing extra.
The only driver round-trips are O(columns) statistics (min/max, distinct
counts) that decide bin edges or which columns to expand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DoubleType, LongType, NumericType, StringType, StructField,
                               StructType, TimestampNTZType, TimestampType)

from quarry.functions.missing import is_missing, nan_to_null, missing_flag_sum
from quarry.operators.quantiles import column_stats, exact_quantiles, quantile_aggs


def _spark(df: DataFrame) -> SparkSession:
    return df.sparkSession


# ---------------------------------------------------------------- missing


def missing_counts(df: DataFrame) -> DataFrame:
    """``(column_name, missing_values, n_rows)`` for every column, one job."""
    cols = list(df.columns)
    aggs = [F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(cols)]
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                           F.col(f"m{i}").alias("missing_values"))
                                  for i, c in enumerate(cols)]))
    return wide.select("n_rows", stacked.alias("s")).select("s.*", "n_rows")


def missing_by_column(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Missing-values table: count and percent of rows per column, columns
    with no missing value left out, sorted by the unrounded percent
    (descending) then name; percent rounded half-to-even to 1 place."""
    m = missing_counts(df).withColumn(
        "__pct", F.try_divide(F.col("missing_values") * F.lit(100.0), F.col("n_rows")))
    if only_missing:
        m = m.filter(F.col("missing_values") != 0)
    return (m.orderBy(F.desc("__pct"), F.asc("column_name"))
            .select("column_name", "missing_values",
                    F.bround("__pct", 1).alias("pct_missing")))


def missing_summary(df: DataFrame) -> DataFrame:
    """``(n_columns, n_columns_with_missing)``: the totals printed with the table."""
    return (missing_counts(df).agg(F.count_if(F.col("missing_values") != 0)
                                   .alias("n_columns_with_missing"))
            .select(F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
                    "n_columns_with_missing"))


def missing_by_row(df: DataFrame) -> DataFrame:
    """How many rows miss exactly n columns: ``(num_cols_missing,
    percent_cols_missing, num_rows)`` ordered by n."""
    ncols = len(df.columns)
    per_row = df.select(missing_flag_sum(df).alias("num_cols_missing"))
    return (per_row.groupBy("num_cols_missing").agg(F.count(F.lit(1)).alias("num_rows"))
            .select("num_cols_missing",
                    F.bround(F.col("num_cols_missing") * F.lit(100.0) / F.lit(ncols), 2)
                    .alias("percent_cols_missing"), "num_rows")
            .orderBy("num_cols_missing"))


# ------------------------------------------------------- distinct / values


def count_unique(df: DataFrame, cols: list[str] | None = None,
                 approx_rsd: float | None = None) -> DataFrame:
    """Exact distinct count (missing excluded) of every column:
    ``(column_name, n_unique)``. All columns in one aggregate (Spark expands
    each row once per distinct aggregate and de-duplicates with partial
    aggregation). ``approx_rsd`` switches to HyperLogLog++ estimates (no row
    expansion) for very wide or very large tables."""
    cols = list(df.columns) if cols is None else cols
    exprs = []
    for i, c in enumerate(cols):
        x = F.when(~is_missing(df, c), F.col(c))
        exprs.append((F.approx_count_distinct(x, approx_rsd) if approx_rsd else F.count_distinct(x))
                     .alias(f"u{i}"))
    wide = df.agg(*exprs)
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                           F.col(f"u{i}").alias("n_unique"))
                                  for i, c in enumerate(cols)]))
    return wide.select(stacked.alias("s")).select("s.*")


def value_counts(df: DataFrame, col: str, dropna: bool = True, sort: str = "count") -> DataFrame:
    """Frequencies of one column: ``(<col>, count)``; ``sort='count'``
    (descending, value as tie-break) or ``'value'`` (ascending, NULL last)."""
    base = nan_to_null(df.select(col))
    base = base if not dropna else base.filter(F.col(col).isNotNull())
    out = base.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if sort == "count":
        return out.orderBy(F.desc("count"), F.asc_nulls_last(col))
    return out.orderBy(F.asc_nulls_last(col))


def value_counts_long(df: DataFrame, cols: list[str], dropna: bool = True) -> DataFrame:
    """Frequencies of several columns in one job: ``(column_name, value,
    count)`` with values as text (NULL is a value when ``dropna=False``)."""
    if not cols:
        schema = StructType([StructField("column_name", StringType()),
                             StructField("value", StringType()),
                             StructField("count", LongType())])
        return _spark(df).createDataFrame([], schema)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.when(~is_missing(df, c), F.col(c).cast("string")).alias("value"))
        for c in cols]))
    long = df.select(pairs.alias("s")).select("s.*")
    if dropna:
        long = long.filter(F.col("value").isNotNull())
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))


def value_counts_strings(df: DataFrame, dropna: bool = True) -> DataFrame:
    """Value counts of every string column (one job)."""
    return value_counts_long(df, [f.name for f in df.schema.fields
                                  if isinstance(f.dataType, StringType)], dropna)


def value_counts_small(df: DataFrame, limit: int = 10, dropna: bool = True) -> DataFrame:
    """Value counts of every column with fewer than ``limit`` distinct values.
    One distinct-count job decides the columns, one job counts them."""
    small = columns_with_few_values(df, limit)
    return value_counts_long(df, small, dropna)


def columns_with_few_values(df: DataFrame, limit: int, cols: list[str] | None = None) -> list[str]:
    """Columns with fewer than ``limit`` distinct (non-missing) values.

    A HyperLogLog pass (no row expansion) rules out the columns that are
    clearly wide; the exact distinct count (one Expand per column) runs only
    for the remaining candidates, so the answer stays exact."""
    cols = list(df.columns) if cols is None else cols
    if not cols:
        return []
    approx = df.agg(*[F.approx_count_distinct(F.when(~is_missing(df, c), F.col(c)))
                      .alias(f"a{i}") for i, c in enumerate(cols)]).first()
    candidates = [c for i, c in enumerate(cols) if approx[f"a{i}"] < 2 * limit + 8]
    exact = exact_counts_below(df, limit, candidates)
    return [c for c in cols if c in exact and exact[c] < limit]


def exact_counts_below(df: DataFrame, limit: int, cols: list[str] | None = None,
                       approx: dict | None = None) -> dict[str, int]:
    """Exact distinct counts of the columns whose HyperLogLog estimate is
    below ``2*limit + 8``. A column with d < limit distinct values cannot be
    screened out: with d values in m registers linear counting estimates at
    most ``-m*ln(1 - d/m)``, which for the default m = 512 and d < 150 stays
    far below the gate."""
    cols = list(df.columns) if cols is None else cols
    if not cols:
        return {}
    if approx is None:
        row = df.agg(*[F.approx_count_distinct(F.when(~is_missing(df, c), F.col(c)))
                       .alias(f"a{i}") for i, c in enumerate(cols)]).first()
        approx = {c: row[f"a{i}"] for i, c in enumerate(cols)}
    candidates = [c for c in cols if approx[c] < 2 * limit + 8]
    if not candidates:
        return {}
    return {r["column_name"]: r["n_unique"] for r in count_unique(df, candidates).collect()}


# ------------------------------------------------------------------- bins


def _numeric_cols(df: DataFrame, cols: list[str] | None) -> list[str]:
    if cols is not None:
        return cols
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _edges(mn: float, mx: float, bins: int, widen_constant: bool) -> tuple[float, float, float]:
    """``(start, width, stop)`` of equal-width bins; a constant column is
    widened by 0.1 % on both sides like pandas' ``cut``, or by 0.5 like
    ``numpy.histogram``."""
    if mn == mx:
        d = (0.001 * abs(mn) if mn != 0 else 0.001) if widen_constant else 0.5
        mn, mx = mn - d, mx + d
    return mn, (mx - mn) / bins, mx


def binned_counts(df: DataFrame, cols: list[str] | None = None, bins: int = 10,
                  closed: str = "right") -> DataFrame:
    """Equal-width binned counts of numeric columns, every bin present.

    ``closed='right'``: pandas ``value_counts(bins=n)``; bins 1..n, right
    closed, the first also holds the minimum. ``closed='left'``: histogram
    (``plt.hist`` / ``numpy.histogram``); bins 0..n-1, left closed, the last
    also holds the maximum. Values are compared with the edge array
    ``start + i*width`` (not with arithmetic on the value), so values sitting
    on an edge go where numpy puts them. Missing values are not counted.

    Output ``(column_name, bin, lo, hi, count)``.
    """
    cols = _numeric_cols(df, cols)
    stats = column_stats(df, cols)  # one job, O(columns) result
    bin_exprs, bin_rows = [], []
    for c in cols:
        n, mn, mx = stats[c]
        if not n:
            continue
        start, width, stop = _edges(mn, mx, bins, widen_constant=(closed == "right"))
        x = F.col(c).cast("double")
        edges = [start + i * width for i in range(1, bins)]
        if closed == "right":
            b = F.lit(1)
            for e in edges:
                b = b + (x > F.lit(e)).cast("int")
            first = 1
        else:
            b = F.lit(0)
            for e in edges:
                b = b + (x >= F.lit(e)).cast("int")
            first = 0
        valid = x.isNotNull() & ~F.isnan(x)
        bin_exprs.append(F.struct(F.lit(c).alias("column_name"),
                                  F.when(valid, b).alias("bin")))
        lows = [mn] + edges if closed == "right" else [start] + edges
        highs = edges + [mx if closed == "right" else stop]
        for i in range(bins):
            bin_rows.append((c, first + i, float(lows[i]), float(highs[i])))
    schema = StructType([StructField("column_name", StringType()),
                         StructField("bin", LongType()),
                         StructField("lo", DoubleType()), StructField("hi", DoubleType())])
    # all bins (O(columns x bins) rows, derived from the statistics above)
    all_bins = _spark(df).createDataFrame(bin_rows, schema)
    if not bin_exprs:
        return all_bins.withColumn("count", F.lit(0).cast("bigint"))
    counts = (df.select(F.explode(F.array(*bin_exprs)).alias("s")).select("s.*")
              .filter(F.col("bin").isNotNull())
              .groupBy("column_name", "bin").agg(F.count(F.lit(1)).alias("count")))
    # counts has at most columns x bins rows (it is aggregated on them)
    return (all_bins.join(F.broadcast(counts), ["column_name", "bin"], "left")
            .select("column_name", F.col("bin").cast("bigint").alias("bin"), "lo", "hi",
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def histogram(df: DataFrame, cols: list[str] | None = None, bins: int = 10) -> DataFrame:
    """Left-closed histogram of numeric columns (see ``binned_counts``)."""
    return binned_counts(df, cols, bins, closed="left")


def as_number(df: DataFrame, col: str):
    """A column's values as doubles in their own order: dates and times as seconds
    since 1970 (times without a zone as if in UTC), booleans as 0 and 1."""
    kind, c = df.schema[col].dataType, F.col(col)
    if isinstance(kind, DateType):
        return F.unix_date(c) * F.lit(86400.0)
    if isinstance(kind, TimestampNTZType):
        return F.unix_micros(F.from_utc_timestamp(c.cast("timestamp"), F.current_timezone())) / F.lit(1e6)
    if isinstance(kind, TimestampType):
        return F.unix_micros(c) / F.lit(1e6)
    return c.cast("int").cast("double") if isinstance(kind, BooleanType) else c.cast("double")


def overview(df: DataFrame, thresh: int = 10, numeric_limit: int = 150,
             bins: int = 10, sort: str | None = None) -> DataFrame:
    """Per-column overview: distinct count; exact value counts (missing
    included) for columns with at most ``thresh`` distinct values; binned
    counts for non-string columns with fewer than ``numeric_limit``.

    Output ``(column_name, n_unique, kind, value, lo, hi, count)`` where kind
    is ``'column'`` (one row per column, ``count`` its present values),
    ``'value'`` or ``'bin'`` (``value`` holds the bin number for bins; the edges of
    dates and times are seconds since 1970).
    ``sort='count'`` orders each column's rows by count (descending),
    ``sort='value'`` by value / bin (ascending, missing last).
    """
    uniq = {r["column_name"]: r["n_unique"] for r in count_unique(df).collect()}
    small, binned = [], []
    ranged = {f.name for f in df.schema.fields if isinstance(f.dataType, (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType))}
    for c in df.columns:
        if uniq[c] <= thresh:
            small.append(c)
        elif uniq[c] < numeric_limit and c in ranged:
            binned.append(c)
    nu = F.create_map(*[x for c in uniq for x in (F.lit(c), F.lit(uniq[c]))]) if uniq else None
    present = df.agg(*[F.count_if(~is_missing(df, c)).alias(f"c{i}") for i, c in enumerate(df.columns)]) if df.columns else None
    parts = [present.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit("column").alias("kind"), F.lit(None).cast("string").alias("value"),
                                                         F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"), F.col(f"c{i}").alias("count"))
                                                for i, c in enumerate(df.columns)])).alias("s")).select("s.*")] if df.columns else []
    if small:
        parts.append(value_counts_long(df, small, dropna=False).select(
            "column_name", F.lit("value").alias("kind"), "value",
            F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
            "count"))
    if binned:
        measured = df.select(*[as_number(df, c).alias(c) for c in binned])
        parts.append(binned_counts(measured, binned, bins, closed="right").select(
            "column_name", F.lit("bin").alias("kind"), F.col("bin").cast("string").alias("value"),
            "lo", "hi", "count"))
    if not parts:
        schema = StructType([StructField("column_name", StringType()),
                             StructField("n_unique", LongType()),
                             StructField("kind", StringType()), StructField("value", StringType()),
                             StructField("lo", DoubleType()), StructField("hi", DoubleType()),
                             StructField("count", LongType())])
        return _spark(df).createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.select("column_name", F.element_at(nu, F.col("column_name")).alias("n_unique"),
                     "kind", "value", "lo", "hi", "count")
    if sort == "count":
        return out.orderBy("column_name", F.desc("count"), F.asc_nulls_last("value"))
    if sort == "value":
        order_key = F.when(F.col("kind") == "bin", F.lpad("value", 12, "0")).otherwise(F.col("value"))
        return out.orderBy("column_name", F.asc_nulls_last(order_key))
    return out


# ---------------------------------------------------------- summaries


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``count, mean, std (sample), min, q25, q50, q75, max`` per numeric
    column, exact quartiles (linear interpolation); missing values excluded."""
    cols = _numeric_cols(df, cols)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        aggs += [F.avg(x).alias(f"a{i}"), F.stddev_samp(x).alias(f"s{i}")]
    probs = [0.25, 0.5, 0.75]
    row = df.agg(*aggs, *quantile_aggs(df, cols, probs)).first()  # one row, O(columns)
    qs = exact_quantiles(df, cols, probs, row)
    data = [(c, row[f"__n{i}"], row[f"a{i}"], row[f"s{i}"], row[f"__mn{i}"], *qs[c], row[f"__mx{i}"])
            for i, c in enumerate(cols)]
    schema = StructType([StructField("column_name", StringType()), StructField("count", LongType())]
                        + [StructField(n, DoubleType()) for n in
                           ("mean", "std", "min", "q25", "q50", "q75", "max")])
    return _spark(df).createDataFrame(data, schema)


def quantiles(df: DataFrame, cols: list[str], probs: list[float] = (0.25, 0.75)) -> DataFrame:
    """Exact quantiles as ``(column_name, prob, value)``."""
    probs = list(probs)
    qs = exact_quantiles(df, cols, probs)
    data = [(c, float(p), qs[c][i]) for c in cols for i, p in enumerate(probs)]
    schema = StructType([StructField("column_name", StringType()),
                         StructField("prob", DoubleType()), StructField("value", DoubleType())])
    return _spark(df).createDataFrame(data, schema)


def table_info(df: DataFrame) -> DataFrame:
    """Schema plus non-null counts: ``(position, column_name, dtype,
    non_null)`` (``df.info()``); one job."""
    aggs = [F.count_if(~is_missing(df, c)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    stacked = F.explode(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                                           F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                                           F.col(f"c{i}").alias("non_null"))
                                  for i, c in enumerate(df.columns)]))
    return wide.select(stacked.alias("s")).select("s.*")


def shape(df: DataFrame) -> DataFrame:
    """``(n_rows, n_columns)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"))
