"""Cleaning operators whose output depends on the data: sparse column / row
removal, low-missing-rate row drops, IQR outlier removal, imputation.

Each one runs a small statistics job (O(columns) result on the driver) and
returns a *lazy* frame (a projection plus a filter), so the cleaning steps of
a workflow collapse into one stage of the final job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.missing import is_missing, missing_flag_sum
from quarry.operators.quantiles import exact_quantiles


def _non_missing_counts(df: DataFrame) -> tuple[int, dict[str, int]]:
    cols = list(df.columns)
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(~is_missing(df, c)).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return row["__n"], {c: row[f"c{i}"] for i, c in enumerate(cols)}


def drop_missing(df: DataFrame, min_col_percent: float = 0.75,
                 min_row_percent: float = 0.75) -> DataFrame:
    """Drop sparse columns, then sparse rows.

    Columns with fewer than ``int(round(min_col_percent * n_rows))``
    non-missing values go first; then rows with fewer than
    ``int(round(min_row_percent * n_remaining_columns))`` non-missing values
    among the remaining columns. ``round`` is half-to-even, as in Python.
    """
    n, present = _non_missing_counts(df)
    col_thresh = int(round(min_col_percent * n))
    kept = [c for c in df.columns if present[c] >= col_thresh]
    out = df.select(*kept)
    row_thresh = int(round(min_row_percent * len(kept)))
    if row_thresh <= 0:
        return out
    non_missing = F.lit(len(kept)) - missing_flag_sum(out, kept)
    return out.filter(non_missing >= F.lit(row_thresh))


def low_missing_columns(df: DataFrame, limit: float = 0.01) -> list[str]:
    n, present = _non_missing_counts(df)
    if n == 0:
        return list(df.columns)
    return [c for c in df.columns if (n - present[c]) / n < limit]


def drop_rows_low_percent(df: DataFrame, limit: float = 0.01) -> DataFrame:
    """Drop rows missing any value in the columns whose missing rate is
    below ``limit`` (strict; fully present columns are included, harmless)."""
    cols = low_missing_columns(df, limit)
    cond = None
    for c in cols:
        k = ~is_missing(df, c)
        cond = k if cond is None else cond & k
    return df if cond is None else df.filter(cond)


def iqr_bounds(df: DataFrame, cols: list[str], k: float = 1.5) -> dict[str, tuple | None]:
    qs = exact_quantiles(df, cols, [0.25, 0.75])
    out = {}
    for c in cols:
        q1, q3 = qs[c]
        if q1 is None:
            out[c] = None
        else:
            iqr = q3 - q1
            out[c] = (q1 - k * iqr, q3 + k * iqr)
    return out


def remove_outliers(df: DataFrame, k: float, cols: list[str], mode: str = "sequential") -> DataFrame:
    """Keep rows with ``q1 - k*iqr < x < q3 + k*iqr`` for each column.

    ``mode='sequential'`` (the reference semantics): columns are processed in
    order and the quartiles of a column are computed on the rows that survived
    the previous columns, so order matters; one quartile selection per column.
    Each selection reads only the columns already filtered on plus the current
    one (column pruning reaches the scan). ``mode='joint'``: all quartiles
    from the input in one selection (a different, order-free semantics).
    Missing values never pass; an all-missing column removes every row.
    """
    if mode == "joint":
        bounds = iqr_bounds(df, cols, k)
        for c in cols:
            df = _apply_bounds(df, c, bounds[c])
        return df
    if mode != "sequential":
        raise ValueError("mode must be 'sequential' or 'joint'")
    for c in cols:
        df = _apply_bounds(df, c, iqr_bounds(df, [c], k)[c])
    return df


def _apply_bounds(df: DataFrame, c: str, b) -> DataFrame:
    if b is None:
        return df.filter(F.lit(False))
    lo, hi = b
    x = F.col(c).cast("double")
    return df.filter((x > F.lit(lo)) & (x < F.lit(hi)))


def impute(df: DataFrame, cols: list[str], strategy: str = "mean") -> DataFrame:
    """Fill missing values with the column mean, median (exact) or mode
    (most frequent value; smallest value among ties)."""
    if strategy == "mean":
        row = df.agg(*[F.avg(F.when(~is_missing(df, c), F.col(c))).alias(c) for c in cols]).first()
        fills = {c: row[c] for c in cols}
    elif strategy == "median":
        qs = exact_quantiles(df, cols, [0.5])
        fills = {c: qs[c][0] for c in cols}
    elif strategy == "mode":
        fills = {}
        for c in cols:
            top = (df.filter(~is_missing(df, c)).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
                   .orderBy(F.desc("n"), F.asc(c)).limit(1).collect())
            fills[c] = top[0][c] if top else None
    else:
        raise ValueError("strategy must be mean, median or mode")
    out = {}
    for c in cols:
        if fills[c] is None:
            continue
        fill = F.lit(fills[c])
        if df.schema[c].dataType.typeName() in ("double", "float"):
            out[c] = F.when(is_missing(df, c), fill).otherwise(F.col(c)).cast(df.schema[c].dataType)
        else:
            out[c] = F.coalesce(F.col(c), fill.cast(df.schema[c].dataType)) \
                if strategy == "mode" else F.coalesce(F.col(c).cast("double"), fill)
    return df.withColumns(out)
