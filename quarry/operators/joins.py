"""Joins: latest row per key, dimension lookups, centroid attachment.

Scale notes
-----------
* ``latest_per_key`` aggregates first (``max`` per key, map-side partial
  aggregation) and joins back on (key, date), which Catalyst makes of the join
  on the key and the date filter. That spreads the rows of a key holding a
  third of the table over its dates, and AQE's skew-join splits what is left.
  A window ``max(...) over (partition by key)`` would put that key into one
  task.
* No side is broadcast by hand. Tables computed from the data (centroids,
  fences) are written first, so the planner knows their bytes and broadcasts
  below its limit; beyond it, the join shuffles two plain tables and AQE splits
  hot keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(tx: DataFrame, key: str, date_col: str, ties: str = "keep",
                   tiebreak: str | None = None) -> DataFrame:
    """Rows of ``tx`` carrying the latest ``date_col`` of their ``key``.

    ``ties='keep'``: every row tied on the maximum date is kept (the inner
    join to a grouped ``MAX`` subquery). ``ties='first'``: one row per key,
    among ties the one with the smallest numeric ``tiebreak``; computed as a
    single ``max(struct(date, -tiebreak, row))`` aggregate (partial
    aggregation, no join).
    """
    if ties == "keep":
        maxes = tx.groupBy(key).agg(F.max(date_col).alias("__max_date"))
        joined = tx.join(maxes, on=key, how="inner")
        return joined.filter(F.col(date_col) == F.col("__max_date")).drop("__max_date")
    if ties == "first":
        if tiebreak is None:
            raise ValueError("ties='first' needs a numeric tiebreak column")
        payload = [c for c in tx.columns if c != key]
        best = F.max(F.struct(F.col(date_col).alias("__d"), (-F.col(tiebreak)).alias("__t"),
                              F.struct(*payload).alias("__row")))
        return (tx.groupBy(key).agg(best.alias("__best"))
                .select(key, *[F.col(f"__best.__row.{c}").alias(c) for c in payload]))
    raise ValueError(f"ties must be 'keep' or 'first', got {ties!r}")


@dataclass(frozen=True)
class Lookup:
    """A left-outer dimension lookup: ``left_key`` of the fact side matches
    ``dim_key`` of ``dim``; ``columns`` are the dimension columns wanted.
    ``unique`` declares the dimension key unique, so a lookup contributing no
    column can be left out without changing the row count."""
    dim: DataFrame
    left_key: str
    dim_key: str
    columns: Sequence[str]
    unique: bool = True


def lookup_chain(df: DataFrame, lookups: Iterable[Lookup]) -> DataFrame:
    """Chain of LEFT JOIN dimension lookups; the planner broadcasts a dimension
    below its byte limit."""
    for lk in lookups:
        if not lk.columns and lk.unique:
            continue  # dead lookup: no column requested, key unique
        cols = [lk.dim_key] + [c for c in lk.columns if c != lk.dim_key]
        dim = lk.dim.select(*cols)
        if lk.left_key == lk.dim_key:
            df = df.join(dim, on=lk.left_key, how="left")
        else:
            df = df.join(dim, df[lk.left_key] == dim[lk.dim_key], "left").drop(dim[lk.dim_key])
    return df


def attach_centroids(df: DataFrame, centroids: DataFrame, key: str = "cluster",
                     prefix: str = "cen_") -> DataFrame:
    """Attach each row's cluster centroid (one row per cluster)."""
    from quarry.plans.materialize import materialize

    renamed = centroids.select(key, *[F.col(c).alias(prefix + c)
                                      for c in centroids.columns if c != key])
    return df.join(materialize(renamed, "centroids"), on=key, how="left")
