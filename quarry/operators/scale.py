"""Feature scaling with fitted statistics and an exact inverse.

``fit_scaler`` is one aggregate job with an O(columns) result; applying or
inverting is a lazy projection (it also works on streaming frames). The
semantics are scikit-learn's: z-score uses the *population* standard
deviation, and a constant column maps to 0 (scale treated as 1) for both
kinds. ``pyspark.ml``'s scalers differ on both points (sample std; constant
min-max column -> 0.5), so column expressions are used instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from quarry.operators.quantiles import clean


@dataclass(frozen=True)
class ScalerStats:
    """Fitted scaler: ``scaled = (x - center) / scale``."""
    kind: str
    cols: tuple[str, ...]
    center: tuple[float, ...]
    scale: tuple[float, ...]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        schema = StructType([StructField("column_name", StringType()),
                             StructField("kind", StringType()),
                             StructField("center", DoubleType()), StructField("scale", DoubleType())])
        return spark.createDataFrame(
            [(c, self.kind, self.center[i], self.scale[i]) for i, c in enumerate(self.cols)], schema)


def fit_scaler(df: DataFrame, cols: list[str], kind: str = "minmax") -> ScalerStats:
    cols = list(cols)
    if kind == "minmax":
        aggs = [e for i, c in enumerate(cols)
                for e in (F.min(clean(df, c)).alias(f"a{i}"),
                          F.max(clean(df, c)).alias(f"b{i}"))]
    elif kind == "standard":
        aggs = [e for i, c in enumerate(cols)
                for e in (F.avg(clean(df, c)).alias(f"a{i}"),
                          F.stddev_pop(clean(df, c)).alias(f"b{i}"))]
    else:
        raise ValueError("kind must be 'minmax' or 'standard'")
    row = df.agg(*aggs).first()
    center, scale = [], []
    for i in range(len(cols)):
        a, b = row[f"a{i}"], row[f"b{i}"]
        if kind == "minmax":
            rng = (b - a) if a is not None else None
            center.append(a)
            scale.append(1.0 if not rng else rng)
        else:
            center.append(a)
            scale.append(1.0 if not b else b)
    return ScalerStats(kind, tuple(cols), tuple(center), tuple(scale))


def apply_scaler(df: DataFrame, stats: ScalerStats, suffix: str = "") -> DataFrame:
    """Scale the fitted columns (in place, or into ``<col><suffix>``)."""
    return df.withColumns({
        c + suffix: (F.col(c).cast("double") - F.lit(stats.center[i])) / F.lit(stats.scale[i])
        for i, c in enumerate(stats.cols)})


def inverse_scaler(df: DataFrame, stats: ScalerStats, suffix: str = "") -> DataFrame:
    """Undo ``apply_scaler`` on columns ``<col><suffix>`` (e.g. centroids)."""
    return df.withColumns({
        c + suffix: F.col(c + suffix).cast("double") * F.lit(stats.scale[i]) + F.lit(stats.center[i])
        for i, c in enumerate(stats.cols)})


def forward_values(stats: ScalerStats, rows: list[list[float]]) -> list[list[float]]:
    """Scale a few points held on the driver (k start centres)."""
    return [[(v - stats.center[i]) / stats.scale[i] for i, v in enumerate(r)] for r in rows]


def inverse_values(stats: ScalerStats, rows: list[list[float]]) -> list[list[float]]:
    """Inverse transform of a few points held on the driver (k centres)."""
    return [[v * stats.scale[i] + stats.center[i] for i, v in enumerate(r)] for r in rows]


def scale_this(df: DataFrame, cols: list[str], kind: str = "minmax") -> tuple[DataFrame, ScalerStats]:
    """Fit on ``df`` and return the scaled frame (all other columns kept, so
    the row key travels along) together with the fitted statistics."""
    stats = fit_scaler(df, cols, kind)
    return apply_scaler(df, stats), stats
