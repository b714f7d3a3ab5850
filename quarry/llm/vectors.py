"""What the vector operators share: which vectors take part, and Arrow lists
as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str | Column) -> Column:
    """Not null, not zero, all components finite numbers."""
    v = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def common_length(vectors: DataFrame, column: str) -> int:
    """The most frequent length of usable vectors (the larger of equals), 0 if
    there are none. One row per length reaches the driver's aggregation."""
    sizes = vectors.where(usable(column)).groupBy(F.size(column).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    best = sizes.agg(F.max(F.struct("n", "d")).alias("m")).first()["m"]
    return best["d"] if best else 0


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest component first, so that no
    square overflows or vanishes."""
    v = v / np.abs(v).max(axis=1, keepdims=True, initial=np.finfo(float).tiny)
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column without nulls, all of one length, as float64 rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), width)
