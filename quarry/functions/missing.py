"""Missing-value expressions.

pandas has one notion of "missing" (NULL, NaN, NaT). Spark keeps NaN apart from
NULL: ``count`` counts NaN, ``max`` returns NaN, ``NaN > x`` is true. The
library therefore normalises NaN to NULL once (``nan_to_null``) and uses plain
NULL logic afterwards; ``is_missing`` covers frames that were not normalised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def _is_float(dtype) -> bool:
    return isinstance(dtype, (DoubleType, FloatType))


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN for floating columns."""
    c = F.col(name)
    if _is_float(df.schema[name].dataType):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Replace NaN by NULL in floating columns (a projection, no shuffle)."""
    targets = [f.name for f in df.schema.fields
               if _is_float(f.dataType) and (cols is None or f.name in cols)]
    if not targets:
        return df
    return df.withColumns({n: F.nanvl(F.col(n), F.lit(None).cast(df.schema[n].dataType))
                           for n in targets})


def missing_flag_sum(df: DataFrame, cols: list[str] | None = None) -> Column:
    """Per-row number of missing values among ``cols`` (default: all)."""
    cols = list(df.columns) if cols is None else cols
    if not cols:
        return F.lit(0)
    terms = [is_missing(df, c).cast("int") for c in cols]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total
