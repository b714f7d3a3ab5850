"""Projection, renaming, filling and filtering operators (lazy projections)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, TimestampNTZType, TimestampType

from quarry.functions.scalar import SINGLE_UNIT_LANDUSE, equals_or_null, recode


def select_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: Iterable[str], missing_ok: bool = False) -> DataFrame:
    """Drop named columns. Like pandas, an absent name is an error unless
    ``missing_ok`` (Spark alone would ignore it silently)."""
    cols = list(cols)
    absent = [c for c in cols if c not in df.columns]
    if absent and not missing_ok:
        raise KeyError(f"columns not found: {absent}")
    return df.drop(*[c for c in cols if c in df.columns])


def rename_columns(df: DataFrame, names: Mapping[str, str] | list[str]) -> DataFrame:
    """Rename by mapping (``{old: new}``) or positionally (list of all names)."""
    if isinstance(names, Mapping):
        return df.withColumnsRenamed(dict(names))
    return df.toDF(*names)


def columns_by_kind(df: DataFrame, kind: str) -> list[str]:
    """Column names by type: ``'string'``, ``'numeric'`` or ``'other'``
    (non-string, the pandas ``dtype != object`` test)."""
    out = []
    for f in df.schema.fields:
        is_str = isinstance(f.dataType, StringType)
        if kind == "string" and is_str:
            out.append(f.name)
        elif kind == "numeric" and isinstance(f.dataType, NumericType):
            out.append(f.name)
        elif kind == "other" and not is_str:
            out.append(f.name)
    return out


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULL (and NaN for floating columns) by a constant per column."""
    out = {}
    for c, v in values.items():
        fill = F.lit(v).cast(df.schema[c].dataType)
        if _is_float(df, c):
            out[c] = F.when(F.col(c).isNull() | F.isnan(c), fill).otherwise(F.col(c))
        else:
            out[c] = F.coalesce(F.col(c), fill)
    return df.withColumns(out)


def _is_float(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() in ("double", "float")


def fill_pool(df: DataFrame, col: str = "poolcnt") -> DataFrame:
    """Missing pool count means no pool."""
    return fill_constant(df, {col: 0})


def fill_unitcnt(df: DataFrame, col: str = "unitcnt") -> DataFrame:
    """Missing unit count on single-unit homes means one unit."""
    return fill_constant(df, {col: 1})


def keep_category_single(df: DataFrame, category_col: str, allowed: Iterable,
                         unit_col: str, unit_value=1) -> DataFrame:
    """Keep rows whose category is in ``allowed`` and whose unit count is
    ``unit_value`` or missing (``isin`` on NULL is not true, so NULL
    categories are dropped, as in pandas)."""
    return df.filter(F.col(category_col).isin(list(allowed))
                     & equals_or_null(unit_col, unit_value))


def single_homes(df: DataFrame, category_col: str = "propertylandusedesc",
                 unit_col: str = "unitcnt") -> DataFrame:
    return keep_category_single(df, category_col, SINGLE_UNIT_LANDUSE, unit_col)


def require_not_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df if cond is None else df.filter(cond)


def recode_column(df: DataFrame, src: str, dst: str, mapping: Mapping,
                  integral: bool = True) -> DataFrame:
    return df.withColumn(dst, recode(src, mapping, integral))


def parse_date_column(df: DataFrame, col: str = "transactiondate", fmt: str | None = None,
                      strict: bool = True) -> DataFrame:
    """``col`` as a datetime; one that already is (with or without a zone) stays as
    it is."""
    from quarry.functions.scalar import parse_datetime
    if isinstance(df.schema[col].dataType, (TimestampType, TimestampNTZType)):
        return df
    return df.withColumn(col, parse_datetime(col, fmt, strict))
