"""Scalar column expressions: recodes, labels, date parsing, range predicates.

All of them are JVM-side expressions (whole-stage codegen, no Python UDF).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The county recode of the property table (FIPS code -> name).
FIPS_COUNTIES = {6037: "LA", 6059: "Orange", 6111: "Ventura"}

# Land-use descriptions counted as single-unit homes.
SINGLE_UNIT_LANDUSE = [
    "Single Family Residential",
    "Condominium",
    "Townhouse",
    "Manufactured, Modular, Prefabricated Homes",
    "Mobile Home",
]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_literal(mapping: Mapping) -> Column:
    """A MapType literal built from a Python dict (small, fixed dictionaries)."""
    parts = []
    for k, v in mapping.items():
        parts += [F.lit(k), F.lit(v)]
    return F.create_map(*parts)


def map_lookup(c, mapping: Mapping) -> Column:
    """Dictionary map without pass-through: unmapped keys give NULL."""
    return F.element_at(map_literal(mapping), _col(c))


def recode(c, mapping: Mapping, integral: bool = True) -> Column:
    """Dictionary recode with pass-through, result is STRING.

    Unmapped codes keep their value as text; NULL stays NULL. Integral codes
    are cast to BIGINT first so a DOUBLE 6037.0 reads as ``6037`` both as a
    map key and as passed-through text.
    """
    code = _col(c).cast("bigint") if integral else _col(c)
    str_map = {k: str(v) for k, v in mapping.items()}
    return F.coalesce(F.element_at(map_literal(str_map), code), code.cast("string"))


def label_concat(prefix: str, c) -> Column:
    """``prefix`` followed by the value as text, e.g. ``cluster_3``."""
    return F.concat(F.lit(prefix), _col(c).cast("string"))


def parse_datetime(c, fmt: str | None = None, strict: bool = True) -> Column:
    """Text to TIMESTAMP. ``strict`` raises on bad text (ANSI) like pandas;
    otherwise bad text gives NULL."""
    c = _col(c)
    if strict:
        return F.to_timestamp(c, fmt) if fmt else F.to_timestamp(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def in_year(c, year: int) -> Column:
    """``date LIKE 'YYYY%'`` rewritten as a half-open range, which parquet
    min/max statistics can prune."""
    lo = _dt.date(year, 1, 1).isoformat()
    hi = _dt.date(year + 1, 1, 1).isoformat()
    c = _col(c)
    # string literals take the column's own type (DATE / TIMESTAMP[_NTZ])
    return (c >= F.lit(lo)) & (c < F.lit(hi))


def open_between(c, lo, hi) -> Column:
    """``lo < c < hi`` (strict on both ends; NULL rows fail)."""
    c = _col(c)
    return (c > lo) & (c < hi)


def equals_or_null(c, value) -> Column:
    c = _col(c)
    return (c == value) | c.isNull()
