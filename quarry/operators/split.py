"""Exact, reproducible splitting and deterministic sampling.

Rows are ordered by ``h = md5('<seed>:<key>')`` (then the key text). The
split gives the first ``ceil(test_size*n)`` rows to ``test``, the next
``ceil(validate_size*rest)`` to ``validate`` and the rest to ``train``:
scikit-learn's sizes, exactly, independent of partitioning.

A global ``row_number()`` would pull every row into one task. Instead only
the two *cut points* are located: per-prefix counts of ``h`` (a fixed number
of groups, map-side aggregated) tell which prefix holds each cut, refining
the prefix until the holding group is small enough to fetch; the row at the
cut becomes a threshold, and the split itself is a projection comparing
``(h, key)`` with the thresholds. No shuffle of the data, no single task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_STEP = 4          # hex digits added per refinement level (65,536 groups)
FETCH_MAX = 50_000       # rows fetched to the driver at the final level


def key_text(key) -> Column:
    """The key as one text; NULL if any part is. Parts of a composite key are
    joined by ``|``, and a ``|`` or backslash inside a part is escaped, so
    different keys have different texts."""
    cols = [key] if isinstance(key, str) else list(key)
    if len(cols) == 1:
        return F.col(cols[0]).cast("string")
    parts = [F.replace(F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")) for c in cols]
    return F.concat(*[x for p in parts for x in (F.lit("|"), p)][1:])


def hash_order(key, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key_text(key)))


def _thresholds(df: DataFrame, h: Column, k: Column, positions: list[int]) -> dict:
    """The (hash, key) of the rows at 0-based ``positions`` in (h, key) order.

    Each level is one aggregate job shared by all positions: counts per hash
    prefix (at most 16**PREFIX_STEP groups under each open prefix). A
    position whose prefix group holds at most FETCH_MAX rows is resolved by
    fetching that group; others refine their prefix by PREFIX_STEP digits."""
    found: dict[int, tuple[str, str]] = {}
    # open positions: pos -> (prefix, rows before the prefix)
    open_p = {p: ("", 0) for p in positions}
    while open_p:
        prefixes = sorted({pre for pre, _b in open_p.values()})
        plen = len(prefixes[0]) + PREFIX_STEP
        if plen > 32:
            plen = 32
        scope = (df if prefixes == [""] else
                 df.filter(F.substring(h, 1, len(prefixes[0])).isin(prefixes)))
        counts = sorted((r["p"], r["n"]) for r in
                        scope.groupBy(F.substring(h, 1, plen).alias("p"))
                        .agg(F.count(F.lit(1)).alias("n")).collect())
        fetch, nxt = {}, {}
        for pos, (pre, base) in open_p.items():
            cum = base
            for p, n in counts:
                if not p.startswith(pre):
                    continue
                if cum + n > pos:
                    break
                cum += n
            else:
                raise RuntimeError("position beyond row count")
            if n <= FETCH_MAX or plen >= 32:
                fetch[pos] = (p, cum)
            else:
                nxt[pos] = (p, cum)
        if fetch:
            groups = sorted({p for p, _c in fetch.values()})
            rows: dict[str, list] = {g: [] for g in groups}
            for r in (df.filter(F.substring(h, 1, plen).isin(groups))
                      .select(F.substring(h, 1, plen).alias("p"), h.alias("h"), k.alias("k"))
                      .collect()):
                rows[r["p"]].append((r["h"], r["k"]))
            for pos, (p, cum) in fetch.items():
                ordered = sorted(rows[p])
                i = pos - cum
                if i > 0 and ordered[i] == ordered[i - 1]:
                    raise ValueError("split key is not unique: duplicate rows straddle a cut")
                found[pos] = ordered[i]
        open_p = nxt
    return found


def split_sizes(n: int, test_size: float = 0.2, validate_size: float = 0.3) -> tuple[int, int, int]:
    """(train, validate, test) sizes: test = ceil(test_size*n), validate =
    ceil(validate_size*(n-test)), train = the rest."""
    n_test = int(math.ceil(test_size * n))
    rest = n - n_test
    n_val = int(math.ceil(validate_size * rest))
    return rest - n_val, n_val, n_test


def three_way_split(df: DataFrame, key, test_size: float = 0.2, validate_size: float = 0.3,
                    seed: int = 713, column: str = "split") -> DataFrame:
    """Add ``column`` in {'test', 'validate', 'train'} with exact sizes.
    ``key`` (a column or list of columns) must identify rows uniquely."""
    h = hash_order(key, seed)
    k = key_text(key)
    n, without = df.agg(F.count(F.lit(1)), F.count_if(k.isNull())).first()
    if without:
        raise ValueError(f"{without} rows have no complete split key")
    _train, n_val, n_test = split_sizes(n, test_size, validate_size)

    found = _thresholds(df, h, k, [p for p in (n_test, n_test + n_val) if 0 < p < n])

    def before(pos: int) -> Column:
        if pos <= 0:
            return F.lit(False)
        if pos >= n:
            return F.lit(True)
        th, tk = found[pos]
        return (h < F.lit(th)) | ((h == F.lit(th)) & (k < F.lit(tk)))

    in_test = before(n_test)
    in_first_two = before(n_test + n_val)
    label = F.when(in_test, "test").when(in_first_two, "validate").otherwise("train")
    return df.withColumn(column, label)


def sample_n(df: DataFrame, n: int, key, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows (or all), chosen by hash order: deterministic and
    independent of partitioning. Each task keeps its own top ``n`` only."""
    return df.orderBy(hash_order(key, seed), key_text(key)).limit(n)


def head_n(df: DataFrame, n: int = 5, order_by=None) -> DataFrame:
    """First ``n`` rows in an explicit order (Spark rows have no order)."""
    cols = [order_by] if isinstance(order_by, str) else list(order_by or df.columns[:1])
    return df.orderBy(*cols).limit(n)


def stratified_sample(df: DataFrame, by: str, n: int, key, seed: int = 0) -> DataFrame:
    """Up to ``n`` rows per value of ``by``, the ones first in hash order; rows
    whose ``by`` is missing are left out.

    The rank limit is pushed below the exchange (``WindowGroupLimit``): each
    task keeps its own first ``n`` rows per value, so at most tasks x n rows
    of a value meet, however hot it is."""
    from pyspark.sql import Window

    from quarry.functions.missing import is_missing
    w = Window.partitionBy(by).orderBy(hash_order(key, seed), key_text(key))
    ranked = df.filter(~is_missing(df, by)).withColumn("__rn", F.row_number().over(w))
    return ranked.filter(F.col("__rn") <= n).drop("__rn")
