"""Exact quantiles (linear interpolation) without a per-task value map.

Spark's exact ``percentile`` merges one value->count map per group into a
single task: for a continuous column of a huge table that is an unbounded
group. Here the needed order statistics are *selected*.

Whole columns (``exact_quantiles``): each wanted rank has a bracket of values. One
scan counts, finds the extremes and places the brackets with
``percentile_approx``, whose rank error is known to be about n / accuracy (a
caller may add these aggregates to a scan of its own, ``quantile_aggs``).
While the rows strictly inside all brackets, some 6 in 10,000 by the sketch's
error, fit ``fetch_values``, a second scan counts the rows below and on the edges
of each bracket, fetches the few inside, and settles every rank. Where they don't
fit, or a rank lies outside its bracket, the bracket's rows are counted with
conditional sums (no row is expanded); a bracket of one value is resolved, one
that holds few rows has its values fetched, another is narrowed by the sketch
again, which divides its rows by some thousands. Duplicates and infinities are
values like others.

Groups (``grouped_quantiles``): rows are sorted by (group, value) in one range
partitioning, written once, and numbered within their partitions. Counts per
(partition, group) turn into offsets, offsets turn the wanted ranks into
positions, and the positions are looked up. A group of any size is spread over
partitions; nothing is collected; one path for all sizes.

The result equals pandas' ``quantile`` / numpy linear interpolation and DuckDB's
``quantile_cont``. Missing values (NULL, NaN) are left out, and so is a missing
group.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000           # rank error of the sketch: rows / ACCURACY
SLACK = 2.0 / ACCURACY      # half a bracket, as a share of the rows
FETCH_VALUES = 20_000       # distinct rows fetched per job, all brackets together


def clean(df: DataFrame, col: str):
    """A column as a double, its missing values (NULL, NaN) as NULL."""
    return F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))


def column_stats(df: DataFrame, cols: list[str]) -> dict[str, tuple[int, float | None, float | None]]:
    aggs = []
    for i, c in enumerate(cols):
        x = clean(df, c)
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"n{i}"], row[f"mn{i}"], row[f"mx{i}"]) for i, c in enumerate(cols)}


def _around(rank: int, base: int, rows: int) -> list[float]:
    """Probabilities on both sides of a rank, wider than the sketch's error."""
    at, slack = (rank - base) / max(1, rows - 1), 2.0 / ACCURACY
    return [max(0.0, at - slack), min(1.0, at + slack)]


def order_statistics(df: DataFrame, cols: list[str], ranks: dict[str, list[int]],
                     stats: dict[str, tuple[int, float, float]],
                     fetch_values: int = FETCH_VALUES) -> dict[tuple[str, int], float]:
    """Values at 0-based ``ranks`` (in ascending order, missing excluded)."""
    result: dict[tuple[str, int], float] = {}
    # target -> (low, high, rows below low, rows in low..high)
    open_t = {(c, r): (stats[c][1], stats[c][2], 0, stats[c][0]) for c in cols for r in ranks.get(c, [])}

    def inside(c, low, high):
        x = clean(df, c)
        return x, (x >= F.lit(low)) & (x <= F.lit(high))

    while open_t:
        for t, (low, high, _base, _rows) in list(open_t.items()):
            if low == high:
                result[t] = low
                del open_t[t]
        brackets = sorted({(c, *b) for (c, _r), b in open_t.items()})
        budget = max(1, fetch_values // max(1, len(brackets)))
        small = [b for b in brackets if b[4] <= budget]
        if small:
            parts = []
            for i, (c, low, high, _base, _rows) in enumerate(small):
                x, k = inside(c, low, high)
                parts.append(F.when(k, F.struct(F.lit(i).alias("i"), x.alias("x"))))
            found = defaultdict(list)
            for r in (df.select(F.explode(F.filter(F.array(*parts), lambda s: s.isNotNull())).alias("s"))
                      .groupBy("s.i", "s.x").agg(F.count(F.lit(1)).alias("n")).collect()):
                found[r["i"]].append((r["x"], r["n"]))
            for i, b in enumerate(small):
                for t in [t for t, v in open_t.items() if (t[0], *v) == b]:
                    at = b[3]
                    for x, n in sorted(found[i]):
                        at += n
                        if t[1] < at:
                            result[t] = x
                            del open_t[t]
                            break
        wide = sorted({(c, *b) for (c, _r), b in open_t.items()})
        if not wide:
            continue
        # the sketch of each wide bracket, then exact counts below and inside
        aggs, asked = [], {}
        for i, (c, low, high, base, rows) in enumerate(wide):
            x, k = inside(c, low, high)
            wanted = sorted(r for (cc, r), v in open_t.items() if (cc, *v) == (c, low, high, base, rows))
            asked[i] = wanted
            probs = [p for r in wanted for p in _around(r, base, rows)]
            aggs.append(F.percentile_approx(F.when(k, x), probs, ACCURACY).alias(f"p{i}"))
        guess = df.agg(*aggs).first()
        sums, narrow = [], []
        for i, (c, low, high, base, _rows) in enumerate(wide):
            x, k = inside(c, low, high)
            for j, r in enumerate(asked[i]):
                lo, hi = guess[f"p{i}"][2 * j], guess[f"p{i}"][2 * j + 1]
                narrow.append(((c, r), low, high, base, lo, hi))
                sums += [F.count_if(k & (x < F.lit(lo))).alias(f"a{len(narrow)}"), F.count_if(k & (x <= F.lit(lo))).alias(f"b{len(narrow)}"),
                         F.count_if(k & (x < F.lit(hi))).alias(f"c{len(narrow)}"), F.count_if(k & (x <= F.lit(hi))).alias(f"d{len(narrow)}")]
        n = df.agg(*sums).first()
        for m, (t, low, high, base, lo, hi) in enumerate(narrow, 1):
            r, rows = t[1] - base, open_t[t][3]
            if r < n[f"a{m}"]:
                after = (low, math.nextafter(lo, -math.inf), base, n[f"a{m}"])
            elif r < n[f"b{m}"]:
                after = (lo, lo, base + n[f"a{m}"], n[f"b{m}"] - n[f"a{m}"])
            elif r < n[f"c{m}"]:
                after = (math.nextafter(lo, math.inf), math.nextafter(hi, -math.inf), base + n[f"b{m}"], n[f"c{m}"] - n[f"b{m}"])
            elif r < n[f"d{m}"]:
                after = (hi, hi, base + n[f"c{m}"], n[f"d{m}"] - n[f"c{m}"])
            else:
                after = (math.nextafter(hi, math.inf), high, base + n[f"d{m}"], rows - n[f"d{m}"])
            open_t[t] = after
    return result


def interpolate(a: float, b: float, t: float) -> float:
    return a if t == 0 or a == b else a + (b - a) * t


def quantile_aggs(df: DataFrame, cols: list[str], probs: list[float]) -> list:
    """Aggregates of the first scan: count, extremes and brackets of each column."""
    around = [min(1.0, max(0.0, p + side * SLACK)) for p in probs for side in (-1, 1)]
    out = []
    for i, c in enumerate(cols):
        x = clean(df, c)
        out += [F.count(x).alias(f"__n{i}"), F.min(x).alias(f"__mn{i}"), F.max(x).alias(f"__mx{i}"),
                F.percentile_approx(x, around, ACCURACY).alias(f"__q{i}")]
    return out


def _second_scan(df: DataFrame, cols: list[str], probs: list[float], row, ranks: dict[str, list[int]], fetch_values: int) -> dict[tuple[str, int], float]:
    """Values at the ranks that the brackets of the first scan settle."""
    brackets = {(c, p): tuple(row[f"__q{i}"][2 * j:2 * j + 2]) for i, c in enumerate(cols) if ranks.get(c) for j, p in enumerate(probs)}
    expected = sum(row[f"__n{cols.index(c)}"] * (2 * SLACK + 2 / ACCURACY) for c, _ in brackets)
    if not brackets or expected > fetch_values:
        return {}
    unique = sorted({(c, *b) for (c, _), b in brackets.items()})
    aggs = []
    for m, (c, low, high) in enumerate(unique):
        x = clean(df, c)
        aggs += [F.count_if(x < F.lit(low)).alias(f"a{m}"), F.count_if(x == F.lit(low)).alias(f"b{m}"), F.count_if(x == F.lit(high)).alias(f"c{m}"),
                 F.collect_list(F.when((x > F.lit(low)) & (x < F.lit(high)), x)).alias(f"v{m}")]
    got = df.agg(*aggs).first()
    found: dict[tuple[str, int], float] = {}
    for m, (c, low, high) in enumerate(unique):
        first, middle = got[f"a{m}"], sorted(got[f"v{m}"])
        after = first + got[f"b{m}"]
        last = after + len(middle)
        for r in ranks[c]:
            if first <= r < after:
                found[(c, r)] = low
            elif after <= r < last:
                found[(c, r)] = middle[r - after]
            elif last <= r < last + got[f"c{m}"] and low != high:
                found[(c, r)] = high
    return found


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    row=None, fetch_values: int = FETCH_VALUES) -> dict[str, list[float | None]]:
    """Exact linear-interpolation quantiles of each column (missing values
    excluded); ``None`` for a column without values. ``row`` holds the results of
    ``quantile_aggs`` if a scan had them."""
    row = row if row is not None else df.agg(*quantile_aggs(df, cols, probs)).first()
    stats = {c: (row[f"__n{i}"], row[f"__mn{i}"], row[f"__mx{i}"]) for i, c in enumerate(cols)}
    ranks = {c: sorted({f(p * (stats[c][0] - 1)) for p in probs for f in (math.floor, math.ceil)}) for c in cols if stats[c][0]}
    found = _second_scan(df, cols, probs, row, ranks, fetch_values)
    left = {c: [r for r in rs if (c, r) not in found] for c, rs in ranks.items()}
    if any(left.values()):
        found |= order_statistics(df, [c for c in cols if left.get(c)], left, stats, fetch_values)
    out: dict[str, list[float | None]] = {}
    for c in cols:
        n = stats[c][0]
        if not n:
            out[c] = [None] * len(probs)
            continue
        out[c] = []
        for p in probs:
            pos = p * (n - 1)
            out[c].append(interpolate(found[(c, math.floor(pos))], found[(c, math.ceil(pos))], pos - math.floor(pos)))
    return out


# ----------------------------------------------------------------- grouped


def grouped_quantiles(df: DataFrame, by: str, col: str, probs: list[float]) -> DataFrame:
    """Exact quantiles of ``col`` per group: ``(by, n, q0, q1, ...)``; a missing
    group and missing values are left out."""
    from quarry.functions.missing import is_missing
    from quarry.plans.materialize import materialize

    probs = [float(p) for p in probs]
    data = (df.filter(~is_missing(df, by)).select(F.col(by).alias("__g"), clean(df, col).alias("__x"))
            .filter(F.col("__x").isNotNull()))
    # a third sort key spreads a value that very many rows share
    ordered = (data.withColumn("__tie", F.monotonically_increasing_id())
               .repartitionByRange("__g", "__x", "__tie").sortWithinPartitions("__g", "__x"))
    placed = materialize(ordered.select("__g", "__x", F.monotonically_increasing_id().alias("__at")), "sorted")
    part = F.shiftright("__at", 33)
    runs = placed.groupBy("__g", part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy("__g").orderBy("__part")
    runs = (runs.withColumn("__before", F.sum("__n").over(before) - F.col("__n"))
            .withColumn("n", F.sum("__n").over(Window.partitionBy("__g"))))
    # the ranks around each quantile that lie in this run
    pos = F.transform(F.array(*[F.lit(p) for p in probs]), lambda p: p * (F.col("n") - 1).cast("double"))
    wanted = F.array_distinct(F.flatten(F.transform(pos, lambda q: F.array(F.floor(q), F.ceil(q)))))
    here = F.filter(wanted, lambda r: (r >= F.col("__before")) & (r < F.col("__before") + F.col("__n")))
    asked = materialize(runs.select("n", "__before", "__first", F.explode(here).alias("__rank"))
                        .select("n", "__rank", (F.col("__first") + F.col("__rank") - F.col("__before")).alias("__at")), "ranks")
    found = placed.join(asked, "__at")
    n1 = (F.max("n") - 1).cast("double")
    aggs = [F.max("n").alias("n")]
    for i, p in enumerate(probs):
        at = F.lit(p) * (F.col("n") - 1).cast("double")
        aggs += [F.max(F.when(F.col("__rank") == F.floor(at), F.col("__x"))).alias(f"__a{i}"),
                 F.max(F.when(F.col("__rank") == F.ceil(at), F.col("__x"))).alias(f"__b{i}"),
                 (F.lit(p) * n1 - F.floor(F.lit(p) * n1)).alias(f"__t{i}")]
    g = found.groupBy("__g").agg(*aggs)
    outs = [F.when((F.col(f"__t{i}") == 0) | (F.col(f"__a{i}") == F.col(f"__b{i}")), F.col(f"__a{i}"))
            .otherwise(F.col(f"__a{i}") + (F.col(f"__b{i}") - F.col(f"__a{i}")) * F.col(f"__t{i}")).alias(f"q{i}")
            for i in range(len(probs))]
    return g.select(F.col("__g").alias(by), "n", *outs)
