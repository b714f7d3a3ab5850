"""Group comparisons: one-way ANOVA and cluster profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.missing import is_missing
from quarry.operators.quantiles import clean


def anova_oneway(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way ANOVA F statistic of ``value`` across the groups of ``group``.

    One job finds the grand mean ``m``. Per group, ``count``, the mean's
    distance ``d_g`` from ``m`` and ``var_pop`` (partially aggregated), then an
    aggregate over the group rows: ``ss_within = sum(n_g * var_g)``,
    ``ss_between = sum(n_g * d_g^2)``, which stays exact where values are large
    and groups close. Missing values and a missing group are left out. Output ``(n_groups, n, df_between,
    df_within, ss_between, ss_within, f_stat)``.
    """
    df = df.filter(~is_missing(df, group))
    x = clean(df, value)
    grand = df.agg(F.avg(x)).first()[0]
    x = x - F.lit(grand if grand is not None else 0.0)
    g = (df.filter(x.isNotNull()).groupBy(group)
         .agg(F.count(x).alias("n"), F.avg(x).alias("m"), F.var_pop(x).alias("v")))
    tot = g.agg(F.count(F.lit(1)).alias("n_groups"), F.sum("n").alias("n"),
                F.sum(F.col("n") * F.col("m")).alias("s1"),
                F.sum(F.col("n") * F.col("m") * F.col("m")).alias("s2"),
                F.sum(F.col("n") * F.col("v")).alias("ss_within"))
    ssb = F.col("s2") - F.try_divide(F.col("s1") * F.col("s1"), F.col("n"))
    dfb = F.col("n_groups") - 1
    dfw = F.col("n") - F.col("n_groups")
    # try_divide: one group (dfb = 0) or one row per group (dfw = 0) -> NULL
    return tot.select("n_groups", "n", dfb.alias("df_between"), dfw.alias("df_within"),
                      ssb.alias("ss_between"), "ss_within",
                      F.try_divide(F.try_divide(ssb, dfb), F.try_divide(F.col("ss_within"), dfw))
                      .alias("f_stat"))


def cluster_profile(df: DataFrame, cluster: str, features: list[str],
                    target: str | None = None) -> DataFrame:
    """Size and feature means (and target mean) of every cluster."""
    aggs = [F.count(F.lit(1)).alias("n")] + [F.avg(clean(df, c)).alias(f"avg_{c}")
                                            for c in features]
    if target:
        aggs.append(F.avg(clean(df, target)).alias(f"avg_{target}"))
    return df.groupBy(cluster).agg(*aggs)
