"""The full acquire-and-prepare workflow, as one lazy plan with a few small
statistics jobs at the data-dependent steps.

acquire (latest order per customer in a year, ties kept, names looked up)
-> order-line features -> category / unit filter -> constant fill -> drop
sparse columns then rows -> drop rows missing low-rate columns -> drop named
columns -> sequential IQR outlier removal -> recode -> dates as datetimes
-> exact 3-way split.

Column pruning and filter pushdown reach the parquet scans through all of
it: the statistics jobs read only the columns they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import clean, columns, split
from quarry.plans.acquire import latest_orders_wide
from quarry.plans.materialize import materialize
from quarry.sources.tables import read_table

# The parameters of the workflow.
SEGMENTS = ["BUILDING", "AUTOMOBILE", "MACHINERY"]
NATION_NAMES = {0: "ALGERIA", 1: "ARGENTINA", 2: "BRAZIL"}
UNNEEDED = ["c_name", "o_orderpriority"]
OUTLIER_COLS = ["o_totalprice", "total_qty", "c_acctbal"]


def order_line_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: number of lines, total quantity, mean discount and the
    number of returned lines (NULL when none, filled later)."""
    li = read_table(spark, sf_dir, "lineitem")
    n_ret = F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    return (li.groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("total_qty"),
                 F.avg("l_discount").alias("avg_discount"), n_ret.alias("__ret"))
            .withColumn("n_returned", F.when(F.col("__ret") == 0, None).otherwise(F.col("__ret")))
            .drop("__ret"))


def wrangle_orders(spark: SparkSession, sf_dir: str, year: int = 2001, seed: int = 713,
                   k: float = 1.5) -> DataFrame:
    wide = latest_orders_wide(spark, sf_dir, year, ties="keep")
    lines = order_line_features(spark, sf_dir)
    df = (wide.join(lines, wide["o_orderkey"] == lines["l_orderkey"], "left")
          .drop("l_orderkey"))
    df = columns.keep_category_single(df, "c_mktsegment", SEGMENTS, "n_returned", 1)
    df = columns.fill_constant(df, {"n_returned": 0})
    df = columns.fill_constant(df, {"n_lines": 1})
    # the steps below run ~a dozen statistics jobs: read them from one table
    df = materialize(df, "wrangle_base")
    df = clean.drop_missing(df, 0.75, 0.75)
    df = clean.drop_rows_low_percent(df, 0.01)
    df = columns.drop_columns(df, UNNEEDED, missing_ok=True)
    df = clean.remove_outliers(df, k, OUTLIER_COLS)
    df = columns.recode_column(df, "c_nationkey", "nation_label", NATION_NAMES)
    df = columns.parse_date_column(df, "o_orderdate")
    return split.three_way_split(df, ["c_custkey", "o_orderkey"], seed=seed)


def wrangle_split(spark: SparkSession, sf_dir: str, **kw) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, validate, test) frames."""
    df = wrangle_orders(spark, sf_dir, **kw)
    return tuple(df.filter(F.col("split") == s).drop("split")
                 for s in ("train", "validate", "test"))
