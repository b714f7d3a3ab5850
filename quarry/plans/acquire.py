"""Acquire: the wide analysis table from fact and dimension tables.

On the driver's star schema: customers (the "property" table) joined to their
latest order (the "transaction" table, ties on the latest date kept or
resolved), filtered to one year, with nation and region names looked up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import in_year
from quarry.operators.columns import require_not_null
from quarry.operators.joins import Lookup, latest_per_key, lookup_chain
from quarry.sources.tables import read_table

CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
ORDER_COLS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def latest_orders_wide(spark: SparkSession, sf_dir: str, year: int = 2001, ties: str = "keep",
                       with_region: bool = True) -> DataFrame:
    """Customers with their latest order (over all years), kept only when
    that order falls in ``year``; nation (and region) names attached.

    The year filter comes *after* the latest-date choice: a customer whose
    last order is in another year drops out rather than falling back to an
    older order of ``year``.
    """
    customers = read_table(spark, sf_dir, "customer").select(*CUSTOMER_COLS)
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", *ORDER_COLS)
    latest = latest_per_key(orders, "o_custkey", "o_orderdate", ties=ties, tiebreak="o_orderkey")
    wide = (customers.join(latest, customers["c_custkey"] == latest["o_custkey"], "inner")
            .drop("o_custkey"))
    lookups = [Lookup(read_table(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey",
                      ["n_name", "n_regionkey"] if with_region else ["n_name"])]
    if with_region:
        lookups.append(Lookup(read_table(spark, sf_dir, "region"), "n_regionkey", "r_regionkey",
                              ["r_name"]))
    wide = lookup_chain(wide, lookups)
    if with_region:
        wide = wide.drop("n_regionkey")
    wide = require_not_null(wide, ["c_acctbal", "o_totalprice"])
    return wide.filter(in_year(F.col("o_orderdate"), year))


def customer_features(spark, sf_dir):
    """Customers with (account balance, total spend): the income/spending
    table of the clustering exercises."""
    spend = (read_table(spark, sf_dir, "orders").groupBy("o_custkey")
             .agg(F.sum("o_totalprice").alias("total_spend")))
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return (c.join(spend, c["c_custkey"] == spend["o_custkey"], "left").drop("o_custkey")
            .withColumn("total_spend", F.coalesce("total_spend", F.lit(0.0))))
