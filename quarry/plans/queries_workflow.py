"""Registered queries, part 4: the full acquire-and-prepare workflow."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans.catalog import ACQUIRE_TIES_SQL, register
from quarry.plans.queries_explore import _iqr_chain_sql, _split_sql
from quarry.plans.workflow import wrangle_orders

_ctes, _last = _iqr_chain_sql(["o_totalprice", "total_qty", "c_acctbal"], "d")

WRANGLE_SQL = "WITH latest AS (" + ACQUIRE_TIES_SQL + """),
li AS (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS total_qty,
              avg(l_discount) AS avg_discount,
              CAST(NULLIF(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 0) AS BIGINT)
                AS n_returned
       FROM lineitem GROUP BY l_orderkey),
w AS (SELECT latest.*, li.n_lines, li.total_qty, li.avg_discount, li.n_returned
      FROM latest LEFT JOIN li ON li.l_orderkey = latest.o_orderkey),
f AS (SELECT * REPLACE (COALESCE(n_returned, 0) AS n_returned, COALESCE(n_lines, 1) AS n_lines) FROM w
      WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY')
        AND (n_returned = 1 OR n_returned IS NULL)),
-- drop_missing at sf0.01: all 16 columns are at least 75 % present (only two
-- order-line features miss values, for orders without lines), so a row
-- needs int(round(0.75 * 16)) = 12 present values.
c1 AS (SELECT * FROM f
       WHERE 16 - ((n_lines IS NULL)::INT + (total_qty IS NULL)::INT
                   + (avg_discount IS NULL)::INT) >= 12),
-- drop_rows_low_percent: every column except those three is under 1 % missing (n_lines is filled).
c2 AS (SELECT * FROM c1
       WHERE c_custkey IS NOT NULL AND c_name IS NOT NULL AND c_nationkey IS NOT NULL
         AND c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL AND o_orderkey IS NOT NULL
         AND o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL
         AND o_orderpriority IS NOT NULL AND n_name IS NOT NULL AND r_name IS NOT NULL
         AND n_returned IS NOT NULL),
d AS (SELECT * EXCLUDE (c_name, o_orderpriority) FROM c2),
""" + ",\n".join(_ctes) + """,
rc AS (SELECT *, COALESCE(CASE c_nationkey WHEN 0 THEN 'ALGERIA' WHEN 1 THEN 'ARGENTINA'
                                           WHEN 2 THEN 'BRAZIL' END,
                          CAST(c_nationkey AS VARCHAR)) AS nation_label FROM """ + _last + """)
SELECT * FROM (""" + _split_sql(
    "rc", "CAST(c_custkey AS VARCHAR) || '|' || CAST(o_orderkey AS VARCHAR)") + ")"


@register("wrangle_full", "SELECT * REPLACE (round_even(avg_discount, 6) AS avg_discount) FROM ("
          + WRANGLE_SQL + ")")
def wrangle_full(spark, sf_dir):
    # a mean of doubles depends on summation order in its last bits: rounded
    # on both sides (the workflow itself keeps full precision)
    df = wrangle_orders(spark, sf_dir)
    return df.withColumn("avg_discount", F.bround("avg_discount", 6))
