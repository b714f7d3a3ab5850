"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the driver tables, plus the DuckDB SQL
that computes the same result (the correctness oracle).

The driver tables have no missing values, so queries about missing data read
``lineitem`` through ``gappy_lineitem``: the same rows with NULLs injected by
fixed rules (identically in ``GAPPY_LINEITEM_SQL``). Doubles that depend on
summation order are rounded half-to-even on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import label_concat, map_lookup, recode
from quarry.operators import clean, columns, profile
from quarry.plans.acquire import latest_orders_wide
from quarry.plans.workflow import NATION_NAMES
from quarry.sources.sql import run_sql
from quarry.sources.tables import read_table, register_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def gappy_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 7 == 0, None).otherwise(F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice",
        F.when(F.col("l_discount") == 0.0, None).otherwise(F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_tax") == 0.0, None).otherwise(F.col("l_tax")).alias("l_tax"),
        F.when(F.col("l_partkey") % 200 == 0, None).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        F.when(F.col("l_suppkey") % 3 == 0, None).otherwise(F.col("l_linestatus")).alias("l_linestatus"),
        F.when(F.col("l_linenumber") == 7, None).otherwise(F.col("l_shipdate")).alias("l_shipdate"))


GAPPY_LINEITEM_SQL = """
gappy AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
         l_extendedprice,
         CASE WHEN l_discount = 0.0 THEN NULL ELSE l_discount END AS l_discount,
         CASE WHEN l_tax = 0.0 THEN NULL ELSE l_tax END AS l_tax,
         CASE WHEN l_partkey % 200 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
         CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE l_linestatus END AS l_linestatus,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS l_shipdate
  FROM lineitem)
"""

GAPPY_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
              "l_shipdate"]

WIDE_SELECT_SQL = """
SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment,
       o.o_orderkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
       n.n_name, r.r_name
"""

# ----------------------------------------------------------- acquisition


ACQUIRE_TIES_SQL = WIDE_SELECT_SQL + """
FROM customer c
JOIN orders o ON o.o_custkey = c.c_custkey
JOIN (SELECT o_custkey, MAX(o_orderdate) AS max_date FROM orders GROUP BY o_custkey) t
  ON t.o_custkey = o.o_custkey AND t.max_date = o.o_orderdate
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
WHERE c.c_acctbal IS NOT NULL AND o.o_totalprice IS NOT NULL
  AND o.o_orderdate >= TIMESTAMP '2001-01-01' AND o.o_orderdate < TIMESTAMP '2002-01-01'
"""


@register("acquire_latest_ties", ACQUIRE_TIES_SQL)
def acquire_latest_ties(spark, sf_dir):
    return latest_orders_wide(spark, sf_dir, 2001, ties="keep")


@register("acquire_latest_first", WIDE_SELECT_SQL + """
FROM customer c
JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                   ORDER BY o_orderdate DESC, o_orderkey) AS rn
      FROM orders) o ON o.o_custkey = c.c_custkey AND o.rn = 1
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
WHERE c.c_acctbal IS NOT NULL AND o.o_totalprice IS NOT NULL
  AND o.o_orderdate >= TIMESTAMP '2001-01-01' AND o.o_orderdate < TIMESTAMP '2002-01-01'
""")
def acquire_latest_first(spark, sf_dir):
    return latest_orders_wide(spark, sf_dir, 2001, ties="first")


@register("acquire_hot_split", ACQUIRE_TIES_SQL)
def acquire_hot_split(spark, sf_dir):
    # the same plan: a hot customer's rows are spread over its dates by the
    # (key, date) join and split by the skew-join rule
    return latest_orders_wide(spark, sf_dir, 2001, ties="keep")


@register("acquire_sql", ACQUIRE_TIES_SQL)
def acquire_sql(spark, sf_dir):
    # the acquire query as SQL text, planned by Catalyst over temp views
    register_views(spark, sf_dir, ["customer", "orders", "nation", "region"])
    return run_sql(spark, ACQUIRE_TIES_SQL)


# bump when a snapshotted query changes, so an old snapshot is not read back
SNAPSHOT_VERSION = 1


def _input_state(spark, sf_dir: str) -> str:
    """Names, lengths and times of the input files, so that a snapshot of
    other contents is not read back."""
    files = sorted(f for t in ("customer", "orders", "nation", "region") for f in read_table(spark, sf_dir, t).inputFiles())
    conf, path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    states = [path(f).getFileSystem(conf).getFileStatus(path(f)) for f in files]
    return str([(f, s.getLen(), s.getModificationTime()) for f, s in zip(files, states)])


def _scratch_path(spark, kind: str, sf_dir: str) -> str:
    """A folder under the cluster's checkpoint directory, keyed by input."""
    import hashlib
    from quarry.session import checkpoint_dir
    tag = hashlib.md5(f"{SNAPSHOT_VERSION}:{sf_dir}:{_input_state(spark, sf_dir)}".encode()).hexdigest()[:12]
    return f"{checkpoint_dir(spark).rstrip('/')}/quarry-{kind}/{tag}"


@register("acquire_snapshot", ACQUIRE_TIES_SQL)
def acquire_snapshot(spark, sf_dir):
    # read-through snapshot: built and written once per input, then read back
    from quarry.sources.files import snapshot
    return snapshot(spark, _scratch_path(spark, "snapshots", sf_dir) + "/acquire_2001",
                    lambda: latest_orders_wide(spark, sf_dir, 2001, ties="keep"))


@register("csv_roundtrip", "SELECT * FROM customer")
def csv_roundtrip(spark, sf_dir):
    # written as CSV with a leading row-label column (as pandas does), read
    # back with the declared schema and the label column dropped
    import uuid
    from quarry.sources.files import read_csv, write_csv
    cust = read_table(spark, sf_dir, "customer")
    path = _scratch_path(spark, "csv", sf_dir) + f"/customer-{uuid.uuid4().hex}"
    write_csv(cust.select(F.col("c_custkey").alias("row_label"), *cust.columns), path)
    from pyspark.sql.types import LongType, StructField, StructType
    schema = StructType([StructField("row_label", LongType())] + cust.schema.fields)
    return read_csv(spark, path, schema=schema, index_col=True)


@register("sql_query", "SELECT * FROM customer")
def sql_query(spark, sf_dir):
    register_views(spark, sf_dir, ["customer"])
    return run_sql(spark, "SELECT * FROM customer")


@register("latest_max_date", """
SELECT o_custkey, MAX(o_orderdate) AS max_orderdate FROM orders GROUP BY o_custkey
""")
def latest_max_date(spark, sf_dir):
    return (read_table(spark, sf_dir, "orders").groupBy("o_custkey")
            .agg(F.max("o_orderdate").alias("max_orderdate")))


# ------------------------------------------------------- columns, filters

@register("single_category_filter", "WITH " + GAPPY_LINEITEM_SQL + """
SELECT l_orderkey, l_linenumber, l_returnflag, unit
FROM (SELECT *, CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_linenumber END AS unit FROM gappy)
WHERE l_returnflag IN ('A', 'R') AND (unit = 1 OR unit IS NULL)
""")
def single_category_filter(spark, sf_dir):
    df = gappy_lineitem(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_returnflag",
        F.when(F.col("l_orderkey") % 5 == 0, None).otherwise(F.col("l_linenumber")).alias("unit"))
    return columns.keep_category_single(df, "l_returnflag", ["A", "R"], "unit", 1)


@register("drop_rename_columns", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity AS qty,
       l_extendedprice AS price, l_discount, l_returnflag, l_shipdate
FROM lineitem
""")
def drop_rename_columns(spark, sf_dir):
    df = read_table(spark, sf_dir, "lineitem")
    df = columns.drop_columns(df, ["l_tax", "l_linestatus"])
    return columns.rename_columns(df, {"l_quantity": "qty", "l_extendedprice": "price"})


@register("dtype_columns", "SELECT l_returnflag, l_linestatus FROM lineitem")
def dtype_columns(spark, sf_dir):
    df = read_table(spark, sf_dir, "lineitem")
    return df.select(*columns.columns_by_kind(df, "string"))


@register("fill_constant", "WITH " + GAPPY_LINEITEM_SQL + """
SELECT l_orderkey, l_linenumber, COALESCE(l_discount, 0.0) AS l_discount,
       COALESCE(l_quantity, 1.0) AS l_quantity, l_tax
FROM gappy
""")
def fill_constant(spark, sf_dir):
    df = gappy_lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_discount",
                                               "l_quantity", "l_tax")
    return columns.fill_constant(df, {"l_discount": 0, "l_quantity": 1})


@register("recode_map", """
SELECT c_custkey, c_nationkey,
       COALESCE(CASE c_nationkey WHEN 0 THEN 'ALGERIA' WHEN 1 THEN 'ARGENTINA'
                                 WHEN 2 THEN 'BRAZIL' END,
                CAST(c_nationkey AS VARCHAR)) AS nation_label
FROM customer
""")
def recode_map(spark, sf_dir):
    df = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return df.withColumn("nation_label", recode("c_nationkey", NATION_NAMES))


@register("map_lookup", """
SELECT c_custkey, c_nationkey,
       CASE c_nationkey WHEN 0 THEN 'ALGERIA' WHEN 1 THEN 'ARGENTINA'
                        WHEN 2 THEN 'BRAZIL' END AS nation_label
FROM customer
""")
def map_lookup_q(spark, sf_dir):
    df = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return df.withColumn("nation_label", map_lookup("c_nationkey", NATION_NAMES))


@register("parse_date", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date_text,
       CAST(strftime(o_orderdate, '%Y-%m-%d') AS TIMESTAMP) AS parsed
FROM orders
""")
def parse_date(spark, sf_dir):
    df = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_text"))
    parsed = columns.parse_date_column(df.withColumn("parsed", F.col("date_text")), "parsed")
    return parsed.withColumn("parsed", F.col("parsed").cast("timestamp_ntz"))


@register("label_concat", """
SELECT l_orderkey, l_linenumber, 'cluster_' || CAST(l_linenumber AS VARCHAR) AS label
FROM lineitem
""")
def label_concat_q(spark, sf_dir):
    df = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return df.withColumn("label", label_concat("cluster_", "l_linenumber"))


# ---------------------------------------------------------------- missing


@register("missing_by_column", "WITH " + GAPPY_LINEITEM_SQL + """,
counts AS (
  SELECT count(*) AS n,
         count_if(l_orderkey IS NULL) AS l_orderkey, count_if(l_partkey IS NULL) AS l_partkey,
         count_if(l_suppkey IS NULL) AS l_suppkey, count_if(l_linenumber IS NULL) AS l_linenumber,
         count_if(l_quantity IS NULL) AS l_quantity,
         count_if(l_extendedprice IS NULL) AS l_extendedprice,
         count_if(l_discount IS NULL) AS l_discount, count_if(l_tax IS NULL) AS l_tax,
         count_if(l_returnflag IS NULL) AS l_returnflag,
         count_if(l_linestatus IS NULL) AS l_linestatus,
         count_if(l_shipdate IS NULL) AS l_shipdate
  FROM gappy),
long AS (UNPIVOT counts ON COLUMNS(* EXCLUDE (n)) INTO NAME column_name VALUE missing_values)
SELECT column_name, CAST(missing_values AS BIGINT) AS missing_values,
       round_even(100.0 * missing_values / n, 1) AS pct_missing
FROM long WHERE missing_values <> 0
""")
def missing_by_column(spark, sf_dir):
    return profile.missing_by_column(gappy_lineitem(spark, sf_dir))


@register("missing_summary", "WITH " + GAPPY_LINEITEM_SQL + """
SELECT CAST(11 AS BIGINT) AS n_columns,
       CAST(""" + " + ".join(f"(count_if({c} IS NULL) > 0)::INT" for c in GAPPY_COLS) + """
            AS BIGINT) AS n_columns_with_missing
FROM gappy
""")
def missing_summary(spark, sf_dir):
    return profile.missing_summary(gappy_lineitem(spark, sf_dir))


_ROW_MISSING_SQL = """(l_orderkey IS NULL)::INT + (l_partkey IS NULL)::INT + (l_suppkey IS NULL)::INT
  + (l_linenumber IS NULL)::INT + (l_quantity IS NULL)::INT + (l_extendedprice IS NULL)::INT
  + (l_discount IS NULL)::INT + (l_tax IS NULL)::INT + (l_returnflag IS NULL)::INT
  + (l_linestatus IS NULL)::INT + (l_shipdate IS NULL)::INT"""


@register("missing_by_row", "WITH " + GAPPY_LINEITEM_SQL + """
SELECT num_cols_missing, round_even(num_cols_missing * 100.0 / 11, 2) AS percent_cols_missing,
       count(*) AS num_rows
FROM (SELECT """ + _ROW_MISSING_SQL + """ AS num_cols_missing FROM gappy)
GROUP BY num_cols_missing
""")
def missing_by_row(spark, sf_dir):
    return profile.missing_by_row(gappy_lineitem(spark, sf_dir))


@register("drop_missing", "WITH " + GAPPY_LINEITEM_SQL + """
-- l_linestatus (about a third missing) is the only column under the 75 % bar;
-- 10 columns remain, so a row needs int(round(0.75 * 10)) = 8 present values.
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_shipdate
FROM gappy
WHERE 10 - ((l_quantity IS NULL)::INT + (l_discount IS NULL)::INT + (l_tax IS NULL)::INT
            + (l_returnflag IS NULL)::INT + (l_shipdate IS NULL)::INT) >= 8
""")
def drop_missing(spark, sf_dir):
    return clean.drop_missing(gappy_lineitem(spark, sf_dir))


@register("drop_rows_low_percent", "WITH " + GAPPY_LINEITEM_SQL + """,
r AS (SELECT count(*) AS n, """ + ", ".join(f"count({c}) AS c_{c}" for c in GAPPY_COLS) + """
      FROM gappy)
SELECT gappy.* FROM gappy, r
WHERE """ + "\n  AND ".join(
    f"({c} IS NOT NULL OR (r.n - r.c_{c}) / r.n >= 0.01)" for c in GAPPY_COLS))
def drop_rows_low_percent(spark, sf_dir):
    return clean.drop_rows_low_percent(gappy_lineitem(spark, sf_dir))


@register("impute_mean", "WITH " + GAPPY_LINEITEM_SQL + """
SELECT l_orderkey, l_linenumber,
       round_even(COALESCE(l_quantity, (SELECT avg(l_quantity) FROM gappy)), 6) AS l_quantity,
       round_even(COALESCE(l_discount, (SELECT avg(l_discount) FROM gappy)), 6) AS l_discount
FROM gappy
""")
def impute_mean(spark, sf_dir):
    df = gappy_lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity",
                                               "l_discount")
    out = clean.impute(df, ["l_quantity", "l_discount"], "mean")
    return out.select("l_orderkey", "l_linenumber", F.bround("l_quantity", 6).alias("l_quantity"),
                      F.bround("l_discount", 6).alias("l_discount"))


@register("impute_median", "WITH " + GAPPY_LINEITEM_SQL + """
SELECT l_orderkey, l_linenumber,
       COALESCE(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM gappy)) AS l_quantity,
       COALESCE(l_tax, (SELECT quantile_cont(l_tax, 0.5) FROM gappy)) AS l_tax
FROM gappy
""")
def impute_median(spark, sf_dir):
    df = gappy_lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return clean.impute(df, ["l_quantity", "l_tax"], "median")


@register("impute_mode", "WITH " + GAPPY_LINEITEM_SQL + """
SELECT l_orderkey, l_linenumber,
       COALESCE(l_returnflag, (SELECT l_returnflag FROM gappy WHERE l_returnflag IS NOT NULL
                               GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS l_returnflag,
       COALESCE(l_discount, (SELECT l_discount FROM gappy WHERE l_discount IS NOT NULL
                             GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS l_discount
FROM gappy
""")
def impute_mode(spark, sf_dir):
    df = gappy_lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_returnflag",
                                               "l_discount")
    return clean.impute(df, ["l_returnflag", "l_discount"], "mode")


# ------------------------------------------------------------- profiling


@register("count_unique", """
UNPIVOT (SELECT count(DISTINCT p_partkey) AS p_partkey, count(DISTINCT p_name) AS p_name,
                count(DISTINCT p_brand) AS p_brand, count(DISTINCT p_type) AS p_type,
                count(DISTINCT p_size) AS p_size, count(DISTINCT p_retailprice) AS p_retailprice
         FROM part)
ON COLUMNS(*) INTO NAME column_name VALUE n_unique
""")
def count_unique(spark, sf_dir):
    return profile.count_unique(read_table(spark, sf_dir, "part"))


@register("value_counts", """
SELECT c_mktsegment, count(*) AS count FROM customer GROUP BY c_mktsegment
""")
def value_counts(spark, sf_dir):
    return profile.value_counts(read_table(spark, sf_dir, "customer"), "c_mktsegment")


@register("value_counts_strings", """
SELECT column_name, value, count(*) AS count
FROM (UNPIVOT (SELECT p_name, p_brand, p_type FROM part)
      ON p_name, p_brand, p_type INTO NAME column_name VALUE value)
GROUP BY column_name, value
""")
def value_counts_strings(spark, sf_dir):
    return profile.value_counts_strings(read_table(spark, sf_dir, "part"))


@register("value_counts_small", """
WITH vals AS (
  SELECT 'event_type' AS column_name, CAST(event_type AS VARCHAR) AS value FROM events
  UNION ALL SELECT 'event_id', CAST(event_id AS VARCHAR) FROM events
  UNION ALL SELECT 'ts', strftime(ts, '%Y-%m-%d %H:%M:%S.%f') FROM events
  UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR) FROM events
  UNION ALL SELECT 'value', CAST(value AS VARCHAR) FROM events
  UNION ALL SELECT 'props', props FROM events),
small AS (SELECT column_name FROM vals GROUP BY column_name HAVING count(DISTINCT value) < 10)
SELECT column_name, value, count(*) AS count
FROM vals WHERE column_name IN (SELECT column_name FROM small)
GROUP BY column_name, value
""")
def value_counts_small(spark, sf_dir):
    return profile.value_counts_small(read_table(spark, sf_dir, "events"), limit=10)


_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _bins_sql(cols, table, closed="right", bins=10):
    """Oracle SQL for equal-width bins of several columns (edge-array form)."""
    parts = []
    for c in cols:
        stats = f"(SELECT min({c}) AS mn, max({c}) AS mx FROM {table})"
        edge = "s.mn + i * ((s.mx - s.mn) / {b})".format(b=bins)
        if closed == "right":
            binexpr = "1 + (SELECT count(*) FROM range(1, {b}) e(i) WHERE t.{c} > {edge})".format(
                b=bins, c=c, edge=edge.replace("i *", "e.i *"))
        else:
            binexpr = "(SELECT count(*) FROM range(1, {b}) e(i) WHERE t.{c} >= {edge})".format(
                b=bins, c=c, edge=edge.replace("i *", "e.i *"))
        parts.append(f"""
  SELECT '{c}' AS column_name, b.i AS bin, b.lo, b.hi, COALESCE(k.n, 0) AS count
  FROM (SELECT {'r.i + 1' if closed == 'right' else 'r.i'} AS i,
               CASE WHEN r.i = 0 THEN s.mn ELSE s.mn + r.i * ((s.mx - s.mn) / {bins}) END AS lo,
               CASE WHEN r.i = {bins - 1} THEN s.mx
                    ELSE s.mn + (r.i + 1) * ((s.mx - s.mn) / {bins}) END AS hi
        FROM range(0, {bins}) r(i), {stats} s) b
  LEFT JOIN (SELECT bin, count(*) AS n
             FROM (SELECT {binexpr} AS bin
                   FROM {table} t, {stats} s WHERE t.{c} IS NOT NULL)
             GROUP BY bin) k ON k.bin = b.i""")
    return "\nUNION ALL".join(parts)


@register("binned_counts", "SELECT column_name, CAST(bin AS BIGINT) AS bin, lo, hi, "
          "CAST(count AS BIGINT) AS count FROM (" + _bins_sql(_LI_NUM, "lineitem", "right") + ")")
def binned_counts(spark, sf_dir):
    return profile.binned_counts(read_table(spark, sf_dir, "lineitem"), _LI_NUM, 10, "right")


@register("histogram", "SELECT column_name, CAST(bin AS BIGINT) AS bin, lo, hi, "
          "CAST(count AS BIGINT) AS count FROM (" + _bins_sql(_LI_NUM, "lineitem", "left") + ")")
def histogram(spark, sf_dir):
    return profile.histogram(read_table(spark, sf_dir, "lineitem"), _LI_NUM, 10)


@register("describe", """
SELECT column_name, count, round_even(mean, 6) AS mean, round_even(std, 6) AS std, min,
       q25, q50, q75, max
FROM (""" + "\nUNION ALL".join(
    f"""
  SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
         CAST(min({c}) AS DOUBLE) AS min,
         quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50,
         quantile_cont({c}, 0.75) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
    for c in _LI_NUM) + ")")
def describe(spark, sf_dir):
    d = profile.describe(read_table(spark, sf_dir, "lineitem"), _LI_NUM)
    return d.select("column_name", "count", F.bround("mean", 6).alias("mean"),
                    F.bround("std", 6).alias("std"), "min", "q25", "q50", "q75", "max")


@register("quantiles", """
SELECT column_name, prob, value FROM (""" + "\nUNION ALL".join(
    f"""
  SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS prob,
         quantile_cont({c}, {p}) AS value FROM lineitem"""
    for c in _LI_NUM for p in ("0.25", "0.75")) + ")")
def quantiles(spark, sf_dir):
    return profile.quantiles(read_table(spark, sf_dir, "lineitem"), _LI_NUM, [0.25, 0.75])


@register("table_info", "WITH " + GAPPY_LINEITEM_SQL + """
SELECT position, column_name, dtype, non_null FROM (VALUES
  (0, 'l_orderkey', 'bigint'), (1, 'l_partkey', 'bigint'), (2, 'l_suppkey', 'bigint'),
  (3, 'l_linenumber', 'int'), (4, 'l_quantity', 'double'), (5, 'l_extendedprice', 'double'),
  (6, 'l_discount', 'double'), (7, 'l_tax', 'double'), (8, 'l_returnflag', 'string'),
  (9, 'l_linestatus', 'string'), (10, 'l_shipdate', 'timestamp_ntz')) AS s(position, column_name, dtype)
JOIN (UNPIVOT (SELECT count(l_orderkey) AS l_orderkey, count(l_partkey) AS l_partkey,
                      count(l_suppkey) AS l_suppkey, count(l_linenumber) AS l_linenumber,
                      count(l_quantity) AS l_quantity, count(l_extendedprice) AS l_extendedprice,
                      count(l_discount) AS l_discount, count(l_tax) AS l_tax,
                      count(l_returnflag) AS l_returnflag, count(l_linestatus) AS l_linestatus,
                      count(l_shipdate) AS l_shipdate FROM gappy)
      ON COLUMNS(*) INTO NAME column_name VALUE non_null) c USING (column_name)
""")
def table_info(spark, sf_dir):
    return profile.table_info(gappy_lineitem(spark, sf_dir))


@register("shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def shape(spark, sf_dir):
    return profile.shape(read_table(spark, sf_dir, "lineitem"))


# the remaining registered queries live in sibling modules
from quarry.plans import queries_explore  # noqa: E402,F401
from quarry.plans import queries_cluster  # noqa: E402,F401
from quarry.plans import queries_workflow  # noqa: E402,F401
