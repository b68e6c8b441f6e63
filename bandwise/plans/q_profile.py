"""Catalog: profile and small aggregations."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from bandwise.operators.prep import (BOOLEAN_TEXT, FLOAT_TEXT, INTEGER_TEXT, drop_low_cardinality,
                                     fill_nulls, flatten_struct, infer_column_types, prepare)
from bandwise.operators.profile import (crosstab_long, distinct_levels, margins_pivot,
                                        min_max_rollup, univariate, value_shares)
from bandwise.plans.catalog import register
from bandwise.plans.common import rounded
from bandwise.plans.oracle_sql import _r
from bandwise.session import checkpoint_dir
from bandwise.sources.files import read_csv, write_report
from bandwise.sources.tables import load_table

# orders with a 0/1 target: order status 'F'.
ORDERS_COLS = [("o_orderkey", "bigint", True), ("o_custkey", "bigint", True),
               ("o_orderstatus", "string", False), ("o_totalprice", "double", True),
               ("o_orderdate", "timestamp_ntz", False), ("o_orderpriority", "string", False),
               ("target", "int", True)]
_ORDERS_BASE = "SELECT *, CAST(o_orderstatus = 'F' AS INTEGER) AS target FROM orders"


def orders_with_target(spark, sf_dir):
    return load_table(spark, sf_dir, "orders").withColumn(
        "target", (F.col("o_orderstatus") == "F").cast("int"))


def univariate_profile(spark, sf_dir):
    return rounded(univariate(orders_with_target(spark, sf_dir), target="target"))


def _profile_sql(cols, base_sql, target="target") -> str:
    parts = []
    for i, (c, t, num) in enumerate(cols):
        if num:
            den = (f"(stddev_pop(CASE WHEN {target} IS NOT NULL THEN CAST({c} AS DOUBLE) END) * "
                   f"stddev_pop(CASE WHEN {c} IS NOT NULL THEN CAST({target} AS DOUBLE) END))")
            cor = f"CASE WHEN {den} = 0 THEN NULL ELSE covar_pop(CAST({c} AS DOUBLE), CAST({target} AS DOUBLE)) / {den} END"
            parts.append(f"""SELECT '{c}' AS variable, '{t}' AS type, COUNT(DISTINCT {c}) AS var_vals,
  {_r(f'MIN({c})', 'var_min')}, {_r(f'MAX({c})', 'var_max')}, {_r(f'AVG({c})', 'var_mean')},
  {_r(f'quantile_cont({c}, 0.5)', 'var_median')}, {_r(cor, 'CorrelationWithTarget')},
  {_r(f'count_if({c} = 0) / COUNT(*)', 'percentZeros')}, {_r(f'count_if({c} IS NULL) / COUNT(*)', 'percentNull')},
  CAST({i} AS INTEGER) AS ordinal FROM base""")
        else:
            parts.append(f"""SELECT '{c}' AS variable, '{t}' AS type, COUNT(DISTINCT {c}) AS var_vals,
  NULL::DOUBLE AS var_min, NULL::DOUBLE AS var_max, NULL::DOUBLE AS var_mean, NULL::DOUBLE AS var_median,
  NULL::DOUBLE AS CorrelationWithTarget, 0.0::DOUBLE AS percentZeros,
  {_r(f'count_if({c} IS NULL) / COUNT(*)', 'percentNull')}, CAST({i} AS INTEGER) AS ordinal FROM base""")
    return f"WITH base AS ({base_sql})\n" + "\nUNION ALL\n".join(parts)


register("univariate_profile", _profile_sql(ORDERS_COLS, _ORDERS_BASE))(univariate_profile)


def drop_constant_columns(spark, sf_dir):
    """Profile -> columns with < 2 distinct values are dropped.
    orders gets a constant column ``channel`` to show the drop."""
    base = orders_with_target(spark, sf_dir).withColumn("channel", F.lit("web"))
    prof = univariate(base, target="target", median=False)
    kept, dropped = drop_low_cardinality(base, prof)
    dropped_set = set(dropped)
    return (prof.select("variable", "var_vals")
            .withColumn("dropped", F.col("variable").isin(list(dropped_set)) if dropped_set else F.lit(False))
            .withColumn("kept_columns", F.lit(len(kept.columns)).cast("int")))


register("drop_constant_columns", """
WITH base AS (SELECT *, CAST(o_orderstatus = 'F' AS INTEGER) AS target, 'web' AS channel FROM orders),
d AS (
  SELECT 'o_orderkey' AS variable, COUNT(DISTINCT o_orderkey) AS var_vals FROM base UNION ALL
  SELECT 'o_custkey', COUNT(DISTINCT o_custkey) FROM base UNION ALL
  SELECT 'o_orderstatus', COUNT(DISTINCT o_orderstatus) FROM base UNION ALL
  SELECT 'o_totalprice', COUNT(DISTINCT o_totalprice) FROM base UNION ALL
  SELECT 'o_orderdate', COUNT(DISTINCT o_orderdate) FROM base UNION ALL
  SELECT 'o_orderpriority', COUNT(DISTINCT o_orderpriority) FROM base UNION ALL
  SELECT 'target', COUNT(DISTINCT target) FROM base UNION ALL
  SELECT 'channel', COUNT(DISTINCT channel) FROM base)
SELECT variable, var_vals, var_vals < 2 AS dropped,
       CAST((SELECT COUNT(*) FROM d WHERE var_vals >= 2) AS INTEGER) AS kept_columns
FROM d""")(drop_constant_columns)


def value_shares_q(spark, sf_dir):
    """A2: level shares (non-null denominator) of the string columns of orders."""
    o = load_table(spark, sf_dir, "orders", ["o_orderstatus", "o_orderpriority"])
    return rounded(value_shares(o))


register("value_shares", f"""
WITH l AS (
  SELECT 'o_orderstatus' AS variable, o_orderstatus AS level FROM orders WHERE o_orderstatus IS NOT NULL
  UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL),
c AS (SELECT variable, level, COUNT(*) AS cnt FROM l GROUP BY ALL)
SELECT variable, level, cnt, {_r('cnt / SUM(cnt) OVER (PARTITION BY variable)', 'share')} FROM c""")(value_shares_q)


def margins_pivot_q(spark, sf_dir):
    """Events (return flag R) and rows per line status with the 'All' margin."""
    li = load_table(spark, sf_dir, "lineitem", ["l_linestatus", "l_returnflag"]).withColumn(
        "event", (F.col("l_returnflag") == "R").cast("int"))
    return margins_pivot(li, "l_linestatus", "event")


register("margins_pivot", """
SELECT l_linestatus, CAST(SUM(CAST(l_returnflag = 'R' AS INTEGER)) AS BIGINT) AS sum,
       COUNT(*) AS len, GROUPING(l_linestatus) = 1 AS is_total
FROM lineitem WHERE l_linestatus IS NOT NULL GROUP BY ROLLUP (l_linestatus)""")(margins_pivot_q)


def crosstab_q(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem", ["l_returnflag", "l_linestatus"])
    return crosstab_long(li, "l_returnflag", "l_linestatus")


register("crosstab", """
SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem
WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL GROUP BY ALL""")(crosstab_q)


def min_max_rollup_q(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem", ["l_linestatus", "l_quantity"])
    return rounded(min_max_rollup(li, "l_linestatus", "l_quantity"))


register("min_max_rollup", f"""
SELECT l_linestatus, {_r('MIN(l_quantity)', 'amin')}, {_r('MAX(l_quantity)', 'amax')},
       GROUPING(l_linestatus) = 1 AS is_total
FROM lineitem WHERE l_linestatus IS NOT NULL GROUP BY ROLLUP (l_linestatus)""")(min_max_rollup_q)


def distinct_levels_q(spark, sf_dir):
    c = load_table(spark, sf_dir, "customer", ["c_mktsegment", "c_name"])
    return distinct_levels(c, ["c_mktsegment"])


register("distinct_levels", """
SELECT DISTINCT 'c_mktsegment' AS variable, c_mktsegment AS level FROM customer
WHERE c_mktsegment IS NOT NULL""")(distinct_levels_q)


def class_count(spark, sf_dir):
    """Number of target classes."""
    o = load_table(spark, sf_dir, "orders", ["o_orderstatus"])
    return o.agg(F.count_distinct("o_orderstatus").alias("n_classes"))


register("class_count", "SELECT COUNT(DISTINCT o_orderstatus) AS n_classes FROM orders")(class_count)


def infer_types(spark, sf_dir):
    """P10: content types of the events columns; select string/floating ones."""
    ev = load_table(spark, sf_dir, "events")
    return infer_column_types(ev, ["string", "floating"])


def _text_type_sql(col: str, table: str) -> str:
    return (f"(SELECT CASE WHEN COUNT({col}) = 0 THEN 'empty' "
            f"WHEN count_if(regexp_full_match({col}, '{INTEGER_TEXT[1:-1]}')) = COUNT({col}) THEN 'integer' "
            f"WHEN count_if(regexp_full_match({col}, '{FLOAT_TEXT[1:-1]}')) = COUNT({col}) THEN 'floating' "
            f"WHEN count_if(regexp_full_match({col}, '{BOOLEAN_TEXT[1:-1]}')) = COUNT({col}) THEN 'boolean' "
            f"ELSE 'string' END FROM {table})")


register("infer_types", f"""
SELECT variable, inferred_type, regexp_matches(inferred_type, 'string|floating') AS selected
FROM (VALUES ('event_id', 'integer'), ('ts', 'datetime64'), ('user_id', 'integer'),
             ('event_type', {_text_type_sql('event_type', 'events')}), ('value', 'floating'),
             ('props', {_text_type_sql('props', 'events')})) t(variable, inferred_type)""")(infer_types)


def null_fill_categorical(spark, sf_dir):
    """Fill nulls by type, then force c_nationkey to a category ``'<n>_'``."""
    c = load_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    return rounded(prepare(c, ["c_nationkey"], cat_na=".", num_na=0))


register("null_fill_categorical", f"""
SELECT COALESCE(c_custkey, 0) AS c_custkey, CAST(COALESCE(c_nationkey, 0) AS VARCHAR) || '_' AS c_nationkey,
       {_r('COALESCE(c_acctbal, 0)', 'c_acctbal')}, COALESCE(c_mktsegment, '.') AS c_mktsegment
FROM customer""")(null_fill_categorical)


def flatten_names(spark, sf_dir):
    """Nested struct (per-segment summary) flattened to ``a_b_`` names."""
    c = load_table(spark, sf_dir, "customer", ["c_mktsegment", "c_acctbal"])
    nested = c.groupBy("c_mktsegment").agg(
        F.struct(F.count(F.lit(1)).alias("count"),
                 F.struct(F.min("c_acctbal").alias("min"), F.max("c_acctbal").alias("max")).alias("acctbal")
                 ).alias("stats"))
    return rounded(flatten_struct(nested))


register("flatten_names", f"""
SELECT c_mktsegment AS c_mktsegment_, COUNT(*) AS stats_count_,
       {_r('MIN(c_acctbal)', 'stats_acctbal_min_')}, {_r('MAX(c_acctbal)', 'stats_acctbal_max_')}
FROM customer GROUP BY c_mktsegment""")(flatten_names)


_FLAGS_BASE = """SELECT o_totalprice, o_orderpriority < '2' AS urgent, CASE WHEN o_orderpriority < '4' THEN o_totalprice > 200000 END AS dear,
  CAST(o_orderstatus = 'F' AS INTEGER) AS target FROM orders"""


def boolean_profile(spark, sf_dir):
    """Profile of boolean columns, one of them with nulls; False is zero."""
    o = load_table(spark, sf_dir, "orders", ["o_totalprice", "o_orderpriority", "o_orderstatus"])
    dear = F.when(F.col("o_orderpriority") < "4", F.col("o_totalprice") > 200000)
    base = o.select("o_totalprice", (F.col("o_orderpriority") < "2").alias("urgent"), dear.alias("dear"),
                    (F.col("o_orderstatus") == "F").cast("int").alias("target"))
    return rounded(univariate(base, target="target"))


register("boolean_profile", _profile_sql(
    [("o_totalprice", "double", True), ("urgent", "boolean", True), ("dear", "boolean", True), ("target", "int", True)],
    f"SELECT o_totalprice, urgent::INTEGER AS urgent, dear::INTEGER AS dear, target FROM ({_FLAGS_BASE})"))(boolean_profile)


def null_fill_joined(spark, sf_dir):
    """Numeric, text and boolean nulls of a left join (customers without an urgent order), filled by type."""
    c = load_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    o = load_table(spark, sf_dir, "orders", ["o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice"])
    urgent = o.where(F.col("o_orderpriority") < "2").groupBy("o_custkey").agg(
        F.sum("o_totalprice").alias("total"), F.max("o_orderstatus").alias("status"), F.max(F.col("o_totalprice") > 250000).alias("dear"),
        F.count(F.lit(1)).alias("orders"))
    joined = c.join(urgent, c.c_custkey == urgent.o_custkey, "left").drop("o_custkey")
    return rounded(fill_nulls(joined, num_na=0, cat_na="."))


register("null_fill_joined", f"""
WITH u AS (SELECT o_custkey, SUM(o_totalprice) AS total, MAX(o_orderstatus) AS status, MAX(o_totalprice > 250000) AS dear, COUNT(*) AS orders
           FROM orders WHERE o_orderpriority < '2' GROUP BY o_custkey)
SELECT c_custkey, c_mktsegment, {_r('COALESCE(total, 0)', 'total')}, COALESCE(status, '.') AS status, COALESCE(dear, FALSE) AS dear,
       COALESCE(orders, 0) AS orders FROM customer LEFT JOIN u ON c_custkey = o_custkey""")(null_fill_joined)


def csv_round_trip(spark, sf_dir):
    """Orders written as a CSV report and read again: declared schema, key column, dates, pruned columns."""
    o = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate"])
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv_round_trip_{uuid.uuid4().hex}"
    write_report(o.withColumn("o_orderdate", F.date_format("o_orderdate", "dd/MM/yyyy")), path)
    schema = "o_orderkey bigint, o_orderpriority string, o_totalprice double, o_orderdate date"
    back = read_csv(spark, path, schema, key_col="key", columns=["key", "o_totalprice", "o_orderdate"], date_format="dd/MM/yyyy")
    return rounded(back)


register("csv_round_trip", f"""
SELECT o_orderkey AS key, {_r('o_totalprice', 'o_totalprice')}, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders""")(csv_round_trip)
