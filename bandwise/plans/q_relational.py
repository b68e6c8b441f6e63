"""Catalog: joins, set operations, ordering and ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from bandwise.operators.prep import is_member
from bandwise.operators.quantiles import average_ranks, value_ranks
from bandwise.operators.relational import align, anti, arg_max, first_rows, left_lookup, semi, union_all
from bandwise.plans.catalog import register
from bandwise.plans.common import rounded
from bandwise.plans.oracle_sql import _r
from bandwise.sources.tables import load_table

# Priority code dictionary for the lookup query.
PRIORITY_CODES = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4)]


def dictionary_lookup(spark, sf_dir):
    """Map order priority to a numeric code (unlisted -> 0) and count per code."""
    o = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority"])
    codes = spark.createDataFrame(PRIORITY_CODES, "o_orderpriority string, code int")
    mapped = left_lookup(o, codes, "o_orderpriority", "code", default=0)
    return mapped.groupBy("code").agg(F.count(F.lit(1)).alias("orders"))


register("dictionary_lookup", """
WITH c AS (SELECT * FROM (VALUES """ + ", ".join(f"('{k}', {v})" for k, v in PRIORITY_CODES) + """) t(k, code))
SELECT CAST(COALESCE(c.code, 0) AS INTEGER) AS code, COUNT(*) AS orders
FROM orders o LEFT JOIN c ON o.o_orderpriority = c.k GROUP BY ALL""")(dictionary_lookup)


def semi_anti_membership(spark, sf_dir):
    """Line counts whose part is / is not a large part (size > 40), via
    semi and anti joins, and the membership flag of each return flag."""
    li = load_table(spark, sf_dir, "lineitem", ["l_partkey", "l_returnflag"])
    big = load_table(spark, sf_dir, "part", ["p_partkey", "p_size"]).where(F.col("p_size") > 40) \
        .select(F.col("p_partkey").alias("l_partkey"))
    inside = semi(li, big, ["l_partkey"]).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("in_set"))
    outside = anti(li, big, ["l_partkey"]).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("not_in_set"))
    flags = is_member(li.select("l_returnflag").distinct(), "l_returnflag", ["R", "A"]) \
        .withColumnRenamed("is_member", "flag_listed")
    return align(inside, outside, ["l_returnflag"]).join(flags, "l_returnflag", "full_outer")


register("semi_anti_membership", """
WITH big AS (SELECT p_partkey FROM part WHERE p_size > 40),
i AS (SELECT l_returnflag, COUNT(*) AS in_set FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM big) GROUP BY ALL),
o AS (SELECT l_returnflag, COUNT(*) AS not_in_set FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM big) GROUP BY ALL),
f AS (SELECT DISTINCT l_returnflag, l_returnflag IN ('R', 'A') AS flag_listed FROM lineitem)
SELECT COALESCE(i.l_returnflag, o.l_returnflag, f.l_returnflag) AS l_returnflag, i.in_set, o.not_in_set, f.flag_listed
FROM i FULL OUTER JOIN o ON i.l_returnflag = o.l_returnflag
FULL OUTER JOIN f ON COALESCE(i.l_returnflag, o.l_returnflag) = f.l_returnflag""")(semi_anti_membership)


def aligned_order_facts(spark, sf_dir):
    """Per-order line facts aligned with order header facts by key
    (full outer), customer segment attached by a left join, columns renamed."""
    li = load_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_quantity"])
    o = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    c = load_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    lines = li.groupBy(F.col("l_orderkey").alias("orderkey")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))
    head = o.withColumnsRenamed({"o_orderkey": "orderkey", "o_totalprice": "total_price"})
    facts = align(lines, head, ["orderkey"])
    return rounded(facts.join(c, facts.o_custkey == c.c_custkey, "left")
                   .select("orderkey", "lines", "quantity", "total_price", "c_mktsegment"))


register("aligned_order_facts", f"""
WITH lines AS (SELECT l_orderkey AS orderkey, COUNT(*) AS lines, SUM(l_quantity) AS quantity FROM lineitem GROUP BY ALL),
head AS (SELECT o_orderkey AS orderkey, o_custkey, o_totalprice AS total_price FROM orders),
f AS (SELECT COALESCE(lines.orderkey, head.orderkey) AS orderkey, lines.lines, lines.quantity, head.total_price,
             head.o_custkey FROM lines FULL OUTER JOIN head ON lines.orderkey = head.orderkey)
SELECT f.orderkey, f.lines, {_r('f.quantity', 'quantity')}, {_r('f.total_price', 'total_price')}, c.c_mktsegment
FROM f LEFT JOIN customer c ON f.o_custkey = c.c_custkey""")(aligned_order_facts)


def union_tables(spark, sf_dir):
    """Union by name of per-flag and per-status summaries with a
    missing column filled, then the distinct line statuses."""
    li = load_table(spark, sf_dir, "lineitem", ["l_returnflag", "l_linestatus", "l_quantity"])
    a = li.groupBy(F.col("l_returnflag").alias("key")).agg(F.count(F.lit(1)).alias("rows"),
                                                          F.sum("l_quantity").alias("quantity"))
    b = li.groupBy(F.col("l_linestatus").alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    u = union_all(a.withColumn("source", F.lit("flag")), b.withColumn("source", F.lit("status")),
                  allow_missing=True)
    d = li.select(F.col("l_linestatus").alias("key")).distinct().select(
        "key", F.lit(None).cast("long").alias("rows"), F.lit(None).cast("double").alias("quantity"),
        F.lit("distinct").alias("source"))
    return rounded(union_all(u, d))


register("union_tables", f"""
SELECT l_returnflag AS key, COUNT(*) AS rows, {_r('SUM(l_quantity)', 'quantity')}, 'flag' AS source FROM lineitem GROUP BY ALL
UNION ALL SELECT l_linestatus, COUNT(*), NULL::DOUBLE, 'status' FROM lineitem GROUP BY l_linestatus
UNION ALL SELECT DISTINCT l_linestatus, NULL::BIGINT, NULL::DOUBLE, 'distinct' FROM lineitem""")(union_tables)


def head_rows(spark, sf_dir):
    """O1/O3: the first 5 orders by descending total price, then key (top-n is the operator)."""
    o = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"])
    return rounded(first_rows(o, 5, [F.col("o_totalprice").desc(), F.col("o_orderkey")]))


register("head_rows", """
SELECT o_orderkey, ROUND(o_totalprice, 6) AS o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""")(head_rows)


def argmax_per_group(spark, sf_dir):
    """Per brand, the part with the highest retail price (ties -> larger key)."""
    p = load_table(spark, sf_dir, "part", ["p_brand", "p_partkey", "p_retailprice"])
    return rounded(arg_max(p, ["p_brand"], "p_retailprice", "p_partkey"))


register("argmax_per_group", """
SELECT p_brand, p_partkey, ROUND(p_retailprice, 6) AS p_retailprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey DESC) AS rn FROM part)
WHERE rn = 1""")(argmax_per_group)


def average_rank(spark, sf_dir):
    """Average-tie rank of every distinct quantity (distributed ranks)."""
    li = load_table(spark, sf_dir, "lineitem", ["l_quantity"])
    r = average_ranks(value_ranks(li, ["l_quantity"]))
    return rounded(r.select(F.col("value").alias("l_quantity"), "cnt", "avg_rank"))


register("average_rank", f"""
WITH d AS (SELECT CAST(l_quantity AS DOUBLE) AS l_quantity, COUNT(*) AS cnt FROM lineitem
           WHERE l_quantity IS NOT NULL GROUP BY ALL)
SELECT l_quantity, cnt,
  {_r('COALESCE(SUM(cnt) OVER (ORDER BY l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (cnt + 1) / 2.0', 'avg_rank')}
FROM d""")(average_rank)
