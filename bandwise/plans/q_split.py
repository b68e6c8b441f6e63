"""Catalog: sampling and splitting (X1-X5) on orders (key o_orderkey)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bandwise.operators.split import (complement, hash_split_flag, kfold_column, sample_n,
                                      size_subset_flag, train_test_split)
from bandwise.plans.catalog import register
from bandwise.plans.common import rounded
from bandwise.plans.model_selection import TRAIN_SIZES
from bandwise.sources.tables import load_table

KEY = ["o_orderkey"]


def _hash_sql(seed: int) -> str:
    return f"('0x' || substr(md5('{seed}:' || CAST(o_orderkey AS VARCHAR)), 1, 8))::UBIGINT"


def _below_sql(seed: int, fraction) -> str:
    return f"({_hash_sql(seed)})::DOUBLE < 4294967296::DOUBLE * {fraction}::DOUBLE"


def hash_split(spark, sf_dir):
    """Every order with its split label (test share 0.2, seed 12345)."""
    o = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice"])
    return rounded(o.withColumn("is_test", hash_split_flag(KEY, 12345, 0.2)))


register("hash_split", f"""
SELECT o_orderkey, o_orderstatus, ROUND(o_totalprice, 6) AS o_totalprice,
       {_below_sql(12345, 0.2)} AS is_test FROM orders""")(hash_split)


def split_complement(spark, sf_dir):
    """Rows of the base that are not in the 70 % train sample, via left-anti join."""
    o = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    train, _ = train_test_split(o, KEY, seed=7, test_size=0.3)
    return complement(o, train, KEY)


register("split_complement", f"""
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (
  SELECT o_orderkey FROM orders WHERE NOT ({_below_sql(7, 0.3)}))""")(split_complement)


def kfold_counts(spark, sf_dir):
    """Rows and events per fold (5 folds, seed 777)."""
    o = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"])
    return (o.withColumn("fold", kfold_column(KEY, 5, 777))
            .groupBy("fold").agg(F.count(F.lit(1)).alias("rows"),
                                 F.sum((F.col("o_orderstatus") == "F").cast("int")).cast("long").alias("events")))


register("kfold_counts", f"""
SELECT CAST(({_hash_sql(777)}) % 5 AS INTEGER) AS fold, COUNT(*) AS rows,
       CAST(SUM(CAST(o_orderstatus = 'F' AS INTEGER)) AS BIGINT) AS events
FROM orders GROUP BY ALL""")(kfold_counts)


def sample_rows(spark, sf_dir):
    """Exactly 100 orders, without replacement, by md5 order (seed 42)."""
    o = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"])
    return rounded(sample_n(o, 100, KEY, seed=42))


register("sample_n", """
SELECT o_orderkey, ROUND(o_totalprice, 6) AS o_totalprice FROM orders
ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100""")(sample_rows)


SIZES = list(TRAIN_SIZES)


def learning_curve_subsets(spark, sf_dir):
    """Nested training-size subsets of the train split; rows per size."""
    o = load_table(spark, sf_dir, "orders", ["o_orderkey"])
    train, _ = train_test_split(o, KEY, seed=12345, test_size=0.2)
    arr = F.array(*[F.struct(F.lit(s).alias("size"), size_subset_flag(KEY, s, 999).alias("inside"))
                    for s in SIZES])
    return (train.select(F.explode(arr).alias("s")).where("s.inside")
            .groupBy(F.col("s.size").alias("training_fraction")).agg(F.count(F.lit(1)).alias("rows")))


register("learning_curve_subsets", f"""
WITH train AS (SELECT o_orderkey FROM orders WHERE NOT ({_below_sql(12345, 0.2)})),
sizes AS (SELECT * FROM (VALUES {', '.join(f'({s})' for s in SIZES)}) s(f))
SELECT CAST(f AS DOUBLE) AS training_fraction, COUNT(*) AS rows
FROM train, sizes
WHERE {_below_sql(999, 'f')}
GROUP BY f""")(learning_curve_subsets)
