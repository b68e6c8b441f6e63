"""Catalog: KS/Gini banding on lineitem (V1-V5, V9)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from bandwise.operators.evaluate import (ks_gini_summary, lorenz_points, score_performance,
                                         variable_trend)
from bandwise.operators.split import hash_split_flag
from bandwise.plans.catalog import register
from bandwise.plans.common import materialised, rounded
from bandwise.plans.oracle_sql import (_r, ks_table_select, ks_table_sql, quantile_counts_cte,
                                       fixed_edges_counts_cte)
from bandwise.sources.tables import load_table

# Minimum slice: score = l_extendedprice, event = (l_returnflag = 'R'), 10 quantile bands.
_LI_BASE = ("SELECT CAST(l_extendedprice AS DOUBLE) AS score, "
            "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS flag FROM lineitem")

# Row key of lineitem for the split: (orderkey, linenumber, partkey, suppkey) as text.
_LI_KEY_SQL = ("CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) || ':' || "
               "CAST(l_partkey AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR)")
LI_KEY_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _split_sql(seed: int, test_size: float) -> str:
    return (f"('0x' || substr(md5('{seed}:' || {_LI_KEY_SQL}), 1, 8))::UBIGINT::DOUBLE "
            f"< 4294967296::DOUBLE * {test_size}::DOUBLE")


def lineitem_scores(spark, sf_dir):
    return load_table(spark, sf_dir, "lineitem",
                      LI_KEY_COLS + ["l_extendedprice", "l_returnflag", "l_discount"])


def ks_gini_bands(spark, sf_dir):
    table, _ = score_performance(lineitem_scores(spark, sf_dir), "l_extendedprice",
                                 "l_returnflag", event="R", bins=10)
    return rounded(table)


register("ks_gini_bands", ks_table_sql(quantile_counts_cte(_LI_BASE, 10)) + ks_table_select())(ks_gini_bands)


def ks_gini_overall(spark, sf_dir):
    table, _ = score_performance(lineitem_scores(spark, sf_dir), "l_extendedprice",
                                 "l_returnflag", event="R", bins=10)
    return rounded(ks_gini_summary(table))


_SUMMARY = f"""
SELECT {_r('MAX(diff) * 100.0', 'KS')}, {_r('(SUM(gini) * 2.0 - 1.0) * 100.0', 'Gini')},
       COUNT(*) AS n_bands
FROM tab WHERE NOT is_total"""
register("ks_gini_overall", ks_table_sql(quantile_counts_cte(_LI_BASE, 10)) + _SUMMARY)(ks_gini_overall)


def ks_gini_test_with_train_edges(spark, sf_dir):
    """V5: edges fitted on the train split, applied to the test split."""
    # The split hash (built from the key text) is computed once on a narrow projection that
    # all three passes read: edges and ranks on train, banding on test.
    li = (lineitem_scores(spark, sf_dir)
          .select("l_extendedprice", "l_returnflag",
                  hash_split_flag(LI_KEY_COLS, seed=12345, test_size=0.2).alias("is_test"))
          .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        train, test = li.where(~F.col("is_test")), li.where(F.col("is_test"))
        _, edges = score_performance(train, "l_extendedprice", "l_returnflag", event="R", bins=10)
        table, _ = score_performance(test, "l_extendedprice", "l_returnflag", event="R", edges=edges)
        return materialised(rounded(table))
    finally:
        li.unpersist()


def _train_test_sql() -> str:
    split = _split_sql(12345, 0.2)
    base_all = (f"SELECT CAST(l_extendedprice AS DOUBLE) AS score, "
                f"CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS flag, {split} AS is_test FROM lineitem")
    edges_sql = f"""SELECT list_concat([LEAST(0.0, mn)], e[2:len(e) - 1], [GREATEST(1.0, mx)]) AS e FROM (
        SELECT list_sort(list_distinct(quantile_cont(ROUND(score, 12), [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e,
               MIN(score) AS mn, MAX(score) AS mx
        FROM ({base_all}) WHERE NOT is_test)"""
    test_sql = f"SELECT score, flag FROM ({base_all}) WHERE is_test"
    return ks_table_sql(fixed_edges_counts_cte(test_sql, edges_sql)) + ks_table_select()


register("ks_gini_test_with_train_edges", _train_test_sql())(ks_gini_test_with_train_edges)


def gini_variable(spark, sf_dir):
    """V4: trend of l_discount against the return flag, 6 bins, no rounding."""
    trend, _, _ = variable_trend(lineitem_scores(spark, sf_dir), "l_discount", "l_returnflag", event="R")
    return rounded(trend)


_DISC_BASE = ("SELECT CAST(l_discount AS DOUBLE) AS score, "
              "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS flag FROM lineitem")
register("gini_variable",
         ks_table_sql(quantile_counts_cte(_DISC_BASE, 6, round_digits=None))
         + f"""SELECT band_id, {_r('band_lo', 'band_lo')}, {_r('band_hi', 'band_hi')}, is_total,
       Event, Total, {_r('rate', 'Event_rate')} FROM tab""")(gini_variable)


def lorenz(spark, sf_dir):
    table, _ = score_performance(lineitem_scores(spark, sf_dir), "l_extendedprice",
                                 "l_returnflag", event="R", bins=10)
    return rounded(lorenz_points(table))


register("lorenz_points",
         ks_table_sql(quantile_counts_cte(_LI_BASE, 10))
         + f"""SELECT CAST(NULL AS INTEGER) AS band_id, 0.0::DOUBLE AS x, 0.0::DOUBLE AS y
UNION ALL
SELECT band_id, {_r('cnp', 'x')}, {_r('cep', 'y')} FROM tab WHERE NOT is_total""")(lorenz)


def ks_gini_fixed01(spark, sf_dir):
    """V6: in-class variant, first/last edge forced to 0 and 1, on a [0,1] score (l_discount * 10)."""
    li = lineitem_scores(spark, sf_dir).withColumn("p", F.col("l_discount") * 10.0)
    table, _ = score_performance(li, "p", "l_returnflag", event="R", bins=10, edge_rule="fixed01",
                                 non_prefix="Non_", event_name="Event")
    return rounded(table)


_P_BASE = ("SELECT CAST(l_discount AS DOUBLE) * 10.0 AS score, "
           "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS flag FROM lineitem")
register("ks_gini_fixed01",
         ks_table_sql(quantile_counts_cte(_P_BASE, 10, edge_rule="fixed01")) + ks_table_select())(ks_gini_fixed01)
