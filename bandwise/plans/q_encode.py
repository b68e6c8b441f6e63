"""Catalog: rare-level folding, unseen levels, one-hot encoding (E1-E9) on part."""

from __future__ import annotations

from pyspark.sql import functions as F

from bandwise.operators.encode import (COMBINED, apply_levels, feature_names, fit_level_table,
                                       fit_one_hot, kept_levels, nonzero_entries, transform_one_hot)
from bandwise.operators.split import train_test_split
from bandwise.plans.catalog import register
from bandwise.plans.common import rounded
from bandwise.plans.oracle_sql import _r
from bandwise.sources.tables import load_table

CATS = ["p_brand", "p_type"]
NUMS = ["p_size", "p_retailprice"]
FLOOR = 0.04
KEY = ["p_partkey"]

_IS_TEST = ("('0x' || substr(md5('12345:' || CAST(p_partkey AS VARCHAR)), 1, 8))::UBIGINT::DOUBLE "
            "< 4294967296::DOUBLE * 0.2::DOUBLE")
_SPLIT_CTE = f"""train AS (SELECT * FROM part WHERE NOT ({_IS_TEST})),
test AS (SELECT * FROM part WHERE {_IS_TEST}),
l AS (SELECT 'p_brand' AS variable, p_brand AS level FROM train WHERE p_brand IS NOT NULL
      UNION ALL SELECT 'p_type', p_type FROM train WHERE p_type IS NOT NULL),
c AS (SELECT variable, level, COUNT(*) AS cnt FROM l GROUP BY ALL),
lt AS (SELECT variable, level, cnt, cnt / SUM(cnt) OVER (PARTITION BY variable) AS share FROM c),
lt2 AS (SELECT *, CASE WHEN share < {FLOOR} THEN '{COMBINED}' ELSE level END AS mapped_level FROM lt),
kept AS (SELECT DISTINCT variable, mapped_level AS level FROM lt2),
mapped AS (
  SELECT t.p_partkey, t.p_size, t.p_retailprice,
         CASE WHEN t.p_brand IS NULL THEN NULL WHEN kb.level IS NOT NULL THEN t.p_brand ELSE '{COMBINED}' END AS p_brand,
         CASE WHEN t.p_type IS NULL THEN NULL WHEN kt.level IS NOT NULL THEN t.p_type ELSE '{COMBINED}' END AS p_type
  FROM test t
  LEFT JOIN (SELECT level FROM kept WHERE variable = 'p_brand') kb ON t.p_brand = kb.level
  LEFT JOIN (SELECT level FROM kept WHERE variable = 'p_type') kt ON t.p_type = kt.level),
names AS (
  SELECT col, level, CASE WHEN level IS NULL THEN col ELSE col || '=' || level END AS feature_name
  FROM (SELECT variable AS col, level FROM kept
        UNION ALL SELECT 'p_size', NULL UNION ALL SELECT 'p_retailprice', NULL)),
feat AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY col, level) - 1 AS INTEGER) AS feature_index,
                col, level, feature_name FROM names)"""


def _split(spark, sf_dir):
    part = load_table(spark, sf_dir, "part", KEY + CATS + NUMS)
    return train_test_split(part, KEY, seed=12345, test_size=0.2)


def rare_levels(spark, sf_dir):
    """Level shares on the train split, folded below a 4 % floor."""
    train, _ = _split(spark, sf_dir)
    return rounded(fit_level_table(train, CATS, FLOOR))


register("rare_levels", f"""WITH {_SPLIT_CTE}
SELECT variable, level, cnt, {_r('share', 'share')}, mapped_level FROM lt2""")(rare_levels)


def unseen_levels(spark, sf_dir):
    """Test levels that are rare or unseen in train map to the combined label."""
    train, test = _split(spark, sf_dir)
    kept = kept_levels(fit_level_table(train, CATS, FLOOR))
    mapped = apply_levels(test, CATS, kept)
    arr = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("level")) for c in CATS])
    return (mapped.select(F.explode(arr).alias("s")).select("s.*")
            .groupBy("variable", "level").agg(F.count(F.lit(1)).alias("rows")))


register("unseen_levels", f"""WITH {_SPLIT_CTE}
SELECT variable, level, COUNT(*) AS rows FROM (
  SELECT 'p_brand' AS variable, p_brand AS level FROM mapped
  UNION ALL SELECT 'p_type', p_type FROM mapped) GROUP BY ALL""")(unseen_levels)


def _fitted(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    kept = kept_levels(fit_level_table(train, CATS, FLOOR))
    train_m = apply_levels(train, CATS, kept)
    test_m = apply_levels(test, CATS, kept)
    model = fit_one_hot(train_m, CATS, NUMS)
    return model, train_m, test_m


def one_hot_features(spark, sf_dir):
    """Sorted feature names of the fitted one-hot encoder."""
    model, _, _ = _fitted(spark, sf_dir)
    names = feature_names(model, CATS, NUMS)
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)],
                                 "feature_index int, feature_name string")


register("one_hot_features", f"""WITH {_SPLIT_CTE}
SELECT feature_index, feature_name FROM feat""")(one_hot_features)


def one_hot_rows(spark, sf_dir):
    """E5: non-zero entries of the encoded test rows (unseen levels give no entry)."""
    model, _, test_m = _fitted(spark, sf_dir)
    enc = transform_one_hot(model, test_m)
    return rounded(nonzero_entries(enc, KEY).withColumn("feature_index", F.col("feature_index").cast("int")))


register("one_hot_rows", f"""WITH {_SPLIT_CTE}
SELECT m.p_partkey, f.feature_index, 1.0::DOUBLE AS value FROM mapped m
  JOIN feat f ON f.col = 'p_brand' AND f.level = m.p_brand
UNION ALL
SELECT m.p_partkey, f.feature_index, 1.0::DOUBLE FROM mapped m
  JOIN feat f ON f.col = 'p_type' AND f.level = m.p_type
UNION ALL
SELECT m.p_partkey, f.feature_index, {_r('m.p_size', 'value')} FROM mapped m
  JOIN feat f ON f.col = 'p_size' WHERE m.p_size <> 0
UNION ALL
SELECT m.p_partkey, f.feature_index, {_r('m.p_retailprice', 'value')} FROM mapped m
  JOIN feat f ON f.col = 'p_retailprice' WHERE m.p_retailprice <> 0""")(one_hot_rows)


def rare_levels_base(spark, sf_dir):
    """Rare-level folding with shares from the whole part table (before the split)."""
    part = load_table(spark, sf_dir, "part", KEY + CATS)
    return rounded(fit_level_table(part, CATS, FLOOR))


register("rare_levels_base", f"""
WITH l AS (SELECT 'p_brand' AS variable, p_brand AS level FROM part WHERE p_brand IS NOT NULL
           UNION ALL SELECT 'p_type', p_type FROM part WHERE p_type IS NOT NULL),
c AS (SELECT variable, level, COUNT(*) AS cnt FROM l GROUP BY ALL),
s AS (SELECT variable, level, cnt, cnt / SUM(cnt) OVER (PARTITION BY variable) AS share FROM c)
SELECT variable, level, cnt, {_r('share', 'share')},
       CASE WHEN share < {FLOOR} THEN '{COMBINED}' ELSE level END AS mapped_level FROM s""")(rare_levels_base)
