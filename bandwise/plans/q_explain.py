"""Catalog: linear-model explainability (M19, H1-H6) on lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from bandwise.operators.explain import (fit_ols, linear_shap, one_feature_ols, partial_dependence,
                                        waterfall)
from bandwise.operators.quantiles import exact_quantiles
from bandwise.operators.split import sample_n
from bandwise.plans.catalog import register
from bandwise.plans.common import rounded
from bandwise.plans.oracle_sql import _r
from bandwise.sources.tables import load_table

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
#: Rows of the background sample.
BACKGROUND = 100
FEATURES = ["l_quantity", "l_discount"]
TARGET = "l_extendedprice"
_KEY_SQL = ("CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) || ':' || "
            "CAST(l_partkey AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR)")
_BG_SQL = (f"SELECT * FROM lineitem ORDER BY md5('42:' || {_KEY_SQL}), l_orderkey, l_linenumber, "
           f"l_partkey, l_suppkey LIMIT {BACKGROUND}")
_COEF_SQL = """s AS (SELECT AVG(l_quantity) AS m1, AVG(l_discount) AS m2, AVG(l_extendedprice) AS my,
    covar_pop(l_quantity, l_quantity) AS s11, covar_pop(l_discount, l_discount) AS s22,
    covar_pop(l_quantity, l_discount) AS s12, covar_pop(l_quantity, l_extendedprice) AS s1y,
    covar_pop(l_discount, l_extendedprice) AS s2y FROM lineitem),
c AS (SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
             (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2, m1, m2, my FROM s),
coef AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM c)"""


def _round(df, cols, digits):
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def _li(spark, sf_dir):
    return load_table(spark, sf_dir, "lineitem", KEY + FEATURES + [TARGET, "l_tax"])


def ols_one_feature(spark, sf_dir):
    """Slope, intercept and r2 of price on quantity (one aggregation)."""
    return rounded(one_feature_ols(_li(spark, sf_dir), "l_quantity", TARGET))


register("ols_one_feature", f"""
SELECT {_r('regr_slope(l_extendedprice, l_quantity)', 'slope')},
       {_r('regr_intercept(l_extendedprice, l_quantity)', 'intercept')},
       {_r('regr_r2(l_extendedprice, l_quantity)', 'r2')},
       CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lineitem""")(ols_one_feature)


def _model(spark, sf_dir):
    li = _li(spark, sf_dir)
    return li, fit_ols(li, FEATURES, TARGET)


def ols_two_features(spark, sf_dir):
    """OLS coefficients of price on quantity and discount (normal equations)."""
    _, m = _model(spark, sf_dir)
    rows = [("intercept", float(m.intercept))] + [(f, float(c)) for f, c in zip(FEATURES, m.coefficients)]
    return _round(spark.createDataFrame(rows, "term string, coefficient double"), ["coefficient"], 3)


register("ols_two_features", f"""WITH {_COEF_SQL}
SELECT 'intercept' AS term, ROUND(b0, 3) AS coefficient FROM coef
UNION ALL SELECT 'l_quantity', ROUND(b1, 3) FROM coef
UNION ALL SELECT 'l_discount', ROUND(b2, 3) FROM coef""")(ols_two_features)


def _shap(spark, sf_dir):
    li, m = _model(spark, sf_dir)
    bg = sample_n(li, BACKGROUND, KEY, seed=42)
    return li, m, bg, linear_shap(li, KEY, FEATURES, [float(c) for c in m.coefficients], float(m.intercept), bg)


_PHI_SQL = f"""bg AS (SELECT AVG(l_quantity) AS q, AVG(l_discount) AS d FROM ({_BG_SQL})),
phi AS (SELECT l.*, b1 * (l_quantity - q) AS p1, b2 * (l_discount - d) AS p2,
               b0 + b1 * l_quantity + b2 * l_discount AS pred, b0 + b1 * q + b2 * d AS base
        FROM lineitem l, coef, bg)"""


def linear_shap_summary(spark, sf_dir):
    """H2/H3/H4: mean and mean-absolute Shapley value per feature over all lines,
    the largest additivity error, E[y] and E[x] - one aggregation over the rows."""
    _, _, _, shap = _shap(spark, sf_dir)
    aggs = [F.max(F.abs("additivity_error")).alias("err"), F.avg(TARGET).alias("mean_y")]
    for f in FEATURES:
        aggs += [F.avg(f"phi_{f}").alias(f"m_{f}"), F.avg(F.abs(f"phi_{f}")).alias(f"a_{f}"),
                 F.avg(f).alias(f"x_{f}")]
    one = shap.agg(*aggs)
    out = one.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"m_{f}").alias("mean_phi"), F.col(f"a_{f}").alias("mean_abs_phi"),
                 F.round(F.col("err"), 3).alias("max_additivity_error"), F.col("mean_y").alias("expected_y"),
                 F.col(f"x_{f}").alias("expected_x")) for f in FEATURES])).alias("s")).select("s.*")
    return _round(out, ["mean_phi", "mean_abs_phi", "max_additivity_error", "expected_y", "expected_x"], 3)


register("linear_shap_summary", f"""WITH {_COEF_SQL},
{_PHI_SQL},
m AS (SELECT AVG(l_extendedprice) AS my, AVG(l_quantity) AS mq, AVG(l_discount) AS md FROM lineitem)
SELECT 'l_quantity' AS feature, ROUND(AVG(p1), 3) AS mean_phi, ROUND(AVG(ABS(p1)), 3) AS mean_abs_phi,
       ROUND(MAX(ABS(p1 + p2 - (pred - base))), 3) AS max_additivity_error, ROUND(ANY_VALUE(m.my), 3) AS expected_y,
       ROUND(ANY_VALUE(m.mq), 3) AS expected_x FROM phi, m
UNION ALL
SELECT 'l_discount', ROUND(AVG(p2), 3), ROUND(AVG(ABS(p2)), 3), ROUND(MAX(ABS(p1 + p2 - (pred - base))), 3), ROUND(ANY_VALUE(m.my), 3),
       ROUND(ANY_VALUE(m.md), 3) FROM phi, m""")(linear_shap_summary)


def _tenths(expr: str) -> str:
    return f"(ROUND({expr}, 1) + 0.0)::DOUBLE"


def linear_shap_rows(spark, sf_dir):
    """H2/H6: per-line Shapley values, prediction, base value and additivity error."""
    _, _, _, shap = _shap(spark, sf_dir)
    return _round(shap.withColumn("additivity_error", F.abs("additivity_error")),
                  ["phi_l_quantity", "phi_l_discount", "prediction", "base", "additivity_error"], 1)


register("linear_shap_rows", f"""WITH {_COEF_SQL}, {_PHI_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_extendedprice, l_tax,
       {_tenths('p1')} AS phi_l_quantity, {_tenths('p2')} AS phi_l_discount, {_tenths('pred')} AS prediction,
       {_tenths('base')} AS base, {_tenths('ABS(p1 + p2 - (pred - base))')} AS additivity_error FROM phi""")(linear_shap_rows)


def partial_dependence_q(spark, sf_dir):
    """H1: mean prediction with quantity fixed at each decile over 100 background lines."""
    li, m = _model(spark, sf_dir)
    bg = sample_n(li, BACKGROUND, KEY, seed=42)
    q = exact_quantiles(li, ["l_quantity"], [i / 10 for i in range(11)])
    grid = sorted({r["value"] for r in q.collect()})
    pd_ = partial_dependence(m, bg.select(*FEATURES), FEATURES, "l_quantity", grid)
    return _round(pd_, ["grid_value", "mean_prediction"], 3)


register("partial_dependence", f"""WITH {_COEF_SQL},
bg AS (SELECT AVG(l_discount) AS d, COUNT(*) AS n FROM ({_BG_SQL})),
g AS (SELECT DISTINCT UNNEST(quantile_cont(l_quantity, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS v
      FROM lineitem)
SELECT ROUND(g.v, 3) AS grid_value, ROUND(coef.b0 + coef.b1 * g.v + coef.b2 * bg.d, 3) AS mean_prediction,
       CAST(bg.n AS BIGINT) AS rows
FROM g, coef, bg""")(partial_dependence_q)


def waterfall_q(spark, sf_dir):
    """Per-line contributions in order of |phi|, all but the first folded."""
    _, _, _, shap = _shap(spark, sf_dir)
    return _round(waterfall(shap, KEY, FEATURES, max_display=2), ["phi", "running_phi"], 1)


register("waterfall", f"""WITH {_COEF_SQL}, {_PHI_SQL},
o AS (SELECT *, ABS(p1) > ABS(p2) AS first1 FROM phi)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN first1 THEN 'l_quantity' ELSE 'l_discount' END AS feature,
       {_tenths('CASE WHEN first1 THEN p1 ELSE p2 END')} AS phi, 1::INTEGER AS rank,
       {_tenths('CASE WHEN first1 THEN p1 ELSE p2 END')} AS running_phi FROM o
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'other features', {_tenths('CASE WHEN first1 THEN p2 ELSE p1 END')},
       2::INTEGER, {_tenths('p1 + p2')} FROM o""")(waterfall_q)


FEATURES_3 = FEATURES + ["l_tax"]


def waterfall_three(spark, sf_dir):
    """Per-line contributions of three features in order of |phi|, the third folded."""
    li = _li(spark, sf_dir)
    m = fit_ols(li, FEATURES_3, TARGET)
    bg = sample_n(li, BACKGROUND, KEY, seed=42)
    shap = linear_shap(li, KEY, FEATURES_3, [float(c) for c in m.coefficients], float(m.intercept), bg)
    return _round(waterfall(shap, KEY, FEATURES_3, max_display=3), ["phi", "running_phi"], 1)


def _covariances(names: list[str]) -> str:
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    short = {c: str(i + 1) for i, c in enumerate(FEATURES_3)} | {TARGET: "y"}
    return ", ".join(f"covar_pop({a}, {b}) AS s{short[a]}{short[b]}" for a, b in pairs)


register("waterfall_three", f"""WITH s AS (SELECT {_covariances(FEATURES_3 + [TARGET])} FROM lineitem),
d AS (SELECT *, s11 * (s22 * s33 - s23 * s23) - s12 * (s12 * s33 - s23 * s13) + s13 * (s12 * s23 - s22 * s13) AS det FROM s),
coef AS (SELECT
  (s1y * (s22 * s33 - s23 * s23) - s12 * (s2y * s33 - s23 * s3y) + s13 * (s2y * s23 - s22 * s3y)) / det AS b1,
  (s11 * (s2y * s33 - s23 * s3y) - s1y * (s12 * s33 - s23 * s13) + s13 * (s12 * s3y - s2y * s13)) / det AS b2,
  (s11 * (s22 * s3y - s2y * s23) - s12 * (s12 * s3y - s2y * s13) + s1y * (s12 * s23 - s22 * s13)) / det AS b3 FROM d),
bg AS (SELECT AVG(l_quantity) AS q, AVG(l_discount) AS d, AVG(l_tax) AS t FROM ({_BG_SQL})),
phi AS (SELECT l.*, b1 * (l_quantity - q) AS p1, b2 * (l_discount - d) AS p2, b3 * (l_tax - t) AS p3
        FROM lineitem l, coef, bg),
o AS (SELECT *, list_sort([{{'o': -ABS(p1), 'f': 'l_quantity', 'p': p1}}, {{'o': -ABS(p2), 'f': 'l_discount', 'p': p2}},
                           {{'o': -ABS(p3), 'f': 'l_tax', 'p': p3}}]) AS e FROM phi)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, e[1].f AS feature, {_tenths('e[1].p')} AS phi, 1::INTEGER AS rank,
       {_tenths('e[1].p')} AS running_phi FROM o
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, e[2].f, {_tenths('e[2].p')}, 2::INTEGER, {_tenths('e[1].p + e[2].p')} FROM o
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'other features', {_tenths('e[3].p')}, 3::INTEGER,
       {_tenths('e[1].p + e[2].p + e[3].p')} FROM o""")(waterfall_three)
