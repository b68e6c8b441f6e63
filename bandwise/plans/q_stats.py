"""Catalog: statistics (T1-T13) and math functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from bandwise.functions.mathfn import (angle, binomial_pmf, dot, four_significant, is_finite, log_base,
                                       logit, norm, normal_pdf, power_law, sigmoid)
from bandwise.operators.prep import complement_probability
from bandwise.operators.stats import (centroids, chebyshev, cohens_d_welch, conditional_probability, correlations,
                                      covariance, impurity, information_gain, log_loss, softmax,
                                      spearman, zscore)
from bandwise.plans.catalog import register
from bandwise.plans.common import rounded
from bandwise.plans.oracle_sql import _r
from bandwise.sources.tables import load_table

PAIRS = [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax"), ("l_quantity", "l_discount")]


def pearson_q(spark, sf_dir):
    """Pearson correlation for three lineitem column pairs."""
    li = load_table(spark, sf_dir, "lineitem", sorted({c for p in PAIRS for c in p}))
    return rounded(correlations(li, PAIRS))


register("pearson", "\nUNION ALL\n".join(
    f"""SELECT '{a}' AS var1, '{b}' AS var2,
  {_r(f"covar_pop({a}, {b}) / (stddev_pop(CASE WHEN {b} IS NOT NULL THEN {a} END) * stddev_pop(CASE WHEN {a} IS NOT NULL THEN {b} END))", 'pearson')}
FROM lineitem""" for a, b in PAIRS))(pearson_q)


def spearman_q(spark, sf_dir):
    """Spearman correlation of l_quantity and l_extendedprice (average ties)."""
    li = load_table(spark, sf_dir, "lineitem", ["l_quantity", "l_extendedprice"])
    return rounded(spearman(li, "l_quantity", "l_extendedprice"))


register("spearman", f"""
WITH b AS (SELECT CAST(l_quantity AS DOUBLE) AS a, CAST(l_extendedprice AS DOUBLE) AS b FROM lineitem
           WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL),
r AS (SELECT RANK() OVER (ORDER BY a) + (COUNT(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra,
             RANK() OVER (ORDER BY b) + (COUNT(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb FROM b)
SELECT {_r('corr(ra, rb)', 'spearman')}, COUNT(*) AS n FROM r""")(spearman_q)


def covariance_q(spark, sf_dir):
    """Population / sample covariance and sum of products."""
    li = load_table(spark, sf_dir, "lineitem", ["l_quantity", "l_extendedprice"])
    return rounded(covariance(li, "l_quantity", "l_extendedprice"))


register("covariance", f"""
SELECT {_r('covar_pop(l_quantity, l_extendedprice)', 'covar_pop')},
       {_r('covar_samp(l_quantity, l_extendedprice)', 'covar_samp')},
       {_r('covar_pop(l_quantity, l_extendedprice) * count_if(l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL)', 'sum_of_products')}
FROM lineitem""")(covariance_q)


def zscore_q(spark, sf_dir):
    """T4: z-score of every order's total price (sample std)."""
    o = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"])
    return rounded(zscore(o, "o_totalprice").select("o_orderkey", "z"))


register("zscore", f"""
SELECT o_orderkey, {_r('(o_totalprice - AVG(o_totalprice) OVER ()) / STDDEV_SAMP(o_totalprice) OVER ()', 'z')}
FROM orders""")(zscore_q)

KS = [1.5, 2.0, 3.0]


def chebyshev_q(spark, sf_dir):
    """T5: share of lineitem prices within k sigma vs 1 - 1/k^2."""
    li = load_table(spark, sf_dir, "lineitem", ["l_extendedprice"])
    return rounded(chebyshev(li, "l_extendedprice", KS))


register("chebyshev", "\nUNION ALL\n".join(f"""
SELECT CAST({k} AS DOUBLE) AS k,
  {_r(f'AVG(CAST(ABS(l_extendedprice - s.mu) <= {k} * s.sd AS DOUBLE))', 'share_within')},
  {_r(f'1.0 - 1.0 / ({k} * {k})', 'chebyshev_bound')}
FROM lineitem, (SELECT AVG(l_extendedprice) AS mu, STDDEV_SAMP(l_extendedprice) AS sd FROM lineitem) s""" for k in KS))(chebyshev_q)


def cohens_d_welch_q(spark, sf_dir):
    """Returned vs other lines, extended price."""
    li = load_table(spark, sf_dir, "lineitem", ["l_extendedprice", "l_returnflag"])
    return rounded(cohens_d_welch(li, "l_extendedprice", F.col("l_returnflag") == "R"))


register("cohens_d_welch", f"""
WITH m AS (SELECT
  CAST(count_if(l_returnflag = 'R' AND l_extendedprice IS NOT NULL) AS BIGINT) AS n1,
  AVG(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS m1,
  VAR_SAMP(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS v1,
  CAST(count_if(NOT (l_returnflag = 'R') AND l_extendedprice IS NOT NULL) AS BIGINT) AS n2,
  AVG(CASE WHEN NOT (l_returnflag = 'R') THEN l_extendedprice END) AS m2,
  VAR_SAMP(CASE WHEN NOT (l_returnflag = 'R') THEN l_extendedprice END) AS v2 FROM lineitem)
SELECT n1, n2, {_r('ABS(m1 - m2) / SQRT(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2))', 'cohens_d')},
       {_r('(m1 - m2) / SQRT(v1 / n1 + v2 / n2)', 'welch_t')} FROM m""")(cohens_d_welch_q)


def cond_prob_q(spark, sf_dir):
    """P(returned | line status F), directly and by Bayes' rule."""
    li = load_table(spark, sf_dir, "lineitem", ["l_returnflag", "l_linestatus"])
    return rounded(conditional_probability(li, F.col("l_returnflag") == "R", F.col("l_linestatus") == "F"))


register("cond_prob", f"""
WITH a AS (SELECT COUNT(*) AS n, count_if(l_returnflag = 'R') AS na, count_if(l_linestatus = 'F') AS nb,
                  count_if(l_returnflag = 'R' AND l_linestatus = 'F') AS nab FROM lineitem)
SELECT {_r('nab / nb', 'p_a_given_b')}, {_r('(nab / na) * (na / n) / (nb / n)', 'p_a_given_b_bayes')},
       {_r('na / n', 'p_a')}, {_r('nb / n', 'p_b')} FROM a""")(cond_prob_q)


def log_loss_q(spark, sf_dir):
    """Log loss of the score 0.25 + 5 * discount against the return flag."""
    li = load_table(spark, sf_dir, "lineitem", ["l_discount", "l_returnflag"])
    y = (F.col("l_returnflag") == "R").cast("double")
    return rounded(log_loss(li, y, F.lit(0.25) + F.col("l_discount") * 5.0))


register("log_loss", f"""
WITH c AS (SELECT CAST(l_returnflag = 'R' AS DOUBLE) AS y,
                  LEAST(GREATEST(0.25 + l_discount * 5.0, 1e-15), 1.0 - 1e-15) AS p FROM lineitem),
l AS (SELECT -(y * LN(p) + (1.0 - y) * LN(1.0 - p)) AS cost FROM c)
SELECT {_r('AVG(cost)', 'mean_log_loss')}, {_r('SUM(cost)', 'total_log_loss')} FROM l""")(log_loss_q)


def impurities_q(spark, sf_dir):
    """Entropy, Gini index and classification error of the order status."""
    o = load_table(spark, sf_dir, "orders", ["o_orderstatus"])
    return rounded(impurity(o, "o_orderstatus"))


register("impurities", f"""
WITH c AS (SELECT o_orderstatus, COUNT(*) AS cnt FROM orders GROUP BY ALL),
p AS (SELECT cnt, cnt / SUM(cnt) OVER () AS p, SUM(cnt) OVER () AS n FROM c)
SELECT {_r('-SUM(CASE WHEN p > 0 THEN p * LOG2(p) ELSE 0 END)', 'entropy')},
       {_r('1.0 - SUM(p * p)', 'gini')}, {_r('1.0 - MAX(p)', 'class_error')}, CAST(ANY_VALUE(n) AS BIGINT) AS n
FROM p""")(impurities_q)


def info_gain_q(spark, sf_dir):
    """Information gain of splitting orders by priority, target order status."""
    o = load_table(spark, sf_dir, "orders", ["o_orderstatus", "o_orderpriority"])
    return rounded(information_gain(o, "o_orderstatus", "o_orderpriority"))


register("info_gain", f"""
WITH c AS (SELECT o_orderpriority AS s, o_orderstatus AS k, COUNT(*) AS cnt FROM orders GROUP BY ALL),
pc AS (SELECT k, SUM(cnt) AS cnt FROM c GROUP BY k),
pp AS (SELECT cnt / SUM(cnt) OVER () AS p FROM pc),
parent AS (SELECT -SUM(CASE WHEN p > 0 THEN p * LOG2(p) ELSE 0 END) AS pe, 1.0 - SUM(p * p) AS pg FROM pp),
ch AS (SELECT s, cnt / SUM(cnt) OVER (PARTITION BY s) AS p, SUM(cnt) OVER (PARTITION BY s) AS n FROM c),
imp AS (SELECT s, ANY_VALUE(n) AS n, -SUM(CASE WHEN p > 0 THEN p * LOG2(p) ELSE 0 END) AS e, 1.0 - SUM(p * p) AS g
        FROM ch GROUP BY s)
SELECT {_r('ANY_VALUE(pe) - SUM(n * e) / SUM(n)', 'info_gain_entropy')},
       {_r('ANY_VALUE(pg) - SUM(n * g) / SUM(n)', 'info_gain_gini')},
       {_r('ANY_VALUE(pe)', 'parent_entropy')}, {_r('ANY_VALUE(pg)', 'parent_gini')}
FROM imp, parent""")(info_gain_q)


def softmax_q(spark, sf_dir):
    """Softmax of event value within each event type."""
    ev = load_table(spark, sf_dir, "events", ["event_id", "event_type", "value"])
    return rounded(softmax(ev, "value", ["event_type"]).select("event_id", "event_type", "softmax"))


register("softmax", f"""
SELECT event_id, event_type,
  {_r('EXP(value - mx) / SUM(EXP(value - mx)) OVER (PARTITION BY event_type)', 'softmax')}
FROM (SELECT *, MAX(value) OVER (PARTITION BY event_type) AS mx FROM events)""")(softmax_q)


def distributions(spark, sf_dir):
    """Observed share of each line number vs binomial, normal and power-law values."""
    li = load_table(spark, sf_dir, "lineitem", ["l_linenumber"])
    stats = li.agg(F.max("l_linenumber").alias("n"), F.avg("l_linenumber").alias("mu"),
                   F.stddev_samp("l_linenumber").alias("sd"), F.count(F.lit(1)).alias("rows")).first()
    n, mu, sd, rows = stats
    dist = li.groupBy(F.col("l_linenumber").alias("x")).agg(F.count(F.lit(1)).alias("cnt"))
    return rounded(dist.select(
        "x", (F.col("cnt") / F.lit(rows)).alias("share"),
        binomial_pmf(F.lit(n), F.col("x"), F.lit(mu / n)).alias("binomial"),
        normal_pdf(F.col("x").cast("double"), F.lit(mu), F.lit(sd)).alias("normal"),
        power_law(F.col("x").cast("double"), 1.0, 2.0).alias("power")))


register("distributions", f"""
WITH s AS (SELECT MAX(l_linenumber) AS n, AVG(l_linenumber) AS mu, STDDEV_SAMP(l_linenumber) AS sd,
                  COUNT(*) AS rows FROM lineitem),
d AS (SELECT l_linenumber AS x, COUNT(*) AS cnt FROM lineitem GROUP BY ALL)
SELECT x, {_r('cnt / rows', 'share')},
  {_r('(factorial(n) / (factorial(x) * factorial(n - x))) * POW(mu / n, x) * POW(1.0 - mu / n, n - x)', 'binomial')},
  {_r('EXP(-((x - mu) * (x - mu)) / (2.0 * sd * sd)) / (sd * SQRT(2 * PI()))', 'normal')},
  {_r('1.0 * POW(x, -2.0)', 'power')}
FROM d, s""")(distributions)


def scalar_functions(spark, sf_dir):
    """Per-line log2, sigmoid, logit, finiteness, rint, sign, sqrt."""
    li = load_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                "l_quantity", "l_discount", "l_extendedprice", "l_tax"])
    z = (F.col("l_extendedprice") - F.lit(50000.0)) / F.lit(25000.0)
    p = F.lit(0.25) + F.col("l_discount") * 5.0
    return rounded(li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        log_base(2, F.col("l_quantity")).alias("log2_qty"),
        sigmoid(z).alias("sigmoid"), logit(p).alias("logit"),
        is_finite(F.try_divide(F.col("l_tax"), F.col("l_discount"))).alias("finite_ratio"),
        F.rint(F.col("l_extendedprice") / 1000.0).alias("rint_k"),
        F.signum(F.col("l_tax") - F.lit(0.04)).alias("sign"),
        F.sqrt(F.col("l_quantity")).alias("sqrt_qty")))


register("scalar_functions", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  {_r('CASE WHEN l_quantity > 0 THEN LOG2(l_quantity) END', 'log2_qty')},
  {_r('1.0 / (1.0 + EXP(-((l_extendedprice - 50000.0) / 25000.0)))', 'sigmoid')},
  {_r('CASE WHEN (0.25 + l_discount * 5.0) > 0 AND (0.25 + l_discount * 5.0) < 1 THEN LN((0.25 + l_discount * 5.0) / (1.0 - (0.25 + l_discount * 5.0))) END', 'logit')},
  CASE WHEN l_discount = 0 THEN FALSE ELSE COALESCE(isfinite(l_tax / l_discount), FALSE) END AS finite_ratio,
  {_r('ROUND_EVEN(l_extendedprice / 1000.0, 0)', 'rint_k')},
  {_r('SIGN(l_tax - 0.04)', 'sign')},
  {_r('SQRT(l_quantity)', 'sqrt_qty')}
FROM lineitem""")(scalar_functions)


def cosine_angle(spark, sf_dir):
    """Dot product, norms and angle between each embedding and its label centroid."""
    emb = load_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    cent = centroids(emb, "embedding", ["label"])
    # The centroid table has one row per label with one entry per dimension.
    j = emb.join(cent, "label")
    return rounded(j.select("vec_id", "label", dot("embedding", "centroid").alias("dot"),
                            norm("embedding").alias("norm"), angle("embedding", "centroid").alias("angle")))


register("cosine_angle", f"""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT label, i, AVG(v[i]) AS m FROM (SELECT label, v, generate_subscripts(v, 1) AS i FROM e) GROUP BY label, i),
c AS (SELECT label, list(m ORDER BY i) AS centroid FROM p GROUP BY label),
j AS (SELECT e.vec_id, e.label, list_dot_product(e.v, c.centroid) AS d,
             SQRT(list_dot_product(e.v, e.v)) AS na, SQRT(list_dot_product(c.centroid, c.centroid)) AS nc
      FROM e JOIN c USING (label))
SELECT vec_id, label, {_r('d', 'dot')}, {_r('na', 'norm')},
       {_r('ACOS(LEAST(1.0, GREATEST(-1.0, d / (na * nc))))', 'angle')} FROM j""")(cosine_angle)


def four_significant_digits(spark, sf_dir):
    """Prices and their thousandths at 4 significant digits, ties by the binary value."""
    p = load_table(spark, sf_dir, "part", ["p_partkey", "p_retailprice", "p_size"])
    return p.select("p_partkey", four_significant("p_retailprice").alias("price"),
                    four_significant(F.col("p_retailprice") / 1000).alias("thousands"),
                    four_significant(F.col("p_size") + 1000.5).alias("half"))


register("four_significant_digits", """
SELECT p_partkey, CAST(printf('%.3e', p_retailprice) AS DOUBLE) AS price, CAST(printf('%.3e', p_retailprice / 1000) AS DOUBLE) AS thousands,
       CAST(printf('%.3e', p_size + 1000.5::DOUBLE) AS DOUBLE) AS half FROM part""")(four_significant_digits)


def complement_probabilities(spark, sf_dir):
    """A stored probability of the event (quantity / 60) and of the other outcome."""
    li = load_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"])
    p = li.withColumn("p_event", F.col("l_quantity") / 60.0)
    return rounded(p.select("l_orderkey", "l_linenumber", "l_partkey", "p_event", complement_probability("p_event").alias("p_other")))


register("complement_probabilities", f"""
SELECT l_orderkey, l_linenumber, l_partkey, {_r('l_quantity / 60.0', 'p_event')}, {_r('1.0 - l_quantity / 60.0', 'p_other')}
FROM lineitem""")(complement_probabilities)
