"""Statistical aggregates.

Whole-table statistics are single aggregations (partial aggregation per task,
one merge). Per-row statistics (z-score, softmax) join a one-row or one-row-
per-group aggregate back instead of using an un-partitioned window, which
would pull every row into one task.
"""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.operators.profile import pearson
from bandwise.operators.quantiles import attach_ranks
from bandwise.session import stored


def centroids(df: DataFrame, vector_col: str, by: list[str], out: str = "centroid") -> DataFrame:
    """Mean vector per group (N8): (*by, out array<double>), one running vector per group and task.

    Rows with a null vector are left out; a null component or a vector of
    another length than its group's raises.
    """
    vectors = df.where(F.col(vector_col).isNotNull()).select(
        *by, array_to_vector(F.transform(vector_col, lambda x: x.cast("double"))).alias("__v"))
    return vectors.groupBy(*by).agg(vector_to_array(Summarizer.mean(F.col("__v"))).alias(out))


def correlations(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Pearson correlation of each column pair (T1): (var1, var2, pearson)."""
    row = df.agg(*[pearson(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    arr = F.array(*[F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"p{i}").alias("pearson"))
                    for i, (a, b) in enumerate(pairs)])
    return row.select(F.explode(arr).alias("s")).select("s.*")


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Spearman rank correlation (T2): Pearson of average-tie ranks.

    Rows are first collapsed to distinct (a, b) pairs with counts; then both
    columns' ranks are attached (``attach_ranks``), the pair moving along.
    """
    base = df.select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))
    base = base.where(~F.isnan("a") & ~F.isnan("b") & F.col("a").isNotNull() & F.col("b").isNotNull())
    pairs = stored(base.groupBy("a", "b").agg(F.count(F.lit(1)).alias("w")))
    j = attach_ranks(pairs, {"a": "ra", "b": "rb"}, "w")
    n = F.sum("w")
    mx, my = F.sum(F.col("w") * F.col("ra")) / n, F.sum(F.col("w") * F.col("rb")) / n
    sxy = F.sum(F.col("w") * F.col("ra") * F.col("rb")) / n - mx * my
    sxx = F.sum(F.col("w") * F.col("ra") * F.col("ra")) / n - mx * mx
    syy = F.sum(F.col("w") * F.col("rb") * F.col("rb")) / n - my * my
    return j.agg(F.try_divide(sxy, F.sqrt(sxx * syy)).alias("spearman"), n.alias("n"))


def covariance(df: DataFrame, a: str, b: str) -> DataFrame:
    """Population and sample covariance, and the plain sum of products."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    return df.agg(F.covar_pop(x, y).alias("covar_pop"), F.covar_samp(x, y).alias("covar_samp"),
                  (F.covar_pop(x, y) * F.count_if(both)).alias("sum_of_products"))


def zscore(df: DataFrame, col: str, ddof: int = 1, out: str = "z") -> DataFrame:
    """z = (x - mean) / std per row (T4); std with ``ddof`` (1 = sample).

    Mean and std come from one aggregation job (two numbers on the driver);
    the per-row expression is then a map-only projection with literals.
    """
    sd = F.stddev_samp(col) if ddof == 1 else F.stddev_pop(col)
    mu, sigma = df.agg(F.avg(col), sd).first()
    if mu is None or not sigma:
        return df.withColumn(out, F.lit(None).cast("double"))
    return df.withColumn(out, (F.col(col) - F.lit(mu)) / F.lit(sigma))


def chebyshev(df: DataFrame, col: str, ks: list[float]) -> DataFrame:
    """Share of rows within k standard deviations vs the bound 1 - 1/k^2 (T5)."""
    mu, sd = df.agg(F.avg(col), F.stddev_samp(col)).first()
    row = df.agg(*[F.avg((F.abs(F.col(col) - F.lit(mu)) <= F.lit(k * sd)).cast("double")).alias(f"s{i}")
                   for i, k in enumerate(ks)])
    arr = F.array(*[F.struct(F.lit(float(k)).alias("k"), F.col(f"s{i}").alias("share_within"),
                             F.lit(1.0 - 1.0 / (k * k)).alias("chebyshev_bound")) for i, k in enumerate(ks)])
    return row.select(F.explode(arr).alias("s")).select("s.*")


def group_moments(df: DataFrame, value: str, flag: Column) -> DataFrame:
    """n, mean, sample variance for rows with flag true / false (one aggregation)."""
    v = F.col(value).cast("double")
    return df.agg(
        F.count_if(flag & v.isNotNull()).alias("n1"), F.avg(F.when(flag, v)).alias("m1"),
        F.var_samp(F.when(flag, v)).alias("v1"),
        F.count_if(~flag & v.isNotNull()).alias("n2"), F.avg(F.when(~flag, v)).alias("m2"),
        F.var_samp(F.when(~flag, v)).alias("v2"))


def cohens_d_welch(df: DataFrame, value: str, flag: Column) -> DataFrame:
    """Cohen's d with pooled sd (T6) and Welch's t statistic (T7) for two groups."""
    m = group_moments(df, value, flag)
    pooled = F.sqrt(((F.col("n1") - 1) * F.col("v1") + (F.col("n2") - 1) * F.col("v2"))
                    / (F.col("n1") + F.col("n2") - 2))
    welch = (F.col("m1") - F.col("m2")) / F.sqrt(F.col("v1") / F.col("n1") + F.col("v2") / F.col("n2"))
    return m.select("n1", "n2", F.try_divide(F.abs(F.col("m1") - F.col("m2")), pooled).alias("cohens_d"),
                    welch.alias("welch_t"))


def conditional_probability(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """P(A|B) directly and by Bayes' rule P(B|A) P(A) / P(B)."""
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(a).alias("na"), F.count_if(b).alias("nb"),
                 F.count_if(a & b).alias("nab"))
    p_a, p_b = F.col("na") / F.col("n"), F.col("nb") / F.col("n")
    p_b_given_a = F.try_divide(F.col("nab").cast("double"), F.col("na"))
    return agg.select(F.try_divide(F.col("nab").cast("double"), F.col("nb")).alias("p_a_given_b"),
                      F.try_divide(p_b_given_a * p_a, p_b).alias("p_a_given_b_bayes"),
                      p_a.alias("p_a"), p_b.alias("p_b"))


def log_loss(df: DataFrame, y: Column, p: Column, eps: float = 1e-15) -> DataFrame:
    """Mean and total logistic cost -[y ln p + (1-y) ln(1-p)] (T9); p clipped to [eps, 1-eps]."""
    pc = F.least(F.greatest(p.cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    cost = -(y * F.log(pc) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - pc))
    return df.agg(F.avg(cost).alias("mean_log_loss"), F.sum(cost).alias("total_log_loss"))


def _impurities(shares: DataFrame, keys: list[str]) -> DataFrame:
    """Entropy (base 2), Gini index and classification error from class shares."""
    return shares.groupBy(*keys).agg(
        (-F.sum(F.when(F.col("p") > 0, F.col("p") * F.log2("p")).otherwise(0.0))).alias("entropy"),
        (F.lit(1.0) - F.sum(F.col("p") * F.col("p"))).alias("gini"),
        (F.lit(1.0) - F.max("p")).alias("class_error"),
        F.first("n_node").alias("n"))


def class_shares(df: DataFrame, label: str, keys: list[str]) -> DataFrame:
    """(keys..., class, cnt, n_node, p) with p = class share inside each node.

    One row per (node, class); node totals are an aggregation of these rows,
    joined back on the node (the whole table is one node: one number)."""
    keys = keys or []
    counts = df.groupBy(*keys, F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("cnt"))
    if keys:
        totals = counts.groupBy(*keys).agg(F.sum("cnt").alias("n_node")).toDF(*[f"__n_{k}" for k in keys], "n_node")
        same = [counts[k].eqNullSafe(totals[f"__n_{k}"]) for k in keys]
        counts = counts.join(totals, same).drop(*[f"__n_{k}" for k in keys])
    else:
        counts = counts.withColumn("n_node", F.lit(counts.agg(F.sum("cnt")).first()[0]).cast("long"))
    return counts.withColumn("p", F.col("cnt") / F.col("n_node"))


def impurity(df: DataFrame, label: str) -> DataFrame:
    """Impurities of the whole table (T11): entropy, gini, class_error, n."""
    return _impurities(class_shares(df, label, []).withColumn("__k", F.lit(1)), ["__k"]).drop("__k")


def information_gain(df: DataFrame, label: str, split: str) -> DataFrame:
    """IG = I(parent) - sum_j N_j/N I(child_j) for entropy and Gini.

    Per-child impurities come from one (split, class) aggregation; the parent
    impurities from one (class) aggregation. Both tables are bounded by the
    number of classes times split values."""
    parent = impurity(df, label).first()
    children = _impurities(class_shares(df, label, [split]), [split])
    return children.agg(
        (F.lit(parent["entropy"]) - F.sum(F.col("n") * F.col("entropy")) / F.sum("n")).alias("info_gain_entropy"),
        (F.lit(parent["gini"]) - F.sum(F.col("n") * F.col("gini")) / F.sum("n")).alias("info_gain_gini"),
        F.lit(parent["entropy"]).alias("parent_entropy"), F.lit(parent["gini"]).alias("parent_gini"))


def softmax(df: DataFrame, value: str, group: list[str], out: str = "softmax") -> DataFrame:
    """exp(x - max) / sum(exp(x - max)) within each group.

    Group max and exp-sum are aggregated (map-side partial aggregation, one row
    per group) and joined back: a hot group is combined per task, never
    gathered into one task as a window would do."""
    mx = df.groupBy(*group).agg(F.max(value).alias("__mx"))
    with_mx = df.join(mx, group)
    sums = with_mx.groupBy(*group).agg(F.sum(F.exp(F.col(value) - F.col("__mx"))).alias("__se"))
    return (with_mx.join(sums, group)
            .withColumn(out, F.exp(F.col(value) - F.col("__mx")) / F.col("__se"))
            .drop("__mx", "__se"))


def pooled_t_from_summary(m1: float, s1: float, m2: float, s2: float, n: int = 1000) -> tuple[float, float]:
    """Two-sample t statistic and two-sided p-value for equal sizes n.

    Used on the learning-curve table (a handful of rows); the p-value uses the
    normal approximation, accurate for the 2n-2 = 1998 degrees of freedom."""
    sp = math.sqrt((s1 * s1 + s2 * s2) / 2.0)
    if sp == 0:
        return (math.inf if m1 != m2 else 0.0), (0.0 if m1 != m2 else 1.0)
    t = (m1 - m2) / (sp * math.sqrt(2.0 / n))
    p = math.erfc(abs(t) / math.sqrt(2.0))
    return t, p
