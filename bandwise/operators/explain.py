"""Explainability for linear models.

Shapley values of a linear model against a background sample are exact and
closed form: phi_j = coef_j * (x_j - mean_bg(x_j)). Partial dependence fixes
one feature at each grid value for every background row (the grid is a short
literal array exploded per row - no join).
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fit_ols(df: DataFrame, features: list[str], label: str) -> LinearRegressionModel:
    """Ordinary least squares with the normal-equation solver."""
    data = VectorAssembler(inputCols=features, outputCol="__x").transform(df.select(*features, label))
    return LinearRegression(featuresCol="__x", labelCol=label, solver="normal", regParam=0.0,
                            elasticNetParam=0.0, standardization=False).fit(data)


def one_feature_ols(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope and intercept of y on one feature from one aggregation."""
    return df.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                  F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                  F.regr_r2(F.col(y), F.col(x)).alias("r2"), F.regr_count(F.col(y), F.col(x)).alias("n"))


def linear_shap(df: DataFrame, key_cols: list[str], features: list[str], coefs: list[float],
                intercept: float, background: DataFrame) -> DataFrame:
    """Per-row Shapley values of a linear model (H2) with the additivity check (H3).

    Background means are one aggregation (one number per feature); the rest is
    a map-only projection. Output: keys, phi_<feature>..., prediction, base,
    additivity_error = sum(phi) - (prediction - base).
    """
    means = background.agg(*[F.avg(c).alias(c) for c in features]).first()
    base = intercept + sum(c * means[f] for f, c in zip(features, coefs))
    phis = [(F.lit(c) * (F.col(f) - F.lit(means[f]))).alias(f"phi_{f}") for f, c in zip(features, coefs)]
    pred = F.lit(intercept)
    for f, c in zip(features, coefs):
        pred = pred + F.lit(c) * F.col(f)
    extra = [c for c in df.columns if c not in key_cols and c not in features]
    out = df.select(*key_cols, *features, *extra, *phis, pred.alias("prediction"), F.lit(base).alias("base"))
    total = sum((F.col(f"phi_{f}") for f in features[1:]), F.col(f"phi_{features[0]}"))
    return out.withColumn("additivity_error", total - (F.col("prediction") - F.col("base")))


def waterfall(shap: DataFrame, key_cols: list[str], features: list[str], max_display: int = 14) -> DataFrame:
    """Contributions per row of ``shap`` in order of |phi| (O4/H5): keys, feature, phi, rank, running_phi.

    Beyond ``max_display - 1`` they are folded into one 'other features' entry.
    Each row sorts and folds its own short array, so no key has to be unique
    and nothing is shuffled. Ties go by feature name.
    """
    keep = max_display - 1
    entry = F.array(*[F.struct((-F.abs(f"phi_{f}")).alias("order"), F.lit(f).alias("feature"),
                               F.col(f"phi_{f}").alias("phi")) for f in features])
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, e: acc + e["phi"])
    shown = F.transform(F.slice("__all", 1, keep), lambda e: F.struct(e["feature"].alias("feature"), e["phi"].alias("phi")))
    rest = F.slice("__all", keep + 1, max(1, len(features)))
    folded = F.array(F.struct(F.lit("other features").alias("feature"), total(rest).alias("phi")))
    out = shap.select(*key_cols, F.array_sort(entry).alias("__all"))
    out = out.withColumn("__shown", F.when(F.size("__all") > keep, F.concat(shown, folded)).otherwise(shown))
    return (out.select(*key_cols, "__shown", F.posexplode("__shown").alias("__at", "e"))
            .select(*key_cols, "e.feature", "e.phi", (F.col("__at") + 1).alias("rank"),
                    total(F.slice("__shown", F.lit(1), F.col("__at") + 1)).alias("running_phi")))


def partial_dependence(model: LinearRegressionModel, background: DataFrame, features: list[str],
                       feature: str, grid: list[float]) -> DataFrame:
    """Mean prediction with ``feature`` fixed at each grid value over the background rows (H1)."""
    arr = F.array(*[F.lit(float(g)) for g in grid])
    expanded = background.select(*[c for c in features if c != feature], F.explode(arr).alias(feature))
    data = VectorAssembler(inputCols=features, outputCol="__x").transform(expanded)
    pred = model.transform(data)
    return pred.groupBy(F.col(feature).alias("grid_value")).agg(
        F.avg("prediction").alias("mean_prediction"), F.count(F.lit(1)).alias("rows"))
