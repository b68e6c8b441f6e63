"""Spark ML estimators, tuning and scoring.

Model names map to Spark ML pipelines. Hyper-parameter grids keep their
original names and are translated to Spark ML parameters:

* ``learning_rate`` -> ``stepSize``; ``n_estimators`` -> ``maxIter`` (boosting)
  or ``numTrees`` (forest); ``max_depth`` -> ``maxDepth`` (at most 30 in Spark);
  ``min_weight_fraction_leaf`` -> ``minWeightFractionPerNode``;
  ``max_features`` -> ``featureSubsetStrategy`` (``None`` -> ``all``).
* ``C`` (inverse regularisation of a summed loss) -> ``regParam = 1 / (C * n)``
  (Spark regularises a mean loss).

The linear SVM gets probabilities from a Platt step: a logistic regression
fitted on out-of-fold SVM margins. A forest is fitted as a regression forest on
the 0/1 label: the decrease of variance is half the Gini decrease, leaves hold
event shares and the prediction is their mean. (Spark's classification trees
merge leaves that predict the same class, which loses the shares: with an event
rate of a third and no strong feature every tree becomes its root.)
"""

from __future__ import annotations

import itertools
import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.operators.ensembles import BoostedTrees

MODEL_NAMES = ("gbm", "random_forest", "svm", "naive_bayes", "logistic_regression")
MAX_DEPTH = 30

# Default search spaces per model.
GBM_PARAMS = {"learning_rate": [0.001, 0.01, 0.1, 1], "n_estimators": [10, 100, 500],
              "min_weight_fraction_leaf": [0.06, 0.1], "max_depth": [3, 10, 20, 40, 80]}
FOREST_PARAMS = {"n_estimators": [10, 100, 200, 500], "min_weight_fraction_leaf": [0.06, 0.1],
                 "max_depth": [3, 10, 20, 40, 80], "max_features": ["auto", "sqrt", "log2", None]}
LOGISTIC_C = [0.001, 0.01, 0.1, 1, 10]
SVM_KERNELS = ["rbf", "sigmoid", "linear", "poly"]
SVM_C = [0.001, 0.01, 0.1, 1.0, 10.0, 100]
SVM_GAMMA = [0.001, 0.01, 0.1, 1.0, 10.0, 100]


def check_model_names(models: list[str]) -> None:
    """Unknown model names raise before any job (M2)."""
    bad = [m for m in models if m not in MODEL_NAMES]
    if bad:
        raise ValueError(f"unknown model(s) {bad}; choose from {MODEL_NAMES}")


def _depth(d) -> int:
    return int(min(MAX_DEPTH, d))


class CalibratedSVM:
    """Linear SVM whose Platt step sees out-of-fold margins only (M5).

    Rows are dealt to ``folds`` parts by the hash of their features; each part
    gets margins from an SVM fitted on the others, the logistic step is fitted
    on all of these, and the SVM that is kept on all rows.
    """

    def __init__(self, scaler: StandardScaler | None, label: str, reg: float, features: str, folds: int = 3):
        self.scaler, self.label, self.features, self.folds = scaler, label, features, folds
        self.svc = LinearSVC(featuresCol="__scaled" if scaler else features, labelCol=label, regParam=reg, standardization=scaler is not None,
                             rawPredictionCol="__svm_raw", predictionCol="__svm_pred")
        self.margin = VectorSlicer(inputCol="__svm_raw", outputCol="__margin_vec", indices=[1])
        self.platt = LogisticRegression(featuresCol="__margin_vec", labelCol=label, regParam=0.0)

    def fit(self, df: DataFrame) -> PipelineModel:
        first = [self.scaler.fit(df)] if self.scaler else []
        fold = F.pmod(F.xxhash64(vector_to_array(self.features)), F.lit(self.folds))
        scaled = (first[0].transform(df) if first else df).withColumn("__part", fold)
        margins = None
        for f in range(self.folds):
            model = self.svc.fit(scaled.where(F.col("__part") != f))
            part = self.margin.transform(model.transform(scaled.where(F.col("__part") == f))).select("__margin_vec", self.label)
            margins = part if margins is None else margins.union(part)
        return PipelineModel(stages=[*first, self.svc.fit(scaled), self.margin, self.platt.fit(margins)])


def build_pipeline(name: str, params: dict, n_rows: int, features: str = "features",
                   label: str = "label", seed: int = 1) -> Pipeline | CalibratedSVM:
    """Pipeline for one model name and one parameter point (M3-M7)."""
    if name == "gbm":
        est = GBTClassifier(featuresCol=features, labelCol=label, seed=seed,
                            stepSize=float(params.get("learning_rate", 0.1)),
                            maxIter=int(params.get("n_estimators", 20)),
                            maxDepth=_depth(params.get("max_depth", 3)),
                            minWeightFractionPerNode=float(params.get("min_weight_fraction_leaf", 0.0)))
        return Pipeline(stages=[est])
    if name == "random_forest":
        mf = params.get("max_features", "auto")
        est = RandomForestRegressor(featuresCol=features, labelCol=label, seed=seed, predictionCol="__event",
                                    numTrees=int(params.get("n_estimators", 20)),
                                    maxDepth=_depth(params.get("max_depth", 5)),
                                    minWeightFractionPerNode=float(params.get("min_weight_fraction_leaf", 0.0)),
                                    featureSubsetStrategy={None: "all", "auto": "sqrt"}.get(mf, mf))
        both = SQLTransformer(statement="SELECT *, 1.0D - __event AS __other, CAST(__event > 0.5 AS DOUBLE) AS prediction FROM __THIS__")
        return Pipeline(stages=[est, both, VectorAssembler(inputCols=["__other", "__event"], outputCol="probability")])
    if name == "naive_bayes":
        return Pipeline(stages=[NaiveBayes(featuresCol=features, labelCol=label, modelType="gaussian")])
    scaler = StandardScaler(inputCol=features, outputCol="__scaled", withMean=True, withStd=True)
    reg = 1.0 / (float(params.get("C", 1.0)) * max(n_rows, 1))
    if name == "logistic_regression":
        lr = LogisticRegression(featuresCol="__scaled", labelCol=label, regParam=reg, elasticNetParam=0.0)
        return Pipeline(stages=[scaler, lr])
    if name == "svm":
        return CalibratedSVM(scaler, label, reg, features)
    if name == "svm_margin":  # without the step to probabilities: ``probability`` holds the margins
        return Pipeline(stages=[scaler, LinearSVC(featuresCol="__scaled", labelCol=label, regParam=reg, rawPredictionCol="probability")])
    raise ValueError(f"unknown model {name}")


def grid_points(space: dict, n_iter: int | None = None, seed: int = 12345) -> list[dict]:
    """The points of a grid (M12) or ``n_iter`` seeded draws without repeats."""
    keys = sorted(space)
    points = [dict(zip(keys, vals)) for vals in itertools.product(*[space[k] for k in keys])]
    if n_iter is not None and n_iter < len(points):
        points = random.Random(seed).sample(points, n_iter)
    return points


def probability_of_event(pred: DataFrame, out: str = "p_event") -> DataFrame:
    """Probability of class 1 as a double column."""
    return pred.withColumn(out, vector_to_array(F.col("probability"))[1])


def auc(pred: DataFrame, label: str = "label") -> float:
    return BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol=label,
                                         metricName="areaUnderROC").evaluate(pred)


def log_loss_metric(pred: DataFrame, label: str = "label") -> float:
    return MulticlassClassificationEvaluator(probabilityCol="probability", labelCol=label,
                                             metricName="logLoss").evaluate(pred)


def accuracies(pred: DataFrame, parts: list[Column], label: str = "label") -> list[float]:
    """Share of rows whose class is predicted within each part, from counts of one pass."""
    right = F.col("prediction") == F.col(label)
    row = pred.agg(*[F.count_if(c) for p in parts for c in (p, p & right)]).first()
    return [r / n if n else float("nan") for n, r in zip(row[::2], row[1::2], strict=True)]


def score(pred: DataFrame, scoring: str = "roc_auc", label: str = "label") -> float:
    """Higher is better for both scorings."""
    if scoring == "roc_auc":
        return auc(pred, label)
    if scoring == "neg_log_loss":
        return -log_loss_metric(pred, label)
    raise ValueError("scoring must be roc_auc or neg_log_loss")


def best_params(results: list[tuple[dict, float]]) -> dict:
    """Arg-max over search results (O5); ties keep the first point."""
    best = max(range(len(results)), key=lambda i: (results[i][1], -i))
    return results[best][0]


def feature_importance(model, names: list[str]) -> list[tuple[str, float]]:
    """(Variable, Gini_importance) sorted descending (M20); tree models only."""
    if isinstance(model, BoostedTrees):
        imp = model.importances
    else:
        trees = next(s for s in model.stages if hasattr(s, "featureImportances"))
        imp = trees.featureImportances.toArray().tolist()
    return sorted(zip(names, imp), key=lambda t: -t[1])
