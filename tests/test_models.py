"""Model operators: metric ranges, band-table invariants, save / load / apply."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bandwise.operators.models import FOREST_PARAMS, GBM_PARAMS, LOGISTIC_C, SVM_C, SVM_GAMMA, SVM_KERNELS, check_model_names, grid_points
from bandwise.plans.model_selection import TRAIN_SIZES, ModelSelection, model_apply
from bandwise.plans.q_models import model_base
from bandwise.session import checkpoint_dir
from tests.conftest import SF_SMALL


def test_model_names_and_grid():
    with pytest.raises(ValueError):
        check_model_names(["gbm", "xgb"])
    pts = grid_points({"a": [1, 2, 3], "b": [4, 5]}, n_iter=4, seed=1)
    assert len(pts) == 4 and len({tuple(sorted(p.items())) for p in pts}) == 4


def test_selection_apply_and_evaluate(spark):
    base = model_base(spark, SF_SMALL)
    ms = ModelSelection(base, "target", ["o_orderkey"], categorical_columns=["c_nationkey"],
                        models=["logistic_regression", "naive_bayes"], cv=2)
    ms.fit_models(logistic_c=[1.0])
    metrics = ms.apply_models().collect()
    assert len(metrics) == 4
    assert all(0 <= r["accuracy"] <= 100 and 0 <= r["f1"] <= 100 for r in metrics)
    tables, summary = ms.evaluate_models()
    for r in tables.where("NOT is_total").groupBy("model", "split").agg(F.sum("`Population_%`").alias("p")).collect():
        assert r["p"] == pytest.approx(1.0)
    assert all(0 <= r["KS"] <= 100 for r in summary.collect())
    ms.select_retrain_model("logistic_regression")
    path = f"{checkpoint_dir(spark)}/test_models_artefacts"
    ms.save_model_objects(path)
    scored = model_apply(base.drop("target"), path, "logistic_regression", ["o_orderkey"], predict_proba=True)
    vals = [r["p_event"] for r in scored.collect()]
    assert len(vals) == base.count() and all(0.0 <= v <= 1.0 for v in vals)


def test_whole_base_transform_and_run(spark):
    from bandwise.plans.model_selection import train_test_transform
    base = model_base(spark, SF_SMALL)
    tr, te, enc = train_test_transform(base, "target", ["o_orderkey"], small_sample_floor=0.05)
    assert tr.count() + te.count() == base.count()
    assert tr.select("o_orderkey").intersect(te.select("o_orderkey")).count() == 0
    ms = ModelSelection(base, "target", ["o_orderkey"], models=["naive_bayes"], cv=2)
    metrics, tables, summary = ms.run()
    assert metrics.count() == 2 and summary.count() == 2


@pytest.mark.parametrize("scoring", ["roc_auc", "neg_log_loss"])
def test_all_families_end_and_apply(spark, scoring):
    base = model_base(spark, SF_SMALL)
    families = ["gbm", "random_forest", "svm", "logistic_regression"]
    ms = ModelSelection(base, "target", ["o_orderkey"], categorical_columns=["c_nationkey"], models=families, cv=2, scoring=scoring,
                        fit_rows=300, parallelism=8)
    ms.fit_models(gbm_params={"n_estimators": [3, 10], "max_depth": [3, 80]}, random_forest_params={"n_estimators": [3, 10]},
                  logistic_c=[0.1, 1.0], svm_c=[1.0], svm_kernels=["rbf", "poly"], svm_gamma=[0.1, 1.0])
    assert {m: len(s) for m, s in ms.search.items()} == {"gbm": 4, "random_forest": 2, "svm": 4, "logistic_regression": 2}
    assert all((0 <= s <= 1) if scoring == "roc_auc" else s < 0 for found in ms.search.values() for _, s in found)
    assert ms.apply_models().count() == 8 and ms.evaluate_models()[1].count() == 8
    assert len(ms.importance("gbm")) == len(ms.importance("random_forest")) == len(ms.feature_names)
    ms.select_retrain_model(["gbm", "random_forest", "svm"])
    path = f"{checkpoint_dir(spark)}/test_models_trees"
    ms.save_model_objects(path)
    for name in ("gbm", "random_forest", "svm"):
        scored = model_apply(base.drop("target"), path, name, ["o_orderkey"], predict_proba=True)
        assert scored.filter("p_event BETWEEN 0 AND 1").count() == base.count()
    ms.release()


@pytest.mark.parametrize("query, families", [
    ("fit_models", {"logistic_regression", "naive_bayes", "random_forest"}), ("fit_gbm", {"gbm"}), ("fit_svm", {"svm"}),
    ("evaluate_models", {"logistic_regression", "random_forest"}), ("learning_curve", {"logistic_regression"}),
    ("feature_importance", {"random_forest"}), ("model_apply", {"logistic_regression"}),
    ("holdout_evaluation", {"logistic_regression"})])
def test_queries_search_the_declared_spaces(spark, monkeypatch, query, families):
    class Reached(Exception):
        pass

    def reached(ms):
        assert ms.spaces == {"gbm": GBM_PARAMS, "random_forest": FOREST_PARAMS, "logistic_regression": {"C": LOGISTIC_C},
                             "svm": {"kernel": SVM_KERNELS, "C": SVM_C, "gamma": SVM_GAMMA}, "naive_bayes": {}}
        assert ms.n_iter == 100 and ms.cv == 5 and ms.train_sizes == list(TRAIN_SIZES)
        assert set(ms.models) == families
        raise Reached

    monkeypatch.setattr(ModelSelection, "fit_learning_curve", reached)
    with pytest.raises(Reached):
        entry.queries()[query](spark, SF_SMALL)
