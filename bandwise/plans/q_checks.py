"""Catalog: steps of model selection on given columns, each with its closed form in SQL."""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from bandwise.operators.evaluate import classification_metrics
from bandwise.operators.models import LOGISTIC_C, auc, build_pipeline, log_loss_metric, probability_of_event
from bandwise.operators.newton import logistic_fits, with_margins
from bandwise.operators.split import kfold_column
from bandwise.plans.catalog import register
from bandwise.plans.common import rounded
from bandwise.plans.model_selection import adequate_size, learning_curve_table
from bandwise.plans.oracle_sql import _r
from bandwise.sources.tables import load_table

_GUESS = "CASE WHEN o_orderpriority < '3' THEN 'F' WHEN o_orderpriority < '4' THEN 'O' ELSE 'P' END"


def classification_scores(spark, sf_dir):
    """V7: accuracy and F1 (binary, macro, micro) of the order status guessed from the priority."""
    guess = load_table(spark, sf_dir, "orders", ["o_orderstatus", "o_orderpriority"]).select(
        "o_orderstatus", F.expr(_GUESS).alias("guess"))
    out = None
    for average in ("binary", "macro", "micro"):
        one = classification_metrics(guess, "o_orderstatus", "guess", average, pos_label="F").select(
            F.lit(average).alias("average"), "accuracy", "f1")
        out = one if out is None else out.unionByName(one)
    return rounded(out)


register("classification_scores", f"""
WITH g AS (SELECT o_orderstatus AS y, {_GUESS} AS p FROM orders),
c AS (SELECT DISTINCT y AS c FROM g UNION SELECT DISTINCT p FROM g),
k AS (SELECT c, (SELECT COUNT(*) FROM g WHERE y = c AND p = c) AS tp, (SELECT COUNT(*) FROM g WHERE y <> c AND p = c) AS fp,
             (SELECT COUNT(*) FROM g WHERE y = c AND p <> c) AS fn FROM c),
f AS (SELECT *, CASE WHEN tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2.0 * tp + fp + fn) END::DOUBLE AS f1 FROM k),
a AS (SELECT 100.0 * AVG((y = p)::INTEGER) AS accuracy FROM g)
SELECT 'binary' AS average, {_r('accuracy', 'accuracy')}, {_r("(SELECT 100.0 * f1 FROM f WHERE c = 'F')", 'f1')} FROM a
UNION ALL SELECT 'macro', {_r('accuracy', 'accuracy')}, {_r('(SELECT 100.0 * AVG(f1) FROM f)', 'f1')} FROM a
UNION ALL SELECT 'micro', {_r('accuracy', 'accuracy')},
  {_r('(SELECT 100.0 * 2.0 * SUM(tp) / (2.0 * SUM(tp) + SUM(fp) + SUM(fn)) FROM f)', 'f1')} FROM a""")(classification_scores)


def standard_scaled(spark, sf_dir):
    """Total price with mean 0 and (sample) standard deviation 1."""
    o = VectorAssembler(inputCols=["o_totalprice"], outputCol="x").transform(
        load_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"]))
    out = StandardScaler(inputCol="x", outputCol="z", withMean=True, withStd=True).fit(o).transform(o)
    return rounded(out.select("o_orderkey", vector_to_array("z")[0].alias("z")))


register("standard_scaled", f"""
SELECT o_orderkey, {_r('(o_totalprice - AVG(o_totalprice) OVER ()) / STDDEV_SAMP(o_totalprice) OVER ()', 'z')} FROM orders""")(
    standard_scaled)


def _status_rows(spark, sf_dir):
    o = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"])
    return VectorAssembler(inputCols=["o_custkey", "o_totalprice"], outputCol="features").transform(
        o.select("o_orderkey", "o_custkey", "o_totalprice", (F.col("o_orderstatus") == "F").cast("double").alias("label")))


def naive_bayes_posterior(spark, sf_dir):
    """M6: probability of the event under Gaussian naive Bayes, per order."""
    rows = _status_rows(spark, sf_dir)
    model = build_pipeline("naive_bayes", {}, 0).fit(rows)
    return rounded(probability_of_event(model.transform(rows)).select("o_orderkey", "p_event"))


register("naive_bayes_posterior", f"""
WITH o AS (SELECT o_orderkey, o_custkey::DOUBLE AS a, o_totalprice AS b, (o_orderstatus = 'F')::INTEGER AS y FROM orders),
e AS (SELECT 1e-9 * GREATEST(VAR_POP(a), VAR_POP(b)) AS eps, COUNT(*) AS n FROM o),
m AS (SELECT y, COUNT(*) AS c, AVG(a) AS ma, AVG(b) AS mb, VAR_POP(a) AS va, VAR_POP(b) AS vb FROM o GROUP BY y),
l AS (SELECT o_orderkey, m.y, LN(c / n) - 0.5 * (LN(2 * PI() * (va + eps)) + (a - ma) * (a - ma) / (va + eps))
             - 0.5 * (LN(2 * PI() * (vb + eps)) + (b - mb) * (b - mb) / (vb + eps)) AS ll FROM o, m, e)
SELECT o_orderkey, {_r('1 / (1 + EXP(SUM(CASE WHEN y = 0 THEN ll ELSE -ll END)))', 'p_event')}
FROM l GROUP BY o_orderkey""")(naive_bayes_posterior)


def scoring_functions(spark, sf_dir):
    """Area under the ROC curve and log loss of a stored probability (quantity / 60)."""
    li = load_table(spark, sf_dir, "lineitem", ["l_quantity", "l_returnflag"])
    p = F.col("l_quantity") / 60.0
    pred = li.select((F.col("l_returnflag") == "R").cast("double").alias("label"),
                     array_to_vector(F.array(1.0 - p, p)).alias("probability"), (p > 0.5).cast("double").alias("prediction"))
    return rounded(spark.createDataFrame([(auc(pred), log_loss_metric(pred))], "roc_auc double, log_loss double"))


register("scoring_functions", f"""
WITH s AS (SELECT l_quantity / 60.0 AS p, (l_returnflag = 'R')::INTEGER AS y FROM lineitem),
r AS (SELECT p, SUM(y) AS pos, COUNT(*) - SUM(y) AS neg FROM s GROUP BY p),
u AS (SELECT pos, neg, SUM(neg) OVER (ORDER BY p) - neg AS below FROM r)
SELECT {_r('(SELECT SUM(pos * (below + neg / 2.0)) / (SUM(pos) * SUM(neg)) FROM u)', 'roc_auc')},
       {_r('-AVG(CASE WHEN y = 1 THEN LN(p) ELSE LN(1 - p) END)', 'log_loss')} FROM s""")(scoring_functions)


def curve_choice(spark, sf_dir):
    """Mean and deviation over folds per size, and the smallest adequate size.

    Sizes are line numbers, folds come from the order key; the two scores are
    mean tax and mean discount, so that neighbouring sizes differ or not.
    """
    li = load_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_tax", "l_discount"])
    folds = li.groupBy(F.lit("m").alias("model"), F.col("l_linenumber").alias("size"),
                       (F.col("l_orderkey") % 5).alias("fold")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg("l_tax").alias("train_accuracy"), F.avg("l_discount").alias("test_accuracy"))
    table = learning_curve_table(folds)
    curve = [tuple(r)[1:] for r in table.drop("model", "training_sample_size").orderBy("size").collect()]
    chosen = adequate_size([(i + 1, *c) for i, c in enumerate(curve)])
    return rounded(table.withColumn("chosen", F.col("size") == F.lit(chosen)).drop("model"))


register("curve_choice", f"""
WITH f AS (SELECT l_linenumber AS size, COUNT(*) AS rows, AVG(l_tax) AS a, AVG(l_discount) AS b
           FROM lineitem GROUP BY l_linenumber, l_orderkey % 5),
t AS (SELECT size, ROUND(AVG(rows))::BIGINT AS n, AVG(a) AS ma, AVG(b) AS mb, STDDEV_POP(a) AS sa, STDDEV_POP(b) AS sb
      FROM f GROUP BY size),
d AS (SELECT *, ROW_NUMBER() OVER w AS place, ABS(mb - LAG(mb) OVER w)
             > 1.959963984540054 * SQRT((sb * sb + LAG(sb) OVER w * LAG(sb) OVER w) / 2.0) * SQRT(2.0 / 1000) AS differs
      FROM t WINDOW w AS (ORDER BY size)),
c AS (SELECT COALESCE(MAX(place) FILTER (WHERE differs), 1) AS place FROM d)
SELECT size, n AS training_sample_size, {_r('ma', 'mean_train_accuracy')}, {_r('mb', 'mean_test_accuracy')},
       {_r('sa', 'std_train_accuracy')}, {_r('sb', 'std_test_accuracy')}, d.place = c.place AS chosen FROM d, c""")(curve_choice)


def logistic_cost_grid(spark, sf_dir):
    """Logistic regressions of all declared costs and 5 folds in the same passes; held-out log loss."""
    o = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice", "o_orderstatus"])
    rows = o.select(array_to_vector(F.array("o_totalprice")).alias("features"),
                    (F.col("o_orderstatus") == "F").cast("double").alias("label"),
                    kfold_column(["o_orderkey"], 5, 777).alias("__fold")).persist()
    fits = logistic_fits(rows, LOGISTIC_C, 5)
    own = F.expr("CASE WHEN label = 1 THEN -m ELSE m END")
    held = (with_margins(rows, fits).select("label", F.col("__fold").alias("fold"), F.posexplode("margins").alias("i", "m"))
            .groupBy("i", "fold").agg((-F.avg(F.greatest(own, F.lit(0.0)) + F.log1p(F.exp(-F.abs("m"))))).alias("neg_log_loss")).collect())
    loss = {(LOGISTIC_C[r["i"]], r["fold"]): r["neg_log_loss"] for r in held}  # a row per fit
    rows.unpersist()
    return rounded(spark.createDataFrame(
        [(m.cost, m.fold, float(m.theta[0]), float(m.theta[1]), loss[m.cost, m.fold]) for m in fits],
        "cost double, fold int, slope double, intercept double, neg_log_loss double"))


def _newton_sql(steps: int = 10) -> str:
    """The same systems, two unknowns each, solved by Cramer's rule step by step."""
    at = "SELECT cost, f, n, mean, sd, reg, b, a, (x - mean) / sd AS z, y, 1 / (1 + exp(-(b * (x - mean) / sd + a))) AS p"
    out = []
    for k in range(steps):
        out.append(f"""
s{k} AS (SELECT cost, f, n, mean, sd, reg, b, a, SUM(p * (1 - p) * z * z) / n + reg AS h11, SUM(p * (1 - p) * z) / n AS h12,
         SUM(p * (1 - p)) / n AS h22, SUM((p - y) * z) / n + reg * b AS g1, SUM(p - y) / n AS g2
         FROM ({at} FROM i{k} JOIN o ON o.fold <> f) GROUP BY cost, f, n, mean, sd, reg, b, a),
i{k + 1} AS (SELECT cost, f, n, mean, sd, reg, b - (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12) AS b,
         a - (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12) AS a FROM s{k})""")
    return f"""
WITH o AS (SELECT o_totalprice AS x, (o_orderstatus = 'F')::INTEGER::DOUBLE AS y,
           CAST((('0x' || substr(md5('777:' || CAST(o_orderkey AS VARCHAR)), 1, 8))::UBIGINT) % 5 AS INTEGER) AS fold FROM orders),
m AS (SELECT f, COUNT(*) AS n, AVG(x) AS mean, STDDEV_SAMP(x) AS sd FROM o JOIN (SELECT unnest(range(5)) AS f) ON fold <> f GROUP BY f),
i0 AS (SELECT cost, f, n, mean, sd, 1 / (cost * n) AS reg, 0.0::DOUBLE AS b, 0.0::DOUBLE AS a
       FROM m, (SELECT unnest([{', '.join(f'{c}::DOUBLE' for c in LOGISTIC_C)}]) AS cost)),{','.join(out)}
SELECT cost, CAST(f AS INTEGER) AS fold, {_r('b', 'slope')}, {_r('a', 'intercept')},
       {_r('AVG(CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END)', 'neg_log_loss')}
FROM ({at} FROM i{steps} JOIN o ON o.fold = f) GROUP BY cost, f, b, a"""


register("logistic_cost_grid", _newton_sql())(logistic_cost_grid)
