"""Operators whose shuffles must not follow the rows or one hot value: ranks, contingency tables, centroids."""

import random

import numpy as np
import pandas as pd
import pytest
from py4j.protocol import Py4JError
from pyspark.sql import functions as F

from bandwise.operators import scorecard
from bandwise.operators.quantiles import attach_ranks
from bandwise.operators.scorecard import contingency, cramers_v
from bandwise.operators.stats import centroids, spearman


@pytest.mark.parametrize("weight", [None, "w"])
def test_attached_ranks(spark, weight):
    rng = random.Random(1)
    rows = [(i, 0.0 if i % 2 else rng.choice([-1.5, 2.5, rng.gauss(0, 1), float("inf"), None, float("nan")]), rng.randrange(1, 4))
            for i in range(3000)]  # half of the rows hold one value
    df = spark.createDataFrame(rows, "id long, x double, w int").repartition(5)
    got = {r["id"]: r["rank"] for r in attach_ranks(df, {"x": "rank"}, weight, buckets=16).collect()}
    values = pd.Series({i: x for i, x, _ in rows if x is not None and x == x})
    times = pd.Series({i: (w if weight else 1) for i, _, w in rows}).loc[values.index]
    want = pd.Series(np.repeat(values.to_numpy(), times)).rank().groupby(np.repeat(values.index.to_numpy(), times)).first()
    assert got == pytest.approx(want.to_dict())


def test_a_hot_value_fills_many_tasks(spark):
    df = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, 0.0).otherwise(F.col("id") * 1.0 - 20_000).alias("x"))
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sizes = [r["n"] for r in attach_ranks(df, {"x": "rank"}, buckets=64).groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 40_000 and max(sizes) < 6_000  # the value alone has 20,000 rows


def test_spearman_of_zero_inflated_columns(spark):
    rng = random.Random(2)
    rows = [(0.0 if rng.random() < 0.5 else rng.random(), 0.0 if rng.random() < 0.6 else rng.gauss(0, 1)) for _ in range(800)]
    rows += [(None, 1.0), (1.0, None), (float("nan"), 1.0)]
    got = spearman(spark.createDataFrame(rows, "a double, b double"), "a", "b").first()
    want = pd.DataFrame(rows[:800]).rank().corr().iloc[0, 1]
    assert got["spearman"] == pytest.approx(want) and got["n"] == 800
    assert attach_ranks(spark.createDataFrame([], "x double"), {"x": "r"}).count() == 0


def test_tables_of_two_hundred_columns(spark, monkeypatch):
    rng = np.random.default_rng(0)
    k, n = 200, 400
    base = rng.integers(0, 4, (n, k))
    base[:, 1] = base[:, 0]
    pdf = pd.DataFrame(base.astype(str), columns=[f"c{i}" for i in range(k)])
    pdf.loc[::7, "c2"] = None
    df = spark.createDataFrame(pdf).repartition(4)
    got = {(r["var1"], r["var2"]): r["CramersV"] for r in cramers_v(df, list(pdf.columns)).collect()}
    assert len(got) == k * (k - 1) // 2 and got["c0", "c1"] == pytest.approx(1)
    for a, b in (("c0", "c5"), ("c2", "c9"), ("c100", "c199")):
        t = pd.crosstab(pdf[a], pdf[b]).to_numpy()
        expected = t.sum(axis=1, keepdims=True) * t.sum(axis=0) / t.sum()
        chi2 = ((t - expected) ** 2 / expected).sum()
        assert got[a, b] == pytest.approx((chi2 / (n * (min(t.shape) - 1))) ** 0.5)
    # What a task sends follows the cells, not the rows.
    some = list(pdf.columns[:20])
    once, often = (d.select(*some).coalesce(1) for d in (df, df.crossJoin(spark.range(10))))
    sent = [d.mapInArrow(scorecard._crossing(20), "i int, j int, l1 string, l2 string, o long") for d in (once, often)]
    assert sent[0].count() == sent[1].count() == contingency(df, some).count()
    # The same cells when tasks hand on early.
    monkeypatch.setattr(scorecard, "HELD_CELLS", 50)
    monkeypatch.setattr(scorecard, "CROSSED_ROWS", 13)
    crossed = scorecard._Crossed(3)
    import pyarrow as pa
    for at in range(0, n, 13):
        crossed.add([pa.array(pdf[c][at:at + 13], pa.string()) for c in ("c0", "c2", "c3")])
    cells = crossed.rows().to_pandas()
    assert cells["o"].sum() == 3 * n and not cells.duplicated(["i", "j", "l1", "l2"]).any()


def test_centroids(spark):
    rows = [("a", [1.0, 2.0]), ("a", [3.0, 4.0]), ("b", [5.0, 6.0]), ("b", None), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "g string, v array<float>")
    assert {r["g"]: r["centroid"] for r in centroids(df, "v", ["g"]).collect()} == {"a": [2.0, 3.0], "b": [5.0, 6.0], None: [1.0, 1.0]}
    plan = centroids(df, "v", ["g"])._jdf.queryExecution().toString()
    assert "Generate" not in plan
    with pytest.raises(Py4JError):
        centroids(spark.createDataFrame([("a", [1.0]), ("a", [1.0, 2.0])], "g string, v array<double>").coalesce(1), "v", ["g"]).collect()
