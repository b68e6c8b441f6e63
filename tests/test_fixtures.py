"""Hand-computed fixtures (small tables written in the test) for operators whose
semantics need exact checks: KS/Gini, profile with nulls, folding and merging,
right-closed bins, infinite WOE, JSON paths, Pearson, adstock, regex rewriting."""

import math
import re

import pytest
from pyspark.sql import functions as F

from bandwise.functions.mathfn import four_significant, saturation
from bandwise.functions.regex import conditional_match, first_match, group, search, to_java_regex
from bandwise.operators.bins import band_expr, quantile_edges
from bandwise.operators.encode import COMBINED, apply_levels, fit_level_table, kept_levels
from bandwise.operators.evaluate import classification_metrics, ks_gini_summary, ks_gini_table
from bandwise.operators.jsonflat import flatten_json
from bandwise.operators.media import geometric_adstock
from bandwise.operators.prep import (as_categorical, check_target_type, drop_low_cardinality, fill_nulls,
                                     flatten_struct, infer_column_types)
from bandwise.operators.profile import univariate
from bandwise.operators.scorecard import merge_level_bins, woe_columns
from bandwise.operators.stats import correlations


def test_ks_gini_bands_fixture(spark):
    counts = spark.createDataFrame([(1, 1, 10), (2, 3, 10), (3, 6, 10)], "band_id int, Event long, Total long")
    tab = ks_gini_table(counts)
    s = ks_gini_summary(tab).first()
    assert s["KS"] == pytest.approx(40.0)
    assert s["Gini"] == pytest.approx(50.0)
    total = tab.where("is_total").first()
    assert total["Cumulative_Event"] == 10 and total["Cumulative_Non_Event"] == 20 and total["Gini"] is None
    rows = {r["band_id"]: r for r in tab.where("NOT is_total").collect()}
    assert rows[3]["Cumulative_Event_%"] == pytest.approx(0.6)
    assert rows[1]["Cumulative_Non_Event_%"] == pytest.approx(1.0)
    assert sum(r["Population_%"] for r in rows.values()) == pytest.approx(1.0)


def test_profile_nulls_fill_and_constant_drop(spark):
    rows = [(1, 0.0, "a", 5, 1), (2, None, None, 5, 0), (3, 2.0, "b", 5, 1),
            (4, 0.0, "a", 5, 0), (None, 4.0, "c", 5, 1), (6, None, "a", 5, 0)]
    df = spark.createDataFrame(rows, "x long, y double, s string, k int, target int")
    prof = {r["variable"]: r for r in univariate(df, "target").collect()}
    assert prof["y"]["percentNull"] == pytest.approx(2 / 6)
    assert prof["y"]["percentZeros"] == pytest.approx(2 / 6)
    assert prof["y"]["var_vals"] == 3
    assert prof["y"]["var_median"] == pytest.approx(1.0)  # values 0,0,2,4 -> linear median 1.0
    assert prof["s"]["percentZeros"] == 0.0 and prof["s"]["var_min"] is None
    assert prof["k"]["var_vals"] == 1 and prof["k"]["CorrelationWithTarget"] is None
    assert prof["target"]["CorrelationWithTarget"] == pytest.approx(1.0)
    kept, dropped = drop_low_cardinality(df, univariate(df, "target", median=False))
    assert dropped == ["k"] and "k" not in kept.columns
    filled = as_categorical(fill_nulls(df, 0, "."), ["x"]).collect()
    assert [r["x"] for r in filled][4] == "0_"
    assert [r["s"] for r in filled][1] == "."
    with pytest.raises(TypeError):
        check_target_type(df, "y")


def test_rare_folding_and_unseen_levels(spark):
    # shares 50 %, 30 %, 15 %, 4 %, 1 %
    levels = ["a"] * 50 + ["b"] * 30 + ["c"] * 15 + ["d"] * 4 + ["e"]
    train = spark.createDataFrame([(v,) for v in levels], "v string")
    table = fit_level_table(train, ["v"], 0.05)
    mapped = {r["level"]: r["mapped_level"] for r in table.collect()}
    assert mapped == {"a": "a", "b": "b", "c": "c", "d": COMBINED, "e": COMBINED}
    test = spark.createDataFrame([("a",), ("d",), ("zz",), (None,)], "v string")
    out = [r["v"] for r in apply_levels(test, ["v"], kept_levels(table)).collect()]
    assert sorted(out, key=str) == sorted(["a", COMBINED, COMBINED, None], key=str)


def test_merge_levels_by_hand():
    import pandas as pd
    # level: (bad, total); shares of 200 rows
    pdf = pd.DataFrame({"level": ["p", "q", "r", "s", "t", "u"],
                        "badCnt": [0, 2, 10, 30, 1, 10],
                        "totalCnt": [4, 10, 80, 90, 2, 14]})
    # 200 rows; by bad rate: p 0.0, r 0.125, q 0.2, s 0.33, t 0.5, u 0.71
    out = merge_level_bins(pdf, 0.06)
    names = [tuple(n) for n, _, _ in out]
    # P (2 %) -> into r; q (5 %) -> into s; t (1 %) -> into u; C4: last bin u+t (8 %) stays;
    # First bin (p,r) has bads -> no merge.
    assert names == [("p", "r"), ("q", "s"), ("t", "u")]
    assert [b for _, b, _ in out] == [10, 32, 11]
    assert [t for _, _, t in out] == [84, 100, 16]


def test_right_closed_bins(spark):
    edges = [0.0, 1.0, 2.0, 5.0]
    df = spark.createDataFrame([(-0.5,), (0.0,), (1.0,), (1.5,), (2.0,), (5.0,), (5.1,)], "x double")
    got = [r[0] for r in df.select(band_expr("x", edges)).collect()]
    assert got == [None, 1, 1, 2, 2, 3, None]


def test_quantile_edges_match_numpy(spark):
    import numpy as np
    vals = [float(v) for v in [1, 2, 2, 3, 7, 7, 7, 10, 11, 40, 41, 41, 50]]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = quantile_edges(df, "x", bins=4, edge_rule="none", round_digits=None)
    want = sorted(set(np.quantile(np.array(vals), [0, 0.25, 0.5, 0.75, 1.0]).tolist()))
    assert got == pytest.approx(want)


def test_infinite_woe(spark):
    bins = spark.createDataFrame([("v", "x", 0, 10), ("v", "y", 5, 5), ("v", "z", 5, 10)],
                                 "var string, bin string, badCnt long, totalCnt long")
    rows = {r["bin"]: r for r in woe_columns(bins).collect()}
    assert rows["x"]["WOE"] == math.inf
    assert rows["y"]["WOE"] == -math.inf
    assert math.isfinite(rows[None]["IV"])  # total IV sums finite bins only
    assert rows[None]["IV"] == pytest.approx(rows["z"]["IV"])


def test_json_paths(spark):
    doc = '{"a":1,"b":{"c":[{"d":2},3]},"e":null,"f":true}'
    df = spark.createDataFrame([(1, doc)], "id long, j string")
    got = {(r["variable"], r["value"]) for r in flatten_json(df, ["id"], "j").collect()}
    assert got == {("_a", "1"), ("_b_c__d", "2"), ("_e", "None"), ("_f", "True")}


def test_pearson_fixture(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0), (2.0, 10.0)], "a double, b double")
    assert correlations(df, [("a", "b")]).first()["pearson"] == pytest.approx(0.59604, abs=1e-5)


def test_adstock_fixture(spark):
    df = spark.createDataFrame([("c", i, float(i)) for i in range(1, 5)], "channel string, period int, x double")
    got = [r["adstock"] for r in geometric_adstock(df, "x", 0.5, 12, normalize=False).orderBy("period").collect()]
    assert got == pytest.approx([1.0, 2.5, 4.25, 6.125])
    ident = [r["adstock"] for r in geometric_adstock(df, "x", 0.0, 12, normalize=False).orderBy("period").collect()]
    assert ident == pytest.approx([1.0, 2.0, 3.0, 4.0])
    sat = spark.range(1).select(saturation(F.lit(2.0), 0.5).alias("s")).first()["s"]
    assert sat == pytest.approx(math.tanh(0.5))


REGEX_TEXTS = ["foobar", "foobar\n", "foobar\n\n", "###foobar", "###foobaz", "foo,foo", "135.135", "1foo1bar",
               "the the cat", "price $15 now?", "ab-ab"]
REGEX_PATTERNS = [r"^foo", r"bar$", r"bar\Z", r"\Afoo", r"o{2}", r"\d+\.\d+", r"(\w+),\1", r"\bfoo\b",
                  r"(?P<w>\w+)-(?P=w)", r"\w+(?=\?)", r"(?<=\$)\d+", r"foo(?!bar)", r"(?<!1)foo", r"ba[rz]"]


@pytest.mark.parametrize("pattern", REGEX_PATTERNS)
def test_regex_against_python(spark, pattern):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(REGEX_TEXTS)], "i int, t string")
    got = df.select("i", search("t", pattern).alias("m"), first_match("t", pattern).alias("f")).orderBy("i").collect()
    for row, text in zip(got, REGEX_TEXTS):
        m = re.search(pattern, text)
        assert row["m"] == (m is not None), (pattern, text)
        assert row["f"] == (m.group(0) if m else None), (pattern, text)


def test_regex_groups_and_conditional(spark):
    df = spark.createDataFrame([("(123)",), ("123",), ("(123",)], "t string")
    # Python: ^(\()?\d+(?(1)\))$
    cond = [r[0] for r in df.select(conditional_match("t", r"^\(", r"^\(\d+\)$", r"^\d+$")).collect()]
    assert cond == [bool(re.search(r"^(\()?\d+(?(1)\))$", t)) for t in ["(123)", "123", "(123"]]
    g = df.select(group("t", r"(\d)(\d)", 2)).collect()
    assert [r[0] for r in g] == ["2", "2", "2"]
    assert to_java_regex(r"(?P<x>a)(?P=x)\Z") == r"(?<x>a)\k<x>\z"
    with pytest.raises(ValueError):
        to_java_regex(r"(a)?(?(1)b|c)")


def test_infer_types_and_flatten(spark):
    df = spark.createDataFrame([("1", "1.5", "x", 1.0), ("2", "2e3", "y", 2.0)], "a string, b string, c string, d double")
    types = {r["variable"]: (r["inferred_type"], r["selected"]) for r in infer_column_types(df).collect()}
    assert types == {"a": ("integer", False), "b": ("floating", True), "c": ("string", True),
                     "d": ("floating", True)}
    nested = spark.createDataFrame([((1, (2, 3)),)], "s struct<a:int, b:struct<c:int, d:int>>")
    assert flatten_struct(nested).columns == ["s_a_", "s_b_c_", "s_b_d_"]


def test_classification_metrics_brute_force(spark):
    pairs = [(1, 1), (1, 0), (0, 0), (0, 0), (1, 1), (0, 1), (2, 2), (2, 0)]
    df = spark.createDataFrame(pairs, "y int, p int")
    acc = sum(a == b for a, b in pairs) / len(pairs) * 100
    f1s = []
    for c in (0, 1, 2):
        tp = sum(a == c and b == c for a, b in pairs)
        fp = sum(a != c and b == c for a, b in pairs)
        fn = sum(a == c and b != c for a, b in pairs)
        f1s.append(2 * tp / (2 * tp + fp + fn))
    macro = classification_metrics(df, "y", "p", "macro").first()
    assert macro["accuracy"] == pytest.approx(acc)
    assert macro["f1"] == pytest.approx(sum(f1s) / 3 * 100)
    binary = classification_metrics(df.where("y < 2 AND p < 2"), "y", "p", "binary").first()
    assert 0 <= binary["f1"] <= 100


def test_four_significant(spark):
    df = spark.createDataFrame([(12345.678,), (0.000123456,), (987.1,), (1.0005,), (1000.5,), (1001.5,), (None,), (-0.00099995,)], "x double")
    got = [r[0] for r in df.select(four_significant("x")).collect()]
    assert got == [12350.0, 0.0001235, 987.1, 1.0, 1000.0, 1002.0, None, float("%.3e" % -0.00099995)]


def test_ks_table_is_in_order(spark):
    bands = spark.createDataFrame([(2, 3, 10), (1, 1, 10), (3, 6, 10)], "band_id int, Event long, Total long")
    assert [(r["band_id"], r["is_total"]) for r in ks_gini_table(bands).collect()] == [(3, False), (2, False), (1, False), (None, True)]
    assert [r["band_id"] for r in ks_gini_table(bands, ascending=True).collect()] == [1, 2, 3, None]


def test_profile_of_booleans(spark):
    df = spark.createDataFrame([(True, 1), (False, 0), (False, 1), (None, 0)], "b boolean, target int")
    r = univariate(df, "target").where("variable = 'b'").first()
    assert (r["var_min"], r["var_max"], r["var_median"], r["percentZeros"], r["percentNull"]) == (0.0, 1.0, 0.0, 0.5, 0.25)
    assert r["var_mean"] == pytest.approx(1 / 3) and r["CorrelationWithTarget"] == pytest.approx(0.5)


def test_regex_lookaround_query_vs_python(spark):
    """The Java-only regex query against Python ``re`` over every sf0.001 conversation turn."""
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL
    got = {(r["conv_id"], r["turn"]): r for r in entry.queries()["regex_lookaround"](spark, SF_SMALL).collect()}
    texts = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "text").collect()
    assert len(got) == len(texts)
    for t in texts:
        row, s = got[(t["conv_id"], t["turn"])], t["text"] or ""
        m = re.search(r"\b(\w+)\s+\1\b", s, re.ASCII)
        assert row["repeated_word"] == (m.group(0) if m else None)
        m = re.search(r"(?P<w>\w+)-(?P=w)", s, re.ASCII)
        assert row["named_repeat"] == (m.group(0) if m else None)
        assert row["words_before_question"] == len(re.findall(r"\w+(?=\?)", s, re.ASCII))
        assert row["amounts_after_dollar"] == len(re.findall(r"(?<=\$)\d+", s, re.ASCII))
        assert row["statement_only"] == bool(re.search(r"^(?!.*\?).*\.\Z", s, re.ASCII))


def test_counts_from_ranks_equal_banding_pass(spark):
    """Train-mode band counts come from running counts at the edges; they must
    equal a banding pass over the rows with the same edges (ties on edges too)."""
    import random
    from bandwise.operators.evaluate import score_performance
    rnd = random.Random(5)
    rows = [(float(rnd.choice([0.0, 0.02, 0.02, 0.05, 0.07, 0.1, 0.1, 0.1])), rnd.choice(["R", "A", "N"]))
            for _ in range(3000)] + [(None, "R")]
    df = spark.createDataFrame(rows, "s double, t string")
    for rule in ("extend01", "none"):
        fast, edges = score_performance(df, "s", "t", event="R", bins=6, edge_rule=rule, round_digits=None)
        slow, _ = score_performance(df, "s", "t", event="R", edges=edges)
        cols = ["band_id", "Total", "Event", "Gini", "Difference"]
        assert sorted(map(tuple, fast.select(cols).collect()), key=str) == \
            sorted(map(tuple, slow.select(cols).collect()), key=str)


def test_ranks_on_empty_and_all_null_columns(spark):
    from bandwise.operators.quantiles import exact_quantiles
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 4.0)], "a double, b double")
    q = {(r["var"], r["prob"]): r["value"] for r in exact_quantiles(df, ["a", "b"], [0.5]).collect()}
    assert q == {("b", 0.5): 2.0}
    empty = spark.createDataFrame([], "a double")
    assert exact_quantiles(empty, ["a"], [0.5]).count() == 0


def test_profile_approximate_options(spark):
    from tests.conftest import SF_SMALL
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumn(
        "target", (F.col("o_orderstatus") == "F").cast("int"))
    exact = {r["variable"]: r for r in univariate(o, "target").collect()}
    approx = {r["variable"]: r for r in univariate(o, "target", median="approx", distinct="approx").collect()}
    assert set(exact) == set(approx)
    for v, r in exact.items():
        assert approx[v]["var_mean"] == r["var_mean"]
        assert approx[v]["var_vals"] == pytest.approx(r["var_vals"], rel=0.1)
        if r["var_median"] is not None:
            assert approx[v]["var_median"] == pytest.approx(r["var_median"], rel=0.05, abs=1.0)


@pytest.mark.parametrize("n, ordered", [(1, 100_000), (7, 2), (100, 2), (1200, 1), (1200, 100_000)])
def test_sample_n_exact_and_ordered(spark, monkeypatch, n, ordered):
    from bandwise.operators import split
    from bandwise.operators.split import order_hash, sample_n
    from tests.conftest import SF_SMALL
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    got = {r[0] for r in sample_n(o, n, ["o_orderkey"], seed=9, ordered_rows=ordered).collect()}
    ref = [r[0] for r in o.withColumn("h", order_hash(["o_orderkey"], 9)).orderBy("h", "o_orderkey").collect()]
    assert len(got) == n and got == set(ref[:n])


def test_json_deep_nesting(spark):
    keys = "abcdefghijkl"
    doc = "".join('{"%s":' % k for k in keys) + '[1, {"z": "deep"}]' + "}" * len(keys)
    df = spark.createDataFrame([(1, doc), (2, '{"x": [true, null, {"y": 2.5}]}'), (3, "not json")],
                               "id long, j string")
    got = {(r["id"], r["variable"], r["value"]) for r in flatten_json(df, ["id"], "j").collect()}
    assert got == {(1, "_" + "_".join(keys) + "__z", "deep"), (2, "_x__y", "2.5")}


@pytest.mark.parametrize("fast", [False, True])
def test_split_disjoint_and_covering(spark, fast):
    from bandwise.operators.split import train_test_split
    from tests.conftest import SF_SMALL
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    tr, te = train_test_split(o, ["o_orderkey"], 7, 0.25, fast=fast)
    a, b = {r[0] for r in tr.collect()}, {r[0] for r in te.collect()}
    assert not (a & b) and len(a | b) == o.count()
    assert 0.15 < len(b) / o.count() < 0.35


def test_unknown_and_null_levels_take_the_others_bin(spark):
    from bandwise.operators.scorecard import apply_level_bins
    df = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "v string")
    m = spark.createDataFrame([("v", "a", "a,b", "Others"), ("v", "b", "a,b", "Others")],
                              "var string, level string, bin string, others_bin string")
    assert sorted(r[0] for r in apply_level_bins(df, ["v"], m).collect()) == ["Others", "Others", "a,b", "a,b"]
    none = m.withColumn("others_bin", F.lit(None).cast("string"))
    assert sorted(str(r[0]) for r in apply_level_bins(df, ["v"], none).collect()) == ["None", "None", "a,b", "a,b"]


def test_adstock_counts_periods_not_rows(spark):
    import datetime
    df = spark.createDataFrame([("c", datetime.date(2024, 1, 1), 1.0), ("c", datetime.date(2024, 1, 5), 1.0)],
                               "channel string, period date, x double")
    got = [r["adstock"] for r in geometric_adstock(df, "x", 0.5, 12, normalize=False).orderBy("period").collect()]
    assert got == [1.0, 1.0 + 0.5 ** 4]
    full = sum(0.5 ** i for i in range(12))
    norm = [r["adstock"] for r in geometric_adstock(df, "x", 0.5, 12).orderBy("period").collect()]
    assert norm == pytest.approx([1 / full, (1 + 0.5 ** 4) / full])


def test_waterfall_needs_no_unique_key(spark):
    from bandwise.operators.explain import waterfall
    df = spark.createDataFrame([(1, 3.0, -5.0, 1.0), (1, 3.0, -5.0, 1.0), (2, 0.0, 0.5, -0.5)],
                               "k int, phi_a double, phi_b double, phi_c double")
    got = sorted(tuple(r) for r in waterfall(df, ["k"], ["a", "b", "c"], max_display=2).collect())
    assert got == sorted([(1, "b", -5.0, 1, -5.0), (1, "other features", 4.0, 2, -1.0)] * 2
                         + [(2, "b", 0.5, 1, 0.5), (2, "other features", -0.5, 2, 0.0)])
    whole = [r["feature"] for r in waterfall(df, ["k"], ["a", "b", "c"]).where("k = 2").orderBy("rank").collect()]
    assert whole == ["b", "c", "a"]


def test_binomial_of_any_size(spark):
    import math
    from bandwise.functions.mathfn import binomial_pmf
    rows = [(25, 7), (1000, 500), (3, 0), (3, 3), (3, 4), (0, 0)]
    df = spark.createDataFrame(rows, "n int, x int")
    got = [r[0] for r in df.select(binomial_pmf("n", "x", 0.3)).collect()]
    assert got == pytest.approx([math.comb(n, x) * 0.3 ** x * 0.7 ** (n - x) if x <= n else 0.0 for n, x in rows])


def test_boolean_columns_are_features(spark):
    from bandwise.operators.encode import feature_columns, feature_names, fit_one_hot, transform_one_hot
    from bandwise.operators.prep import fill_nulls
    df = spark.createDataFrame([(True, "a"), (None, None), (False, "b")], "f boolean, s string")
    filled = fill_nulls(df)
    assert [tuple(r) for r in filled.collect()] == [(True, "a"), (False, "."), (False, "b")]
    cats, nums = feature_columns(filled)
    assert (cats, nums) == (["s"], ["f"])
    model = fit_one_hot(filled, cats, nums)
    assert feature_names(model, cats, nums)[0] == "f"
    assert [r["features"][0] for r in transform_one_hot(model, filled).collect()] == [1.0, 0.0, 0.0]


def test_split_fractions_are_not_rounded(spark):
    from bandwise.operators.split import hash_split_flag
    df = spark.range(200_000).withColumn("k", F.col("id"))
    third, tiny = (df.where(hash_split_flag(["k"], 3, f)).count() for f in (1 / 3, 0.00004))
    assert abs(third / 200_000 - 1 / 3) < 0.005 and 0 < tiny < 40
    h = F.conv(F.substring(F.md5(F.concat(F.lit("3:"), F.col("k").cast("string"))), 1, 8), 16, 10).cast("long")
    assert third == df.where(h < F.lit((1 << 32) / 3)).count()


def test_equal_depths_are_searched_once():
    from bandwise.operators.ensembles import collapsed
    from bandwise.operators.models import GBM_PARAMS, grid_points
    points = grid_points(GBM_PARAMS)
    assert len(points) == 4 * 3 * 2 * 5 and {p["max_depth"] for p in points} == {3, 10, 20, 40, 80}
    assert {(p["min_weight_fraction_leaf"], p["max_depth"]) for p in map(collapsed, points)} == {(0.1, 3), (0.1, 9), (0.06, 3), (0.06, 10), (0.06, 15)}


def test_json_has_no_depth_limit(spark):
    depth = 70
    df = spark.createDataFrame([(1, '{"a":' * depth + "1" + "}" * depth)], "id int, j string")
    got = flatten_json(df, ["id"], "j").collect()
    assert [(r["variable"], r["value"]) for r in got] == [("_a" * depth, "1")]


def test_search_required_literal_prefilter(spark):
    df = spark.createDataFrame([("mail a.b@x.org now",), ("no at sign x.org",), (None,), ("@ only",)], "t string")
    pat = r"[A-Za-z0-9._]+@[A-Za-z0-9.]+\.[a-z]{2,}"
    plain = [r[0] for r in df.select(search("t", pat)).collect()]
    fast = [r[0] for r in df.select(search("t", pat, required="@")).collect()]
    assert plain == fast == [True, False, None, False]


@pytest.mark.parametrize("ranked_rows", [1, 5, 200_000])
def test_selected_ranks_of_any_shape(spark, monkeypatch, ranked_rows):
    """Heavy tails, ties, infinities, null and NaN: the same order statistics as a sort."""
    import random
    from bandwise.operators import quantiles as Q
    passes, counting, received, hit = [], Q._counting, [], Q._hit
    monkeypatch.setattr(Q, "_counting", lambda *a: passes.append(a[3]) or counting(*a))

    def seen(*a):
        out = hit(*a)
        received.append(out.count())
        return out
    monkeypatch.setattr(Q, "_hit", seen)
    rng = random.Random(2)
    a = [10 ** rng.uniform(-5, 5) * rng.choice([-1, 1]) for _ in range(60)] + [3.0] * 30 + [math.inf, -math.inf, 1e300, 0.0, -0.0]
    b = [None] * 50 + [float("nan")] * 10 + [7.0] * (len(a) - 60)
    df = spark.createDataFrame([(x, y, 1 if i % 3 else 0) for i, (x, y) in enumerate(zip(a, b))], "a double, b double, e int")
    probs = [0.1, 0.25, 0.5, 0.9]
    r = Q.selected_ranks(df, ["a", "b"], probs, sums={"e": F.col("e")}, ranked_rows=ranked_rows)
    assert len(passes) <= (2 if ranked_rows > 10 else 4) and max(received) <= 2 * 2 * len(probs)
    got = {(v, i): (x, lo["cum_e"]) for v, i, _, x, (lo, _) in Q.interpolate(r, probs)}
    s = sorted(zip(a, [1 if i % 3 else 0 for i in range(len(a))]))
    for i, p in enumerate(probs):
        h = (len(s) - 1) * p
        lo, frac = int(h), h - int(h)
        want = s[lo][0] + (s[lo + 1][0] - s[lo][0]) * frac
        assert got["a", i][0] == pytest.approx(want)
        assert got["a", i][1] == sum(e for x, e in s if x <= s[lo][0])
        assert got["b", i][0] == 7.0
    assert r.n == {"a": len(a), "b": len(a) - 60}


def test_nan_scores_are_missing_in_both_modes(spark):
    from bandwise.operators.evaluate import score_performance
    df = spark.createDataFrame([(float("nan"), 1), (0.2, 0), (0.4, 1), (0.6, 1), (None, 1)], "s double, t int")
    train, edges = score_performance(df, "s", "t", bins=2)
    assert edges == pytest.approx([0.0, 0.4, 1.0])
    test, _ = score_performance(df, "s", "t", edges=edges)
    assert sorted(map(repr, train.collect())) == sorted(map(repr, test.collect()))
    assert train.where("is_total").first()["Total"] == 3


def test_adstock_of_all_days_and_waterfall_of_three(spark):
    import __spark_entry__ as entry
    from bandwise.plans.q_media import _spend
    from tests.conftest import SF_SMALL
    days = {(r["channel"], str(r["period"])) for r in _spend(spark, SF_SMALL).collect()}
    got = entry.queries()["adstock_all_days"](spark, SF_SMALL).collect()
    assert {(r["channel"], str(r["period"])) for r in got} == days and len(got) == len(days)
    ranks = entry.queries()["waterfall_three"](spark, SF_SMALL).groupBy("rank").count().collect()
    assert {r["rank"] for r in ranks} == {1, 2, 3} and len({r["count"] for r in ranks}) == 1
