"""The merged categorical WOE query against an independent pandas computation
of the same steps (level counts, small levels -> Others, greedy merges, WOE)."""

import math

import pytest

import __spark_entry__ as entry
from bandwise.plans.q_scorecard import CATS, _TRAIN_SQL
from tests.conftest import SF_SMALL


def _merge(levels, min_pct):
    """levels: list of [names, bad, total] sorted by bad rate; returns merged list."""
    grand = sum(t for _, _, t in levels)
    rows = [list(r) for r in levels]
    # pass 1: a bin below min_pct flows into its successor (the last bin excepted)
    out, carry = [], None
    for k, (names, bad, tot) in enumerate(rows):
        if carry:
            names, bad, tot = carry[0] + names, carry[1] + bad, carry[2] + tot
            carry = None
        if k < len(rows) - 1 and tot / grand < min_pct:
            carry = (names, bad, tot)
        else:
            out.append([names, bad, tot])
    # pass 2: a small last bin joins the one before it
    if len(out) >= 2 and out[-1][2] / grand < min_pct:
        last = out.pop()
        out[-1] = [out[-1][0] + last[0], out[-1][1] + last[1], out[-1][2] + last[2]]
    # pass 3: bins without bads flow into their successor (the last bin excepted)
    res, carry = [], None
    for k, (names, bad, tot) in enumerate(out):
        if carry:
            names, bad, tot = carry[0] + names, carry[1] + bad, carry[2] + tot
            carry = None
        if k < len(out) - 1 and bad == 0:
            carry = (names, bad, tot)
        else:
            res.append([names, bad, tot])
    return res


def test_woe_categorical_against_pandas(spark, duck):
    train = duck.execute(_TRAIN_SQL).fetchdf()
    want = {}
    for var in CATS:
        g = train[train[var].notna()].groupby(var)["target"].agg(["sum", "count"]).reset_index()
        share = g["count"] / g["count"].sum()
        g["mapped"] = [("Others" if s < 0.0025 else lvl) for lvl, s in zip(g[var], share)]
        m = g.groupby("mapped")[["sum", "count"]].sum().reset_index()
        m["rate"] = m["sum"] / m["count"]
        m = m.sort_values(["rate", "mapped"], kind="mergesort")
        merged = _merge([[[lvl], int(b), int(t)] for lvl, b, t in zip(m["mapped"], m["sum"], m["count"])], 0.06)
        tb = sum(b for _, b, _ in merged)
        tg = sum(t - b for _, b, t in merged)
        for names, b, t in merged:
            bd, gd = b / tb, (t - b) / tg
            woe = math.inf if bd == 0 else (-math.inf if gd == 0 else math.log(gd / bd))
            want[(var, ",".join(names))] = (b, t, woe, woe * (gd - bd))
    got = {(r["var"], r["bin"]): r for r in
           entry.queries()["woe_categorical"](spark, SF_SMALL).where("NOT is_total").collect()}
    assert set(got) == set(want)
    for k, (b, t, woe, iv) in want.items():
        r = got[k]
        assert (r["badCnt"], r["totalCnt"]) == (b, t)
        assert r["WOE"] == pytest.approx(round(woe, 6), abs=2e-6)
        assert r["IV"] == pytest.approx(round(iv, 6), abs=2e-6)


def test_tree_bins_against_brute_force(spark, duck):
    from bandwise.plans.q_scorecard import NUMS
    from tests.test_treebin import brute_force_leaves
    train = duck.execute(_TRAIN_SQL).fetchdf()
    min_leaf = int(round(len(train) * 0.06))
    got = entry.queries()["tree_bins"](spark, SF_SMALL).where("NOT is_total").collect()
    for var in NUMS:
        sub = train[train[var].notna()]
        above = sub[sub[var] > 0.0]
        low = sub[sub[var] <= 0.0]
        history = brute_force_leaves(list(above[var]), list(above["target"]), 6, min_leaf)
        chosen = None
        for k in range(6, 1, -1):
            leaves = history[min(k - 1, len(history) - 1)]
            rows = []
            for lo, hi in leaves:
                part = above[(above[var] >= lo) & (above[var] <= hi)]
                rows.append((hi, lo, int(part["target"].sum()), len(part), False))
            if len(low):
                rows.append((low[var].max(), low[var].min(), int(low["target"].sum()), len(low), True))
            rows.sort(key=lambda r: (r[0], not r[4]))
            rates = [100.0 * b / t for _, _, b, t, _ in rows]
            signs = {(rates[i] > rates[i + 1]) - (rates[i] < rates[i + 1])
                     for i in range(len(rows) - 1) if not rows[i][4]}
            chosen = (k, rows)
            if len(signs) == 1:
                break
        k, rows = chosen
        mine = sorted(((r["amin"], r["amax"], r["badCnt"], r["totalCnt"], r["n_leaves"]) for r in got
                       if r["var"] == var), key=lambda t: t[1])
        theirs = sorted(((round(lo, 6), round(hi, 6), b, t, k) for hi, lo, b, t, _ in rows), key=lambda t: t[1])
        assert mine == theirs


def test_cramers_selection_loop_matches_recursive_sql(spark, duck):
    """With cv_max = 0 every pair qualifies, so the greedy loop drops several
    variables; the Python loop and the recursive SQL must agree."""
    from bandwise.operators.scorecard import cramers_v, cramers_v_select, iv_totals, woe_binned
    from bandwise.plans.q_scorecard import NUMS, _binned_train, _cramers_select_sql
    binned = _binned_train(spark, SF_SMALL)
    iv = iv_totals(woe_binned(binned, CATS + NUMS, "target"))
    dropped, _ = cramers_v_select(cramers_v(binned, CATS + NUMS), iv, 0.0)
    sql_count = duck.execute(_cramers_select_sql(0.0)).fetchdf()["dropped_count"].iloc[0]
    assert len(dropped) >= 2
    assert len(dropped) == sql_count


@pytest.mark.parametrize("levels", [
    [("p", 0, 4), ("q", 2, 10), ("r", 10, 80), ("s", 30, 90), ("t", 1, 2), ("u", 10, 14)],
    [("a", 0, 30), ("b", 2, 50), ("c", 10, 100), ("d", 3, 5)],          # small last bin, zero-bad first bin
    [("a", 0, 3), ("b", 0, 40), ("c", 4, 60), ("d", 9, 60), ("e", 1, 2)],
])
def test_recursive_merge_sql_matches_python(duck, levels):
    import pandas as pd
    from bandwise.operators.scorecard import merge_level_bins
    from bandwise.plans.q_scorecard import _merged_woe_sql
    rows = [(lvl, 1) for lvl, b, t in levels for _ in range(b)] + \
           [(lvl, 0) for lvl, b, t in levels for _ in range(t - b)]
    values = ", ".join(f"('{lvl}', {y})" for lvl, y in rows)
    src = f"SELECT 'v' AS var, level, target FROM (VALUES {values}) t(level, target)"
    got = duck.execute(_merged_woe_sql(0.06, 0.0, levels_sql=src)).fetchdf()
    got = got[~got["is_total"]].sort_values("bin_id")
    pdf = pd.DataFrame({"level": [x[0] for x in levels], "badCnt": [x[1] for x in levels],
                        "totalCnt": [x[2] for x in levels]})
    want = merge_level_bins(pdf, 0.06)
    assert list(got["bin"]) == [",".join(n) for n, _, _ in want]
    assert list(got["badCnt"]) == [b for _, b, _ in want]
    assert list(got["totalCnt"]) == [t for _, _, t in want]
