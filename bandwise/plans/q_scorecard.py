"""Catalog: scorecard operators (C1-C20) on orders joined with customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from bandwise.operators.scorecard import (apply_cuts, apply_level_bins, cramers_v, cramers_v_select,
                                          fold_small_levels, iv_totals, level_counts,
                                          structure_bin_map, woe_binned, woe_categorical,
                                          woe_columns)
from bandwise.operators.split import train_test_split
from bandwise.operators.treebin import tree_binning
from bandwise.plans.catalog import register
from bandwise.plans.common import materialised, rounded
from bandwise.plans.oracle_sql import _r
from bandwise.plans.scorecard_flow import Scorecard
from bandwise.sources.tables import load_table

CATS = ["c_mktsegment", "o_orderpriority", "c_nation"]
NUMS = ["o_totalprice", "c_acctbal"]
KEY = ["o_orderkey"]
INF = float("inf")
# Cut points for the SQL-checkable numeric WOE (right-closed bins).
PRICE_CUTS = [-INF, -1.0, 50000.0, 100000.0, 150000.0, 200000.0, 300000.0, INF]
BAL_CUTS = [-INF, -1.0, 0.0, 2500.0, 5000.0, 7500.0, INF]
# Fixed value: manual regrouping of the market segment used by the C18 query.
SEGMENT_STRUCTURE = {"c_mktsegment": [["AUTOMOBILE", "BUILDING"], ["FURNITURE", "Others"],
                                      ["HOUSEHOLD", "MACHINERY"]]}

_BASE_SQL = """SELECT o.o_orderkey, c.c_mktsegment, o.o_orderpriority,
       CAST(c.c_nationkey AS VARCHAR) AS c_nation, o.o_totalprice, c.c_acctbal,
       CAST(o.o_orderstatus = 'F' AS INTEGER) AS target
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""
_TRAIN_SQL = (f"SELECT * FROM ({_BASE_SQL}) WHERE NOT (('0x' || substr(md5('1:' || "
              f"CAST(o_orderkey AS VARCHAR)), 1, 8))::UBIGINT::DOUBLE < 4294967296::DOUBLE * 0.2::DOUBLE)")


# ---------------------------------------------------------------- Spark side

def scorecard_base(spark, sf_dir):
    o = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus",
                                            "o_totalprice", "o_orderpriority"])
    c = load_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select("o_orderkey", "c_mktsegment", "o_orderpriority",
                    F.col("c_nationkey").cast("string").alias("c_nation"),
                    "o_totalprice", "c_acctbal",
                    (F.col("o_orderstatus") == "F").cast("int").alias("target")))


def _train(spark, sf_dir):
    train, _ = train_test_split(scorecard_base(spark, sf_dir), KEY, seed=1, test_size=0.2)
    return train


def _binned_train(spark, sf_dir):
    """Categorical levels with small levels folded to Others + numerics on fixed cuts."""
    train = _train(spark, sf_dir)
    counts = level_counts(train, CATS, "target")
    # Only kept levels go into the (broadcast) map: at most 1/floor rows per variable.
    # Folded and unseen levels take the fallback bin 'Others'.
    bin_map = (fold_small_levels(counts, 0.0025).where(F.col("mapped") != "Others")
               .select("var", "level", F.col("mapped").alias("bin"), F.lit("Others").alias("others_bin")))
    binned = apply_level_bins(train, CATS, bin_map)
    return apply_cuts(binned, {"o_totalprice": PRICE_CUTS, "c_acctbal": BAL_CUTS})


# ---------------------------------------------------------------- SQL side

def _lit(v: float) -> str:
    if v == INF:
        return "'inf'::DOUBLE"
    if v == -INF:
        return "'-inf'::DOUBLE"
    return repr(v)


def _iv_label(lo: float, hi: float) -> str:
    def f(v):
        return "inf" if v == INF else "-inf" if v == -INF else repr(v)
    return f"({f(lo)}, {f(hi)}]"


def _cut_case(col: str, cuts: list[float]) -> str:
    parts = [f"WHEN {col} <= {_lit(cuts[0])} THEN NULL"]
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        parts.append(f"WHEN {col} <= {_lit(hi)} THEN '{_iv_label(lo, hi)}'")
    return f"CASE WHEN {col} IS NULL THEN NULL " + " ".join(parts) + " END"


def _woe_sql(binned_cte: str) -> str:
    """WOE table over a CTE ``binned(var, bin, target)`` (non-null bins)."""
    return f"""WITH {binned_cte},
cnt AS (SELECT var, bin, CAST(SUM(target) AS BIGINT) AS badCnt, COUNT(*) AS totalCnt FROM binned GROUP BY ALL),
t AS (SELECT *, totalCnt - badCnt AS goodCnt,
             SUM(badCnt) OVER (PARTITION BY var) AS tb, SUM(totalCnt - badCnt) OVER (PARTITION BY var) AS tg,
             SUM(totalCnt) OVER (PARTITION BY var) AS tt FROM cnt),
d AS (SELECT *, CAST(badCnt AS DOUBLE) / tb AS bd, CAST(goodCnt AS DOUBLE) / tg AS gd FROM t),
w AS (SELECT *, CASE WHEN bd = 0 AND gd = 0 THEN 'nan'::DOUBLE WHEN bd = 0 THEN 'inf'::DOUBLE
                     WHEN gd = 0 THEN '-inf'::DOUBLE ELSE ln(gd / bd) END AS woe FROM d),
iv AS (SELECT *, woe * (gd - bd) AS iv FROM w)
SELECT var, bin, FALSE AS is_total, badCnt, totalCnt, goodCnt, {_r('totalCnt / tt', 'popPercentage')},
       {_r('bd', 'badDistribution')}, {_r('gd', 'goodDistribution')}, {_r('gd - bd', 'distributedGoodBad')},
       {_r('woe', 'WOE')}, {_r('iv', 'IV')}, {_r('badCnt / totalCnt', 'badRate')}
FROM iv
UNION ALL
SELECT var, NULL, TRUE, CAST(SUM(badCnt) AS BIGINT), CAST(SUM(totalCnt) AS BIGINT),
       CAST(SUM(goodCnt) AS BIGINT), 1.0, 1.0, 1.0, 0.0, 0.0,
       {_r('COALESCE(SUM(CASE WHEN isfinite(iv) THEN iv END), 0.0)', 'IV')},
       {_r('SUM(badCnt) / SUM(totalCnt)', 'badRate')}
FROM iv GROUP BY var"""


def _cat_raw_cte() -> str:
    """train -> lv (long levels) -> mp (level -> level or Others) -> binned."""
    unp = " UNION ALL ".join(f"SELECT '{c}' AS var, {c} AS level, target FROM train WHERE {c} IS NOT NULL"
                             for c in CATS)
    return f"""train AS ({_TRAIN_SQL}),
lv AS ({unp}),
lc AS (SELECT var, level, COUNT(*) AS n FROM lv GROUP BY ALL),
mp AS (SELECT var, level, CASE WHEN n / SUM(n) OVER (PARTITION BY var) < 0.0025 THEN 'Others' ELSE level END AS mapped
       FROM lc),
binned AS (SELECT lv.var, mp.mapped AS bin, lv.target FROM lv JOIN mp USING (var, level))"""


def _num_fixed_cte() -> str:
    return f"""train AS ({_TRAIN_SQL}),
b AS (SELECT target, {_cut_case('o_totalprice', PRICE_CUTS)} AS p, {_cut_case('c_acctbal', BAL_CUTS)} AS a
      FROM train),
binned AS (SELECT 'o_totalprice' AS var, p AS bin, target FROM b WHERE p IS NOT NULL
           UNION ALL SELECT 'c_acctbal', a, target FROM b WHERE a IS NOT NULL)"""


def _binned_wide_cte() -> str:
    """Every feature of the train rows replaced by its bin label: CTE ``bt``."""
    joins = " ".join(f"LEFT JOIN (SELECT level, mapped FROM mp WHERE var = '{c}') m_{c} ON t.{c} = m_{c}.level"
                     for c in CATS)
    cols = ", ".join(
        [f"CASE WHEN t.{c} IS NULL THEN NULL ELSE COALESCE(m_{c}.mapped, 'Others') END AS {c}" for c in CATS]
        + [f"{_cut_case('t.o_totalprice', PRICE_CUTS)} AS o_totalprice",
           f"{_cut_case('t.c_acctbal', BAL_CUTS)} AS c_acctbal"])
    return f"""{_cat_raw_cte().replace('binned AS (', 'binned_raw AS (')},
bt AS (SELECT t.o_orderkey, t.target, {cols} FROM train t {joins})"""


def _all_binned_cte() -> str:
    unp = " UNION ALL ".join(f"SELECT '{c}' AS var, {c} AS bin, target FROM bt WHERE {c} IS NOT NULL"
                             for c in CATS + NUMS)
    return f"""{_binned_wide_cte()},
binned AS ({unp})"""


def _cramers_sql() -> str:
    cols = CATS + NUMS
    pairs = [(cols[i], cols[j]) for i in range(len(cols)) for j in range(len(cols)) if i < j]
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS var1, '{b}' AS var2, {a} AS l1, {b} AS l2 FROM bt "
        f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for a, b in pairs)
    dist = " UNION ALL ".join(f"SELECT '{c}' AS var, COUNT(DISTINCT {c}) AS d FROM bt" for c in cols)
    den = "n.n * (LEAST(d1.d, d2.d) - 1)"
    return f"""WITH {_binned_wide_cte()},
cells AS ({cells}),
obs AS (SELECT var1, var2, l1, l2, COUNT(*) AS o FROM cells GROUP BY ALL),
m AS (SELECT *, SUM(o) OVER (PARTITION BY var1, var2, l1) AS r, SUM(o) OVER (PARTITION BY var1, var2, l2) AS c,
             SUM(o) OVER (PARTITION BY var1, var2) AS nn FROM obs),
chi AS (SELECT var1, var2, ANY_VALUE(nn) * (SUM(o * o / (r * c)) - 1.0) AS chi2 FROM m GROUP BY ALL),
dist AS ({dist}),
n AS (SELECT COUNT(*) AS n FROM train)
SELECT chi.var1, chi.var2,
       {_r(f'sqrt(CASE WHEN {den} = 0 THEN NULL ELSE chi2 / ({den}) END)', 'CramersV')}
FROM chi JOIN dist d1 ON chi.var1 = d1.var JOIN dist d2 ON chi.var2 = d2.var CROSS JOIN n"""


# ---------------------------------------------------------------- queries

def woe_categorical_raw(spark, sf_dir):
    """Level counts, small levels -> Others, WOE/IV per level (no merging)."""
    counts = level_counts(_train(spark, sf_dir), CATS, "target")
    regrouped = (fold_small_levels(counts, 0.0025).groupBy("var", F.col("mapped").alias("bin"))
                 .agg(F.sum("badCnt").alias("badCnt"), F.sum("totalCnt").alias("totalCnt")))
    return rounded(woe_columns(regrouped))


register("woe_categorical_raw", _woe_sql(_cat_raw_cte()))(woe_categorical_raw)


def woe_numeric_fixed_edges(spark, sf_dir):
    """Right-closed bins from given cut points, WOE/IV per bin."""
    binned = apply_cuts(_train(spark, sf_dir), {"o_totalprice": PRICE_CUTS, "c_acctbal": BAL_CUTS})
    return rounded(woe_binned(binned, NUMS, "target"))


register("woe_numeric_fixed_edges", _woe_sql(_num_fixed_cte()))(woe_numeric_fixed_edges)


def iv_filter_q(spark, sf_dir):
    """Total IV per variable and the keep flag (IV >= 0.02)."""
    iv = iv_totals(woe_binned(_binned_train(spark, sf_dir), CATS + NUMS, "target"))
    return rounded(iv.withColumn("keep", F.col("IV") >= F.lit(0.02)))


register("iv_filter", f"""WITH woe AS ({_woe_sql(_all_binned_cte())})
SELECT var, IV, IV >= 0.02 AS keep FROM woe WHERE is_total""")(iv_filter_q)


def cramers_v_pairs(spark, sf_dir):
    """Cramér's V between every pair of binned variables."""
    return rounded(cramers_v(_binned_train(spark, sf_dir), CATS + NUMS))


register("cramers_v_pairs", _cramers_sql())(cramers_v_pairs)


def woe_regrouped(spark, sf_dir):
    """Manual regrouping of c_mktsegment, then its WOE table."""
    smap = structure_bin_map(spark, SEGMENT_STRUCTURE)
    binned = apply_level_bins(_train(spark, sf_dir), ["c_mktsegment"], smap)
    return rounded(woe_binned(binned, ["c_mktsegment"], "target"))


register("woe_regrouped", _woe_sql(f"""train AS ({_TRAIN_SQL}),
binned AS (SELECT 'c_mktsegment' AS var,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'AUTOMOBILE,BUILDING'
       WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN 'HOUSEHOLD,MACHINERY'
       ELSE 'FURNITURE,Others' END AS bin, target
  FROM train WHERE c_mktsegment IS NOT NULL)"""))(woe_regrouped)


def woe_categorical_merged(spark, sf_dir):
    """Categorical WOE with greedy bin merging (applyInPandas on level tables)."""
    train = _train(spark, sf_dir)
    return rounded(woe_categorical(train, CATS, "target", 0.06, 0.0025).drop("cuts"))


def _merged_woe_sql(min_pct: float = 0.06, floor: float = 0.0025, levels_sql: str | None = None) -> str:
    """C1-C6 with the greedy merges as recursive CTEs over each variable's levels
    ordered by bad rate (ties by level): pass 1 carries a small bin into the
    next, pass 2 folds a small last bin backwards, pass 3 carries bins without
    bads forward; then the WOE table."""
    unp = levels_sql or " UNION ALL ".join(
        f"SELECT '{c}' AS var, {c} AS level, target FROM train WHERE {c} IS NOT NULL" for c in CATS)
    bin_t = "STRUCT(names VARCHAR[], bad BIGINT, tot BIGINT)"
    return f"""WITH RECURSIVE train AS ({_TRAIN_SQL}),
lv AS ({unp}),
lc AS (SELECT var, level, CAST(SUM(target) AS BIGINT) AS bad, COUNT(*) AS tot FROM lv GROUP BY ALL),
mp AS (SELECT var, CASE WHEN tot / SUM(tot) OVER (PARTITION BY var) < {floor} THEN 'Others' ELSE level END AS level,
              bad, tot FROM lc),
rg AS (SELECT var, level, CAST(SUM(bad) AS BIGINT) AS bad, CAST(SUM(tot) AS BIGINT) AS tot FROM mp GROUP BY ALL),
ord AS (SELECT var, level, bad, tot,
               ROW_NUMBER() OVER (PARTITION BY var ORDER BY bad / tot, level) AS k,
               COUNT(*) OVER (PARTITION BY var) AS n, SUM(tot) OVER (PARTITION BY var) AS grand FROM rg),
p1(var, k, n, grand, c_names, c_bad, c_tot, out) AS (
  SELECT DISTINCT var, 0, n, grand, CAST([] AS VARCHAR[]), CAST(0 AS BIGINT), CAST(0 AS BIGINT),
         CAST([] AS {bin_t}[]) FROM ord
  UNION ALL
  SELECT p.var, p.k + 1, p.n, p.grand,
         CASE WHEN carry THEN nm ELSE CAST([] AS VARCHAR[]) END,
         CASE WHEN carry THEN b ELSE 0 END, CASE WHEN carry THEN t ELSE 0 END,
         CASE WHEN carry THEN p.out ELSE list_append(p.out, {{'names': nm, 'bad': b, 'tot': t}}) END
  FROM p1 p, LATERAL (SELECT list_append(p.c_names, o.level) AS nm, p.c_bad + o.bad AS b, p.c_tot + o.tot AS t,
                             (p.k + 1 < p.n AND (p.c_tot + o.tot) / p.grand < {min_pct}) AS carry
                      FROM ord o WHERE o.var = p.var AND o.k = p.k + 1) x),
b1 AS (SELECT var, grand, out FROM p1 WHERE k = n),
b2 AS (SELECT var, grand,
         CASE WHEN len(out) >= 2 AND out[len(out)].tot / grand < {min_pct}
              THEN list_append(out[1:len(out) - 2],
                     {{'names': list_concat(out[len(out) - 1].names, out[len(out)].names),
                       'bad': out[len(out) - 1].bad + out[len(out)].bad,
                       'tot': out[len(out) - 1].tot + out[len(out)].tot}})
              ELSE out END AS bins FROM b1),
e2 AS (SELECT var, UNNEST(bins) AS bn, generate_subscripts(bins, 1) AS k, len(bins) AS n FROM b2),
p3(var, k, n, c_names, c_bad, c_tot, out) AS (
  SELECT DISTINCT var, 0, n, CAST([] AS VARCHAR[]), CAST(0 AS BIGINT), CAST(0 AS BIGINT),
         CAST([] AS {bin_t}[]) FROM e2
  UNION ALL
  SELECT p.var, p.k + 1, p.n,
         CASE WHEN carry THEN nm ELSE CAST([] AS VARCHAR[]) END,
         CASE WHEN carry THEN b ELSE 0 END, CASE WHEN carry THEN t ELSE 0 END,
         CASE WHEN carry THEN p.out ELSE list_append(p.out, {{'names': nm, 'bad': b, 'tot': t}}) END
  FROM p3 p, LATERAL (SELECT list_concat(p.c_names, e.bn.names) AS nm, p.c_bad + e.bn.bad AS b,
                             p.c_tot + e.bn.tot AS t, (p.k + 1 < p.n AND p.c_bad + e.bn.bad = 0) AS carry
                      FROM e2 e WHERE e.var = p.var AND e.k = p.k + 1) x),
fin AS (SELECT var, UNNEST(out) AS bn, generate_subscripts(out, 1) AS bin_id FROM p3 WHERE k = n),
binned_cnt AS (SELECT var, CAST(bin_id AS INTEGER) AS bin_id, array_to_string(bn.names, ',') AS bin,
                      bn.bad AS badCnt, bn.tot AS totalCnt FROM fin),
t AS (SELECT *, totalCnt - badCnt AS goodCnt,
             SUM(badCnt) OVER (PARTITION BY var) AS tb, SUM(totalCnt - badCnt) OVER (PARTITION BY var) AS tg,
             SUM(totalCnt) OVER (PARTITION BY var) AS tt FROM binned_cnt),
d AS (SELECT *, CAST(badCnt AS DOUBLE) / tb AS bd, CAST(goodCnt AS DOUBLE) / tg AS gd FROM t),
w AS (SELECT *, CASE WHEN bd = 0 AND gd = 0 THEN 'nan'::DOUBLE WHEN bd = 0 THEN 'inf'::DOUBLE
                     WHEN gd = 0 THEN '-inf'::DOUBLE ELSE ln(gd / bd) END AS woe FROM d),
iv AS (SELECT *, woe * (gd - bd) AS iv FROM w)
SELECT var, bin_id, bin, FALSE AS is_total, badCnt, totalCnt, goodCnt, {_r('totalCnt / tt', 'popPercentage')},
       {_r('bd', 'badDistribution')}, {_r('gd', 'goodDistribution')}, {_r('gd - bd', 'distributedGoodBad')},
       {_r('woe', 'WOE')}, {_r('iv', 'IV')}, {_r('badCnt / totalCnt', 'badRate')}
FROM iv
UNION ALL
SELECT var, NULL, NULL, TRUE, CAST(SUM(badCnt) AS BIGINT), CAST(SUM(totalCnt) AS BIGINT),
       CAST(SUM(goodCnt) AS BIGINT), 1.0, 1.0, 1.0, 0.0, 0.0,
       {_r('COALESCE(SUM(CASE WHEN isfinite(iv) THEN iv END), 0.0)', 'IV')},
       {_r('SUM(badCnt) / SUM(totalCnt)', 'badRate')}
FROM iv GROUP BY var"""


register("woe_categorical", _merged_woe_sql())(woe_categorical_merged)


def tree_bins(spark, sf_dir):
    """Tree node table of the numeric variables (monotone leaf count)."""
    nodes, _ = tree_binning(_train(spark, sf_dir), NUMS, "target", 6, 0.0, [-1.0])
    return rounded(nodes)


def _tree_sql(leaves: int = 6, share: float = 0.06) -> str:
    """Best-first growth over all distinct values, one split a step, then every leaf count from the recorded splits."""
    def impurity(b, n):
        return f"({n} - ({b} * {b} + ({n} - {b}) * ({n} - {b})) / {n})"

    values = " UNION ALL ".join(f"SELECT '{c}' AS var, {c} AS value, target FROM train WHERE {c} IS NOT NULL" for c in NUMS)
    steps = []
    for k in range(leaves - 1):
        steps.append(f"""
n{k} AS (SELECT var, value, n, bad, len(list_filter(cuts, lambda c: c < value)) AS node FROM above JOIN cuts{k} USING (var)),
r{k} AS (SELECT *, SUM(n) OVER w AS nl, SUM(bad) OVER w AS bl, SUM(n) OVER (PARTITION BY var, node) AS nt,
         SUM(bad) OVER (PARTITION BY var, node) AS bt FROM n{k} WINDOW w AS (PARTITION BY var, node ORDER BY value)),
b{k} AS (SELECT var, node, value, nt, bt, nl, bl FROM r{k}, least WHERE nl < nt AND nl >= min_leaf AND nt - nl >= min_leaf
         QUALIFY row_number() OVER (PARTITION BY var, node ORDER BY
           {impurity('bl', 'nl')} + {impurity('(bt - bl)', '(nt - nl)')}, value) = 1),
g{k} AS (SELECT var, value FROM b{k} WHERE {impurity('bt', 'nt')} / nt > 1e-7
         QUALIFY row_number() OVER (PARTITION BY var ORDER BY
           {impurity('bt', 'nt')} - {impurity('bl', 'nl')} - {impurity('(bt - bl)', '(nt - nl)')} DESC) = 1),
cuts{k + 1} AS (SELECT var, CASE WHEN value IS NULL THEN cuts ELSE list_append(cuts, value) END AS cuts
                FROM cuts{k} LEFT JOIN g{k} USING (var))""")
    return f"""
train AS ({_TRAIN_SQL}),
vals AS ({values}),
least AS (SELECT round(COUNT(*) * {share})::BIGINT AS min_leaf FROM train),
above AS (SELECT var, value, COUNT(*)::DOUBLE AS n, SUM(target)::DOUBLE AS bad FROM vals WHERE value > 0 GROUP BY ALL),
cuts0 AS (SELECT DISTINCT var, CAST([] AS DOUBLE[]) AS cuts FROM above),{','.join(steps)},
counts AS (SELECT unnest(range(2, {leaves} + 1)) AS k),
leaf AS (SELECT var, k, 1 AS tree, len(list_filter(cuts[1:k - 1], lambda c: c < value)) AS node, MIN(value) AS amin,
         MAX(value) AS amax, SUM(bad) AS bad, SUM(n) AS n FROM above JOIN cuts{leaves - 1} USING (var), counts GROUP BY ALL
         UNION ALL
         SELECT var, k, 0, -1, MIN(value), MAX(value), SUM(target), COUNT(*) FROM vals, counts WHERE value <= 0 GROUP BY var, k),
sized AS (SELECT *, bad / n * 100.0 AS rate, SUM(n) OVER v AS tn, SUM(bad) OVER v AS tb,
          row_number() OVER (PARTITION BY var, k, tree ORDER BY amax) AS place,
          sign(bad / n * 100.0 - lead(bad / n * 100.0) OVER (PARTITION BY var, k ORDER BY amax, tree)) AS sgn
          FROM leaf WINDOW v AS (PARTITION BY var, k)),
monotone AS (SELECT var, k, COUNT(DISTINCT sgn) FILTER (WHERE tree = 1 AND sgn IS NOT NULL) = 1 AS good FROM sized GROUP BY var, k),
chosen AS (SELECT var, COALESCE(MAX(k) FILTER (WHERE good), 2) AS k FROM monotone GROUP BY var),
nodes AS (SELECT *, CASE WHEN bad = 0 AND n = bad THEN 'nan'::DOUBLE WHEN bad = 0 THEN 'inf'::DOUBLE WHEN n = bad THEN '-inf'::DOUBLE
                         ELSE ln(((n - bad) / (tn - tb)) / (bad / tb)) END * ((n - bad) / (tn - tb) - bad / tb) * 100.0 AS iv
          FROM sized JOIN chosen USING (var, k))"""


register("tree_bins", f"""WITH {_tree_sql()}
SELECT var, CAST(CASE WHEN tree = 0 THEN -1 ELSE place END AS INTEGER) AS node, FALSE AS is_total, {_r('amin', 'amin')}, {_r('amax', 'amax')},
       CAST(bad AS BIGINT) AS badCnt, CAST(n AS BIGINT) AS totalCnt, {_r('n / tn * 100.0', 'popPercentage')}, {_r('iv', 'IV')},
       {_r('rate', 'badRate')}, {_r('sgn', 'badSign')}, CAST(k AS INTEGER) AS n_leaves FROM nodes
UNION ALL
SELECT var, NULL, TRUE, {_r('MIN(amin)', 'amin')}, {_r('MAX(amax)', 'amax')}, CAST(SUM(bad) AS BIGINT), CAST(SUM(n) AS BIGINT), 100.0,
       {_r('SUM(iv) FILTER (WHERE isfinite(iv))', 'IV')}, {_r('SUM(bad) / SUM(n) * 100.0', 'badRate')}, NULL, CAST(k AS INTEGER)
FROM nodes GROUP BY var, k""")(tree_bins)


def tree_cuts(spark, sf_dir):
    """C11: the cut points that the tree gives each numeric variable, in order."""
    _, cuts = tree_binning(_train(spark, sf_dir), NUMS, "target", 6, 0.0, [-1.0])
    return rounded(spark.createDataFrame([(v, i, float(c)) for v, points in cuts.items() for i, c in enumerate(points)],
                                         "var string, place int, cut double"))


register("tree_cuts", f"""WITH {_tree_sql()},
ends AS (SELECT var, amax AS cut FROM nodes WHERE rate > 0 AND rate < 100
         QUALIFY row_number() OVER (PARTITION BY var ORDER BY amax DESC, tree DESC) > 1
         UNION SELECT DISTINCT var, -1.0 FROM vals UNION SELECT DISTINCT var, unnest(['-inf'::DOUBLE, 'inf'::DOUBLE]) FROM vals)
SELECT var, CAST(row_number() OVER (PARTITION BY var ORDER BY cut) - 1 AS INTEGER) AS place, {_r('cut', 'cut')} FROM ends""")(tree_cuts)


def cramers_v_selection(spark, sf_dir):
    """C17: greedy elimination over the pair table (cv_max 0.6) with variable IVs."""
    binned = _binned_train(spark, sf_dir)
    iv = iv_totals(woe_binned(binned, CATS + NUMS, "target"))
    dropped, table = cramers_v_select(cramers_v(binned, CATS + NUMS), iv, 0.6)
    return rounded(table.withColumn("dropped_count", F.lit(len(dropped))))


def _cramers_select_sql(cv_max: float = 0.6) -> str:
    """Pairs with both IVs plus the number of variables the greedy elimination drops.

    The elimination is a recursive CTE: each step takes the highest remaining
    pair above ``cv_max`` and drops its lower-IV member (var1 on ties)."""
    pairs = _cramers_sql().replace("SELECT chi.var1, chi.var2,", "SELECT chi.var1, chi.var2, ", 1)
    woe = _woe_sql(_all_binned_cte())
    return f"""WITH RECURSIVE pv AS ({pairs}),
iv AS (SELECT var, IV FROM ({woe}) WHERE is_total),
tab AS (SELECT pv.var1, pv.var2, pv.CramersV, i1.IV AS var1_IV, i2.IV AS var2_IV
        FROM pv LEFT JOIN iv i1 ON pv.var1 = i1.var LEFT JOIN iv i2 ON pv.var2 = i2.var),
sel(step, dropped) AS (
  SELECT 0, CAST([] AS VARCHAR[])
  UNION ALL
  SELECT step + 1, list_append(dropped, victim) FROM (
    SELECT s.step, s.dropped,
      (SELECT CASE WHEN COALESCE(t.var1_IV, '-inf'::DOUBLE) > COALESCE(t.var2_IV, '-inf'::DOUBLE)
                   THEN t.var2 ELSE t.var1 END
       FROM tab t WHERE t.CramersV > {cv_max} AND NOT list_contains(s.dropped, t.var1)
                    AND NOT list_contains(s.dropped, t.var2)
       ORDER BY t.CramersV DESC, t.var1, t.var2 LIMIT 1) AS victim
    FROM sel s) x
  WHERE victim IS NOT NULL)
SELECT var1, var2, CramersV, var1_IV, var2_IV,
       CAST((SELECT MAX(step) FROM sel) AS INTEGER) AS dropped_count FROM tab"""


register("cramers_v_select", _cramers_select_sql())(cramers_v_selection)


def scorecard_final(spark, sf_dir):
    """C1-C20 chain: profile, split, both WOE fits, IV filter, Cramér's V, manual
    regrouping, final WOE. The driver tables are random, so every IV is far
    below the usual 0.02; the chain keeps variables from IV 0.001 up."""
    sc = Scorecard(scorecard_base(spark, sf_dir), "target", KEY).run(SEGMENT_STRUCTURE, iv_min=0.001)
    out = materialised(rounded(sc.woe_scaled))
    sc.release()
    return out


register("scorecard_final")(scorecard_final)


# Columns that are related: a hint that mostly tells the target of every fourth order, and two binnings of one price.
RELATED = ["c_mktsegment", "hint", "price_band", "price_bin"]
BAND_CUTS = [-INF, 100000.0, 200000.0, INF]


def related_selection(spark, sf_dir):
    """C15/C17 on related columns: total IV, the keep flag, and which variables the elimination drops by name."""
    told = (F.col("target") == 1) != (F.col("o_orderkey") % 12 == 0)
    hint = F.when(F.col("o_orderkey") % 4 != 0, "none").when(told, "bad").otherwise("good")
    train = _train(spark, sf_dir).withColumns(
        {"hint": hint, "price_band": F.col("o_totalprice"), "price_bin": F.col("o_totalprice")})
    binned = apply_cuts(train, {"price_band": BAND_CUTS, "price_bin": PRICE_CUTS}).select("target", *RELATED)
    iv = iv_totals(woe_binned(binned, RELATED, "target"))
    dropped, _ = cramers_v_select(cramers_v(binned, RELATED), iv, 0.6)
    return rounded(iv.withColumn("keep", F.col("IV") >= F.lit(0.02)).withColumn("dropped", F.col("var").isin(dropped)))


def _related_sql() -> str:
    unpivoted = " UNION ALL ".join(f"SELECT '{c}' AS var, {c} AS bin, target FROM bt WHERE {c} IS NOT NULL" for c in RELATED)
    woe = _woe_sql(f"""train AS ({_TRAIN_SQL}),
bt AS (SELECT target, c_mktsegment, CASE WHEN o_orderkey % 4 <> 0 THEN 'none'
            WHEN (target = 1) <> (o_orderkey % 12 = 0) THEN 'bad' ELSE 'good' END AS hint,
       {_cut_case('o_totalprice', BAND_CUTS)} AS price_band, {_cut_case('o_totalprice', PRICE_CUTS)} AS price_bin FROM train),
binned AS ({unpivoted})""")
    pairs = [(a, b) for i, a in enumerate(RELATED) for b in RELATED[i + 1:]]
    train = f"""SELECT target, c_mktsegment,
       CASE WHEN o_orderkey % 4 <> 0 THEN 'none'
            WHEN (target = 1) <> (o_orderkey % 12 = 0) THEN 'bad' ELSE 'good' END AS hint,
       {_cut_case('o_totalprice', BAND_CUTS)} AS price_band, {_cut_case('o_totalprice', PRICE_CUTS)} AS price_bin
       FROM ({_TRAIN_SQL})"""
    cells = " UNION ALL ".join(f"SELECT '{a}' AS var1, '{b}' AS var2, {a} AS l1, {b} AS l2 FROM rel" for a, b in pairs)
    return f"""WITH woe AS ({woe}), ivs AS (SELECT var, IV FROM woe WHERE is_total),
rel AS ({train}), cells AS ({cells}),
obs AS (SELECT var1, var2, l1, l2, COUNT(*) AS o FROM cells GROUP BY ALL),
m AS (SELECT *, SUM(o) OVER (PARTITION BY var1, var2, l1) AS r, SUM(o) OVER (PARTITION BY var1, var2, l2) AS c FROM obs),
v AS (SELECT var1, var2, SQRT((SUM(o * o / (r * c)) - 1.0) / (LEAST(COUNT(DISTINCT l1), COUNT(DISTINCT l2)) - 1)) AS v
      FROM m GROUP BY ALL),
gone AS (SELECT CASE WHEN a.IV > b.IV THEN v.var2 ELSE v.var1 END AS var
         FROM v JOIN ivs a ON a.var = v.var1 JOIN ivs b ON b.var = v.var2 WHERE v.v > 0.6)
SELECT var, IV, IV >= 0.02 AS keep, var IN (SELECT var FROM gone) AS dropped FROM ivs"""


register("related_selection", _related_sql())(related_selection)


#: Share of the rows below which a level of ``levels_replaced`` is folded: some nations are, some are not.
NATION_FLOOR = 0.04


def levels_replaced(spark, sf_dir):
    """Every train row's levels replaced by their bin labels; folded nations get the bin that holds Others."""
    train = _train(spark, sf_dir)
    folded = fold_small_levels(level_counts(train, CATS, "target"), NATION_FLOOR)
    kept = folded.where(F.col("mapped") != "Others")
    bins = kept.select("var", "level", F.concat(F.lit("bin:"), "mapped").alias("bin"), F.lit("Others").alias("others_bin"))
    return apply_level_bins(train, CATS, bins).select("o_orderkey", *CATS)


register("levels_replaced", f"""
WITH train AS ({_TRAIN_SQL}),
{", ".join(f"k{i} AS (SELECT {c} AS level FROM train GROUP BY 1 HAVING COUNT(*) / (SELECT COUNT(*) FROM train)::DOUBLE >= {NATION_FLOOR})"
           for i, c in enumerate(CATS))}
SELECT o_orderkey, {", ".join(f"CASE WHEN {c} IN (SELECT level FROM k{i}) THEN 'bin:' || {c} ELSE 'Others' END AS {c}" for i, c in enumerate(CATS))}
FROM train""")(levels_replaced)
