"""Scorecard building blocks (C1-C7, C12-C19): level counts, small-level folding,
greedy bin merging, WOE/IV tables, bin application, Cramér's V selection.

Row-level work is one unpivot + ``groupBy(var, level)`` for all variables at
once. Python only sees per-variable level tables after folding: a level
survives only with a share >= ``small_sample_floor``, so a variable has at most
``1/small_sample_floor + 1`` rows in the merge UDF (401 with the default).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INF = float("inf")
# Fixed value: label of the bin that collects small levels.
OTHERS = "Others"

# Names of the report columns.
WOE_COLS = ["badCnt", "totalCnt", "goodCnt", "popPercentage", "badDistribution", "goodDistribution",
            "distributedGoodBad", "WOE", "IV", "badRate"]


def unpivot_levels(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """(var, level string, target) rows for non-null levels."""
    arr = F.array(*[F.struct(F.lit(c).alias("var"), F.col(f"`{c}`").cast("string").alias("level"))
                    for c in cols])
    return (df.select(F.explode(arr).alias("s"), F.col(target).alias("__t"))
            .select("s.var", "s.level", "__t").where(F.col("level").isNotNull()))


def level_counts(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """badCnt (sum of the 0/1 target) and totalCnt per (var, level)."""
    return (unpivot_levels(df, cols, target).groupBy("var", "level")
            .agg(F.sum("__t").cast("long").alias("badCnt"), F.count(F.lit(1)).alias("totalCnt")))


def fold_small_levels(counts: DataFrame, floor: float = 0.0025) -> DataFrame:
    """Levels with share < floor -> 'Others' (C2); returns (var, level, mapped, badCnt, totalCnt).

    The level table can be as long as a column's cardinality, so the share uses
    a per-variable total (one row per variable, broadcast) rather than a window
    that would put every level of a variable in one task.
    """
    totals = counts.groupBy("var").agg(F.sum("totalCnt").alias("__all"))
    return (counts.join(F.broadcast(totals), "var")
            .withColumn("mapped", F.when(F.col("totalCnt") / F.col("__all") < F.lit(floor), F.lit(OTHERS))
                        .otherwise(F.col("level")))
            .drop("__all"))


def woe_columns(bins: DataFrame, key: str = "var", iv_scale: float = 1.0,
                total_iv: str = "finite") -> DataFrame:
    """Add WOE/IV columns and the per-variable total row.

    ``bins`` has (key, <bin columns>, badCnt, totalCnt), one row per bin, at
    most a few hundred rows per variable. WOE = ln(goodDist / badDist) with
    explicit branches: no bads -> +inf, no goods -> -inf, neither -> NaN.
    The total row has IV = sum of the finite bin IVs.
    """
    w = Window.partitionBy(key)
    t = (bins.withColumn("goodCnt", F.col("totalCnt") - F.col("badCnt"))
         .withColumn("__tb", F.sum("badCnt").over(w))
         .withColumn("__tg", F.sum("goodCnt").over(w))
         .withColumn("__tt", F.sum("totalCnt").over(w)))
    bd = F.try_divide(F.col("badCnt").cast("double"), F.col("__tb"))
    gd = F.try_divide(F.col("goodCnt").cast("double"), F.col("__tg"))
    t = (t.withColumn("popPercentage", F.col("totalCnt") / F.col("__tt"))
         .withColumn("badRate", F.col("badCnt") / F.col("totalCnt"))
         .withColumn("badDistribution", bd)
         .withColumn("goodDistribution", gd)
         .withColumn("distributedGoodBad", F.col("goodDistribution") - F.col("badDistribution")))
    b, g = F.col("badDistribution"), F.col("goodDistribution")
    woe = (F.when(b.isNull() | g.isNull(), F.lit(None).cast("double"))
           .when((b == 0) & (g == 0), F.lit(float("nan")))
           .when(b == 0, F.lit(INF)).when(g == 0, F.lit(-INF))
           .otherwise(F.log(g / b)))
    t = (t.withColumn("WOE", woe)
         .withColumn("IV", F.col("WOE") * F.col("distributedGoodBad") * F.lit(iv_scale))
         .withColumn("is_total", F.lit(False)))
    finite = F.abs(F.col("IV")) < F.lit(INF)
    iv_sum = (F.sum(F.when(finite, F.col("IV"))) if total_iv == "finite" else F.sum("IV"))
    total = (t.groupBy(key).agg(F.sum("badCnt").alias("badCnt"), F.sum("totalCnt").alias("totalCnt"),
                                F.coalesce(iv_sum, F.lit(0.0)).alias("IV"))
             .select(key, "badCnt", "totalCnt", (F.col("totalCnt") - F.col("badCnt")).alias("goodCnt"),
                     F.lit(1.0).alias("popPercentage"),
                     (F.col("badCnt") / F.col("totalCnt")).alias("badRate"),
                     F.lit(1.0).alias("badDistribution"), F.lit(1.0).alias("goodDistribution"),
                     F.lit(0.0).alias("distributedGoodBad"), F.lit(0.0).alias("WOE"), "IV",
                     F.lit(True).alias("is_total")))
    out = t.drop("__tb", "__tg", "__tt").unionByName(total, allowMissingColumns=True)
    extra = [c for c in bins.columns if c not in (key, "badCnt", "totalCnt")]
    return out.select(key, *extra, "is_total", *WOE_COLS)


def merge_level_bins(pdf: pd.DataFrame, min_pct: float = 0.06) -> list[tuple[list[str], int, int]]:
    """Greedy merge of one variable's level table.

    Levels sorted by bad rate (ties by level name) are scanned once: a bin
    under ``min_pct`` of the rows is merged into the next bin (C3); a last bin
    still under the minimum joins the one before it (C4); bins without bads are
    merged forward (C5, the last bin excepted). Returns [(levels, bad, total)].
    """
    pdf = pdf.assign(rate=pdf["badCnt"] / pdf["totalCnt"]).sort_values(["rate", "level"], kind="mergesort")
    bins = [([str(lvl)], int(bad), int(total)) for lvl, bad, total in zip(pdf["level"], pdf["badCnt"], pdf["totalCnt"], strict=True)]
    rows = float(sum(b[2] for b in bins))

    def joined(a, b):
        return a[0] + b[0], a[1] + b[1], a[2] + b[2]

    def closed(bins, unfinished):
        """Bins filled from left to right; one is closed as soon as it is no longer ``unfinished``, or at the end."""
        out, filling = [], ([], 0, 0)
        for b in bins:
            filling = joined(filling, b)
            if not unfinished(filling):
                out.append(filling)
                filling = ([], 0, 0)
        return out + [filling] * bool(filling[0])

    bins = closed(bins, lambda b: b[2] / rows < min_pct)
    if len(bins) > 1 and bins[-1][2] / rows < min_pct:
        bins[-2:] = [joined(bins[-2], bins[-1])]
    return closed(bins, lambda b: b[1] == 0)


MERGED_SCHEMA = "var string, bin_id int, cuts array<string>, badCnt long, totalCnt long"


def merged_bins(level_table: DataFrame, min_pct: float = 0.06) -> DataFrame:
    """Run the greedy merge per variable with ``applyInPandas`` (bounded groups)."""
    def per_var(pdf: pd.DataFrame) -> pd.DataFrame:
        var = pdf["var"].iloc[0]
        rows = merge_level_bins(pdf, min_pct)
        return pd.DataFrame({"var": [var] * len(rows), "bin_id": list(range(1, len(rows) + 1)),
                             "cuts": [r[0] for r in rows], "badCnt": [r[1] for r in rows],
                             "totalCnt": [r[2] for r in rows]})
    return level_table.groupBy("var").applyInPandas(per_var, MERGED_SCHEMA)


def woe_categorical(train: DataFrame, cols: list[str], target: str, min_pct: float = 0.06,
                    floor: float = 0.0025) -> DataFrame:
    """Categorical WOE table (C1-C6): var, bin_id, cuts, bin, is_total, WOE columns."""
    counts = level_counts(train, cols, target)
    regrouped = (fold_small_levels(counts, floor)
                 .groupBy("var", F.col("mapped").alias("level"))
                 .agg(F.sum("badCnt").alias("badCnt"), F.sum("totalCnt").alias("totalCnt")))
    merged = merged_bins(regrouped, min_pct)
    # The merged table is report-sized (<= 1/floor + 1 rows per variable): materialise it
    # once so the pandas step is not re-run for every use in the WOE table.
    bins = train.sparkSession.createDataFrame(merged.collect(), merged.schema) \
        .withColumn("bin", F.array_join("cuts", ","))
    return woe_columns(bins.select("var", "bin_id", "bin", "cuts", "badCnt", "totalCnt"))


def level_bin_map(woe_cat: DataFrame) -> DataFrame:
    """(var, level, bin) for every level named in a bin, plus each variable's
    fallback bin (the one holding 'Others', null if none) (C7/J5)."""
    bins = woe_cat.where(~F.col("is_total")).select("var", "bin", "cuts")
    levels = bins.select("var", "bin", F.explode("cuts").alias("level"))
    others = (levels.where(F.col("level") == OTHERS).groupBy("var")
              .agg(F.first("bin").alias("others_bin")))
    return levels.join(others, "var", "left")


def apply_level_bins(df: DataFrame, cols: list[str], bin_map: DataFrame) -> DataFrame:
    """Replace each categorical column by its bin label; null and unknown levels get
    the 'Others' bin of that variable, null when it has none (C7/C18).

    The map is joined per column, however many levels it has; the fallback
    labels are one string per variable.
    """
    fallback = {r["var"]: r["others_bin"] for r in
                bin_map.where(F.col("others_bin").isNotNull()).select("var", "others_bin").distinct().collect()}
    out = df
    for c in cols:
        m = (bin_map.where(F.col("var") == c)
             .select(F.col("level").alias(f"__l_{c}"), F.col("bin").alias(f"__b_{c}")))
        out = (out.join(m, out[c].cast("string") == m[f"__l_{c}"], "left")
               .withColumn(c, F.coalesce(F.col(f"__b_{c}"), F.lit(fallback.get(c)).cast("string")))
               .drop(f"__l_{c}", f"__b_{c}"))
    return out


def cut_label_expr(x: Column, cuts: list[float]) -> Column:
    """Right-closed bin label of ``x`` for sorted cut points (C12); null outside."""
    if len(cuts) < 2:
        return F.lit(None).cast("string")
    expr = F.when(x.isNull() | (x <= F.lit(cuts[0])), F.lit(None).cast("string"))
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        expr = expr.when(x <= F.lit(hi), F.lit(_fmt_interval(lo, hi)))
    return expr.otherwise(F.lit(None).cast("string"))


def _fmt_num(v: float) -> str:
    if math.isinf(v):
        return "inf" if v > 0 else "-inf"
    return repr(float(v))


def _fmt_interval(lo: float, hi: float) -> str:
    return f"({_fmt_num(lo)}, {_fmt_num(hi)}]"


def apply_cuts(df: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Bin numeric columns with per-variable cut points."""
    return df.withColumns({c: cut_label_expr(F.col(c).cast("double"), cs) for c, cs in cuts.items()})


def woe_binned(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """WOE table over already-binned columns (C13/C19): (var, bin, is_total, WOE columns)."""
    if not cols:
        empty = df.sparkSession.createDataFrame([], "var string, bin string, badCnt long, totalCnt long")
        return woe_columns(empty)
    counts = (unpivot_levels(df, cols, target).groupBy("var", F.col("level").alias("bin"))
              .agg(F.sum("__t").cast("long").alias("badCnt"), F.count(F.lit(1)).alias("totalCnt")))
    return woe_columns(counts)


def iv_totals(woe_table: DataFrame) -> DataFrame:
    """Total IV per variable (C14): (var, IV)."""
    return woe_table.where(F.col("is_total")).select("var", "IV")


def iv_filter(iv: DataFrame, iv_min: float = 0.02) -> tuple[list[str], list[str]]:
    """Variables kept / dropped by total IV (C15); one row per variable."""
    rows = iv.collect()
    keep = [r["var"] for r in rows if r["IV"] is not None and r["IV"] >= iv_min]
    drop = [r["var"] for r in rows if r["var"] not in keep]
    return keep, drop


#: Rows whose levels are crossed at once, and contingency cells a task holds before it hands them on.
CROSSED_ROWS, HELD_CELLS = 1 << 15, 1 << 21


class _Crossed:
    """Contingency cells of all column pairs over some rows of a task.

    The levels of all columns are numbered once per task; a cell is (number of
    the first level, number of the second), so one sorted list of numbers with
    counts holds every pair's table.
    """

    def __init__(self, k: int):
        self.k, self.held, self.size = k, [], 0
        self.numbers: list[dict] = [{} for _ in range(k)]
        self.levels: list[tuple[int, str | None]] = []

    def add(self, columns: list[pa.Array]) -> None:
        codes = np.empty((len(columns[0]), self.k), np.int64)
        for i, c in enumerate(columns):
            local = c.dictionary_encode(null_encoding="encode")
            known = self.numbers[i]
            own = np.empty(len(local.dictionary), np.int64)
            for j, level in enumerate(local.dictionary.to_pylist()):
                if level not in known:
                    known[level] = len(self.levels)
                    self.levels.append((i, level))
                own[j] = known[level]
            codes[:, i] = own[local.indices.to_numpy()]
        width = len(self.levels)
        for i in range(self.k - 1):
            present, first = np.unique(codes[:, i], return_inverse=True)
            keys = (first[:, None] * width + codes[:, i + 1:]).ravel()
            if len(present) * width <= 1 << 22:
                counts = np.bincount(keys, minlength=0)
                keys = np.flatnonzero(counts)
                counts = counts[keys]
            else:
                keys, counts = np.unique(keys, return_counts=True)
            self.held.append(((present[keys // width] << 32) | (keys % width), counts))
            self.size += len(keys)
        if self.size > HELD_CELLS:
            self.merge()

    def merge(self) -> None:
        keys, counts = (np.concatenate(c) for c in zip(*self.held, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        self.held = [(keys[first], np.add.reduceat(counts, first))] if len(keys) else []
        self.size = len(first) if len(keys) else 0

    def rows(self) -> pa.RecordBatch:
        self.merge()
        keys, counts = self.held[0] if self.held else (np.empty(0, np.int64), np.empty(0, np.int64))
        column = np.array([c for c, _ in self.levels], np.int32)
        name = pa.array([n for _, n in self.levels], pa.string())
        a, b = keys >> 32, keys & 0xFFFFFFFF
        return pa.RecordBatch.from_arrays([pa.array(column[a]), pa.array(column[b]), name.take(pa.array(a)), name.take(pa.array(b)),
                                           pa.array(counts)], ["i", "j", "l1", "l2", "o"])


def _crossing(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crossed = _Crossed(k)
        for batch in batches:
            for at in range(0, len(batch), CROSSED_ROWS):
                crossed.add([c.slice(at, CROSSED_ROWS) for c in batch.columns])
                if crossed.size > HELD_CELLS // 2 or len(crossed.levels) > HELD_CELLS:
                    yield crossed.rows()
                    crossed = _Crossed(k)
        if crossed.held:
            yield crossed.rows()
    return run


def contingency(df: DataFrame, cols: list[str]) -> DataFrame:
    """(i, j, l1, l2, o): cells of the table of every column pair i < j, missing levels included as null.

    Each task counts all pairs over its rows and sends one row per cell that
    occurs, so what is shuffled follows the cells, not the rows.
    """
    levels = df.select(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(cols)])
    cells = levels.mapInArrow(_crossing(len(cols)), "i int, j int, l1 string, l2 string, o long")
    return cells.groupBy("i", "j", "l1", "l2").agg(F.sum("o").alias("o"))


def cramers_v(df: DataFrame, cols: list[str]) -> DataFrame:
    """Cramér's V for every column pair i < j in ``cols`` order (C16), no
    continuity correction: V = sqrt(chi2 / (n * (min(r, c) - 1))).

    Everything follows from the cells of ``contingency``: n (all rows), r and c
    (distinct levels) and chi2 = N * (sum O^2/(R*C) - 1) over the cells without
    a missing level, N their total.
    """
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "var1 string, var2 string, CramersV double")
    full = F.col("l1").isNotNull() & F.col("l2").isNotNull()
    rows, columns = Window.partitionBy("i", "j", "l1"), Window.partitionBy("i", "j", "l2")
    cells = (contingency(df, cols).withColumn("f", F.when(full, F.col("o")))
             .withColumn("R", F.sum("f").over(rows))
             .withColumn("one1", F.when(F.col("l1").isNotNull(), (F.row_number().over(rows.orderBy("l2")) == 1).cast("long")))
             .withColumn("C", F.sum("f").over(columns))
             .withColumn("one2", F.when(F.col("l2").isNotNull(), (F.row_number().over(columns.orderBy("l1")) == 1).cast("long"))))
    table = cells.groupBy("i", "j").agg(
        F.sum("o").alias("n"), F.sum("f").alias("full"), F.sum(F.col("f") * F.col("f") / (F.col("R") * F.col("C"))).alias("s"),
        F.sum("one1").alias("d1"), F.sum("one2").alias("d2"))
    names = F.array(*[F.lit(c) for c in cols])
    chi2 = F.col("full") * (F.col("s") - 1.0)
    return (table.where(F.col("full").isNotNull())
            .select(F.element_at(names, F.col("i") + 1).alias("var1"), F.element_at(names, F.col("j") + 1).alias("var2"),
                    F.sqrt(F.try_divide(chi2, F.col("n") * (F.least("d1", "d2") - 1))).alias("CramersV")))


def cramers_v_select(pairs: DataFrame, iv: DataFrame, cv_max: float = 0.6) -> tuple[list[str], DataFrame]:
    """Greedy elimination (C17): pairs above ``cv_max`` from the highest V down; one whose members
    are both still there loses its lower-IV member (var1 on ties).

    Returns (dropped variables, pair table with var1_IV / var2_IV). The pair
    table has one row per column pair, so the loop runs on collected rows.
    """
    iv1 = iv.select(F.col("var").alias("var1"), F.col("IV").alias("var1_IV"))
    iv2 = iv.select(F.col("var").alias("var2"), F.col("IV").alias("var2_IV"))
    table = pairs.join(iv1, "var1", "left").join(iv2, "var2", "left").select(
        "var1", "var2", "CramersV", "var1_IV", "var2_IV")
    strong = sorted((r for r in table.collect() if r["CramersV"] is not None and r["CramersV"] > cv_max),
                    key=lambda r: (-r["CramersV"], r["var1"], r["var2"]))
    dropped: dict[str, None] = {}  # in the order they fall
    for r in strong:
        if r["var1"] not in dropped and r["var2"] not in dropped:
            first, second = (-INF if r[c] is None else r[c] for c in ("var1_IV", "var2_IV"))
            dropped[r["var2"] if first > second else r["var1"]] = None
    return list(dropped), table


def structure_bin_map(spark, structure: dict[str, list[list[str]]]) -> DataFrame:
    """Manual regrouping (C18): var -> list of level lists, as a bin map table."""
    rows = []
    for var, groups in structure.items():
        others = next((",".join(g) for g in groups if OTHERS in g), None)
        for g in groups:
            label = ",".join(g)
            for lvl in g:
                rows.append((var, label, lvl, others))
    return spark.createDataFrame(rows, "var string, bin string, level string, others_bin string")
