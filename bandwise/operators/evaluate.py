"""Banded model evaluation: KS/Gini tables (V1-V6, V9), classification metrics (V7).

The raw rows are touched once per table: a band CASE expression and one
``groupBy(band)`` (partial aggregation map-side, at most ``bins`` groups).
All running sums, shares and lags then run on that tiny banded table, so the
un-partitioned windows below never see more than ``bins`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandwise.operators.bins import band_bounds, band_expr, quantile_edges, quantile_probs
from bandwise.operators.quantiles import interpolate, selected_ranks


def event_flag(target: Column | str, event=1) -> Column:
    """1 when target == event, else 0 (null counts as non-event)."""
    t = F.col(target) if isinstance(target, str) else target
    return F.when(t == F.lit(event), F.lit(1)).otherwise(F.lit(0))


def band_counts(df: DataFrame, band_col: str, flag_col: str,
                event_name: str = "Event", total_name: str = "Total") -> DataFrame:
    """Event sum and row count per band (A3); null bands are dropped."""
    return (df.where(F.col(band_col).isNotNull())
            .groupBy(band_col)
            .agg(F.sum(flag_col).cast("long").alias(event_name),
                 F.count(F.lit(1)).alias(total_name)))


def ks_gini_table(counts: DataFrame, band_col: str = "band_id", event_name: str = "Event",
                  total_name: str = "Total", ascending: bool = False,
                  non_prefix: str = "Non_") -> DataFrame:
    """KS/Gini table from a banded count table (V1), plus the grand-total row.

    Output columns: the band column(s) from ``counts``, ``is_total``,
    Total, Event, Non_Event, Cumulative_Non_Event, Cumulative_Event,
    Population_%, Cumulative_Non_Event_%, Cumulative_Event_%, Difference,
    Event_rate, Gini. On the total row cumulatives equal the totals and Gini
    is null.
    """
    ev, tot = event_name, total_name
    non = f"{non_prefix}{ev}"
    cnon, cev = f"Cumulative_{non}", f"Cumulative_{ev}"
    base = counts.where(F.col(tot).isNotNull())
    order = F.col(band_col).asc() if ascending else F.col(band_col).desc()
    w_run = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    w_all = Window.partitionBy(F.lit(1))
    w_lag = Window.orderBy(order)
    t = (base
         .withColumn(non, F.col(tot) - F.col(ev))
         .withColumn(cnon, F.sum(non).over(w_run))
         .withColumn(cev, F.sum(ev).over(w_run))
         .withColumn("__tt", F.sum(tot).over(w_all))
         .withColumn("__te", F.sum(ev).over(w_all))
         .withColumn("__tn", F.sum(non).over(w_all)))
    t = (t.withColumn("Population_%", F.try_divide(F.col(tot).cast("double"), F.col("__tt")))
         .withColumn(f"{cnon}_%", F.try_divide(F.col(cnon).cast("double"), F.col("__tn")))
         .withColumn(f"{cev}_%", F.try_divide(F.col(cev).cast("double"), F.col("__te")))
         .withColumn("Difference", F.col(f"{cev}_%") - F.col(f"{cnon}_%"))
         .withColumn(f"{ev}_rate", F.try_divide(F.col(ev).cast("double"), F.col(tot)))
         .withColumn("Gini", (F.col(f"{cev}_%") + F.lag(f"{cev}_%", 1, 0.0).over(w_lag)) / 2.0
                     * (F.col(f"{cnon}_%") - F.lag(f"{cnon}_%", 1, 0.0).over(w_lag)))
         .withColumn("is_total", F.lit(False))
         .drop("__tt", "__te", "__tn"))
    total = base.agg(F.sum(tot).alias(tot), F.sum(ev).alias(ev)).select(
        F.lit(True).alias("is_total"),
        F.col(tot), F.col(ev),
        (F.col(tot) - F.col(ev)).alias(non),
        (F.col(tot) - F.col(ev)).alias(cnon),
        F.col(ev).alias(cev),
        F.lit(1.0).alias("Population_%"),
        F.lit(1.0).alias(f"{cnon}_%"),
        F.lit(1.0).alias(f"{cev}_%"),
        F.lit(0.0).alias("Difference"),
        F.try_divide(F.col(ev).cast("double"), F.col(tot)).alias(f"{ev}_rate"),
        F.lit(None).cast("double").alias("Gini"),
    )
    out = t.unionByName(total, allowMissingColumns=True)
    band_cols = [c for c in counts.columns if c not in (ev, tot)]
    ordered = band_cols + ["is_total", tot, ev, non, cnon, cev, "Population_%", f"{cnon}_%",
                           f"{cev}_%", "Difference", f"{ev}_rate", "Gini"]
    # O2: bands in order, the total last; a row per band.
    return out.select(*ordered).orderBy("is_total", order)


def ks_gini_summary(table: DataFrame) -> DataFrame:
    """KS = 100*max(Difference); Gini = 100*(2*sum(Gini terms) - 1), band rows only."""
    bands = table.where(~F.col("is_total"))
    return bands.agg(
        (F.max("Difference") * 100.0).alias("KS"),
        ((F.sum("Gini") * 2.0 - 1.0) * 100.0).alias("Gini"),
        F.count(F.lit(1)).alias("n_bands"),
    )


def score_performance(df: DataFrame, score_col: str, target_col: str, event=1, bins: int = 10,
                      edges: list[float] | None = None, edge_rule: str = "extend01",
                      round_digits: int | None = 12, ascending: bool = False,
                      event_name: str = "Event", total_name: str = "Total",
                      non_prefix: str = "Non_", method: str = "exact"):
    """Band a score column and return ``(ks_gini_table, edges)`` (V2/V3/V6).

    With ``edges`` given (the train edges) the rows are banded with them
    (test-set mode); otherwise quantile edges are computed from ``df``.
    """
    score = F.col(score_col).cast("double")
    base = df.select(F.when(~F.isnan(score), score).alias("__score"),  # NaN counts as missing
                     event_flag(target_col, event).alias("__flag"))
    counts = None
    if edges is None and method == "exact":
        edges, counts = _edges_and_counts(base, bins, edge_rule, round_digits, event_name, total_name)
    elif edges is None:
        edges = quantile_edges(base, "__score", bins=bins, edge_rule=edge_rule,
                               round_digits=round_digits, method=method)
    if counts is None:
        banded = base.select(band_expr("__score", edges).alias("band_id"), "__flag")
        counts = band_counts(banded, "band_id", "__flag", event_name, total_name)
        lo, hi = band_bounds("band_id", edges)
        counts = counts.select("band_id", lo.alias("band_lo"), hi.alias("band_hi"), event_name, total_name)
    table = ks_gini_table(counts, "band_id", event_name, total_name, ascending, non_prefix)
    return table, edges


def _edges_and_counts(base: DataFrame, bins: int, edge_rule: str, round_digits, event_name: str,
                      total_name: str):
    """Quantile edges and, when it is exact, the banded counts without another pass.

    The ranked distinct-value table carries running row and event counts. An
    interior edge is interpolated between two adjacent order statistics, so
    "rows <= edge" is the running count at one of them. This holds when the
    outer edges enclose all values (extend01 / none) and rounding did not move
    a looked-up value; otherwise the counts come from a banding pass.
    """
    raw = F.col("__score")
    r = selected_ranks(base, ["__score"], quantile_probs(bins), sums={"bad": F.col("__flag")},
                    extras={"mn": F.min(raw), "mx": F.max(raw)})
    quant = interpolate(r, quantile_probs(bins), round_digits)
    n, total_bad = r.n.get("__score", 0), r.totals["bad"].get("__score", 0.0)
    if not quant:
        return [], None
    by_value = {}
    for _, _, _, v, (a, b) in sorted(quant, key=lambda t: t[1]):
        by_value.setdefault(float(v), (a, b))
    edges = sorted(by_value)
    mn, mx = r.extras["mn"], r.extras["mx"]
    if edge_rule == "extend01":
        edges[0], edges[-1] = min(0.0, mn), max(1.0, mx)
    elif edge_rule == "fixed01":
        edges[0], edges[-1] = 0.0, 1.0
    exact = (edge_rule in ("extend01", "none") and len(edges) >= 2 and
             all(round_digits is None or round(row["value"], round_digits) == row["value"]
                 for pair in by_value.values() for row in pair))
    if not exact:
        return edges, None
    interior = sorted(by_value.items())[1:-1]

    def at_or_below(e, pair):
        a, b = pair
        row = b if e >= b["value"] else a
        return row["cum_hi"], row["cum_bad"]
    cum = [(0, 0.0)] + [at_or_below(e, pair) for e, pair in interior] + [(n, total_bad)]
    rows = []
    for i in range(1, len(edges)):
        tot = int(cum[i][0] - cum[i - 1][0])
        if tot > 0:
            rows.append((i, float(edges[i - 1]), float(edges[i]), int(round(cum[i][1] - cum[i - 1][1])), tot))
    counts = base.sparkSession.createDataFrame(
        rows, f"band_id int, band_lo double, band_hi double, `{event_name}` long, `{total_name}` long")
    return edges, counts


def variable_trend(df: DataFrame, var_col: str, target_col: str, event=1, bins: int = 6,
                   ascending: bool = False):
    """Gini and trend of one raw variable (V4): 6 quantile bins, no rounding.

    Returns ``(trend_df, summary_df)``; the trend has band id, bounds, Event,
    Total, Event_rate (total row included).
    """
    table, edges = score_performance(df, var_col, target_col, event=event, bins=bins,
                                     edge_rule="extend01", round_digits=None, ascending=ascending)
    trend = table.select("band_id", "band_lo", "band_hi", "is_total", "Event", "Total", "Event_rate")
    return trend, ks_gini_summary(table), edges


def lorenz_points(table: DataFrame, non_prefix: str = "Non_", event_name: str = "Event") -> DataFrame:
    """Lorenz-curve points (V9): the origin plus each band's cumulative shares."""
    cn, ce = f"Cumulative_{non_prefix}{event_name}_%", f"Cumulative_{event_name}_%"
    pts = table.where(~F.col("is_total")).select(
        F.col("band_id").cast("int").alias("band_id"), F.col(cn).alias("x"), F.col(ce).alias("y"))
    origin = table.sparkSession.range(1).select(
        F.lit(None).cast("int").alias("band_id"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    return origin.unionByName(pts)


def classification_metrics(pred: DataFrame, label_col: str, pred_col: str,
                           average: str = "binary", pos_label=1) -> DataFrame:
    """Accuracy and F1 (in %) from one confusion aggregation (V7).

    ``average``: binary (F1 of ``pos_label``), macro (mean of per-class F1),
    micro (global counts; equals accuracy for single-label data).
    The confusion table has at most classes^2 rows.
    """
    conf = pred.groupBy(F.col(label_col).alias("y"), F.col(pred_col).alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    hit = F.col("y") == F.col("p")
    zero = F.lit(0).cast("long")
    contrib = conf.select(F.explode(F.array(
        F.struct(F.col("y").alias("c"), F.when(hit, F.col("n")).otherwise(zero).alias("tp"),
                 zero.alias("fp"), F.when(hit, zero).otherwise(F.col("n")).alias("fn")),
        F.struct(F.col("p").alias("c"), zero.alias("tp"),
                 F.when(hit, zero).otherwise(F.col("n")).alias("fp"), zero.alias("fn")),
    )).alias("s")).select("s.*")
    per_class = (contrib.groupBy("c").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"),
                                          F.sum("fn").alias("fn"))
                 .withColumn("f1", F.coalesce(F.try_divide(2.0 * F.col("tp"),
                                                           2.0 * F.col("tp") + F.col("fp") + F.col("fn")),
                                              F.lit(0.0))))
    accuracy = (F.sum("tp") * 100.0 / F.sum(F.col("tp") + F.col("fn"))).alias("accuracy")
    if average == "binary":
        f1 = F.max(F.when(F.col("c") == F.lit(pos_label), F.col("f1"))) * 100.0
    elif average == "macro":
        f1 = F.avg("f1") * 100.0
    elif average == "micro":
        f1 = F.try_divide(2.0 * F.sum("tp"), 2.0 * F.sum("tp") + F.sum("fp") + F.sum("fn")) * 100.0
    else:
        raise ValueError("average must be binary, macro or micro")
    return per_class.agg(accuracy, f1.alias("f1"))
