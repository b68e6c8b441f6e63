"""Univariate profile (A1) and the small aggregations around it.

The profile is one row per column: type, var_vals (distinct non-null count),
var_min, var_max, var_mean, var_median (numbers and booleans), CorrelationWithTarget
(the same, pairwise non-null Pearson), percentZeros and percentNull (both
over all rows). The column statistics ride along the first pass of the
distributed exact median; one shuffle over the unpivoted (var, value) pairs
with map-side combine counts the distinct values. Every
result table has one row per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from bandwise.operators.quantiles import interpolate, selected_ranks


def pearson(a: Column | str, b: Column | str) -> Column:
    """Pearson correlation over pairwise non-null rows (A9/T1); null when a side is constant."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    a, b = a.cast("double"), b.cast("double")
    sa = F.stddev_pop(F.when(b.isNotNull(), a))
    sb = F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), sa * sb)


def univariate(df: DataFrame, target: str | None = None, median: bool | str = True,
               distinct: str = "exact") -> DataFrame:
    """Profile table, one row per column.

    ``median``: True / "exact" (distributed exact, linear interpolation),
    "approx" (``percentile_approx`` in the single statistics pass, no extra
    shuffle) or False. ``distinct``: "exact" or "approx" (HyperLogLog in the
    same pass). The approximate options keep a very wide table at one pass.
    """
    fields = df.schema.fields
    # Booleans count as the numbers 0 and 1; False is zero.
    numeric = [f.name for f in fields if isinstance(f.dataType, (NumericType, BooleanType))]
    has_target = target is not None and isinstance(df.schema[target].dataType, NumericType)
    aggs = {"__n": F.count(F.lit(1))}
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs[f"nul{i}"] = F.count_if(c.isNull())
        c = c.cast("int") if isinstance(f.dataType, BooleanType) else c
        if f.name in numeric:
            aggs.update({f"min{i}": F.min(c).cast("double"), f"max{i}": F.max(c).cast("double"),
                         f"avg{i}": F.avg(c).cast("double"), f"zer{i}": F.count_if(c == 0)})
            if has_target:
                aggs[f"cor{i}"] = pearson(c, F.col(f"`{target}`"))
    medians = {}
    if median == "approx" and numeric:
        for i, f in enumerate(fields):
            if f.name in numeric:
                aggs[f"med{i}"] = F.percentile_approx(F.col(f"`{f.name}`").cast("double"), 0.5, 10_000)
    if distinct == "approx":
        for i, f in enumerate(fields):
            aggs[f"hll{i}"] = F.approx_count_distinct(F.col(f"`{f.name}`"))
    if (median is True or median == "exact") and numeric:
        # The column statistics ride along the first pass of the distributed median.
        r = selected_ranks(df, numeric, [0.5], extras=aggs)
        stats = r.extras
        medians = {var: v for var, _, _, v, _ in interpolate(r, [0.5])}
    else:
        row = df.agg(*[e.alias(k) for k, e in aggs.items()]).first()
        stats = row.asDict()
        if median == "approx":
            medians = {f.name: stats.get(f"med{i}") for i, f in enumerate(fields) if f.name in numeric}
    n = stats["__n"]
    rows = []
    for i, f in enumerate(fields):
        num = f.name in numeric

        def ratio(k):
            return (stats[k] / n) if n else None
        rows.append((f.name, f.dataType.simpleString(),
                     stats.get(f"min{i}") if num else None, stats.get(f"max{i}") if num else None,
                     stats.get(f"avg{i}") if num else None, medians.get(f.name) if num else None,
                     stats.get(f"cor{i}") if (num and has_target) else None,
                     ratio(f"zer{i}") if num else (0.0 if n else None), ratio(f"nul{i}"), i))
    # One row per column: the statistics are a small local table.
    stats_df = df.sparkSession.createDataFrame(
        rows, "variable string, type string, var_min double, var_max double, var_mean double, "
              "var_median double, CorrelationWithTarget double, percentZeros double, percentNull double, "
              "ordinal int")
    if distinct == "approx":
        distinct = df.sparkSession.createDataFrame(
            [(f.name, int(stats[f"hll{i}"])) for i, f in enumerate(fields)], "variable string, var_vals long")
    else:
        distinct = distinct_counts(df)
    out = stats_df.join(distinct, "variable", "left").withColumn(
        "var_vals", F.coalesce("var_vals", F.lit(0).cast("long")))
    return out.select("variable", "type", "var_vals", "var_min", "var_max", "var_mean", "var_median",
                      "CorrelationWithTarget", "percentZeros", "percentNull", "ordinal")


def long_values(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Unpivot to (variable, value string) without nulls; one row per cell."""
    cols = cols or df.columns
    arr = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"`{c}`").cast("string").alias("value"))
                    for c in cols])
    return df.select(F.explode(arr).alias("s")).select("s.*").where(F.col("value").isNotNull())


def distinct_counts(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Exact distinct non-null count per column (A6): (variable, var_vals).

    ``groupBy(variable, value)`` collapses duplicates map-side, then a count per
    variable. ``approx=True`` uses HyperLogLog in a single aggregation instead.
    """
    cols = cols or df.columns
    if approx:
        wide = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(cols)])
        arr = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"d{i}").cast("long").alias("var_vals"))
                        for i, c in enumerate(cols)])
        return wide.select(F.explode(arr).alias("s")).select("s.*")
    # Values longer than 64 characters are counted by their SHA-256 digest, so long
    # texts are not shuffled whole; the tags keep short values and digests apart.
    v = F.col("value")
    key = F.when(F.length(v) > 64, F.concat(F.lit("#"), F.sha2(v, 256))).otherwise(F.concat(F.lit("="), v))
    return (long_values(df, cols).select("variable", key.alias("k")).groupBy("variable", "k")
            .agg(F.lit(1).alias("one"))
            .groupBy("variable").agg(F.count(F.lit(1)).alias("var_vals")))


def value_shares(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Share of each level among non-null values, per column (A2):
    (variable, level, cnt, share). One shuffle for all columns."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    counts = (long_values(df, cols).groupBy("variable", F.col("value").alias("level"))
              .agg(F.count(F.lit(1)).alias("cnt")))
    totals = counts.groupBy("variable").agg(F.sum("cnt").alias("__tot"))
    # totals: one row per column, a proven bound.
    return (counts.join(F.broadcast(totals), "variable")
            .withColumn("share", F.col("cnt") / F.col("__tot")).drop("__tot"))


def margins_pivot(df: DataFrame, key: str, value: str, total_label: str = "All") -> DataFrame:
    """``pivot_table(index=key, values=value, aggfunc=[sum, len], margins=True)``.

    ROLLUP over the key: rows with a null key are left out first (pandas
    drops them from the groups and from the margin). Returns
    (key, is_total, sum, len).
    """
    base = df.where(F.col(key).isNotNull())
    return (base.rollup(key).agg(F.sum(value).alias("sum"), F.count(F.col(value)).alias("len"),
                                 F.grouping(key).alias("__g"))
            .withColumn("is_total", F.col("__g") == 1).drop("__g"))


def min_max_rollup(df: DataFrame, key: str, value: str) -> DataFrame:
    """Min/max of ``value`` per ``key`` plus the overall row."""
    base = df.where(F.col(key).isNotNull())
    return (base.rollup(key).agg(F.min(value).alias("amin"), F.max(value).alias("amax"),
                                 F.grouping(key).alias("__g"))
            .withColumn("is_total", F.col("__g") == 1).drop("__g"))


def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """Two-way contingency table in long form (A5): (a, b, n), null pairs excluded."""
    return (df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
            .groupBy(a, b).agg(F.count(F.lit(1)).alias("n")))


def distinct_levels(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Distinct levels per string column (A11): (variable, level)."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return long_values(df, cols).select("variable", F.col("value").alias("level")).distinct()
