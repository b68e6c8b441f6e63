"""Media-mix transforms.

Spend is a long table (channel, period, spend): one row per channel and
period after aggregating raw events, so each channel's window holds one row
per period (bounded by the calendar, not by the event volume).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bandwise.functions.mathfn import saturation


def spend_table(events: DataFrame, channel_col: str, ts_col: str, value_col: str,
                period: str = "day") -> DataFrame:
    """Aggregate raw rows to (channel, period, spend) (partial aggregation map-side)."""
    p = F.to_date(ts_col) if period == "day" else F.date_trunc(period, F.col(ts_col)).cast("date")
    return (events.groupBy(F.col(channel_col).alias("channel"), p.alias("period"))
            .agg(F.sum(value_col).alias("spend")))


def min_max_scale(df: DataFrame, value: str, group: list[str], out: str | None = None) -> DataFrame:
    """(x - min) / (max - min) per group (E8); null when the group is constant.

    Min/max are one row per group, joined back on the group keys."""
    out = out or f"{value}_scaled"
    mm = df.groupBy(*group).agg(F.min(value).alias("__mn"), F.max(value).alias("__mx"))
    return (df.join(mm, group)
            .withColumn(out, F.try_divide(F.col(value) - F.col("__mn"), F.col("__mx") - F.col("__mn")))
            .drop("__mn", "__mx"))


def geometric_adstock(df: DataFrame, value: str, alpha: float | str = 0.5, length: int = 12,
                      normalize: bool = True, partition: list[str] | None = None,
                      order: str = "period", out: str = "adstock") -> DataFrame:
    """sum_{l < L} alpha^l * x_{t-l}, l in periods; a period without a row spent nothing.

    ``order`` is a date (periods are days) or a whole period number; one row
    per partition and period. ``alpha`` may be a column name (per-channel
    decay). ``normalize`` divides by sum_{l < L} alpha^l (true division). The
    window is a range of L periods, so each row gathers at most L values.
    """
    partition = partition or ["channel"]
    is_date = df.schema[order].dataType.simpleString() in ("date", "timestamp", "timestamp_ntz")
    period = (F.unix_date(F.col(order).cast("date")) if is_date else F.col(order)).cast("long")
    w = Window.partitionBy(*partition).orderBy(period).rangeBetween(-(length - 1), 0)
    a = F.col(alpha) if isinstance(alpha, str) else F.lit(float(alpha))
    spent = F.collect_list(F.struct(period.alias("t"), F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("x")))
    total = F.aggregate("__spent", F.lit(0.0),
                        lambda acc, s: acc + F.pow("__alpha", (F.col("__t") - s["t"]).cast("double")) * s["x"])
    if normalize:
        total = total / F.aggregate(F.sequence(F.lit(0), F.lit(length - 1)), F.lit(0.0),
                                    lambda acc, l: acc + F.pow("__alpha", l.cast("double")))
    return (df.withColumn("__spent", spent.over(w)).withColumns({"__t": period, "__alpha": a.cast("double")})
            .withColumn(out, total).drop("__spent", "__t", "__alpha"))


def channel_contributions(spend: DataFrame, params: DataFrame, value: str = "spend",
                          length: int = 12) -> DataFrame:
    """beta * saturation(adstock(x)) for delayed channels, beta * saturation(x) otherwise (D3).

    The adstock is normalised. ``params``: (channel, alpha, mu, beta, delayed),
    one row per channel; Spark broadcasts it if its size allows.
    """
    j = spend.join(params, "channel")
    j = geometric_adstock(j, value, alpha="alpha", length=length, out="__ad")
    x = F.when(F.col("delayed"), F.col("__ad")).otherwise(F.col(value))
    return (j.withColumn("transformed", x)
            .withColumn("contribution", F.col("beta") * saturation(F.col("transformed"), F.col("mu")))
            .drop("__ad"))


def response(contrib: DataFrame, intercept: float = 0.0) -> DataFrame:
    """Predicted response per period: intercept + sum of channel contributions."""
    return contrib.groupBy("period").agg(
        (F.lit(intercept) + F.sum("contribution")).alias("response"),
        F.count(F.lit(1)).alias("channels"))
