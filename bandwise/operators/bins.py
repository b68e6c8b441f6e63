"""Quantile edges (W7) and right-closed band assignment.

Band ids are 1..k for the k intervals of a sorted edge list
``e0 < e1 < ... < ek``: band 1 is ``[e0, e1]`` (lowest edge included), band i
is ``(e_{i-1}, e_i]``. Values outside ``[e0, ek]`` get a null band and drop out
of grouped tables, as with ``pd.cut``. ML ``Bucketizer`` is left-closed, so the
band is a generated CASE expression instead (JVM, whole-stage codegen).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.operators.quantiles import quantiles_from_ranks, selected_ranks

# Edge rules for the first/last edge after the quantile edges are computed.
EDGE_RULES = ("extend01", "fixed01", "none")


def quantile_probs(bins: int) -> list[float]:
    return [i / bins for i in range(bins + 1)]


def quantile_edges(df: DataFrame, col: str, bins: int = 10, edge_rule: str = "extend01",
                   round_digits: int | None = 12, method: str = "exact") -> list[float]:
    """Sorted, de-duplicated quantile edges of ``col`` (``qcut(..., duplicates='drop')``).

    ``edge_rule``:
      * ``extend01``: first edge = min(0, min x), last = max(1, max x)
      * ``fixed01``: first edge = 0, last = 1
      * ``none``: raw quantile edges

    ``method="exact"`` uses the distributed exact quantile; ``"approx"`` uses
    ``percentile_approx`` (returns data values, not interpolated).
    The result is at most ``bins + 1`` numbers (collected to the driver).
    """
    if edge_rule not in EDGE_RULES:
        raise ValueError(f"edge_rule must be one of {EDGE_RULES}")
    probs = quantile_probs(bins)
    raw = F.col(col).cast("double")
    raw = F.when(~F.isnan(raw), raw)  # NaN counts as missing
    if method == "exact":
        r = selected_ranks(df.select(col), [col], probs, extras={"mn": F.min(raw), "mx": F.max(raw)})
        q = quantiles_from_ranks(r, probs, round_digits=round_digits)
        values = [row["value"] for row in q.orderBy("prob_index").collect()]
        mm = (r.extras["mn"], r.extras["mx"])
    elif method == "approx":
        x = F.round(raw, round_digits) if round_digits is not None else raw
        head = df.agg(F.percentile_approx(x, probs, 100_000), F.min(raw), F.max(raw)).first()
        values, mm = list(head[0] or []), (head[1], head[2])
    else:
        raise ValueError("method must be 'exact' or 'approx'")
    edges = sorted({float(v) for v in values if v is not None and not math.isnan(v)})
    if not edges:
        return []
    if edge_rule == "extend01":
        edges[0] = min(0.0, mm[0])
        edges[-1] = max(1.0, mm[1])
    elif edge_rule == "fixed01":
        edges[0] = 0.0
        edges[-1] = 1.0
    return edges


def band_expr(x: Column | str, edges: list[float]) -> Column:
    """Right-closed band id (1-based), lowest edge included, null outside."""
    x = F.col(x) if isinstance(x, str) else x
    if len(edges) < 2:
        return F.lit(None).cast("int")
    expr = F.when(x < F.lit(edges[0]), F.lit(None).cast("int"))
    for i, e in enumerate(edges[1:], start=1):
        expr = expr.when(x <= F.lit(e), F.lit(i))
    return expr.otherwise(F.lit(None).cast("int"))


def band_bounds(band: Column | str, edges: list[float]) -> tuple[Column, Column]:
    """(lower, upper) edge of a band id as columns."""
    band = F.col(band) if isinstance(band, str) else band
    arr = F.array(*[F.lit(float(e)) for e in edges])
    return F.element_at(arr, band), F.element_at(arr, band + 1)
