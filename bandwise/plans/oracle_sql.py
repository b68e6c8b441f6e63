"""DuckDB reference SQL for the catalog queries (the correctness oracle).

Each string runs on DuckDB with the driver tables registered as views. Column
names and types match the Spark side; floating outputs are rounded to 6
decimals on both sides.
"""

from __future__ import annotations

R = 6


def _r(expr: str, alias: str) -> str:
    # "+ 0.0" turns a rounded negative zero into 0.0, as Spark's decimal rounding does.
    return f"(ROUND(CAST({expr} AS DOUBLE), {R}) + 0.0) AS \"{alias}\""


def probs_list(bins: int) -> str:
    return "[" + ", ".join(repr(i / bins) for i in range(bins + 1)) + "]"


def ks_table_sql(counts_cte: str, ascending: bool = False, non: str = "Non_Event",
                 ev: str = "Event", tot: str = "Total") -> str:
    """KS/Gini table over a CTE named ``counts(band_id, band_lo, band_hi, Event, Total)``."""
    order = "band_id ASC" if ascending else "band_id DESC"
    cnon, cev = f"Cumulative_{non}", f"Cumulative_{ev}"
    return f"""
{counts_cte},
t AS (
  SELECT band_id, band_lo, band_hi, {ev} AS ev, {tot} AS tot, {tot} - {ev} AS non,
         SUM({tot} - {ev}) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnon,
         SUM({ev}) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cev,
         SUM({tot}) OVER () AS tt, SUM({ev}) OVER () AS te, SUM({tot} - {ev}) OVER () AS tn
  FROM counts),
m AS (
  SELECT *, CAST(tot AS DOUBLE) / tt AS pop, CAST(cnon AS DOUBLE) / tn AS cnp,
         CAST(cev AS DOUBLE) / te AS cep
  FROM t),
g AS (
  SELECT *, (cep + COALESCE(LAG(cep) OVER (ORDER BY {order}), 0.0)) / 2.0
            * (cnp - COALESCE(LAG(cnp) OVER (ORDER BY {order}), 0.0)) AS gini
  FROM m),
tab AS (
  SELECT CAST(band_id AS INTEGER) AS band_id, band_lo, band_hi, FALSE AS is_total,
         CAST(tot AS BIGINT) AS {tot}, CAST(ev AS BIGINT) AS {ev}, CAST(non AS BIGINT) AS {non},
         CAST(cnon AS BIGINT) AS {cnon}, CAST(cev AS BIGINT) AS {cev},
         pop, cnp, cep, cep - cnp AS diff, CAST(ev AS DOUBLE) / tot AS rate, gini
  FROM g
  UNION ALL
  SELECT NULL, NULL, NULL, TRUE, CAST(SUM({tot}) AS BIGINT), CAST(SUM({ev}) AS BIGINT),
         CAST(SUM({tot}) - SUM({ev}) AS BIGINT), CAST(SUM({tot}) - SUM({ev}) AS BIGINT),
         CAST(SUM({ev}) AS BIGINT), 1.0, 1.0, 1.0, 0.0,
         CAST(SUM({ev}) AS DOUBLE) / SUM({tot}), NULL
  FROM counts)
"""


def ks_table_select(non: str = "Non_Event", ev: str = "Event", tot: str = "Total") -> str:
    cnon, cev = f"Cumulative_{non}", f"Cumulative_{ev}"
    return f"""SELECT band_id, {_r('band_lo', 'band_lo')}, {_r('band_hi', 'band_hi')}, is_total,
       {tot}, {ev}, {non}, {cnon}, {cev},
       {_r('pop', 'Population_%')}, {_r('cnp', cnon + '_%')}, {_r('cep', cev + '_%')},
       {_r('diff', 'Difference')}, {_r('rate', ev + '_rate')}, {_r('gini', 'Gini')}
FROM tab"""


def quantile_counts_cte(base_sql: str, bins: int, edge_rule: str = "extend01",
                        round_digits: int | None = 12) -> str:
    """CTEs base(score, flag) -> edges -> counts(band_id, band_lo, band_hi, Event, Total)."""
    x = f"ROUND(score, {round_digits})" if round_digits is not None else "score"
    if edge_rule == "extend01":
        first, last = "LEAST(0.0, mn)", "GREATEST(1.0, mx)"
    elif edge_rule == "fixed01":
        first, last = "0.0", "1.0"
    else:
        first, last = "e[1]", "e[len(e)]"
    return f"""WITH base AS ({base_sql}),
q AS (SELECT list_sort(list_distinct(quantile_cont({x}, {probs_list(bins)}))) AS e,
             MIN(score) AS mn, MAX(score) AS mx FROM base),
edges AS (SELECT list_concat([CAST({first} AS DOUBLE)], e[2:len(e) - 1], [CAST({last} AS DOUBLE)]) AS e FROM q),
{band_counts_cte()}"""


def fixed_edges_counts_cte(base_sql: str, edges_sql: str) -> str:
    """Same as :func:`quantile_counts_cte` with edges from a SQL expression (``edges(e)``)."""
    return f"""WITH base AS ({base_sql}),
edges AS ({edges_sql}),
{band_counts_cte()}"""


def band_counts_cte() -> str:
    return """banded AS (
  SELECT CASE WHEN b.score < e[1] OR b.score > e[len(e)] THEN NULL
              ELSE GREATEST(1, len(list_filter(e, lambda x: x < b.score))) END AS band_id,
         b.flag, edges.e AS e
  FROM base b CROSS JOIN edges),
counts AS (
  SELECT band_id, any_value(e)[band_id] AS band_lo, any_value(e)[band_id + 1] AS band_hi,
         CAST(SUM(flag) AS BIGINT) AS Event, COUNT(*) AS Total
  FROM banded WHERE band_id IS NOT NULL GROUP BY band_id)"""
