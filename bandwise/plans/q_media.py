"""Catalog: media-mix transforms (D1-D4, E8) on daily event value per event type."""

from __future__ import annotations

from pyspark.sql import functions as F

from bandwise.functions.mathfn import saturation
from bandwise.operators.media import (channel_contributions, geometric_adstock, min_max_scale, response,
                                      spend_table)
from bandwise.plans.catalog import register
from bandwise.plans.common import rounded
from bandwise.plans.oracle_sql import _r
from bandwise.sources.tables import load_table

ALPHA, L = 0.5, 12
# Channel parameters (decay alpha, saturation mu, weight beta, delayed or not).
CHANNEL_PARAMS = [
    ("click", 0.3, 2.0, 1.5, False),
    ("error", 0.5, 3.0, 0.5, False),
    ("purchase", 0.6, 3.0, 2.0, True),
    ("signup", 0.4, 4.0, 1.0, True),
    ("view", 0.7, 2.5, 0.8, False),
]
_SPEND_SQL = ("SELECT event_type AS channel, CAST(ts AS DATE) AS period, SUM(value) AS spend "
              "FROM events GROUP BY ALL")


def _spend(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events", ["ts", "event_type", "value"])
    return spend_table(ev, "event_type", "ts", "value")


def spend_scaled(spark, sf_dir):
    """Daily spend per channel scaled to [0, 1]."""
    return rounded(min_max_scale(_spend(spark, sf_dir), "spend", ["channel"]))


register("spend_scaled", f"""
WITH s AS ({_SPEND_SQL})
SELECT channel, CAST(period AS VARCHAR) AS period, {_r('spend', 'spend')},
  {_r('(spend - MIN(spend) OVER w) / NULLIF(MAX(spend) OVER w - MIN(spend) OVER w, 0)', 'spend_scaled')}
FROM s WINDOW w AS (PARTITION BY channel)""")(spend_scaled)


def adstock(spark, sf_dir):
    """Geometric adstock (alpha 0.5, 12 periods) of every channel's spend, raw and normalised."""
    s = geometric_adstock(_spend(spark, sf_dir), "spend", ALPHA, L, normalize=False, out="adstock")
    s = geometric_adstock(s, "spend", ALPHA, L, normalize=True, out="adstock_norm")
    return rounded(s)


def _adstock_sql(table: str, value: str, alpha: str) -> str:
    """Sum over the rows of the last L days, by a join on the dates; oldest first, as the operator adds."""
    return (f"(SELECT SUM(POW({alpha}, (a.period - b.period)::DOUBLE) * b.{value} ORDER BY b.period) FROM {table} b "
            f"WHERE b.channel = a.channel AND b.period BETWEEN a.period - {L - 1} AND a.period)")


_NORM = f"list_sum(list_transform(range({L}), lambda l: POW({{}}, l::DOUBLE)))"
register("adstock", f"""
WITH s AS ({_SPEND_SQL})
SELECT channel, CAST(period AS VARCHAR) AS period, {_r('spend', 'spend')},
  {_r(_adstock_sql('s', 'spend', str(ALPHA)), 'adstock')},
  {_r(_adstock_sql('s', 'spend', str(ALPHA)) + ' / ' + _NORM.format(ALPHA), 'adstock_norm')}
FROM s a""")(adstock)


def adstock_all_days(spark, sf_dir):
    """The same over every day's spend of every channel."""
    s = geometric_adstock(_spend(spark, sf_dir), "spend", ALPHA, L, normalize=False, out="adstock")
    s = geometric_adstock(s, "spend", ALPHA, L, normalize=True, out="adstock_norm")
    return rounded(s)


register("adstock_all_days", f"""
WITH s AS ({_SPEND_SQL})
SELECT channel, CAST(period AS VARCHAR) AS period, {_r('spend', 'spend')},
  {_r(_adstock_sql('s', 'spend', str(ALPHA)), 'adstock')},
  {_r(_adstock_sql('s', 'spend', str(ALPHA)) + ' / ' + _NORM.format(ALPHA), 'adstock_norm')}
FROM s a""")(adstock_all_days)


def saturation_q(spark, sf_dir):
    """Saturation (mu 3) of the scaled daily spend."""
    s = min_max_scale(_spend(spark, sf_dir), "spend", ["channel"], out="x")
    return rounded(s.withColumn("reach", saturation(F.col("x"), 3.0)).select("channel", "period", "x", "reach"))


register("saturation", f"""
WITH s AS ({_SPEND_SQL}),
x AS (SELECT channel, period,
        (spend - MIN(spend) OVER w) / NULLIF(MAX(spend) OVER w - MIN(spend) OVER w, 0) AS x
      FROM s WINDOW w AS (PARTITION BY channel))
SELECT channel, CAST(period AS VARCHAR) AS period, {_r('x', 'x')}, {_r('(1 - EXP(-3.0 * x)) / (1 + EXP(-3.0 * x))', 'reach')} FROM x""")(saturation_q)


def _params(spark):
    return spark.createDataFrame(CHANNEL_PARAMS, "channel string, alpha double, mu double, beta double, "
                                                 "delayed boolean")


def mmm_response(spark, sf_dir):
    """Channel contributions on scaled spend and the predicted response per day."""
    s = min_max_scale(_spend(spark, sf_dir), "spend", ["channel"], out="x")
    contrib = channel_contributions(s.select("channel", "period", "x"), _params(spark), value="x", length=L)
    return rounded(response(contrib, intercept=0.0))


def _mmm_sql() -> str:
    vals = ", ".join(f"('{c}', {a}, {m}, {b}, {str(d).upper()})" for c, a, m, b, d in CHANNEL_PARAMS)
    return f"""
WITH s AS ({_SPEND_SQL}),
x AS (SELECT channel, period,
        (spend - MIN(spend) OVER w) / NULLIF(MAX(spend) OVER w - MIN(spend) OVER w, 0) AS x
      FROM s WINDOW w AS (PARTITION BY channel)),
p AS (SELECT * FROM (VALUES {vals}) t(channel, alpha, mu, beta, delayed)),
j AS (SELECT x.*, p.alpha, p.mu, p.beta, p.delayed FROM x JOIN p USING (channel)),
a AS (SELECT a.*, {_adstock_sql('j', 'x', 'a.alpha')} / {_NORM.format('a.alpha')} AS ad FROM j a),
c AS (SELECT period, beta * (1 - EXP(-mu * CASE WHEN delayed THEN ad ELSE x END))
                         / (1 + EXP(-mu * CASE WHEN delayed THEN ad ELSE x END)) AS contribution FROM a)
SELECT CAST(period AS VARCHAR) AS period, {_r('0.0 + SUM(contribution)', 'response')}, COUNT(*) AS channels FROM c GROUP BY period"""


register("mmm_response", _mmm_sql())(mmm_response)
