"""Joins, set operations and ordering helpers.

Small dimension tables are not broadcast by hint: the join is declared and
Spark chooses (size statistics, then AQE re-planning at runtime), so a side
that grows with the data is never forced into memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_lookup(df: DataFrame, table: DataFrame, key: str, value: str, out: str | None = None,
                default=None) -> DataFrame:
    """Dictionary lookup ``col.map(dict)`` as a left join (J3); unmatched -> ``default``."""
    out = out or value
    t = table.select(F.col(key).alias("__k"), F.col(value).alias("__v"))
    j = df.join(t, df[key] == t["__k"], "left").drop("__k")
    v = F.coalesce(F.col("__v"), F.lit(default)) if default is not None else F.col("__v")
    return j.withColumn(out, v).drop("__v") if out != "__v" else j


def semi(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in ``keys`` (J4, ``isin`` of a computed set)."""
    return df.join(keys.select(*on), on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not in ``keys``."""
    return df.join(keys.select(*on), on, "left_anti")


def align(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Row-aligned concatenation of two keyed tables (J2): full outer join on the key."""
    return a.join(b, on, "full_outer")


def union_all(*dfs: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Union by column name (U1); ``allow_missing`` fills absent columns with nulls."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=allow_missing)
    return out


def first_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows in a key order (O3): a top-n, the limit is the operator."""
    return df.orderBy(*order).limit(n)


def arg_max(df: DataFrame, group: list[str], value: str, payload: str) -> DataFrame:
    """Per group, the ``payload`` of the row with the largest ``value`` (O5);
    ties go to the largest payload so the result is deterministic."""
    best = F.max(F.struct(F.col(value).alias("v"), F.col(payload).alias("p")))
    return df.groupBy(*group).agg(best.alias("__b")).select(
        *group, F.col("__b.p").alias(payload), F.col("__b.v").alias(value))
