"""Synthetic uniform / normal columns (S4), generated inside Spark tasks.

``spark.range`` partitions the row ids; ``rand`` / ``randn`` with a seed are
deterministic per partition, so a lost task regenerates the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def random_table(spark: SparkSession, rows: int, uniform: list[str] | None = None,
                 normal: list[str] | None = None, seed: int = 0, partitions: int | None = None) -> DataFrame:
    """``rows`` rows with U(0, 1) columns ``uniform`` and N(0, 1) columns ``normal``."""
    base = spark.range(0, rows, 1, partitions) if partitions else spark.range(rows)
    cols = [F.rand(seed + i).alias(c) for i, c in enumerate(uniform or [])]
    cols += [F.randn(seed + 1000 + i).alias(c) for i, c in enumerate(normal or [])]
    return base.select("id", *cols)
