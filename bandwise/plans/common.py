"""Shared helpers for catalog queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column for engine-independent comparison.

    Floating sums and interpolations differ in the last bits between engines;
    reports are compared at ``digits`` decimals. Dates are emitted as ISO text.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name))
        elif isinstance(f.dataType, DateType):
            cols.append(F.col(f"`{f.name}`").cast("string").alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def materialised(df: DataFrame) -> DataFrame:
    """A small result table as a local relation (lets cached inputs be released)."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)
