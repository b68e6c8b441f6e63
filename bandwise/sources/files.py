"""CSV scans with declared schemas (S1-S3), repartitioned loads (S5),
report writes (S6) and saved artefact tables (S7/S8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, key_col: str | None = None,
             columns: list[str] | None = None, date_format: str | None = None,
             partitions: int | None = None) -> DataFrame:
    """CSV scan.

    * ``schema``: declared schema (inference is a full extra pass; only used when
      no schema is given).
    * ``key_col``: name for the first column when it is an unnamed row key
      (``index_col=0`` in the pandas world).
    * ``columns``: pruned projection (``usecols``).
    * ``date_format``: pattern for DateType/TimestampType columns (``parse_dates``).
    * ``partitions``: spread the scan over N partitions (S5).
    """
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    if date_format:
        reader = reader.option("dateFormat", date_format).option("timestampFormat", date_format)
    df = reader.csv(path)
    if key_col:
        first = df.columns[0]
        if first != key_col:
            df = df.withColumnRenamed(first, key_col)
    if columns:
        df = df.select(*columns)
    if partitions:
        df = df.repartition(partitions)
    return df


def write_report(df: DataFrame, path: str, fmt: str = "csv", header: bool = True,
                 mode: str = "overwrite", single_file: bool = False) -> None:
    """Write a report table (S6). ``single_file`` only for small report tables
    (bands, WOE tables): it funnels the rows through one task."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode(mode)
    if fmt == "csv":
        writer.option("header", header).csv(path)
    else:
        writer.format(fmt).save(path)


def save_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Persist a fitted artefact table (level tables, edges, WOE tables) as parquet."""
    df.write.mode(mode).parquet(path)


def load_saved_table(spark: SparkSession, path: str) -> DataFrame:
    """Load an artefact table written by :func:`save_table`."""
    return spark.read.parquet(path)
