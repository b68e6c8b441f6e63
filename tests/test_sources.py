"""CSV scans (S1-S3, S5), report writes (S6) and synthetic tables."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from bandwise.sources.files import read_csv, write_report
from bandwise.sources.synthetic import random_table
from tests.conftest import SF_SMALL


def test_csv_scan_with_schema_key_and_pruning(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    out = tempfile.mkdtemp(prefix="bandwise-csv-", dir="/tmp")
    path = os.path.join(out, "orders_csv")
    # An unnamed first column plays the role of the row key of a CSV export.
    orders.select(F.col("o_orderkey").alias("_c0"), "o_totalprice",
                  F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
                  "o_orderstatus").write.option("header", True).csv(path)
    schema = "_c0 long, o_totalprice double, o_orderdate date, o_orderstatus string"
    df = read_csv(spark, path, schema=schema, key_col="o_orderkey",
                  columns=["o_orderkey", "o_orderdate", "o_totalprice"], date_format="yyyy-MM-dd", partitions=4)
    assert df.columns == ["o_orderkey", "o_orderdate", "o_totalprice"]
    assert dict(df.dtypes)["o_orderdate"] == "date"
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == orders.count()
    got = {r["o_orderkey"]: r["o_totalprice"] for r in df.collect()}
    want = {r["o_orderkey"]: r["o_totalprice"] for r in orders.collect()}
    assert got == pytest.approx(want)
    inferred = read_csv(spark, path)
    assert inferred.count() == orders.count()
    report = os.path.join(out, "report")
    write_report(df.groupBy("o_orderdate").count(), report, single_file=True)
    assert any(f.endswith(".csv") for f in os.listdir(report))


def test_random_table(spark):
    t = random_table(spark, 5000, uniform=["u"], normal=["z"], seed=3, partitions=4)
    s = t.agg(F.min("u"), F.max("u"), F.avg("z"), F.stddev("z")).first()
    assert 0.0 <= s[0] and s[1] <= 1.0
    assert abs(s[2]) < 0.1 and abs(s[3] - 1.0) < 0.1
    assert t.collect() == random_table(spark, 5000, uniform=["u"], normal=["z"], seed=3, partitions=4).collect()
