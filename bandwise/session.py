"""Session helpers.

The library never creates a session behind the caller's back except through
``get_spark``; on a cluster the caller passes its own session. Lineage cuts go
to the shared folder named by ``spark.checkpoint.dir``; a local default is set
only when the session has none (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "bandwise") -> SparkSession:
    """Local/test session with AQE on. On a cluster use the existing session."""
    master = master or os.environ.get("BANDWISE_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("BANDWISE_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BANDWISE_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.ansi.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset and
    the master is local (local runs, tests) a fresh local folder is created and
    registered; on a cluster an unset folder is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc_dir = spark.sparkContext.getCheckpointDir()
        if not sc_dir:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    sc_dir = spark.sparkContext.getCheckpointDir()
    if sc_dir:
        return sc_dir
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared, reliable folder; a machine-local "
                           "folder does not survive executor or node loss")
    local = tempfile.mkdtemp(prefix="bandwise-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table of its own in the checkpoint folder, and read it.

    Like a checkpoint the files survive lost executors; a written table also has
    true sizes, and its plan carries no constraints along.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/bandwise-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
