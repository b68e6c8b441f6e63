"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: White space of the word and line rules: [\x20\x09-\x0D].
ASCII_SPACE = " \t\n\x0b\x0c\r"
FOLDS = 5


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(value: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(value, UPPER, LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column that is used inside a higher-order function may be inlined into
    it and recomputed per element; binding it as a lambda argument avoids that.
    """
    return F.transform(F.array(value), body)[0]


def stored(df: DataFrame, after_shuffle: bool = False) -> DataFrame:
    """Write ``df`` to a table of its own in the folder ``spark.checkpoint.dir`` names, and read it.

    Cuts the lineage like a checkpoint: the files survive lost executors. A
    written table also has true size statistics and, unlike a checkpoint,
    doesn't carry the plan's inferred constraints along, which multiply in
    loops. Files stay until ``release`` or until the folder is cleaned.
    ``after_shuffle``: the last step was a shuffle, whose partitions may share
    files (four tasks a core), however many there are.
    """
    spark = df.sparkSession
    if after_shuffle:
        df = df.coalesce(4 * spark.sparkContext.defaultParallelism)
    path = f"{checkpoint_dir(spark).rstrip('/')}/bandwise-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete the files of ``stored`` tables that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_stored_at", None):
            jvm = df.sparkSession.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def held_out(key: str = "doc_id") -> Column:
    """crc32 of the key's decimal text mod 5 is 0; a null key counts as empty text (0: held out)."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == 0


def draw(seed: int, *columns: str) -> Column:
    """Uniform in [0, 1) from a row's values: ``draw * rows < n`` takes about n rows, the same ones each time."""
    return F.pmod(F.xxhash64(*columns, F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)


def free_name(df: DataFrame | list[str], name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` (or of a list of names) clashes with it."""
    taken = {c.lower() for c in (df if isinstance(df, list) else df.columns)}
    while name.lower() in taken:
        name = "_" + name
    return name


#: Rows up to which a side whose rows have been counted is broadcast; beyond it the join is salted.
BROADCAST_ROWS = 10_000


def spread_join(rows: DataFrame, small: DataFrame, key: str, salt_by: str, n_small: int, salts: int = 32) -> DataFrame:
    """Left join of ``rows`` to the one row per key of ``small``, null keys equal, for hot keys.

    ``n_small`` is the counted number of rows of ``small``: up to BROADCAST_ROWS
    it is broadcast; a larger one is repeated per salt and joined on (key,
    salt), so a hot key's rows are shared out over ``salts`` tasks.
    """
    taken = rows.columns + small.columns
    other, own, dealt = (free_name(taken, n) for n in ("_small_key", "_small_salt", "_row_salt"))
    small = small.withColumnRenamed(key, other)
    if n_small <= BROADCAST_ROWS:
        return rows.join(F.broadcast(small), rows[f"`{key}`"].eqNullSafe(small[other]), "left").drop(other)
    small = small.withColumn(own, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = rows.withColumn(dealt, F.pmod(F.xxhash64(F.col(f"`{salt_by}`")), F.lit(salts)).cast("int"))
    on = rows[f"`{key}`"].eqNullSafe(small[other]) & (rows[dealt] == small[own])
    return rows.join(small, on, "left").drop(other, own, dealt)


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, xor, multiply)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def chained(state: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Hash of (what ``state`` is the hash of, value)."""
    return mix64(state * _MULTIPLIER + value)


def give_back() -> None:
    """Return freed memory to the system: a worker process lives on for the tasks of other operators."""
    pa.default_memory_pool().release_unused()
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of text, one row at least, to bound a worker's memory."""
    try:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(sizes.astype(np.int64)) // most
            for start, rows in zip(*np.unique(group, return_index=True, return_counts=True)[1:], strict=True):
                yield batch.slice(int(start), int(rows))
    finally:
        give_back()
