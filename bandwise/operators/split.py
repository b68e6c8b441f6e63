"""Deterministic sampling and splitting.

Random permutations are not reproducible across engines or recomputations, so
every split is a pure function of a row key: the first 32 bits of
``md5("<seed>:<key>")``, compared with ``fraction * 2^32``. The same rows come out on every executor
retry, in every partitioning, and in DuckDB (``('0x' || substr(md5(..),1,8))::UBIGINT``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.session import cut_lineage

HASH_RANGE, HASH_48 = 1 << 32, 1 << 48


def hash_key(key_cols: list[str], seed: int) -> Column:
    return F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols])


def hash_bucket(key_cols: list[str], seed: int, modulus: int = HASH_RANGE, fast: bool = False) -> Column:
    """0..modulus-1 from the first 8 hex digits of md5(seed:key).

    ``fast=True`` uses Spark's ``xxhash64`` instead: several times cheaper per
    row (no key text is built), equally deterministic across executors and
    retries, but not reproducible in other SQL engines."""
    if fast:
        return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in key_cols]), F.lit(modulus))
    h = F.conv(F.substring(F.md5(hash_key(key_cols, seed)), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(modulus))


def hash_split_flag(key_cols: list[str], seed: int = 12345, test_size: float = 0.2,
                    fast: bool = False) -> Column:
    """True for test rows."""
    return hash_bucket(key_cols, seed, fast=fast) < F.lit(float(HASH_RANGE) * test_size)


def train_test_split(df: DataFrame, key_cols: list[str], seed: int = 12345,
                     test_size: float = 0.2, fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """(train, test) by hash; the two sides are disjoint and cover all rows."""
    flag = hash_split_flag(key_cols, seed, test_size, fast)
    return df.where(~flag), df.where(flag)


def complement(base: DataFrame, sample: DataFrame, key_cols: list[str]) -> DataFrame:
    """Rows of ``base`` whose key is not in ``sample`` (X3), a left-anti join."""
    return base.join(sample.select(*key_cols), key_cols, "left_anti")


def kfold_column(key_cols: list[str], k: int = 5, seed: int = 777) -> Column:
    """Fold id 0..k-1 (X4), usable as ``CrossValidator(foldCol=...)``."""
    return hash_bucket(key_cols, seed, k).cast("int")


def size_subset_flag(key_cols: list[str], fraction: float, seed: int = 999) -> Column:
    """Nested training-size subsets (X5): a row in the 10 % subset is also in 20 %."""
    return hash_bucket(key_cols, seed) < F.lit(float(HASH_RANGE) * fraction)


def order_hash(key_cols: list[str], seed: int) -> Column:
    """First 48 bits of md5(seed:key) as a long: the sampling order (ties by key)."""
    return F.conv(F.substring(F.md5(hash_key(key_cols, seed)), 1, 12), 16, 10).cast("long")


#: Rows that one task may order; larger samples are cut by counts first.
ORDERED_ROWS = 100_000


def sample_n(df: DataFrame, n: int, key_cols: list[str], seed: int = 42, ordered_rows: int = ORDERED_ROWS) -> DataFrame:
    """Exactly ``n`` rows without replacement (X1): the first by (md5(seed:key), key).

    After a count, one scan keeps the rows whose hash lies below a guess that
    leaves n rows with ten standard deviations to spare; only those are ordered,
    and written, so that nothing hashes the table again. Should they be fewer
    than n after all, the guess is widened. Beyond ``ordered_rows`` the kept
    rows are counted by hash cells, whole cells are taken and one is ordered.
    The limit is the operator itself.
    """
    total = df.count()
    if total <= n:
        return df
    order, keep = ["__o", *key_cols], n + 10 * math.sqrt(n) + 20
    hashed = df.withColumn("__o", order_hash(key_cols, seed))
    while True:
        bound = min(HASH_48, math.ceil(HASH_48 * min(1.0, keep / total)))
        near = hashed.where(F.col("__o") < F.lit(bound))
        if n <= ordered_rows:
            out = cut_lineage(near.orderBy(*order).limit(n).drop("__o"))
            if bound == HASH_48 or out.count() == n:
                return out
        else:
            near = cut_lineage(near)
            cells = max(2, -(-n // ordered_rows) * 4)
            # Cells of equal width: whole numbers, so that every engine cuts alike.
            cell = F.expr(f"__o div {-(-bound // cells)}")
            counts = sorted((r["cell"], r["n"]) for r in near.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect())
            if bound == HASH_48 or sum(c for _, c in counts) >= n:
                want = n
                for at, rows in counts:
                    if rows >= want:
                        break
                    want -= rows
                last = near.where(cell == at).orderBy(*order).limit(want)
                return near.where(cell < at).unionByName(last).drop("__o")
        keep *= 4
