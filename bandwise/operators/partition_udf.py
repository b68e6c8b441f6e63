"""Partitioned Python functions.

``map_partitions`` runs a pandas function over Arrow batches of each
partition with a declared output schema (``mapInPandas``); expensive state
(a model, a tokenizer) is built once per partition via ``init``.
``attach_token_count`` keeps the result next to its row with an iterator
``arrow_udf``, so nothing has to be re-stitched afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Token and sentence patterns of the text statistics.
TOKEN_PATTERN = r"[A-Za-z0-9]+"
SENTENCE_END = r"[.!?]+"


def map_partitions(df: DataFrame, fn: Callable[[pd.DataFrame, object], pd.DataFrame], schema: str,
                   init: Callable[[], object] | None = None, partitions: int | None = None) -> DataFrame:
    """Apply ``fn(batch, state)`` to every Arrow batch; ``state = init()`` once per partition (G1).

    ``partitions`` spreads the input over N partitions first (S5)."""
    src = df.repartition(partitions) if partitions else df

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = init() if init else None
        for batch in batches:
            yield fn(batch, state)
    return src.mapInPandas(run, schema)


def text_stats_batch(batch: pd.DataFrame, state=None, text_col: str = "text") -> pd.DataFrame:
    """Per-text statistics on a pandas batch: tokens, sentences, characters."""
    s = batch[text_col].fillna("")
    out = batch.drop(columns=[text_col]).copy()
    out["n_tokens"] = s.str.count(TOKEN_PATTERN).astype("int64")
    out["n_sentences"] = s.str.count(SENTENCE_END).astype("int64")
    out["n_chars"] = s.str.len().astype("int64")
    return out


def attach_token_count(col: str = "text"):
    """Iterator Arrow UDF: token count of each text, returned next to its row.

    The texts are counted where the batch lies: no Python string is made of one.
    """
    @F.arrow_udf("long")
    def token_count(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in it:
            yield pc.fill_null(pc.count_substring_regex(texts, TOKEN_PATTERN), 0).cast(pa.int64())
    return token_count(F.col(col))


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition (G3): one row per non-empty partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def get_partition(df: DataFrame, i: int) -> DataFrame:
    """Rows of partition ``i`` only."""
    return df.where(F.spark_partition_id() == F.lit(i))
