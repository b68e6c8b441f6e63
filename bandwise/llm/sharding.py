"""Sharding by weighted rendezvous hashing.

Every (key, shard) pair has a hash that gives a uniform number u; a record goes
to the shard with the largest ``-weight / ln(u)``. Only the record's key, the
shard numbers and their weights decide, so one more shard takes records only
into itself and a record otherwise stays where it was.

Slots number the records of a shard without gaps, in the order of a hash of the
record. They are counted from the sizes of (shard, hash range) cells, so no
task sorts a whole shard: records are numbered inside their cell and moved by
the number of records in the cells before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandwise.llm.common import stored, text_of

#: Hexadecimal digits of the hash that make the uniform number (52 bits, exact in a double).
DIGITS = 13


def uniform(*parts: Column) -> Column:
    """u in (0, 1) from the md5 of the parts, joined by colons (null: empty)."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("double")
    return (bits + 0.5) / float(16 ** DIGITS)


def shard_score(key: Column, shard: int, weight: float) -> Column:
    """-weight / ln(u) of "key:shard"."""
    return F.lit(-float(weight)) / F.log(uniform(key, F.lit(shard)))


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard (from 0) that wins the key; equal scores go to the smaller shard."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("shard weights must be positive")
    scores = [F.struct(shard_score(key, i, w).alias("score"), F.lit(-i).alias("order"))
              for i, w in enumerate(weights)]
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return -best["order"]


def shard_documents(docs: DataFrame, weights: Sequence[float], id_col: str = "doc_id", text_col: str = "text",
                    added_weight: float = 1.0, rows_per_cell: int = 50_000) -> DataFrame:
    """Per row: id, size (UTF-8 bytes + 1), text_crc32, law, shard, slot, grown_shard.

    ``grown_shard`` is the shard after one more shard of ``added_weight`` is
    added. A null text has no bytes (size 1, crc32 0); a null id counts as the
    empty key, so all such rows share a shard. Repeated rows keep a slot each.
    Slots follow (hash of id, crc and size, then these), so a rerun gives the
    same rows the same slots; only rows equal in all of these can trade places. An empty table gives an empty table.
    """
    body = text_of(text_col).cast("binary")
    key = F.col(id_col)
    rows = stored(docs.select(
        key.alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        rendezvous_shard(key, weights).alias("shard"),
        rendezvous_shard(key, [*weights, added_weight]).alias("grown_shard")))
    cells = max(1, -(-rows.count() // (rows_per_cell * len(weights))) * 4)
    order = ["u", "doc_id", "text_crc32", "size"]
    rows = rows.withColumn("u", uniform(*map(F.col, order[1:])))
    rows = rows.withColumn("cell", F.floor(F.col("u") * cells).cast("int"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
              .select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    inside = F.row_number().over(Window.partitionBy("shard", "cell").orderBy(*order)) - 1
    return (rows.withColumn("inside", inside).join(starts, ["shard", "cell"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("start") + F.col("inside")).cast("long").alias("slot"), "grown_shard"))
