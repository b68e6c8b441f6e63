"""Catalog: partitioned Python functions over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from bandwise.operators.partition_udf import (SENTENCE_END, TOKEN_PATTERN, attach_token_count, get_partition, map_partitions,
                                              partition_sizes, text_stats_batch)
from bandwise.plans.catalog import register
from bandwise.sources.tables import load_table

_STATS_SQL = f"""SELECT doc_id, CAST(len(regexp_extract_all(COALESCE(text, ''), '{TOKEN_PATTERN}')) AS BIGINT) AS n_tokens,
       CAST(len(regexp_extract_all(COALESCE(text, ''), '{SENTENCE_END}')) AS BIGINT) AS n_sentences,
       CAST(length(COALESCE(text, '')) AS BIGINT) AS n_chars FROM documents"""


def text_udf_partitions(spark, sf_dir):
    """G1: text statistics computed per partition of the scan with mapInPandas; no text is shuffled."""
    d = load_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return map_partitions(d, text_stats_batch, "doc_id long, n_tokens long, n_sentences long, n_chars long")


register("text_udf_partitions", _STATS_SQL)(text_udf_partitions)


def text_udf_column(spark, sf_dir):
    """Token count attached next to each row with an iterator pandas UDF."""
    d = load_table(spark, sf_dir, "documents", ["doc_id", "lang", "text"])
    return d.select("doc_id", "lang", attach_token_count("text").alias("n_tokens"))


register("text_udf_column", f"""SELECT doc_id, lang,
  CAST(len(regexp_extract_all(COALESCE(text, ''), '{TOKEN_PATTERN}')) AS BIGINT) AS n_tokens FROM documents""")(text_udf_column)


PARTITIONS = 16


def partition_counts(spark, sf_dir):
    """Partitions of a PARTITIONS-way repartition, their rows, and the rows of the first one fetched alone."""
    d = load_table(spark, sf_dir, "documents", ["doc_id"]).repartitionByRange(PARTITIONS, "doc_id")
    sizes = partition_sizes(d).agg(F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("rows"))
    return sizes.crossJoin(F.broadcast(get_partition(d, 0).agg(F.min("doc_id").alias("first_doc"))))


register("partition_counts", f"""SELECT {PARTITIONS}::BIGINT AS partitions, COUNT(*)::BIGINT AS rows,
       MIN(doc_id) AS first_doc FROM documents""")(partition_counts)


def tokens_per_language(spark, sf_dir):
    """Total tokens and characters per language, with built-in functions only."""
    d = load_table(spark, sf_dir, "documents", ["lang", "text"])
    text = F.coalesce("text", F.lit(""))
    return d.groupBy("lang").agg(
        F.sum(F.regexp_count(text, F.lit(TOKEN_PATTERN)).cast("long")).alias("tokens"),
        F.sum(F.char_length(text).cast("long")).alias("chars"), F.count(F.lit(1)).alias("docs"))


register("tokens_per_language", f"""SELECT lang,
  CAST(SUM(len(regexp_extract_all(COALESCE(text, ''), '{TOKEN_PATTERN}'))) AS BIGINT) AS tokens,
  CAST(SUM(length(COALESCE(text, ''))) AS BIGINT) AS chars, COUNT(*) AS docs
FROM documents GROUP BY lang""")(tokens_per_language)
