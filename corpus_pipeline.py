"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

    language ID -> line dedup -> near-duplicate removal -> source mix -> byte-level BPE

A stage is ``stage(spark, docs, sf_dir)``; all but the last return the columns
of ``docs``. Every stage works on all rows the one before kept, and its
decisions take effect. The rows of a stage handle nulls, empty and repeated
texts as the operator it calls says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.llm.common import stored
from bandwise.llm.langid import UNKNOWN, with_languages
from bandwise.llm.line_dedup import drop_common_lines
from bandwise.llm.minhash_dedup import drop_near_duplicates
from bandwise.llm.mixing import mix_sources
from bandwise.llm.queries import bpe_digests
from bandwise.sources.tables import load_table

#: Probability of the predicted language below which a document is rejected.
LEAST_SCORE = 0.5
#: Documents from which a line is dropped.
LINE_DOCUMENTS = 10
#: Words per shingle, and percent of shingles that near-duplicates share.
SHINGLE_WORDS, PERCENT = 5, 80
#: Weights of the sources in turn, words of the mix per word of its input, and the most copies of a document.
WEIGHTS, SHARE, MOST_COPIES = (3, 1, 2), 1.5, 2


def _row(docs: DataFrame) -> Column:
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those whose language is uncertain; the others stay as they are."""
    good = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return with_languages(docs).filter(good).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that occur in LINE_DOCUMENTS documents. Every document stays, with the lines it has left."""
    out = drop_common_lines(docs.select("doc_id", "text", _row(docs).alias("row")), min_docs=LINE_DOCUMENTS)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, the one with the smallest id."""
    return drop_near_duplicates(docs, percent=PERCENT, width=SHINGLE_WORDS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, from not at all to MOST_COPIES times."""
    rows = docs.select("doc_id", "text", "source", _row(docs).alias("row"))
    mixed = mix_sources(rows, WEIGHTS, SHARE, MOST_COPIES).filter("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of the mix."""
    return bpe_digests(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix", mix),
          ("bpe", encode)]

#: The language classifier and the near-duplicate components cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``."""
    docs = load_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
