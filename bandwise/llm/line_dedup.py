"""Line dedup: drop lines whose normalised form occurs in many documents.

Plan, all in built-in functions:

1. Each text is split at \\n and every line normalised to its key (ASCII white
   space stripped at both ends, A-Z lower-cased); keys explode to (document,
   position, 128-bit hash).
2. ``groupBy(hash, document, content)`` gathers the positions, so a very common
   line is spread over its documents' partitions, documents without an id by
   their text; the table is written once. A second, map-side combined count
   gives the distinct ids per hash.
3. Occurrences of hashes at or over the threshold are found with a join on
   (hash, salt): the rare frequent hashes are repeated per salt, so that the
   occurrences of one hot line are shared out over ``salts`` tasks.
4. Their positions are gathered per document and the text is put together
   again from the positions that stay. The text itself moves at most once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import ASCII_SPACE, ascii_lower, free_name, let, stored, text_of

SALTS = 32


def line_keys(text: Column) -> Column:
    """Array of normalised line keys of a text, one per line."""
    return F.transform(F.split(ascii_lower(text), "\n", -1), lambda x: F.btrim(x, F.lit(ASCII_SPACE)))


def drop_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
                      min_chars: int = 1, salts: int = SALTS) -> DataFrame:
    """All rows and columns of ``docs`` with common lines removed from ``text_col``.

    Adds ``n_lines`` (before) and ``n_dropped`` (both long); columns of these
    names that ``docs`` has already are replaced. A line is dropped everywhere
    if its key has at least ``min_chars`` code points and occurs in at least
    ``min_docs`` documents (distinct ids; a null id counts as one document).

    Null or empty text is one empty line, which stays (an empty key is shorter
    than ``min_chars``), so the result text is empty. If every line goes, the
    result text is empty as well. Rows repeated under one id count as one
    document and are all returned. An empty table gives an empty table.
    """
    key, content = free_name(docs, "_line_id"), free_name(docs, "_line_content")
    gone = free_name(docs, "_line_gone")
    rows = docs.withColumns({key: F.col(id_col), content: F.xxhash64(text_of(text_col))})
    occurrences = (
        rows.select(F.col(key).alias("id"), F.col(content).alias("content"),
                    F.posexplode(line_keys(text_of(text_col))).alias("pos", "line"))
        .filter(F.char_length("line") >= min_chars)
        .select("id", "content", F.unhex(F.md5("line")).alias("hash"), "pos"))
    per_doc = stored(occurrences.groupBy("hash", "id", "content").agg(F.collect_list("pos").alias("spots")))
    frequent = (per_doc.select("hash", "id").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs)
                .select("hash", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")))
    dropped = (
        per_doc.withColumn("salt", F.pmod(F.xxhash64("id", "content"), F.lit(salts)).cast("int"))
        .join(frequent, ["hash", "salt"])
        .select("id", "content", F.explode("spots").alias("pos"))
        .groupBy("id", "content").agg(F.collect_list("pos").alias(gone)))
    lines = F.split(text_of(text_col), "\n", -1)
    kept = let(lines, lambda x: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.coalesce(F.col(gone), F.array().cast("array<int>"))),
        lambda i: x[i]), "\n"))
    joined = rows.join(dropped, rows[key].eqNullSafe(dropped["id"]) & (rows[content] == dropped["content"]), "left")
    n_dropped = F.coalesce(F.size(F.array_distinct(gone)), F.lit(0)).cast("long")
    new = {text_col: kept, "n_lines": F.size(lines).cast("long"), "n_dropped": n_dropped}
    names = [*docs.columns, *(c for c in ("n_lines", "n_dropped") if c not in docs.columns)]
    return joined.select(*(new[c].alias(c) if c in new else rows[c] for c in names))
