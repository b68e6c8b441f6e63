"""Catalog: regular expressions (R1-R14) and JSON flattening."""

from __future__ import annotations

from pyspark.sql import functions as F

from bandwise.functions.regex import (all_matches, conditional_match, first_match, group, join_list,
                                      search, split_list)
from bandwise.operators.jsonflat import flatten_json
from bandwise.plans.catalog import register
from bandwise.sources.tables import load_table

# Predicate patterns over whole document texts (RE2-compatible, so
# the DuckDB oracle evaluates the same expressions).
PREDICATES = [
    ("has_year", r"\d{4}"),
    ("starts_upper", r"^[A-Z]"),
    ("word_the", r"\bthe\b"),
    ("non_ascii", r"[^\x00-\x7F]"),
    ("secret_ci", r"(?i)secret"),
    ("double_space", r"\s{2,}"),
    ("three_vowels", r"[aeiou]{3}"),
    ("email_like", r"[A-Za-z0-9._]+@[A-Za-z0-9.]+\.[a-z]{2,}"),
    ("lazy_tag", r"<.+?>"),
]


# Literals that every match of a predicate contains (a prefilter, same result).
REQUIRED = {"email_like": "@"}


def regex_predicates(spark, sf_dir):
    """Predicate flags over every document's whole text."""
    d = load_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", *[search("text", p, REQUIRED.get(n)).alias(n) for n, p in PREDICATES])


register("regex_predicates", "SELECT doc_id, " + ", ".join(
    f"regexp_matches(text, '{p}') AS {n}" for n, p in PREDICATES) + " FROM documents")(regex_predicates)


def regex_counts(spark, sf_dir):
    """Documents matching each predicate, per language."""
    d = load_table(spark, sf_dir, "documents", ["lang", "text"])
    return d.groupBy("lang").agg(*[F.count_if(search("text", p, REQUIRED.get(n))).alias(n) for n, p in PREDICATES])


register("regex_counts", "SELECT lang, " + ", ".join(
    f"CAST(count_if(regexp_matches(text, '{p}')) AS BIGINT) AS {n}" for n, p in PREDICATES)
    + " FROM documents GROUP BY lang")(regex_counts)

URL_GROUPS = [
    ("scheme", r"^(https?)://", 1),
    ("host", r"://([^/?#]+)", 1),
    ("lang", r"^[a-z]+://[^/]+/([a-z]{2})/", 1),
    ("page_no", r"[?&]page=(\d+)", 1),
    ("fragment", r"#(\w+)$", 1),
    ("tld", r"\.([a-z]+)(?:/|$)", 1),
]


def regex_groups(spark, sf_dir):
    """Capture groups from page URLs (null when no match)."""
    p = load_table(spark, sf_dir, "pages", ["page_id", "url"])
    return p.select("page_id", *[group("url", pat, i).alias(n) for n, pat, i in URL_GROUPS],
                    first_match("url", r"\d+").alias("first_number"))


register("regex_groups", "SELECT page_id, " + ", ".join(
    f"CASE WHEN regexp_matches(url, '{pat}') THEN regexp_extract(url, '{pat}', {i}) END AS {n}"
    for n, pat, i in URL_GROUPS)
    + r", CASE WHEN regexp_matches(url, '\d+') THEN regexp_extract(url, '\d+', 0) END AS first_number"
    + " FROM pages")(regex_groups)


def regex_conditional(spark, sf_dir):
    """Conditional pattern as a CASE of two predicates: https URLs must
    carry a fragment, the others a query string."""
    p = load_table(spark, sf_dir, "pages", ["page_id", "url"])
    return p.select("page_id", conditional_match("url", r"^https", r"#", r"\?").alias("well_formed"))


register("regex_conditional", r"""
SELECT page_id, CASE WHEN regexp_matches(url, '^https') THEN regexp_matches(url, '#')
                     ELSE regexp_matches(url, '\?') END AS well_formed FROM pages""")(regex_conditional)


def split_join(spark, sf_dir):
    """URL path split to a list, membership test, re-join."""
    p = load_table(spark, sf_dir, "pages", ["page_id", "url"])
    parts = split_list(F.regexp_replace("url", r"^[a-z]+://", ""), "/")
    return p.select("page_id", F.size(parts).alias("n_parts"),
                    F.array_contains(parts, "en").alias("has_en"),
                    join_list(parts, "|").alias("joined"))


register("split_join", r"""
WITH s AS (SELECT page_id, string_split(regexp_replace(url, '^[a-z]+://', ''), '/') AS parts FROM pages)
SELECT page_id, CAST(len(parts) AS INTEGER) AS n_parts, list_contains(parts, 'en') AS has_en,
       array_to_string(parts, '|') AS joined FROM s""")(split_join)


def regex_lookaround(spark, sf_dir):
    """Backreference, named group/backreference, lookahead and
    lookbehind over every conversation turn (Java regex; no RE2 oracle)."""
    c = load_table(spark, sf_dir, "conversations", ["conv_id", "turn", "text"])
    return c.select(
        "conv_id", "turn",
        first_match("text", r"\b(\w+)\s+\1\b").alias("repeated_word"),
        first_match("text", r"(?P<w>\w+)-(?P=w)").alias("named_repeat"),
        F.size(all_matches("text", r"\w+(?=\?)")).alias("words_before_question"),
        F.size(all_matches("text", r"(?<=\$)\d+")).alias("amounts_after_dollar"),
        search("text", r"^(?!.*\?).*\.\Z").alias("statement_only"))


register("regex_lookaround")(regex_lookaround)


def json_flatten(spark, sf_dir):
    """Every event's JSON properties as (variable, value) leaves."""
    ev = load_table(spark, sf_dir, "events", ["event_id", "props"])
    return flatten_json(ev, ["event_id"], "props")


register("json_flatten", """
SELECT e.event_id, '_' || j.key AS variable,
       CASE json_type(j.value) WHEN 'NULL' THEN 'None' WHEN 'BOOLEAN' THEN
              CASE WHEN CAST(j.value AS BOOLEAN) THEN 'True' ELSE 'False' END
            WHEN 'VARCHAR' THEN j.value ->> '$' ELSE CAST(j.value AS VARCHAR) END AS value
FROM events e, json_each(e.props) j
WHERE json_type(j.value) NOT IN ('OBJECT', 'ARRAY')""")(json_flatten)


def json_nested(spark, sf_dir):
    """An order with its customer and lines as one nested document -> leaves, three levels deep."""
    o = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])
    li = load_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount",
                                               "l_returnflag", "l_linestatus"])
    line = F.struct(F.col("l_linenumber").alias("number"), F.array("l_returnflag", "l_linestatus").alias("tags"),
                    (F.col("l_discount") > 0.05).alias("cut"),
                    F.struct(F.col("l_partkey").alias("part"), F.when(F.col("l_quantity") > 10, F.col("l_suppkey")).alias("supplier")).alias("item"))
    lines = li.groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))  # an order's lines
    document = F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.struct(F.col("o_custkey").alias("key")).alias("customer"), "lines"),
                         {"ignoreNullFields": "false"})
    return flatten_json(o.join(lines, o.o_orderkey == lines.l_orderkey).select("o_orderkey", document.alias("doc")), ["o_orderkey"], "doc")


register("json_nested", """
WITH d AS (SELECT o.*, l.* FROM orders o JOIN lineitem l ON o_orderkey = l_orderkey),
k AS (SELECT DISTINCT o_orderkey, o_orderstatus, o_custkey FROM d)
SELECT o_orderkey, '_status' AS variable, o_orderstatus AS value FROM k
UNION ALL SELECT o_orderkey, '_customer_key', CAST(o_custkey AS VARCHAR) FROM k
UNION ALL SELECT o_orderkey, '_lines__number', CAST(l_linenumber AS VARCHAR) FROM d
UNION ALL SELECT o_orderkey, '_lines__cut', CASE WHEN l_discount > 0.05 THEN 'True' ELSE 'False' END FROM d
UNION ALL SELECT o_orderkey, '_lines__item_part', CAST(l_partkey AS VARCHAR) FROM d
UNION ALL SELECT o_orderkey, '_lines__item_supplier', CASE WHEN l_quantity > 10 THEN CAST(l_suppkey AS VARCHAR) ELSE 'None' END FROM d""")(json_nested)
