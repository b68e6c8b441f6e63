"""Catalog of this subpackage: opN_<name> queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.llm.bpe import decode_documents, encode_documents
from bandwise.llm.hard_negatives import mine_hard_negatives
from bandwise.llm.importance import resample
from bandwise.llm.langid import identify_languages
from bandwise.llm.licenses import scan_licenses
from bandwise.llm.line_dedup import drop_common_lines
from bandwise.llm.minhash_dedup import near_duplicates
from bandwise.llm.mixing import mix_sources
from bandwise.llm.quality import COUNTS, judge_quality
from bandwise.llm.sharding import shard_documents
from bandwise.llm.substring_dedup import drop_repeated_passages
from bandwise.llm.topk import top_inner_products
from bandwise.llm.toxicity import score_toxicity
from bandwise.sources.tables import load_table

#: Rank file and pre-token pattern of the registered query: a public multilingual vocabulary.
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@register("op1_line_dedup", r"""
WITH lines AS (
  SELECT doc_id, rn, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, rn, unnest(l) AS line, generate_subscripts(l, 1) AS pos
        FROM (SELECT doc_id, row_number() OVER () AS rn, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
common AS (SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN common c ON l.key = c.key
GROUP BY doc_id, rn""")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents", ["doc_id", "text"])
    out = drop_common_lines(docs, min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@register("op2_odd_sketch_dedup")
def op2_odd_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return near_duplicates(docs, percent=80, width=2).select("doc_id", "n_shingles", "component_id", "kept")


def _uniform_sql(text: str) -> str:
    return f"((('0x' || substr(md5({text}), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE)"


def _winner_sql(shards: int) -> str:
    scores = (f"(-1.0 / ln({_uniform_sql(f"coalesce(doc_id::VARCHAR, '') || ':{i}'")}), {-i})" for i in range(shards))
    return f"-list_max([{', '.join(scores)}])[2]"


#: crc32 by its table, which a recursive query derives from the polynomial.
_CRC_TABLE_SQL = """RECURSIVE steps(i, k, v) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM steps WHERE k = 8),"""
_CRC_SQL = _CRC_TABLE_SQL + """
docs AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(
               regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crc_table)"""


@register("op3_rendezvous_sharding", f"""WITH {_CRC_SQL},
dealt AS (SELECT *, {_winner_sql(8)} AS shard, {_winner_sql(9)} AS grown_shard,
          {_uniform_sql("concat_ws(':', coalesce(doc_id::VARCHAR, ''), text_crc32::VARCHAR, size::VARCHAR)")} AS u FROM docs)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY u, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       grown_shard::INTEGER AS grown_shard FROM dealt""")
def op3_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return shard_documents(docs, weights=[1.0] * 8)


@register("op4_norm_sorted_topk", """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5""")
def op4_norm_sorted_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(load_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), k=5, query_every=50)


def bpe_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    out = decode_documents(encode_documents(docs, RANKS, PATTERN), RANKS)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op5_chunked_bpe")
def op5_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(load_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@register("op6_nnpu_toxicity")
def op6_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = load_table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    return score_toxicity(docs, labels)


@register("op7_ftrl_language_id")
def op7_ftrl_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(load_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"]))


@register("op8_isolation_quality")
def op8_isolation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = load_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    return judge_quality(docs, labels).select("doc_id", *COUNTS, "base_failed", "kept")


@register("op9_license_scan")
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(load_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def _mix_sql(passes: int) -> str:
    """The same plan with window functions over whole sources."""
    steps = []
    for k in range(passes):
        steps.append(f"""
c{k} AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q RANGE UNBOUNDED PRECEDING) AS run FROM r{k}
         WHERE q IS NOT NULL AND NOT extra AND size <= open),
k{k} AS (SELECT source, max(q) AS cut, sum(size) AS words FROM c{k} WHERE run <= open GROUP BY source),
r{k + 1} AS (SELECT r.doc_id, r.source, size, source_size, target, certain, q,
             extra OR coalesce(size <= open AND q <= cut, false) AS extra, open - coalesce(words, 0) AS open
             FROM r{k} r LEFT JOIN k{k} k ON r.source IS NOT DISTINCT FROM k.source)""")
    return r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT
          ::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
          FROM docs GROUP BY source),
weighed AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((place - 1) % 3 + 1)::INT] AS weight,
            source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM sizes),
levels AS (SELECT *, cap / weight AS ratio,
           (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
           FROM weighed),
final AS (SELECT min_by(level, (ratio, place)) AS level FROM levels WHERE ratio > level),
targets AS (SELECT source, source_size, CASE WHEN f.level IS NULL THEN cap ELSE least(cap, f.level * weight) END AS target
            FROM levels, final f),
by_x AS (SELECT source, floor(sqrt(size::DOUBLE) * 1000)::BIGINT AS x, sum(size) AS words FROM docs WHERE size > 0 GROUP BY ALL),
caps AS (SELECT source, x, coalesce(sum(words) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         (sum(words::HUGEINT * x) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS rest
         FROM by_x WINDOW w AS (PARTITION BY source ORDER BY x DESC)),
rate AS (SELECT c.source, arg_max((target - 2.0::DOUBLE * before) / rest, x) AS rate
         FROM caps c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source
         WHERE (target - 2.0::DOUBLE * before) / rest * x < 2 GROUP BY c.source),
hoped AS (SELECT docs.*, source_size, target,
          coalesce(least(2.0::DOUBLE, rate * floor(sqrt(greatest(size, 1)::DOUBLE) * 1000)::BIGINT), 2.0::DOUBLE) AS copies
          FROM docs JOIN targets t ON docs.source IS NOT DISTINCT FROM t.source LEFT JOIN rate r ON docs.source IS NOT DISTINCT FROM r.source),
r0 AS (SELECT doc_id, source, size, source_size, target, floor(copies)::BIGINT AS certain,
       CASE WHEN copies > floor(copies)
            THEN (u * (1 - (copies - floor(copies)))) / ((1 - u) * (copies - floor(copies))) END AS q,
       false AS extra, target - sum(floor(copies)::BIGINT * size) OVER (PARTITION BY source) AS open
       FROM hoped),""" + ",".join(steps) + f"""
,
nearest AS (SELECT source, arg_min(size, (abs(size - open), q)) AS pick_size, arg_min(q, (abs(size - open), q)) AS pick_q
            FROM r{passes} WHERE q IS NOT NULL AND NOT extra AND size > 0 AND abs(size - open) < open GROUP BY source)
SELECT doc_id, size, source_size, target,
       size * (certain + (extra OR coalesce(size = pick_size AND q = pick_q, false))::BIGINT) AS taken
FROM r{passes} r LEFT JOIN nearest n ON r.source IS NOT DISTINCT FROM n.source"""


@register("op10_pareto_mix", _mix_sql(4))
def op10_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    return mix_sources(docs, weights=(3, 1, 2), share=1.5, max_copies=2).select(
        "doc_id", "size", "source_size", "target", "taken")


@register("op11_bond_hard_negatives", """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
           FROM v a JOIN v c ON len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
positives AS (SELECT * FROM scored WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
 AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5""")
def op11_bond_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(vectors.withColumn("label", label))


def _words_sql(table: str, id_col: str) -> str:
    return rf"""(SELECT id, rn, unnest(l) AS word, generate_subscripts(l, 1) AS pos
        FROM (SELECT {id_col} AS id, row_number() OVER () AS rn, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS l FROM {table}))"""


def _features_sql(words: str) -> str:
    return f"""(SELECT rn, word AS f FROM {words} UNION ALL
    SELECT rn, f FROM (SELECT rn, word || ' ' || lead(word) OVER (PARTITION BY rn ORDER BY pos) AS f FROM {words})
    WHERE f IS NOT NULL)"""


@register("op12_segment_resample", f"""WITH {_CRC_TABLE_SQL}
doc_words AS {_words_sql("documents", "doc_id")},
target_words AS {_words_sql("benchmark", "item_id")},
df AS {_features_sql("doc_words")},
tf AS {_features_sql("target_words")},
hashed AS (SELECT f, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(
             regexp_extract_all(hex(encode(f)), '..'), lambda h: ('0x' || h)::BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
           FROM (SELECT f FROM df UNION SELECT f FROM tf), crc_table),
db AS (SELECT rn, bucket FROM df JOIN hashed USING (f)),
s AS (SELECT bucket, count(*)::DOUBLE AS s FROM db GROUP BY bucket),
t AS (SELECT bucket, count(*)::DOUBLE AS t FROM tf JOIN hashed USING (f) GROUP BY bucket),
gains AS (SELECT b.i AS bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT sum(s) FROM s) + 10000)
            / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000))))::BIGINT AS gain
          FROM range(10000) b(i) LEFT JOIN s ON s.bucket = b.i LEFT JOIN t ON t.bucket = b.i),
weights AS (SELECT rn, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
            FROM db JOIN gains USING (bucket) GROUP BY rn),
scored AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
             + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
           FROM (SELECT doc_id, row_number() OVER () AS rn FROM documents) LEFT JOIN weights USING (rn)),
ranked AS (SELECT *, n_features >= 39 AS fits,
           row_number() OVER (PARTITION BY n_features >= 39 ORDER BY score DESC, doc_id NULLS LAST) AS r,
           count(*) FILTER (WHERE n_features >= 39) OVER () * 25 // 100 AS n_drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN fits AND r <= n_drawn THEN r END AS rank FROM ranked""")
def op12_segment_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents", ["doc_id", "text"])
    target = load_table(spark, sf_dir, "benchmark", ["text"])
    out = resample(docs, target, percent=25, least_words=20, seed=7)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


@register("op13_fixed_block_dedup", r"""
WITH docs AS (SELECT doc_id, coalesce(doc_id, 9223372036854775807) AS id, row_number() OVER () AS rn,
              regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l FROM documents),
windows AS (SELECT id, rn, s, md5(array_to_string(l[s:s + 12], ' ')) AS g
            FROM (SELECT id, rn, l, unnest(range(1, len(l) - 11)) AS s FROM docs)),
least AS (SELECT g, min(id) AS first FROM windows GROUP BY g),
gone AS (SELECT DISTINCT rn, unnest(range(s, s + 13)) AS pos FROM windows JOIN least USING (g) WHERE id > first),
words AS (SELECT doc_id, rn, unnest(l) AS word, generate_subscripts(l, 1) AS pos FROM docs),
kept AS (SELECT w.rn, count(g.pos) AS n_removed, string_agg(word, ' ' ORDER BY w.pos) FILTER (WHERE g.pos IS NULL) AS text
         FROM words w LEFT JOIN gone g ON w.rn = g.rn AND w.pos = g.pos GROUP BY w.rn)
SELECT doc_id, len(l)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rn)""")
def op13_fixed_block_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents", ["doc_id", "text"])
    out = drop_repeated_passages(docs, width=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
