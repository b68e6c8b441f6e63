"""The pipeline against a plain version of its stages."""

import hashlib
import math
import random
import string

import numpy as np

import corpus_pipeline
from bandwise.llm import bpe, queries
from bandwise.llm.common import stored
from tests.conftest import SF_SMALL
from tests.llm.conftest import odd_rows
from tests.llm.test_dedup import brute_components, brute_lines
from tests.llm.test_mix_shard_topk import plain_targets


def test_stages_on_odd_rows(spark, odd, nothing):
    for docs in (odd, nothing):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF_SMALL))
            if name != "bpe":
                assert docs.columns == columns
    assert docs.count() == 0
    kept = corpus_pipeline.language_id(spark, odd, SF_SMALL)
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in odd_rows()} - {1, 2, 3, 9}


def test_language_stage_rejects_noise(spark):
    """Letter noise is no language; real texts stay. On all learning rows of sf0.01."""
    rng, sf = random.Random(1), SF_SMALL.replace("0.001", "0.01")
    noise = [(10 ** 9 + i, " ".join("".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randrange(1, 10)))
                                    for _ in range(rng.choice([10, 50, 300])))) for i in range(200)]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    planted = spark.createDataFrame(noise, "doc_id long, text string")
    both = docs.unionByName(planted, allowMissingColumns=True)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, both, sf).select("doc_id").collect()}
    real = [r.doc_id for r in docs.filter("text rlike '[a-zA-Z]'").select("doc_id").collect()]
    assert sum(i in kept for i, _ in noise) <= 10 and sum(i in kept for i in real) >= 0.99 * len(real)


def test_run_against_plain_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    first = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, SF_SMALL).collect()}
    letters = {i for i, r in rows.items() if any(c.isalpha() for c in r.text or "")}
    assert first <= letters and len(letters - first) <= 0.01 * len(letters)
    lines = {i: t for i, t, _, _ in brute_lines([(i, rows[i].text) for i in sorted(first)], corpus_pipeline.LINE_DOCUMENTS)}
    left = {i: lines[i] for i, n, c in brute_components(sorted(lines.items()), corpus_pipeline.SHINGLE_WORDS) if i == c or not n}
    encode = bpe.pieces_of(queries.RANKS, queries.PATTERN).bpe.encode_ordinary
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    taken = {}
    for r in got:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + 1
        ids = np.array(encode(left[r.doc_id]), "<u4")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(left[r.doc_id].encode()).hexdigest()
    sizes, words = {}, {}
    for i, t in left.items():
        source = rows[i].source
        sizes[source] = sizes.get(source, 0) + len(t.split())
        words[source] = words.get(source, 0) + taken.get(i, 0) * len(t.split())
    assert max(taken.values()) <= 2
    targets = plain_targets(sizes, corpus_pipeline.WEIGHTS, corpus_pipeline.SHARE, corpus_pipeline.MOST_COPIES)
    assert math.isclose(sum(targets.values()), 1.5 * sum(sizes.values()))
    for s, t in targets.items():
        assert abs(words[s] - t) <= max(10, 0.15 * t)
