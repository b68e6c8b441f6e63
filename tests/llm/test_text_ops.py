"""BPE, toxicity, language, quality and licences: brute force, round trips, held-out accuracy, odd inputs."""

import random
import re
from collections import Counter

import math

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from bandwise.llm import bpe, licenses, quality, queries
from bandwise.llm import langid, toxicity
from bandwise.llm.langid import identify_languages, with_languages
from bandwise.llm.toxicity import score_toxicity
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOCS, doc, odd_rows

SF = SF_SMALL.replace("0.001", "0.01")
RANKS, PATTERN = queries.RANKS, public_tokenizers.PATTERN
ALPHABET = ["a", "b", " ", "  ", "\n", "'", "'re", "'l", "1", "!", "é", "世", "😀", "\t", "the ", "s", "　", "\r\n",
            "a" * 24, " " * 20, "1" * 30]


@pytest.mark.parametrize("size, overlap", [(3, 0), (5, 5), (8, 3), (16, 12), (40, 30)])
def test_stitched_chunks_equal_the_whole(size, overlap):
    table, rng = bpe.pieces_of(RANKS, PATTERN), random.Random(size)
    for _ in range(1500):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(100)))
        cuts = bpe.cut(text, size, overlap)
        parts = [bpe.encoded_chunk(table, size, overlap, i, i == len(cuts) - 1, c) for i, c in enumerate(cuts)]
        got = bpe.stitch(table, size, *(list(x) for x in zip(*parts)))
        assert got.tolist() == table.bpe.encode_ordinary(text), text


def test_chunks_hand_on_their_text_only_where_a_seam_needs_it():
    table = bpe.pieces_of(RANKS, PATTERN)
    text = "some words here " * 400 + "a" * 3000 + " and more words" * 300
    cuts = bpe.cut(text, 1000, 100)
    parts = [bpe.encoded_chunk(table, 1000, 100, i, i == len(cuts) - 1, c) for i, c in enumerate(cuts)]
    assert 2 <= sum(p[0] is not None for p in parts) <= 6


@pytest.mark.parametrize("chunk", [500, 16_384])
def test_bpe_of_odd_rows(odd, nothing, chunk):
    out = bpe.decode_documents(bpe.encode_documents(odd, RANKS, PATTERN, chunk_chars=chunk, overlap_chars=20), RANKS).collect()
    encode = bpe.pieces_of(RANKS, PATTERN).bpe.encode_ordinary
    want = sorted((repr(r[0]), tuple(encode(r[1] or "")), (r[1] or "").encode()) for r in odd_rows())
    assert sorted((repr(r.doc_id), tuple(np.frombuffer(bytes(r.ids), "<u4").tolist()), bytes(r.decoded)) for r in out) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in out)
    assert bpe.encode_documents(nothing, RANKS, PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe.encode_documents(odd, RANKS, PATTERN, chunk_chars=10, overlap_chars=11)


def test_language_accuracy_and_odd_rows(spark, odd, nothing):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = queries.op7_ftrl_language_id(spark, SF).join(truth, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and 0.1 < len(held) / 1000 < 0.3
    assert sum(r.lang_pred == r.lang for r in held) / len(held) >= 0.98
    out = {r.doc_id: r for r in identify_languages(odd).collect()}
    assert all((out[i].lang_pred, out[i].score) == ("und", 0.0) for i in (1, 2, 3, 9)) and out[4].lang_pred == "en"
    assert identify_languages(odd).count() == len(odd_rows()) and identify_languages(nothing).count() == 0
    assert with_languages(odd).select("row.*").columns == odd.columns
    none = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in identify_languages(none).collect()} == {"und"}


def test_language_sample_is_a_thousand_rows_a_language(spark, monkeypatch):
    from bandwise.llm import langid
    docs = spark.range(6000).selectExpr("id AS doc_id", "concat('word ', id) AS text", "if(id % 2 = 0, 'en', 'de') AS lang")
    sizes = []
    monkeypatch.setattr(langid, "fit", lambda sample, idf: (sizes.append(sample["lang"].value_counts().to_dict()),
                                                            (["de"], np.zeros((langid.BUCKETS + 1, 1)), 1.0))[1])
    langid.with_languages(docs)
    assert set(sizes[0]) == {"en", "de"} and all(850 <= n <= 1150 for n in sizes[0].values())


def test_toxicity_accuracy_and_odd_rows(spark, odd, nothing):
    large = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{large}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op6_nnpu_toxicity(spark, large).filter("held_out").join(labels, "doc_id").collect()
    clean = [r for r in rows if not r.toxic]
    toxic = [r for r in rows if r.toxic]
    assert sum(r.predicted for r in clean) / len(clean) <= 0.03
    assert sum(r.predicted for r in toxic) / len(toxic) >= 0.7
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(1, 15)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    assert score_toxicity(odd, marks).count() == len(odd_rows())
    assert score_toxicity(nothing, marks).count() == 0
    assert {r.score for r in score_toxicity(odd, marks.filter("toxic = 0")).collect()} == {0.0}


def test_toxicity_ignores_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((r.doc_id, r.score) for r in score_toxicity(docs, x).collect()) for x in (labels, turned))
    assert a == b


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    n, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if n[w] > 1:
            covered |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality(spark, odd, nothing):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op8_isolation_quality(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = brute_quality(docs[r.doc_id])
        assert tuple(r[c] for c in quality.COUNTS) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.kept and r.base_failed)
    judged = [(r.kept, labels[r.doc_id]) for r in rows if r.doc_id in labels and not r.base_failed]
    clean, bad = ([k for k, q in judged if q == x] for x in (1, 0))
    assert sum(clean) / len(clean) >= 0.99 and sum(bad) / len(bad) <= 0.1
    marks = spark.createDataFrame([(None, 1), (6, 1), (7, None), (13, 0)], "doc_id long, quality int")
    out = quality.judge_quality(odd, marks).collect()
    assert sorted((repr(r.doc_id), *(r[c] for c in quality.COUNTS)) for r in out) == sorted(
        (repr(r[0]), *brute_quality(r[1])) for r in odd_rows())
    assert quality.judge_quality(nothing, marks).count() == 0


def test_rare_defects_get_a_stricter_cut():
    # 100,000 clean rows, 90 of them in bin 8,500; 10,000 bad ones, 150 of them (1.5 %) in bin 9,500.
    bins = pd.DataFrame([(0, 1, 5_000, 99_910), (0, 1, 8_500, 90), (0, 0, 5_000, 9_850), (0, 0, 9_500, 150),
                         (1, 1, 5_000, 99_910), (1, 1, 8_500, 90), (1, 0, 5_000, 9_990), (1, 0, 8_500, 10)],
                        columns=["statistic", "quality", "bin", "n"])
    cuts = quality.calibrated_thresholds(bins, 0.999, 50)
    assert 0.85 < cuts[0] <= 0.95  # keeps every clean row, rejects the defect
    assert all(c > 1 for c in cuts[1:])  # nothing stricter to reject


def test_isolation_forest_finds_the_odd_one():
    rows = np.concatenate((np.random.default_rng(0).normal(0, 1, (500, 2)), [[9.0, 9.0]]))
    scores = quality.IsolationForest(rows, 100, 128).score(rows)
    assert scores.argmax() == 500 and (scores > 0).all() and (scores < 1).all()


def brute_licenses(text, templates, threshold, block):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], {}
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    for start in range(0, max(1, len(words) - block // 2), block // 2):
        inside = set(words[start:start + block])
        for label, t in templates:
            wanted = {w.decode() for w in licenses.words_of(t)}
            share = len(wanted & inside) / len(wanted)
            if len(wanted & inside) >= licenses.needed(len(wanted), threshold):
                labels[label] = max(labels.get(label, 0), share)
    base = {x for _, x in places}
    first = [i for i, _ in places]
    return (len(words), len(places), min(first, default=None), max(first, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | labels.keys())), max([1.0] * bool(base) + list(labels.values()), default=0.0))


def test_licenses(spark, odd, nothing):
    rng, rows = random.Random(6), odd_rows()
    filler = [w.decode() for _, t in licenses.TEMPLATES for w in licenses.words_of(t)] + ["été", "Ünder", "x", "y", "z"] * 40
    for i in range(120):
        words = [rng.choice(filler) for _ in range(rng.randrange(300))]
        for _ in range(rng.randrange(4)):
            template = rng.choice(licenses.TEMPLATES)[1].split()
            rng.shuffle(template) if rng.random() < 0.3 else None
            at = rng.randrange(len(words) + 1)
            words[at:at] = template[:len(template) - rng.randrange(3)]
        rows.append(doc(1000 + i, rng.choice([" ", "\n", "-"]).join(words)))
    rows += [doc(2000, "MIT License mit license, (Apache  License) general public license"), doc(2001, "mitt license")]
    got = licenses.scan_licenses(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    want = sorted(repr((r[0], *brute_licenses(r[1], licenses.TEMPLATES, licenses.THRESHOLD, licenses.BLOCK_WORDS))) for r in rows)
    assert sorted(repr(tuple(r)) for r in got) == want
    assert sum(r.labels != r.base_labels for r in got) > 10
    assert licenses.scan_licenses(nothing).count() == 0


def plain_ftrl(rows, classes, epochs):
    """Follow the regularised leader, one weight at a time; rows: ({place: value}, label)."""
    z, n = {}, {}

    def weight(key):
        if abs(z.get(key, 0.0)) <= langid.L1:
            return 0.0
        return -(z[key] - math.copysign(langid.L1, z[key])) / ((langid.BETA + math.sqrt(n[key])) / langid.ALPHA + langid.L2)

    for _ in range(epochs):
        for x, label in rows:
            scores = [sum(v * weight((i, c)) for i, v in x.items()) for c in range(classes)]
            e = [math.exp(s - max(scores)) for s in scores]
            for c in range(classes):
                for i, v in x.items():
                    g = v * (e[c] / sum(e) - (c == label))
                    w, old = weight((i, c)), n.get((i, c), 0.0)
                    z[i, c] = z.get((i, c), 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / langid.ALPHA * w
                    n[i, c] = old + g * g
    return {key: weight(key) for key in z}


def test_ftrl_against_a_plain_version():
    rng = np.random.default_rng(0)
    rows = [(rng.choice(200, 12, replace=False), rng.normal(size=12), int(rng.integers(3))) for _ in range(50)]
    model = langid.Ftrl(3)
    for _ in range(2):
        for at, x, label in rows:
            model.learn(at, x, label)
    want = plain_ftrl([(dict(zip(at.tolist(), x.tolist())), label) for at, x, label in rows], 3, 2)
    got = model.weights(slice(None))
    assert all(abs(got[i, c] - w) < 1e-9 for (i, c), w in want.items()) and np.count_nonzero(got) == sum(w != 0 for w in want.values())


def test_language_sample_is_bounded_for_repeated_ids_and_rows(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(langid, "fit", lambda sample, idf: (sizes.append(sample["lang"].value_counts().to_dict()),
                                                            (["de"], np.zeros((langid.BUCKETS + 1, 1)), 1.0))[1])
    one_id = spark.range(20_000).selectExpr("1L AS doc_id", "concat('word ', id) AS text", "'en' AS lang")
    one_row = spark.range(20_000).selectExpr("2L AS doc_id", "'the same' AS text", "'de' AS lang")
    many = spark.range(400).selectExpr("id + 10 AS doc_id", "concat('rare ', id) AS text", "concat('l', id) AS lang")
    with_languages(one_id.union(one_row).union(many), rows_per_language=1000, most_languages=5)
    assert 800 < sizes[0]["en"] < 1200 and sizes[0].get("de", 0) <= 1 and len(sizes[0]) <= 5


def test_nnpu_risk_against_a_plain_version():
    rng = np.random.default_rng(1)
    width, prior = 6, 0.2
    p, u = ([np.sort(rng.choice(width, int(rng.integers(0, 4)), replace=False)) for _ in range(n)] for n in (9, 30))

    def risk(w):
        def mean_loss(rows, sign):
            return np.mean([math.log1p(math.exp(-sign * (sum(w[i] for i in r) + w[-1]))) for r in rows])
        negatives = mean_loss(u, -1) - prior * mean_loss(p, -1)
        return prior * mean_loss(p, 1) + max(0.0, negatives), negatives

    rows = [toxicity.Rows(x, width) for x in (p, u)]
    w = rng.normal(size=width + 1) * 0.1
    scores = [r.scores(w) for r in rows]
    assert np.allclose(scores[1], [sum(w[i] for i in r) + w[-1] for r in u])
    g = prior * rows[0].gradient(toxicity.sigmoid(scores[0]) - 1) + rows[1].gradient(toxicity.sigmoid(scores[1])) - prior * rows[0].gradient(toxicity.sigmoid(scores[0]))
    step = 1e-6 * np.eye(width + 1)
    assert risk(w)[1] > 0 and np.allclose(g, [(risk(w + d)[0] - risk(w - d)[0]) / 2e-6 for d in step], atol=1e-6)
    trained = toxicity.train(*rows, prior)
    assert risk(trained)[0] < risk(np.append(np.zeros(width), math.log(prior / (1 - prior))))[0]


def test_toxicity_sample_is_bounded_for_repeated_ids(spark, monkeypatch):
    sizes = []
    train = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda p, u, prior: sizes.append((p.n, u.n)) or train(p, u, prior, 3))
    docs = spark.range(6000).selectExpr("if(id % 2 = 0, 1L, id) AS doc_id", "concat('word', id % 700, ' bad thing') AS text")
    marks = spark.createDataFrame([(1, 1), (3, 0), (7, 0), (11, 1)], "doc_id long, toxic int")
    assert score_toxicity(docs, marks, positive_rows=200, unlabelled_rows=300).count() == 6000
    assert 0 < sizes[0][0] <= 300 and 0 < sizes[0][1] <= 400
