"""Hard negatives, importance resampling and substring dedup against plain versions, and their odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bandwise.llm import hard_negatives, words
from bandwise.llm.hard_negatives import mine_hard_negatives
from bandwise.llm.importance import Segments, bucket_counts, resample
from bandwise.llm.substring_dedup import drop_repeated_passages
from tests.llm.conftest import DOCS, doc, odd_rows

PLAIN = re.compile("[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Words

def test_words_and_hashes():
    texts = ["Hello world  a\n", "", None, "x" * 200 + " été\x0bfoo 1a", "no", "end", "y" * 200 + " " + "x" * 200]
    data, offsets = words.utf8(pa.array(texts))
    starts, ends, text = words.spans(data, offsets, words.PLAIN)
    got = [(int(t), data[s:e].tobytes().decode()) for s, e, t in zip(starts, ends, text, strict=True)]
    assert got == [(i, w) for i, x in enumerate(texts) for w in PLAIN.findall(x or "")]
    assert [int(c) for c in words.crc32_words(data, starts, ends)] == [zlib.crc32(w.encode()) for _, w in got]
    state = words.crc32_space(words.crc32_words(data, starts, ends))
    pairs = words.crc32_words(data, starts[1:], ends[1:], state[:-1])
    assert [int(c) for c in pairs] == [zlib.crc32(f"{a} {b}".encode()) for (_, a), (_, b) in zip(got, got[1:])]
    for h in words.word_hashes(data, starts, ends):
        assert len(set(h.tolist())) == len({w for _, w in got})


# Substring dedup

def plain_passages(rows, width):
    """(n_words, n_removed, text, spans) of rows (id, text)."""
    least, split = {}, [PLAIN.findall(t or "") for _, t in rows]
    ids = [math.inf if i is None else i for i, _ in rows]
    for i, w in zip(ids, split):
        for k in range(len(w) - width + 1):
            g = tuple(w[k:k + width])
            least[g] = min(least.get(g, math.inf), i)
    out = []
    for i, w in zip(ids, split):
        gone = np.zeros(len(w) + 1, bool)
        for k in range(len(w) - width + 1):
            if least[tuple(w[k:k + width])] < i:
                gone[k:k + width] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([False], gone)).astype(int)))
        out.append((len(w), int(gone.sum()), " ".join(x for x, g in zip(w, gone) if not g),
                    tuple((int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2]))))
    return out


def passages(df, **kw):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.text, tuple(tuple(s) for s in r.repeats))
                  for r in drop_repeated_passages(df, **kw).collect())


def wanted(rows, width):
    return sorted((i is None, i or 0, *p) for (i, _), p in zip(rows, plain_passages(rows, width)))


@pytest.mark.parametrize("width", [1, 2, 13])
def test_passages(spark, width):
    rng = random.Random(width)
    passage = [" ".join(rng.choice("abcdefgh") * 2 + str(rng.randrange(40)) for _ in range(n)) for n in (12, 13, 14, 30, 55)]
    rows = []
    for i in range(160):
        parts = [rng.choice(passage) if rng.random() < 0.4 else " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(20)))
                 for _ in range(rng.randrange(6))]
        rows.append((rng.choice([i, i, i, 7, None]), rng.choice([" ", "\n", "\t\x0b "]).join(parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for chunk, part in ((1 << 20, 1 << 20), (500, 700)):  # one chunk and part, and many
        assert passages(df, width=width, chunk_bytes=chunk, part_bytes=part) == wanted(rows, width)


def test_passage_of_a_third_of_the_rows(spark):
    common = " ".join(f"c{i}" for i in range(40))
    rows = [(i, f"own{i} {common} tail{i}" if i % 3 == 0 else f"only {i} here") for i in range(900)]
    got = drop_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), chunk_bytes=2000, part_bytes=2000)
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[0].n_removed == 0 and by_id[3].n_removed == 40 and by_id[3].text == "own3 tail3"
    assert [tuple(s) for s in by_id[897].repeats] == [(1, 40)]
    assert sum(r.n_removed for r in by_id.values()) == 40 * 299


def test_passages_of_odd_rows(spark, odd, nothing):
    got = drop_repeated_passages(odd, chunk_bytes=1000)
    assert got.columns == [*odd.columns, "n_words", "n_removed", "repeats"]
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert passages(odd, chunk_bytes=1000) == wanted(rows, 13)
    kept = {r.doc_id: r for r in got.collect()}
    assert kept[7].text == "end"  # the long text again
    assert kept[10].source is None and kept[5].copies == "x"
    assert drop_repeated_passages(nothing).count() == 0
    clash = odd.withColumnsRenamed({"size": "_chunk", "score": "n_words", "copies": "_seq", "p": "repeats"})
    again = drop_repeated_passages(clash, chunk_bytes=1000)
    assert again.columns == [*clash.columns, "n_removed"] and again.filter("_chunk = 'x' AND _seq = 'x'").count() == len(rows)
    with pytest.raises(ValueError):
        drop_repeated_passages(odd, width=0)


# Importance resampling

def features(text):
    w = ALNUM.findall((text or "").translate(LOWER))
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def plain_resample(rows, target, percent, least_words):
    counts = [Counter(zlib.crc32(f.encode()) % 10_000 for t in texts for f in features(t)[1])
              for texts in (target, [t for _, t in rows])]
    t_all, s_all = (sum(c.values()) + 10_000.0 for c in counts)
    out = []
    for i, text in rows:
        w, fs = features(text)
        gains = [math.floor(1000 * math.log((counts[0][b] + 1.0) * s_all / ((counts[1][b] + 1.0) * t_all)))
                 for b in (zlib.crc32(f.encode()) % 10_000 for f in fs)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(w), len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    n = percent * len(fit) // 100
    return out, [(r[4], r[0]) for r in fit[:n]]


def check_resample(df, rows, target, target_df, **kw):
    want, drawn = plain_resample(rows, target, 25, kw.get("least_words", 20))
    got = resample(df, target_df, **kw).collect()
    assert sorted(map(repr, ([r.doc_id, r.n_words, r.n_features, r.weight, r.score] for r in got))) == sorted(map(repr, want))
    ranked = sorted((r.rank, r.score, r.doc_id) for r in got if r.rank is not None)
    assert [r[0] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(s, i) for _, s, i in ranked] == drawn


def test_resample(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["été", "A-b", "X1", "," * 3]

    def text():
        return rng.choice(["\n", " \n\n", ". "]).join(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(12)))
                                                      for _ in range(rng.randrange(8)))

    rows = [(i, text()) for i in range(400)] + [(1000 + i, "the same line\n" * 30) for i in range(200)]
    target = [" ".join(vocabulary[:9]) for _ in range(5)] + [None, ""]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    target_df = spark.createDataFrame([(t,) for t in target], "text string")
    check_resample(df, rows, target, target_df)
    check_resample(df, rows, target, target_df, rows_per_task=7)  # many range partitions
    counts = {r.bucket: r.n for r in bucket_counts(df.select("text"), 50).collect()}
    assert counts == Counter(zlib.crc32(f.encode()) % 50 for _, t in rows for f in features(t)[1])


def test_segments_are_evaluated_once():
    s = Segments(pa.array(["a b\nc\n\na b", "a b\n \nc d", None]))
    assert len(s.lines) == 5 and len(s.line) == 5  # blank lines have no place
    assert sorted(zip(s.text.tolist(), (s.lines[int(i)].as_py() for i in s.line))) == sorted(
        [(0, "a b"), (0, "c"), (0, "a b"), (1, "a b"), (1, "c d")])
    crc, text = s.crossing()
    assert sorted(zip(text.tolist(), crc.tolist())) == sorted(
        (i, zlib.crc32(p)) for i, p in [(0, b"b c"), (0, b"c a"), (1, b"b c")])


def test_resample_of_odd_rows(spark, odd, nothing):
    rows = [(r[0], r[1]) for r in odd_rows()]
    target_df = spark.createDataFrame([("one word of few",)], "text string")
    check_resample(odd, rows, ["one word of few"], target_df, least_words=1)
    assert resample(odd, target_df).columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    check_resample(odd, rows, [], target_df.limit(0), least_words=1)
    assert resample(nothing, target_df).count() == 0
    assert resample(odd, target_df, percent=0).filter("rank IS NOT NULL").count() == 0
    repeated = spark.createDataFrame([(5, "a b c")] * 40, "doc_id long, text string")
    assert sorted(r.rank for r in resample(repeated, target_df, least_words=1).collect() if r.rank) == list(range(1, 11))


# Hard negatives

def plain_negatives(rows, every=100, k=5, low=80, high=100):
    """rows: (id, label, vector of whole numbers)."""
    found = set()
    for a, label, q in rows:
        if a % every:
            continue
        scores = [(sum(x * y for x, y in zip(q, v)), i, l == label) for i, l, v in rows if i != a and len(v) == len(q)]
        for p, p_id, _ in sorted((s for s in scores if s[2]), key=lambda s: (-s[0], s[1]))[:k]:
            inside = sorted((s for s in scores if not s[2] and low * p <= 100 * s[0] <= high * p), key=lambda s: (-s[0], s[1]))
            found |= {(a, p_id, r, n_id, p, n) for r, (n, n_id, _) in enumerate(inside[:k], 1)}
    return found


def mined(df, **kw):
    rows = [tuple(r) for r in mine_hard_negatives(df, **kw).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("sizes", [dict(), dict(block=16, bundle=3, group=4)])
def test_hard_negatives(spark, sizes):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 12)) * 2
    rows, plain = [], []
    for i in range(600):
        label = 0 if i % 3 == 0 else int(rng.integers(4))  # a hot label
        v = centres[label] * 0.3 + centres[0] + rng.normal(size=12) * 0.5
        if i % 5 == 0:
            v = centres[0]  # a hot vector: ties
        rows.append((i, [float(x) for x in v], label))
        plain.append((i, label, [math.floor(256 * float(x)) for x in v]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    want = plain_negatives(plain, every=50)
    assert len(want) > 50 and mined(df, anchor_every=50, **sizes) == want


def test_hard_negatives_of_odd_rows(spark):
    rows = [(0, [1.0, 1.0], 1), (100, [1.0, 0.5], 1), (1, [1.0, 0.9], 2), (2, [1.0, 0.9], 2), (2, [1.0, 0.9], 2), (3, None, 1),
            (4, [1.0, None], 1), (5, [math.nan, 1.0], 1), (6, [math.inf, 0.0], 2), (7, [1.0, 0.9], None), (None, [1.0, 1.0], 2),
            (200, [1.0], 1), (8, [1.0], 1), (9, [0.9], 3), (300, [], 1), (10, [], 1), (11, [], 2), (400, [-1.0, -1.0], 5), (12, [1.0, 1.0], 5)]
    df = (spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
          .withColumns({c: F.lit("x") for c in ("id", "v", "cell", "rank", "score", "block", "team")}))
    part = {(i, l, tuple(math.floor(256 * x) for x in v)) for i, v, l in rows
            if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    assert mined(df) == plain_negatives(sorted(part))
    assert mined(df.limit(0)) == set() and mined(df.filter("vec_id % 100 <> 0")) == set()


def test_scans_drop_candidates_before_all_columns_are_read():
    rng = np.random.default_rng(1)
    columns = rng.normal(size=(64, 500)) * np.linspace(40, 1, 64)[:, None]
    columns = np.floor(columns)
    b = hard_negatives.Block(64, np.arange(500).tobytes(), columns.tobytes(), columns.min(axis=1).tobytes(), columns.max(axis=1).tobytes())
    q, left = columns[:, 0], []
    search = hard_negatives.Positives(0, np.array([-np.inf]), 5)

    def keep(lower, upper):
        left.append(len(lower))
        return upper >= max(search.least, hard_negatives.kth_largest(lower, 6))

    live = hard_negatives.scan(q, b, keep)
    exact = q @ columns
    assert set(np.argsort(-exact, kind="stable")[:6]) <= set(live) and left[-1] < 250 and len(live) < 250


def test_wide_scores_are_exact(spark):
    big = float(2 ** 29)  # products beyond 2^53
    rows = [(0, [big, 1.0], 1), (1, [big, 3.0], 1), (2, [big, 2.0], 2), (3, [big, 1.0], 2), (4, [big, 4.0], 2)]
    got = mined(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), scale=1.0)
    assert got == plain_negatives([(i, l, [int(x) for x in v]) for i, v, l in rows]) and len(got) == 2
