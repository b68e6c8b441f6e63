"""Quality rules: rule statistics of every text, judged by an isolation forest.

The statistics come from one pass of numpy over Arrow batches. The forest is
grown on a bounded sample of rows (a parameter): each tree splits a random
subsample at random values, and rows that come to a leaf after few splits are
anomalies. Every rule statistic has trees of its own, since a rule that few
statistics break is lost among splits on the others. The anomaly score of a
statistic at which a document is rejected is read off the scores of all
labelled rows, gathered as histograms; a statistic whose anomalies are not
bad documents far more often than clean ones rejects nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import chained, draw, stored, text_of, text_slices

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the forest sees of a text.
FEATURES = ("log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share",
            "mark_share", "line_words", "distinct_share", "loud_share")
TREES, SUBSAMPLE, SAMPLE_ROWS, BINS = 40, 256, 20_000, 10_000
#: Share of clean labelled rows that a statistic must keep, and how much oftener it must reject the others.
CLEAN_KEPT, BAD_TO_CLEAN = 0.999, 50


def _codes(chars: bytes) -> np.ndarray:
    return np.frombuffer(chars, np.uint8)


UPPER, DIGITS, MARKS = (_codes(x) for x in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?,.;:-_=~+/\\\"'()[]{}@^`"))


def repeated_words(hashes: np.ndarray) -> int:
    """Words that lie in a window of 3 that occurs at least twice."""
    if len(hashes) < 4:
        return 0
    windows = chained(chained(hashes[:-2], hashes[1:-1]), hashes[2:])
    _, which, n = np.unique(windows, return_inverse=True, return_counts=True)
    again = n[which] > 1
    covered = np.zeros(len(hashes), bool)
    for i in range(3):
        covered[i:len(hashes) - 2 + i] |= again
    return int(covered.sum())


def text_statistics(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(COUNTS per text, FEATURES per text)."""
    data = [t.encode("utf-8") for t in texts]
    words = [d.split() for d in data]
    flat = np.array([w for doc in words for w in doc] or [b""], dtype=object)
    hashed = pd.util.hash_array(flat, categorize=False)
    counts, features = np.zeros((len(texts), len(COUNTS)), np.int64), np.zeros((len(texts), len(FEATURES)))
    at = 0
    for i, (d, w) in enumerate(zip(data, words, strict=True)):
        h = hashed[at:at + len(w)]
        at += len(w)
        of = np.bincount(_codes(d), minlength=256)
        chars = len(d) - int(of[128:192].sum()) - int(of[_codes(SPACES)].sum())
        lines = [x for x in d.split(b"\n") if x.strip()]
        counts[i] = (len(w), chars, of[_codes(SYMBOLS)].sum(), len(lines) - len(set(lines)), repeated_words(h))
        if w:
            n, letters = len(w), max(1, chars)
            features[i] = (math.log(n), chars / n, counts[i, 2] / letters, counts[i, 3] / len(lines), counts[i, 4] / n,
                           of[UPPER].sum() / letters, of[DIGITS].sum() / letters, of[MARKS].sum() / letters,
                           math.log(n / len(lines)), len(np.unique(h)) / n, of[ord("!")] / n)
    return counts, features


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batches):
        counts, features = text_statistics(part.column("text").to_pylist())
        stats = pa.ListArray.from_arrays(np.arange(0, features.size + 1, len(FEATURES), dtype=np.int32), features.ravel())
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c) for c in counts.T), stats],
                                         ["doc_id", *COUNTS, "stats"])


def usual_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


class IsolationForest:
    """Trees as arrays: feature, threshold, children, and the path length at a leaf."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 8):
        rng = np.random.default_rng(seed)
        self.size = min(subsample, len(rows))
        self.height = max(1, math.ceil(math.log2(max(2, self.size))))
        self.trees = [self._grow(rows[rng.choice(len(rows), self.size, replace=False)], rng) for _ in range(trees)]

    def _grow(self, rows: np.ndarray, rng: np.random.Generator):
        nodes: list[list[float]] = []  # feature (-1: leaf), threshold, left, right, path

        def add(part: np.ndarray, depth: int) -> int:
            me = len(nodes)
            nodes.append([-1, 0.0, me, me, depth + usual_path(len(part))])
            low, high = part.min(axis=0), part.max(axis=0)
            wide = np.flatnonzero(high > low)
            if depth < self.height and len(part) > 1 and len(wide):
                feature = int(rng.choice(wide))
                cut = rng.uniform(low[feature], high[feature])
                left = part[:, feature] <= cut
                nodes[me][0], nodes[me][1] = feature, cut
                nodes[me][2], nodes[me][3] = add(part[left], depth + 1), add(part[~left], depth + 1)
            return me

        add(rows, 0)
        table = np.array(nodes)
        return table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64), table[:, 3].astype(np.int64), table[:, 4]

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / usual path): towards 1 for anomalies."""
        paths, each = np.zeros(len(rows)), np.arange(len(rows))
        for feature, cut, left, right, path in self.trees:
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.height):
                at = np.where(rows[each, np.maximum(feature[at], 0)] <= cut[at], left[at], right[at])
            paths += path[at]
        return 2.0 ** (-paths / len(self.trees) / max(usual_path(self.size), 1e-9))


def _scored(forests: list[IsolationForest]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = np.stack(frame["stats"].to_numpy()) if len(frame) else np.zeros((0, len(FEATURES)))
            scores = np.column_stack([f.score(rows[:, [j]]) for j, f in enumerate(forests)])
            yield frame.drop(columns="stats").assign(anomaly=list(scores))
    return run


def calibrated_thresholds(bins: pd.DataFrame, clean_kept: float, bad_to_clean: float, n_bins: int = BINS) -> list[float]:
    """Per statistic the anomaly score from which it rejects (over 1: never).

    ``bins``: statistic, quality (1: clean), bin, n. Counts the lowest cut that
    keeps ``clean_kept`` of the clean rows and rejects a share of the others
    that is ``bad_to_clean`` times the share of clean rows it costs (one row at
    least).
    """
    out = [2.0] * len(FEATURES)
    for j, part in bins.groupby("statistic"):
        table = np.zeros((2, n_bins + 1))
        np.add.at(table, (part["quality"].to_numpy(int), part["bin"].to_numpy(int)), part["n"].to_numpy(float))
        total = table.sum(axis=1)
        if total.all():
            kept = np.cumsum(table, axis=1) / total[:, None]
            least = bad_to_clean * np.maximum(1 - kept[1], 1 / total[1] / bad_to_clean)
            good = (kept[1] >= clean_kept) & (1 - kept[0] >= least)
            if good.any():
                out[int(j)] = (int(np.argmax(good)) + 1) / n_bins
    return out


def judge_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50,
                  max_repeat_percent: int = 50, sample_rows: int = SAMPLE_ROWS, clean_kept: float = CLEAN_KEPT,
                  bad_to_clean: float = BAD_TO_CLEAN, seed: int = 8) -> DataFrame:
    """Per row: doc_id, COUNTS, base_failed, anomaly (0 to 1 per FEATURES), kept.

    ``labels`` has doc_id and quality (1: clean, 0: not). The forest is grown on
    about ``sample_rows`` rows, drawn by hash; statistics, scores and the threshold
    cover all rows. base_failed: fewer than ``min_words`` words, or more than
    ``max_repeat_percent`` percent of the words in repeated windows. Null text
    counts as empty (no words: base_failed). Without labels of both kinds
    nothing but the base rules rejects. Repeated rows are each returned; an
    empty table gives an empty table.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    counted = ", ".join(f"{c} long" for c in COUNTS)
    rows = stored(docs.mapInArrow(_measured, f"doc_id {id_type}, {counted}, stats array<double>"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    judged = rows.filter(~F.col("base_failed"))
    # The limit only bounds rows that are equal in all that is drawn by.
    sample = (judged.filter(draw(seed, "doc_id", "n_words", "word_chars") * judged.count() < sample_rows)
              .select("stats").limit(2 * sample_rows).toPandas())
    if len(sample) < 2:
        return rows.select("doc_id", *COUNTS, "base_failed", F.lit(None).cast("array<double>").alias("anomaly"),
                           (~F.col("base_failed")).alias("kept"))
    sampled = np.stack(sample["stats"].to_numpy())
    forests = [IsolationForest(sampled[:, [j]], seed=seed + j) for j in range(len(FEATURES))]
    schema = f"doc_id {id_type}, {counted}, base_failed boolean, anomaly array<double>"
    scored = stored(rows.select("doc_id", *COUNTS, "base_failed", "stats").mapInPandas(_scored(forests), schema))
    marks = labels.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("quality"))
    bins = (scored.filter(~F.col("base_failed")).join(marks.filter("quality in (0, 1)"), F.col("doc_id") == F.col("label_id"))
            .select("quality", F.posexplode("anomaly").alias("statistic", "value"))
            .groupBy("statistic", "quality", F.floor(F.col("value") * BINS).cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))
    most = calibrated_thresholds(bins.toPandas(), clean_kept, bad_to_clean)
    usual = F.lit(True)
    for j, cut in enumerate(most):
        if cut <= 1:
            usual &= F.col("anomaly")[j] < cut
    return scored.withColumn("kept", ~F.col("base_failed") & usual)
