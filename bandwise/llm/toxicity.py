"""Toxicity by non-negative positive-unlabelled learning.

Features are the words of a text and their first letters (presence). A linear
classifier is trained in numpy from confirmed toxic examples (P) and unlabelled
text (U) with the class prior p of toxic text. The risk

    p * E_P[loss(+)] + max(0, E_U[loss(-)] - p * E_P[loss(-)])

corrects for the toxic texts among the unlabelled ones and is kept from turning
negative: where the bracket would, its gradient is followed upwards instead.
The prior is the share of toxic rows among all labelled learning rows; the
examples are bounded samples (parameters), and every text is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import chained, draw, held_out, release, stored, text_of, text_slices

LETTERS = regex.compile(r"\p{L}+")
#: First letters of a word that are features of their own, by how often they occur in a text at least.
STEM, TIMES = 4, (1, 2, 4)
POSITIVE_ROWS, UNLABELLED_ROWS, FEATURES = 2_000, 8_000, 2_048
#: A feature occurs in this many positive examples at least, and more often than in unlabelled ones by this many
#: standard errors.
LEAST_ROWS, LEAST_ERRORS = 3, 5.0
STEPS, RATE, PENALTY = 300, 0.1, 1e-4


def text_features(texts: list[str], selected: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, 64-bit feature) pairs, each once: words that occur, and stems that occur TIMES times.

    With ``selected`` (sorted features) only those.
    """
    found = [LETTERS.findall(t.lower()) for t in texts]
    flat = np.array([w for doc in found for w in doc] or [""], dtype=object)
    codes, words = pd.factorize(flat)
    rows = np.repeat(np.arange(len(found)), [len(doc) for doc in found])
    stem_of, stems = pd.factorize(np.array([w[:STEM] for w in words], dtype=object))
    whole = pd.util.hash_array(words, categorize=False)
    stem = pd.util.hash_array(stems, hash_key="stem0123456789ab", categorize=False)
    out = []
    for code, hashes in ((codes, [(1, whole)]), (stem_of[codes], [(t, chained(stem, np.uint64(t))) for t in TIMES])):
        code = code[:len(rows)]
        if selected is None:
            use = np.ones(len(rows), bool)
        else:
            use = np.any([np.isin(h.view(np.int64), selected) for _, h in hashes], axis=0)[code]
        pairs, n = np.unique(rows[use] * len(hashes[0][1]) + code[use], return_counts=True)
        row, code = np.divmod(pairs, len(hashes[0][1]))
        out += [(row[n >= t], h.view(np.int64)[code[n >= t]]) for t, h in hashes]
    row, feature = (np.concatenate(x) for x in zip(*out, strict=True))
    if selected is not None:
        known = np.isin(feature, selected)
        row, feature = row[known], feature[known]
    order = np.argsort(row, kind="stable")
    return row[order], feature[order]


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct features of every text."""
    for part in text_slices(batches):
        row, feature = text_features(part.column("text").to_pylist())
        ends = np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(feature))], ["features"])


def select_features(examples: DataFrame, n_positive: int, n_unlabelled: int, most: int) -> np.ndarray:
    """Sorted features that occur oftener in positive than in unlabelled examples, the ``most`` surest ones."""
    counts = (examples.select("positive", F.explode("features").alias("feature")).groupBy("feature")
              .agg(F.count_if("positive").alias("n"), F.count_if(~F.col("positive")).alias("m"))
              .filter(F.col("n") >= LEAST_ROWS))
    usual = (F.col("m") + 1) / F.lit(float(n_unlabelled + 2))
    errors = (F.col("n") / F.lit(float(n_positive)) - usual) / F.sqrt(usual * (1 - usual) / F.lit(float(n_positive)))
    best = counts.withColumn("errors", errors).filter(F.col("errors") >= LEAST_ERRORS)
    return np.sort(best.orderBy(F.col("errors").desc(), "feature").limit(most).select("feature").toPandas()["feature"].to_numpy(np.int64))


def _restricted(selected: np.ndarray):
    """Features of every example that are selected, as their places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.flatnonzero(np.isin(selected, np.asarray(f.values))) for f in batch.column("features")]
            yield pa.RecordBatch.from_arrays([batch.column("positive"), pa.array(found, pa.list_(pa.int64()))],
                                             ["positive", "at"])
    return run


class Rows:
    """Presence of selected features, by row."""

    def __init__(self, at: list[np.ndarray], width: int):
        self.n, self.width = len(at), width
        self.row = np.repeat(np.arange(self.n), [len(a) for a in at])
        self.feature = np.concatenate([*at, np.empty(0, np.int64)]).astype(np.int64)

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.feature], self.n) + w[-1]

    def gradient(self, slope: np.ndarray) -> np.ndarray:
        """Of the mean loss, given its slope in every row's score."""
        g = np.bincount(self.feature, slope[self.row], self.width + 1)
        g[-1] += slope.sum()
        return g / max(1, self.n)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def train(positive: Rows, unlabelled: Rows, prior: float, steps: int = STEPS) -> np.ndarray:
    """Weights (the last is the bias) that minimise the non-negative risk under the logistic loss."""
    w = np.zeros(positive.width + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        p, u = positive.scores(w), unlabelled.scores(w)
        of_negatives = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
        as_negative = unlabelled.gradient(sigmoid(u)) - prior * positive.gradient(sigmoid(p))
        g = -as_negative if of_negatives < 0 else prior * positive.gradient(sigmoid(p) - 1) + as_negative
        g += PENALTY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w


def _scored(selected: np.ndarray, w: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            score = np.full(len(part), w[-1])
            if len(selected):
                row, feature = text_features(part.column("text").to_pylist(), selected)
                score += np.bincount(row, w[np.searchsorted(selected, feature)], len(part))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(sigmoid(score))],
                                             ["doc_id", "held_out", "score"])
    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   positive_rows: int = POSITIVE_ROWS, unlabelled_rows: int = UNLABELLED_ROWS) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted (score >= 0.5).

    ``labels`` has doc_id and toxic (1: confirmed). Held-out ids (crc32 of the
    id's text mod 5 is 0; null: held out) are neither examples nor counted.
    About ``positive_rows`` confirmed examples and ``unlabelled_rows`` texts,
    drawn by the hash of id and text, are trained on, repeated rows once, so that
    ids that repeat do not enlarge the sample; a text without words has the
    bias's score. Without confirmed examples all scores are 0. Repeated rows
    are each returned; an empty table gives an empty table.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), held_out(id_col).alias("held_out"))
    marks = labels.filter(~held_out("doc_id") & F.col("toxic").isin(0, 1))
    n_marks, n_toxic = marks.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0))).first()
    selected, w = np.empty(0, np.int64), np.array([-np.inf])
    if n_toxic:
        learning = docs.filter(~F.col("held_out"))
        confirmed = (learning.select("doc_id", draw(6, "doc_id", "text").alias("draw"))
                     .join(marks.filter("toxic = 1").select("doc_id"), "doc_id", "left_semi"))
        n_confirmed, n = confirmed.count(), learning.select("held_out").count()
        chosen = confirmed.filter(F.col("draw") * n_confirmed < positive_rows).distinct()  # about positive_rows rows
        positive = (learning.withColumn("draw", draw(6, "doc_id", "text")).join(F.broadcast(chosen), ["doc_id", "draw"])
                    .dropDuplicates(["draw"]).select("text").mapInArrow(_examples, "features array<long>"))
        unlabelled = (learning.withColumn("draw", draw(16, "doc_id", "text")).filter(F.col("draw") * n < unlabelled_rows)
                      .dropDuplicates(["draw"]).select("text").mapInArrow(_examples, "features array<long>"))
        examples = stored(positive.withColumn("positive", F.lit(True)).union(unlabelled.withColumn("positive", F.lit(False))))
        n_positive, n_unlabelled = examples.agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()
        if n_positive and n_unlabelled:
            selected = select_features(examples, n_positive, n_unlabelled, FEATURES)
            found = examples.mapInArrow(_restricted(selected), "positive boolean, at array<long>").toPandas()
            p, u = (Rows(found.loc[found["positive"] == side, "at"].tolist(), len(selected)) for side in (True, False))
            w = train(p, u, min(max(n_toxic / n_marks, 1e-4), 0.5))
        release(examples)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "held_out", "text").mapInArrow(
        _scored(selected, w), f"doc_id {id_type}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
