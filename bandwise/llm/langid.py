"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies come from one pass over all learning rows. The classifier
is fitted on a bounded sample of them (rows per language, a parameter; a row's
hash decides) with follow-the-regularised-leader: per-coordinate rates, and
elastic-net penalties that leave most weights exactly zero. Part of the sample
is kept back to choose the temperature that divides the scores, so that the
probability of the predicted language is calibrated.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F, types as T

from bandwise.llm.common import chained, draw, give_back, held_out, text_of, text_slices

#: Hash buckets of the n-grams of 1 to GRAMS characters.
BUCKETS, GRAMS = 1 << 14, 3
#: Fitted on about so many rows of a language; no more languages than that are learned.
ROWS_PER_LANGUAGE, MOST_LANGUAGES, EPOCHS = 1_000, 100, 3
#: Follow-the-regularised-leader: learning rate, its smoothing, and the L1 and L2 penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.01, 0.001
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """(buckets, counts) of the lower-cased text's n-grams, anything but letters as a space; None without a letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    known = letters()[codes]
    if not known.any():
        return None
    codes = np.where(known, codes, 32).astype(np.uint64)
    value, total = np.zeros(len(codes), np.uint64), np.zeros(BUCKETS, np.int64)
    for n in range(GRAMS):
        value = chained(value[:len(codes) - n], codes[n:])
        if not len(value):
            break
        words = known[n:] if n == 0 else known[:len(value)] | known[n:]
        total += np.bincount((value[words] % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
    at = np.flatnonzero(total)
    return at, total[at]


def weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[at]
    return x / max(np.sqrt((x * x).sum()), 1e-12)


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(BUCKETS, np.int64), 0
    for part in text_slices(batches):
        for text in part.column("text").to_pylist():
            if grams := gram_counts(text):
                df[grams[0]] += 1
                n += 1
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array([*at.tolist(), -1], pa.int32()), pa.array([*df[at].tolist(), n], pa.int64())],
                                     ["bucket", "n"])


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batches):
        grams = [gram_counts(t) for t in part.column("text").to_pylist()]
        use = [i for i, g in enumerate(grams) if g]
        yield pa.RecordBatch.from_arrays(
            [part.column("lang").take(pa.array(use, pa.int64())), part.column("place").take(pa.array(use, pa.int64())),
             pa.array([grams[i][0] for i in use], pa.list_(pa.int32())),
             pa.array([grams[i][1] for i in use], pa.list_(pa.int32()))], ["lang", "place", "at", "counts"])


class Ftrl:
    """Multinomial logistic regression by follow-the-regularised-leader with elastic net; row BUCKETS is the bias."""

    def __init__(self, classes: int):
        self.z, self.n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = softmax(x @ w)
        error[label] -= 1
        g = x[:, None] * error
        more = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] = more


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(sample: pd.DataFrame, idf: np.ndarray) -> tuple[list[str], np.ndarray, float]:
    """(languages, weights, temperature) from rows of lang, place (their random order), at, counts."""
    sample = sample.sort_values("place", kind="stable")
    names = sorted(sample["lang"].unique())
    rows = [(np.append(a, np.int32(BUCKETS)), np.append(weighted(a, c, idf), 1.0).astype(np.float32), names.index(k))
            for k, a, c in zip(sample["lang"], sample["at"], sample["counts"], strict=True)]
    kept_back = rows[::5] if len(rows) >= 10 * len(names) else rows
    learning = [r for i, r in enumerate(rows) if i % 5] if kept_back is not rows else rows
    model = Ftrl(len(names))
    for _ in range(EPOCHS):
        for row in learning:
            model.learn(*row)
    w = model.weights(slice(None))
    scores = np.array([x @ w[at] for at, x, _ in kept_back])
    truth = np.array([k for *_, k in kept_back])

    # One row in doubt for each language: rows that are all right would ask for no temperature at all.
    doubt = 1 / (len(truth) + len(names))

    def loss(t: float) -> float:
        p = np.log(softmax(scores / t) + 1e-300)
        right = p[np.arange(len(truth)), truth]
        return -((1 - len(names) * doubt) * right + doubt * p.sum(axis=1)).mean()

    return names, w, float(min(np.geomspace(0.05, 5, 60), key=loss))


def _predicted(names: list[str], w: np.ndarray, idf: np.ndarray, temperature: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            out = []
            for text in part.column("text").to_pylist():
                grams = gram_counts(text) if names else None
                if not grams:
                    out.append((UNKNOWN, 0.0))
                    continue
                p = softmax((weighted(*grams, idf) @ w[grams[0]] + w[BUCKETS]) / temperature)
                out.append((names[int(p.argmax())], float(p.max())))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())],
                ["row", "lang_pred", "score"])
    return run


def with_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   rows_per_language: int = ROWS_PER_LANGUAGE, most_languages: int = MOST_LANGUAGES) -> DataFrame:
    """row (all columns of ``docs``, as a struct), lang_pred, score, per row.

    Learns from rows with a language that are not held out (crc32 of the id's
    text mod 5 is 0; null id: held out), of the ``most_languages`` languages with
    the most rows (ties by name). A row joins the fitting sample if the hash of
    its id and text falls below ``rows_per_language`` / rows of its language;
    repeated rows join once. So the sample holds about that many rows of each,
    whatever ids repeat, and it is learned in the order of a second hash. Null, empty or letterless text
    is ``und`` with score 0, as is everything when there is nothing to learn
    from. Repeated rows are each returned; an empty table gives an empty table.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), text_of(text_col).alias("text"))
    learning = (docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull())
                .select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"),
                        F.col(lang_col).cast("string").alias("lang")))
    per_language = learning.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    frequency = (learning.select("text").mapInArrow(_document_frequency, "bucket int, n long")
                 .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas())  # BUCKETS + 1 rows at most
    df = np.zeros(BUCKETS + 1)
    np.add.at(df, frequency["bucket"].to_numpy(int), frequency["n"].to_numpy(float))  # -1: the number of texts
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    largest = per_language.orderBy(F.col("rows").desc(), "lang").limit(most_languages)
    sample = (learning.withColumn("draw", draw(7, "doc_id", "text")).join(F.broadcast(largest), "lang")
              .filter(F.col("draw") * F.col("rows") < rows_per_language).withColumn("place", draw(8, "doc_id", "text"))
              .dropDuplicates(["lang", "draw"]).select("text", "lang", "place")
              .mapInArrow(_grams, "lang string, place double, at array<int>, counts array<int>").toPandas())
    names, w, temperature = fit(sample, idf) if len(sample) else ([], np.zeros((BUCKETS + 1, 0)), 1.0)
    del sample
    give_back()
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_predicted(names, w, idf, temperature), schema)


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       rows_per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score per row; see ``with_languages``."""
    key = F.col(id_col).alias("doc_id")
    docs = docs.select(key, F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    out = with_languages(docs, rows_per_language=rows_per_language)
    return out.select("row.doc_id", "lang_pred", "score").select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
