"""Target-distribution importance resampling over hashed word n-grams, by segments.

A document's features are its words and pairs of consecutive words, each hashed
into a bucket (crc32). Documents are drawn by the mean log ratio of their
buckets' frequencies in the target and in the corpus, with Gumbel noise from a
hash of their id.

Segments: newlines separate words, so a text is its lines and what crosses them.
Corpus counts come from the distinct lines of all documents: lines are counted
(combined in the tasks that read them), every distinct line is hashed once and
its bucket counts multiplied by its occurrences. Pairs that cross a line break
are counted beside them, into the same buckets. For a document's mean the lines
of a slice of texts are again evaluated once each.

What reaches the driver is one number per bucket. The drawn documents are
ordered in range partitions and numbered from the partitions' counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bandwise.llm.common import give_back, stored, text_of, text_slices
from bandwise.llm.words import ALNUM, crc32_space, crc32_words, lowered, spans, utf8

BUCKETS = 10_000
#: Drawn rows that one task numbers.
ROWS_PER_TASK = 200_000


class Segments:
    """Distinct lines of some texts, their words, and what crosses line breaks.

    ``line``, ``text``: of every place where a line stands, blank lines left out.
    """

    def __init__(self, texts: pa.Array):
        lines = pc.split_pattern(texts.fill_null(""), "\n")
        text = np.repeat(np.arange(len(texts)), np.diff(lines.offsets.to_numpy()))
        self.set_lines((flat := lines.flatten().dictionary_encode()).dictionary)
        line = flat.indices.to_numpy()
        full = self.words[line] > 0
        self.line, self.text = line[full], text[full]

    def set_lines(self, lines: pa.Array) -> None:
        self.lines = lines
        data, offsets = utf8(lines)
        self.data = lowered(data)
        self.starts, self.ends, self.line_of = spans(self.data, offsets, ALNUM)
        self.words = np.bincount(self.line_of, minlength=len(lines))
        self.crc = crc32_words(self.data, self.starts, self.ends)

    def pair_crc(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """crc32 of pairs of words, given by their places."""
        return crc32_words(self.data, self.starts[second], self.ends[second], crc32_space(self.crc[first]))

    def inside(self) -> tuple[np.ndarray, np.ndarray]:
        """(crc32, line) of the features inside the distinct lines."""
        first = np.flatnonzero(self.line_of[1:] == self.line_of[:-1])
        return (np.concatenate((self.crc, self.pair_crc(first, first + 1))),
                np.concatenate((self.line_of, self.line_of[first])))

    def crossing(self) -> tuple[np.ndarray, np.ndarray]:
        """(crc32, text) of the pairs that cross line breaks: a line's last word, the next line's first."""
        behind = np.cumsum(self.words)
        at = np.flatnonzero(self.text[1:] == self.text[:-1])
        first, second = behind[self.line[at]] - 1, behind[self.line[at + 1]] - self.words[self.line[at + 1]]
        return self.pair_crc(first, second), self.text[at]


def _counted(buckets: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(buckets)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(buckets[some])], ["line", "bucket", "n"])


def _lines(buckets: int):
    """Distinct lines with their occurrences, slice by slice, and the task's crossing pairs by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crossing = np.zeros(buckets, np.int64)
        for part in text_slices(batches):
            s = Segments(part.column("text"))
            crossing += np.bincount(s.crossing()[0] % np.uint32(buckets), minlength=buckets)
            n = np.bincount(s.line, minlength=len(s.lines))
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [s.lines.take(pa.array(some)).cast(pa.string()), pa.nulls(len(some), pa.int32()), pa.array(n[some])],
                ["line", "bucket", "n"])
        yield _counted(crossing)
    return run


def _line_buckets(buckets: int):
    """Distinct lines with their occurrences -> the task's counts by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in text_slices(batches, "line"):
            s = Segments.__new__(Segments)
            s.set_lines(part.column("line"))
            crc, line = s.inside()
            n = part.column("n").to_numpy()
            # Sums of a slice are exact in a double: occurrences are below 2^53 by far.
            total += np.bincount(crc % np.uint32(buckets), n[line].astype(np.float64), buckets).astype(np.int64)
        yield _counted(total)
    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: occurrences of all features of column ``text``, by bucket; buckets without any are absent."""
    schema = "line string, bucket int, n long"
    found = stored(texts.select(text_of("text").alias("text")).mapInArrow(_lines(buckets), schema)
                   .groupBy("line", "bucket").agg(F.sum("n").alias("n")))
    inside = found.filter(F.col("bucket").isNull()).mapInArrow(_line_buckets(buckets), schema)
    return (inside.union(found.filter(F.col("bucket").isNotNull())).groupBy("bucket").agg(F.sum("n").alias("n")))


def bucket_gains(target: dict[int, int], corpus: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of every bucket, in doubles."""
    t_all, s_all = float(sum(target.values()) + buckets), float(sum(corpus.values()) + buckets)
    return np.array([math.floor(1000 * math.log(float(target.get(b, 0) + 1) * s_all / (float(corpus.get(b, 0) + 1) * t_all)))
                     for b in range(buckets)], np.int64)


def _weigh(gains: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            s, n = Segments(part.column("text")), len(part)
            crc, line = s.inside()
            gain = gains[crc % np.uint32(len(gains))]
            # Sums of whole numbers, exact in a double.
            sums = np.bincount(line, gain, len(s.lines))
            crc, text = s.crossing()
            total = np.bincount(s.text, sums[s.line], n) + np.bincount(text, gains[crc % np.uint32(len(gains))], n)
            words = np.bincount(s.text, s.words[s.line], n).astype(np.int64)
            features = np.maximum(2 * words - 1, 0)
            weight = np.where(features > 0, total.astype(np.int64) // np.maximum(features, 1), 0)
            rest = [part.column(c) for c in part.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(words), pa.array(features), pa.array(weight)],
                                             [*(c for c in part.schema.names if c != "text"), "n_words", "n_features", "weight"])
    return run


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7,
             buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Per row of ``docs``: its id, n_words, n_features, weight, score, rank (long; null unless drawn).

    Of the N rows with at least ``least_words`` words, floor(percent N / 100)
    are drawn, highest score first. Equal scores go to the smaller id, null ids
    last; rows equal in both, as repeated rows are, are drawn in any order. Null
    and empty texts have no features and weight 0; a null id counts as the empty
    text in the noise. With an empty target all its frequencies are equal. An
    empty table gives an empty table. Other columns are not returned.
    """
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    counts = [{r["bucket"]: r["n"] for r in bucket_counts(t, buckets).collect()}  # as many rows as buckets
              for t in (target.select(F.col(target_text_col).alias("text")), texts)]
    kind = texts.schema["id"].dataType.simpleString()
    weighed = texts.mapInArrow(_weigh(bucket_gains(*counts, buckets)),
                               f"id {kind}, n_words long, n_features long, weight long")
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    scored = stored(weighed.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(u))))
                    .withColumn("place", F.monotonically_increasing_id()))

    fits = F.col("n_words") >= least_words
    # Scores are whole numbers between the bounds of weight and noise: some 10^5 rows, however many documents.
    by_score = stored(scored.filter(fits).groupBy("score").agg(F.count(F.lit(1)).alias("n")))
    n_drawn = (by_score.agg(F.sum("n")).first()[0] or 0) * percent // 100
    above = F.sum("n").over(Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1))
    cut = by_score.withColumn("above", F.coalesce(above, F.lit(0))).filter(F.col("above") < n_drawn).agg(F.min("score")).first()[0]
    top = fits & (F.col("score") >= F.lit(cut).cast("long"))

    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("place")]
    dealt = stored(scored.filter(top).repartitionByRange(max(1, -(-n_drawn // rows_per_task)), *order)
                   .withColumn("cell", F.spark_partition_id()))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    starts = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).select(
        "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    number = F.col("start") + F.row_number().over(Window.partitionBy("cell").orderBy(*order))
    columns = [F.col("id").alias(id_col), "n_words", "n_features", "weight", "score"]
    ranked = dealt.join(starts, "cell").withColumn("rank", number)
    return (ranked.select(*columns, F.when(F.col("rank") <= n_drawn, F.col("rank")).alias("rank"))
            .union(scored.filter(~F.coalesce(top, F.lit(False))).select(*columns, F.lit(None).cast("long"))))
