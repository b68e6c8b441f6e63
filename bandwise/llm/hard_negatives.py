"""Hard-negative mining with BOND vertical scans: branch and bound over decomposed vectors.

Vectors are stored in blocks of one label, column by column (dimension-major),
with each column's smallest and largest value. A scan reads the columns in the
order of the anchor's descending magnitudes. After each step the columns not yet
read can add no less and no more than their min/max contributions; candidates
whose score can no longer matter leave the bitmap. What is left when few
candidates or no columns remain gets its exact integer score.

1. Rows are packed into blocks by label and by the signs of the dimensions that
   vary most, so that min/max are tight. A label of a third of all rows is many
   blocks. Anchors are taken out block by block, with the k-th best score inside
   the own block as a first bound.
2. Positives: anchors meet the blocks of their label; a candidate stays while it
   may be among the k best.
3. Negatives: anchors meet the blocks of the other labels; a candidate stays
   while its score may lie in the window of a positive and may be among that
   window's best.

In both, anchors meet the blocks' headers (min and max) first, and a block's
columns are sent only to the anchors whose bounds it can still reach. Each task
holds one group of anchors and one bundle of blocks; it returns at most k rows
per anchor (positive), which are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bandwise.llm.common import give_back, stored
from bandwise.llm.topk import exact_scores

#: Rows of a block, blocks of a bundle, anchors of a group.
BLOCK, BUNDLE, GROUP = 1024, 32, 256
#: Columns read between two looks at the bitmap, and candidates below which exact scores are cheaper.
STEP, FEW = 8, 32
#: Dimensions whose signs order the rows inside a label.
SIGNS = 10

BLOCKS = "block long, label long, dim int, ids binary, columns binary, least binary, most binary"
ANCHORS = "label long, dim int, id long, vector binary, windows binary"
FOUND = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"


def take_part(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, label, v (array<double>) of the rows that take part, repeated rows once."""
    value = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), value.alias("v"))
    return rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & fine).distinct()


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums and squares of every dimension."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for dim, _, x in _by_size(batch):
            total[dim] = total.get(dim, 0) + np.stack([np.full(dim, float(len(x))), x.sum(axis=0), (x * x).sum(axis=0)])
    for dim, t in total.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(dim, dim, np.int32)), pa.array(np.arange(dim, dtype=np.int32)),
                                          *(pa.array(c) for c in t)], ["dim", "i", "n", "total", "squares"])


def _by_size(batch: pa.RecordBatch, column: str = "v") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, rows, matrix) for each length of the vectors."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield int(dim), at, lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)


def _cells(marks: dict[int, tuple[np.ndarray, np.ndarray]]):
    """Adds the row's cell: the signs, against the mean, of the dimensions that vary most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.zeros(len(batch), np.int64)
            for dim, at, x in _by_size(batch):
                which, mean = marks.get(dim, (np.empty(0, int), np.empty(0)))
                cell[at] = (x[:, which] > mean) @ (1 << np.arange(len(which))[::-1]).astype(np.int64)
            yield batch.append_column("cell", pa.array(cell))
    return run


def scaled(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) in doubles."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x * scale), -np.finfo(float).max, np.finfo(float).max)


def _pack(block: int, scale: float):
    """Rows in the order they come -> blocks of one label and dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rest = TaskContext.get().partitionId() << 32, {}

        def row(label: int, dim: int, ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            number += 1
            out = [[number - 1], [label], [dim], [ids.tobytes()], [np.ascontiguousarray(x.T).tobytes()],
                   [x.min(axis=0).tobytes()], [x.max(axis=0).tobytes()]]
            kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)],
                                              ["block", "label", "dim", "ids", "columns", "least", "most"])

        for batch in batches:
            ids, labels = (batch.column(c).to_numpy() for c in ("id", "label"))
            for dim, at, x in _by_size(batch):
                x = scaled(x, scale)
                for label in np.unique(labels[at]):
                    own = labels[at] == label
                    i, v = ids[at][own], x[own]
                    if (label, dim) in rest:
                        i, v = np.concatenate((rest[label, dim][0], i)), np.concatenate((rest[label, dim][1], v))
                    full = len(i) // block * block
                    for k in range(0, full, block):
                        yield row(int(label), dim, i[k:k + block], v[k:k + block])
                    rest[label, dim] = i[full:], v[full:]
        for (label, dim), (i, v) in rest.items():
            if len(i):
                yield row(int(label), dim, i, v)
    return run


class Block:
    """One block: ids, columns (dimension-major), smallest and largest value of each column."""

    def __init__(self, dim: int, ids: bytes, columns: bytes, least: bytes, most: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.columns = np.frombuffer(columns, np.float64).reshape(dim, len(self.ids))
        self.least, self.most = np.frombuffer(least, np.float64), np.frombuffer(most, np.float64)


def bounds(q: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest contribution of every dimension."""
    a, b = q * least, q * most
    return np.minimum(a, b), np.maximum(a, b)


def scan(q: np.ndarray, block: Block, keep) -> np.ndarray:
    """Rows of the block that ``keep(lower, upper)`` never dropped; columns are read by descending magnitude."""
    order = np.argsort(-np.abs(q), kind="stable")
    low, high = bounds(q[order], block.least[order], block.most[order])
    # What the columns from each place on can add; the slack covers rounding.
    low, high = (np.append(np.cumsum(c[::-1])[::-1], 0.0) for c in (low, high))
    slack = 1e-9 * (np.abs(low[0]) + np.abs(high[0]) + 1)
    live, part = np.arange(len(block.ids)), np.zeros(len(block.ids))
    for at in range(0, len(order), STEP):
        if len(live) <= FEW:
            break
        read = order[at:at + STEP]
        columns = block.columns[read] if len(live) == len(block.ids) else block.columns[np.ix_(read, live)]
        part = part + q[read] @ columns
        done = min(at + STEP, len(order))
        stay = keep(part + low[done] - slack, part + high[done] + slack)
        if not stay.all():
            live, part = live[stay], part[stay]
    return live


def kth_largest(values: np.ndarray, k: int) -> float:
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id."""
    return np.lexsort((ids, ~scores))[:k]


class Positives:
    """The k best rows of the anchor's label, itself left out."""

    def __init__(self, anchor: int, windows: np.ndarray, k: int):
        self.anchor, self.k, self.least = anchor, k, windows[0]
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def reach(self, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        return upper >= self.least

    def look(self, q: np.ndarray, block: Block) -> None:
        # One more than k: the anchor itself may be among them.
        live = scan(q, block, lambda lower, upper: upper >= max(self.least, kth_largest(lower, self.k + 1)))
        live = live[block.ids[live] != self.anchor]
        scores = np.concatenate((self.scores, exact_scores(q[None], block.columns[:, live].T)[0]))
        ids = np.concatenate((self.ids, block.ids[live]))
        top = best(scores, ids, self.k)
        self.scores, self.ids = scores[top], ids[top]
        if len(top) == self.k:
            self.least = max(self.least, float(scores[top[-1]]))

    def rows(self) -> list[tuple]:
        return [(self.anchor, None, None, int(i), int(s)) for i, s in zip(self.ids, self.scores, strict=True)]


class Negatives:
    """For each positive's window the k best rows of other labels."""

    def __init__(self, anchor: int, windows: np.ndarray, k: int, low: int, high: int):
        self.anchor, self.k = anchor, k
        ids, scores = windows.view(np.int64).reshape(2, -1)
        self.positives = list(zip(ids.tolist(), scores.tolist(), strict=True))
        # low P <= 100 N <= high P, as whole numbers.
        self.least = np.array([-(-low * p // 100) for _, p in self.positives], object)
        self.most = np.array([high * p // 100 for _, p in self.positives], object)
        self.bound = self.least.astype(float)
        self.top = self.most.astype(float)
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in self.positives]

    def reach(self, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lower), bool)
        for bound, top in zip(self.bound, self.top, strict=True):
            out |= (upper >= bound) & (lower <= top)
        return out

    def _stay(self, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lower), bool)
        for least, bound, top in zip(self.least, self.bound, self.top, strict=True):
            sure = lower[(lower >= float(least)) & (upper <= top)]
            out |= (upper >= max(bound, kth_largest(sure, self.k))) & (lower <= top)
        return out

    def look(self, q: np.ndarray, block: Block) -> None:
        live = scan(q, block, self._stay)
        scores = exact_scores(q[None], block.columns[:, live].T)[0]
        ids = block.ids[live]
        for j, (least, most) in enumerate(zip(self.least, self.most, strict=True)):
            inside = (scores >= least) & (scores <= most) if len(scores) else np.empty(0, bool)
            own, names = (np.concatenate(c) for c in zip(self.found[j], (scores[inside.astype(bool)], ids[inside.astype(bool)]), strict=True))
            top = best(own, names, self.k)
            self.found[j] = own[top], names[top]
            if len(top) == self.k:
                self.bound[j] = max(self.bound[j], float(own[top[-1]]))

    def rows(self) -> list[tuple]:
        return [(self.anchor, p, score, int(i), int(s)) for (p, score), (scores, ids) in zip(self.positives, self.found, strict=True)
                for i, s in zip(ids, scores, strict=True)]


def _anchors(every: int, k: int):
    """Anchors of a block, with the k-th best score inside it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                b = Block(r["dim"], r["ids"], r["columns"], r["least"], r["most"])
                at = np.flatnonzero(b.ids % every == 0)
                out = []
                for i in at:
                    q = np.ascontiguousarray(b.columns[:, i])
                    own = Positives(int(b.ids[i]), np.array([-np.inf]), k)
                    own.look(q, b)
                    out.append((r["label"], r["dim"], int(b.ids[i]), q.tobytes(), np.array([own.least]).tobytes()))
                columns = list(zip(*out, strict=True)) or [()] * 5
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                                 ["label", "dim", "id", "vector", "windows"])
    return run


def _read(anchors: pd.DataFrame, search) -> list[tuple]:
    return [(r.label, r.dim, np.frombuffer(r.vector, np.float64), search(int(r.id), np.frombuffer(r.windows, np.float64).copy()))
            for r in anchors.itertuples(index=False)]


def _reached(search, same: bool):
    """Blocks of a bundle that some anchor of the group can need, by their headers alone."""
    def run(key: tuple, anchors: pd.DataFrame, headers: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(anchors) and len(headers):
            sides = [(np.frombuffer(h.least, np.float64), np.frombuffer(h.most, np.float64)) for h in headers.itertuples(index=False)]
            live = np.zeros(len(headers), bool)
            for label, dim, q, state in _read(anchors, search):
                at = np.flatnonzero(((headers["label"] == label) == same) & (headers["dim"] == dim) & ~live)
                if len(at):
                    low, high = bounds(q, np.stack([sides[i][0] for i in at]), np.stack([sides[i][1] for i in at]))
                    low, high = low.sum(axis=1), high.sum(axis=1)
                    slack = 1e-9 * (np.abs(low) + np.abs(high) + 1)
                    live[at] = state.reach(low - slack, high + slack)
            out = headers["block"][live].tolist()
        return pd.DataFrame({"team": np.full(len(out), key[0], np.int64), "bundle": np.full(len(out), key[1], np.int64),
                             "block": np.array(out, np.int64)})
    return run


def _search(search, same: bool):
    """A group of anchors against the blocks of a bundle that it needs."""
    def run(anchors: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        rows = []
        held = [(r.label, r.dim, Block(r.dim, r.ids, r.columns, r.least, r.most)) for r in blocks.itertuples(index=False)]
        for label, dim, q, state in _read(anchors, search) if held else []:
            own = [b for b_label, b_dim, b in held if (b_label == label) == same and b_dim == dim]
            low, high = bounds(q, np.stack([b.least for b in own]), np.stack([b.most for b in own])) if own else (np.empty((0, 0)),) * 2
            low, high = low.sum(axis=1), high.sum(axis=1)
            for i in np.argsort(-high, kind="stable"):
                slack = 1e-9 * (abs(low[i]) + abs(high[i]) + 1)
                if state.reach(low[i:i + 1] - slack, high[i:i + 1] + slack)[0]:
                    state.look(q, own[i])
            rows += state.rows()
        give_back()
        return pd.DataFrame(rows, columns=["anchor_id", "positive_id", "positive_score", "vec_id", "score"], dtype=object).astype(
            {"anchor_id": "int64", "positive_id": "Int64", "positive_score": "Int64", "vec_id": "int64", "score": "int64"})
    return run


class _Meeting:
    """Groups of anchors and bundles of blocks, and the search of one against the other."""

    def __init__(self, blocks: DataFrame, n_blocks: int, teams: int, bundle: int):
        self.bundles, self.teams = max(1, math.ceil(n_blocks / bundle)), teams
        self.blocks = blocks.withColumn("bundle", F.pmod(F.xxhash64("block"), F.lit(self.bundles)))

    @staticmethod
    def _with_each(df: DataFrame, column: str, n: int) -> DataFrame:
        return df.withColumn(column, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))

    def run(self, anchors: DataFrame, search, same: bool) -> DataFrame:
        dealt = self._with_each(anchors, "bundle", self.bundles)
        headers = self._with_each(self.blocks.select("block", "label", "dim", "least", "most", "bundle"), "team", self.teams)
        needed = stored(dealt.groupBy("team", "bundle").cogroup(headers.groupBy("team", "bundle")).applyInPandas(
            _reached(search, same), "team long, bundle long, block long"))
        sent = needed.join(self.blocks.drop("bundle"), "block")
        return dealt.groupBy("team", "bundle").cogroup(sent.groupBy("team", "bundle")).applyInPandas(_search(search, same), FOUND)


def mine_hard_negatives(vectors: DataFrame, k_positives: int = 5, k_negatives: int = 5, low: int = 80, high: int = 100,
                        anchor_every: int = 100, scale: float = 256.0, id_col: str = "vec_id",
                        vector_col: str = "embedding", label_col: str = "label", block: int = BLOCK,
                        bundle: int = BUNDLE, group: int = GROUP) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Scores are integer inner products of floor(scale * x) with the anchor, in
    doubles where they are exact, saturated at 64 bits; higher first, ties to the
    smaller id. Anchors are the rows whose id is divisible by ``anchor_every``;
    their positives are the ``k_positives`` best other rows of their label; the
    negatives of a positive are the ``k_negatives`` best rows of other labels
    with low * positive_score <= 100 * negative_score <= high * positive_score.
    Fewer rows than that give fewer; a positive without any negative gives none.

    A null id, label or vector, or a null or non-finite component takes no part.
    Vectors of different dimensions never meet. Repeated rows count once; several
    rows under one id are candidates each, and as anchors their results are
    merged by id. An empty table gives an empty table. Other columns are ignored.
    """
    rows = stored(take_part(vectors, id_col, vector_col, label_col))
    sums = rows.select("v").mapInArrow(_moments, "dim int, i int, n double, total double, squares double")
    sums = sums.groupBy("dim", "i").agg(*(F.sum(c).alias(c) for c in ("n", "total", "squares"))).toPandas()  # a row per dimension
    marks, n_rows = {}, 0
    for dim, s in sums.sort_values("i").groupby("dim"):
        mean = (s["total"] / s["n"]).to_numpy()
        which = np.argsort(-((s["squares"] / s["n"]).to_numpy() - mean * mean), kind="stable")[:SIGNS]
        marks[int(dim)] = which, mean[which]
        n_rows += int(s["n"].iloc[0])
    parts = max(1, math.ceil(n_rows / (block * 8)))
    order = ["label", "cell", "id"]
    blocks = stored(rows.mapInArrow(_cells(marks), "id long, label long, v array<double>, cell long")
                    .repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .select("id", "label", "v").mapInArrow(_pack(block, scale), BLOCKS))
    n_blocks = blocks.count()
    anchors = stored(blocks.mapInArrow(_anchors(anchor_every, k_positives), ANCHORS))
    # Groups are ranges of labels, so that a group needs few labels' blocks.
    anchors = stored(anchors.repartitionByRange(max(1, math.ceil(anchors.count() / group)), "label", "id")
                     .withColumn("team", F.spark_partition_id().cast("long")))
    teams = (anchors.agg(F.max("team")).first()[0] or 0) + 1
    meeting = _Meeting(blocks, n_blocks, teams, bundle)

    def first(df: DataFrame, by: list[str], k: int) -> DataFrame:
        ordered = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id")
        return df.withColumn("rank", F.row_number().over(ordered)).filter(F.col("rank") <= k)

    found = meeting.run(anchors, lambda a, w: Positives(a, w, k_positives), True)
    pairs = first(found.select("anchor_id", "vec_id", "score"), ["anchor_id"], k_positives)
    own = pairs.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("vec_id", "score"))).alias("p"))  # k at most
    ready = stored(anchors.drop("windows").join(own, F.col("id") == F.col("anchor_id"))
                   .mapInArrow(_windows, ANCHORS + ", team long"))
    found = meeting.run(ready, lambda a, w: Negatives(a, w, k_negatives, low, high), False)
    by = ["anchor_id", "positive_id", "positive_score"]
    return first(found.dropDuplicates([*by, "vec_id", "score"]), by, k_negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs an anchor's positives: ids, then scores."""
    for batch in batches:
        packed = [np.array([[p["vec_id"] for p in ps], [p["score"] for p in ps]], np.int64).tobytes()
                  for ps in batch.column("p").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("label", "dim", "id", "vector")), pa.array(packed, pa.binary()), batch.column("team")],
            ["label", "dim", "id", "vector", "windows", "team"])
