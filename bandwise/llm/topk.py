"""Exact top-k inner products over norm-sorted blocks.

1. One aggregation sums the Gram matrix of all vectors (d x d numbers, however
   many rows); its eigenvectors are the right singular vectors of the data.
   Rotated by them, most of an inner product is in the first coordinates.
2. Vectors are sorted by descending length (range partitioned) and packed into
   blocks of ``block`` rows, one Spark row each; queries are packed likewise.
3. The block with the longest vectors gives every query a first k-th best
   score, and so the length below which no vector can matter to it. Headers
   meet first: a block (its longest vector, a few numbers) is sent to a group
   of queries only if its longest vector reaches the least length that one of
   them needs. Then each query block meets the blocks sent in the order of
   their length. A query skips a block whose length bound |q| |x| stays below its
   present k-th best score; otherwise the partial sum over the first rotated
   coordinates plus the Cauchy-Schwarz bound of the residuals decides which
   vectors are worth their exact integer score.
4. Per query, the best k of all tasks are merged.

Bounds carry a slack for rounding; scores are exact integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bandwise.llm.common import stored

BLOCK = 1024
#: Share of the data's squared length that the partial sums cover.
ENERGY = 0.8
#: Integers up to here are exact in a double, sums included.
EXACT = float(1 << 53)
BLOCK_SCHEMA = "dim int, longest double, n int, ids binary, vectors binary"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """id, v (array<double> of integers floor(scale * x)); rows that take no part are left out."""
    value = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), value.alias("v"))
            .filter(F.col("id").isNotNull() & F.col("v").isNotNull() & fine)
            .select("id", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("v")))


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for dim, rows in _by_dim(batch):
            x = rows[1]
            total[dim] = total.get(dim, 0) + x.T @ x
    for dim, g in total.items():
        i, j = np.indices(g.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(g.size, dim, np.int32)), pa.array(i.ravel().astype(np.int32)),
             pa.array(j.ravel().astype(np.int32)), pa.array(g.ravel())], ["dim", "i", "j", "value"])


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
    """(dimension, (ids, matrix)) of the batch's vectors, dimension 0 included."""
    ids, column = batch.column("id").to_numpy(), batch.column("v")
    sizes = np.diff(column.offsets.to_numpy())
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield int(dim), (ids[at], flat.reshape(len(at), dim))


def rotations(data: DataFrame) -> dict[int, tuple[np.ndarray, int]]:
    """Per dimension: orthogonal matrix, and the coordinates that carry ENERGY of the squared length."""
    sums = data.mapInArrow(_gram, "dim int, i int, j int, value double").groupBy("dim", "i", "j").agg(F.sum("value").alias("value"))
    out = {}
    for dim, cells in sums.toPandas().groupby("dim"):  # d x d numbers per dimension
        g = np.zeros((dim, dim))
        g[cells["i"], cells["j"]] = cells["value"]
        values, vectors = np.linalg.eigh((g + g.T) / 2) if np.isfinite(g).all() else (np.ones(dim), np.eye(dim))
        values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
        head = int(np.searchsorted(np.cumsum(values), ENERGY * values.sum())) + 1
        out[int(dim)] = (np.ascontiguousarray(vectors), min(head, dim))
    return out


def _pack(block: int):
    """Rows in the order they come -> one row per block and dimension."""
    def row(dim: int, ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        longest = float(np.sqrt((x * x).sum(axis=1)).max())
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([longest]), pa.array([len(ids)], pa.int32()),
             pa.array([ids.tobytes()], pa.binary()), pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())],
            ["dim", "longest", "n", "ids", "vectors"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for dim, (ids, x) in _by_dim(batch):
                if dim in rest:
                    ids, x = np.concatenate((rest[dim][0], ids)), np.concatenate((rest[dim][1], x))
                full = len(ids) // block * block
                for at in range(0, full, block):
                    yield row(dim, ids[at:at + block], x[at:at + block])
                rest[dim] = (ids[full:], x[full:])
        for dim, (ids, x) in rest.items():
            if len(ids):
                yield row(dim, ids, x)
    return run


def packed(data: DataFrame, block: int, parts: int) -> DataFrame:
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    order = [F.col("length").desc(), F.col("id")]
    return (data.withColumn("length", length).repartitionByRange(parts, *order).sortWithinPartitions(*order)
            .select("id", "v").mapInArrow(_pack(block), BLOCK_SCHEMA))


def _unpack(dim: int, ids: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(vectors, np.float64).reshape(len(ids), dim)


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; doubles are used where they are exact. Saturated at the 64-bit range."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    if np.abs(q).max() * np.abs(x).max() * q.shape[1] < EXACT:
        return (q @ x.T).astype(np.int64)
    wide = [[int(b) for b in r] for r in x]
    rows = [[sum(int(a) * b for a, b in zip(r, s, strict=True)) for s in wide] for r in q]
    return np.array([[max(-(1 << 63), min((1 << 63) - 1, v)) for v in r] for r in rows], np.int64)


class Best:
    """The k best (score, id) of every query of a block, ties to the smaller id."""

    def __init__(self, k: int, ids: np.ndarray, at_least: np.ndarray | None = None):
        self.k, self.ids = k, ids
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(ids)
        self.bound = np.full(len(ids), -np.inf) if at_least is None else at_least.copy()

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        other = ids != self.ids[query]
        scores, ids = (np.concatenate(p) for p in zip(self.found[query], (scores[other], ids[other]), strict=True))
        top = np.lexsort((ids, -scores.astype(np.float64)))[:self.k] if np.abs(scores, dtype=np.float64).max(initial=0) < EXACT \
            else np.array(sorted(range(len(ids)), key=lambda i: (-int(scores[i]), int(ids[i])))[:self.k], int)
        self.found[query] = (scores[top], ids[top])
        if len(top) == self.k:
            self.bound[query] = max(self.bound[query], float(scores[top[-1]]))


def search_block(best: Best, q: np.ndarray, ids: np.ndarray, x: np.ndarray, rotation: np.ndarray, head: int) -> int:
    """Add a block's vectors to the best of the queries; returns how many scores were computed."""
    q_length, x_length = np.sqrt((q * q).sum(axis=1)), np.sqrt((x * x).sum(axis=1))
    slack = 1e-9 * (q_length * x_length.max(initial=0) + 1)
    live = np.flatnonzero(q_length * x_length.max(initial=0) + slack >= best.bound)
    if not len(live):
        return 0
    qr, xr = q[live] @ rotation, x @ rotation
    rest_q = np.sqrt(np.maximum((qr[:, head:] ** 2).sum(axis=1), 0))
    rest_x = np.sqrt(np.maximum((xr[:, head:] ** 2).sum(axis=1), 0))
    upper = qr[:, :head] @ xr[:, :head].T + np.outer(rest_q, rest_x) + slack[live, None]
    worth = upper >= best.bound[live, None]
    scores, n = exact_scores(q[live], x) if worth.mean() > 0.1 else None, 0
    for i, query in enumerate(live):
        at = np.flatnonzero(worth[i])
        if len(at):
            exact = exact_scores(q[query:query + 1], x[at])[0] if scores is None else scores[i, at]
            best.add(query, exact, ids[at])
            n += len(at)
    return n


def _search(k: int, turned: dict[int, tuple[np.ndarray, int]]):
    """One cell: its query blocks against its data blocks, longest vectors first."""
    def run(queries: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("longest", ascending=False)
        out = [pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64),
                             "score": np.empty(0, np.int64)})]
        for q_row in queries.itertuples(index=False):
            q_ids, q = _unpack(q_row.dim, q_row.q_ids, q_row.q_vectors)
            best = Best(k, q_ids, np.frombuffer(q_row.at_least, np.float64))
            for row in blocks.itertuples(index=False):
                if row.dim == q_row.dim:
                    rotation, head = turned.get(row.dim, (np.eye(row.dim), row.dim))
                    search_block(best, q, *_unpack(row.dim, row.ids, row.vectors), rotation, head)
            out.append(pd.DataFrame({"query_id": np.repeat(q_ids, [len(s) for s, _ in best.found]),
                                     "vec_id": np.concatenate([i for _, i in best.found]),
                                     "score": np.concatenate([s for s, _ in best.found])}))
        return pd.concat(out, ignore_index=True)
    return run


def least_length(q_lengths: np.ndarray, bounds: np.ndarray) -> float:
    """Length of the shortest vectors that can still reach a query's bound, with the slack of ``search_block``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(q_lengths > 0, (bounds - 1e-9) / (q_lengths * (1 + 1e-9)), np.where(bounds <= 1e-9, -np.inf, np.inf))
    return float(need.min(initial=np.inf))


def _first_bounds(k: int):
    """Adds each query's k-th best score within the block of the longest vectors, and the length that a vector needs."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out, need = [], []
            for row in frame.itertuples(index=False):
                q_ids, q = _unpack(row.dim, row.q_ids, row.q_vectors)
                best = Best(k, q_ids)
                ids, x = _unpack(row.dim, row.ids, row.vectors)
                for i, s in enumerate(exact_scores(q, x)):
                    best.add(i, s, ids)
                out.append(best.bound.tobytes())
                need.append(least_length(np.sqrt((q * q).sum(axis=1)), best.bound))
            yield frame[["dim", "q_ids", "q_vectors"]].assign(at_least=out, need=need)
    return run


def headers(blocks: DataFrame) -> DataFrame:
    """A block's key, dimension and longest vector, and its ids."""
    return blocks.select(F.md5("ids").alias("key"), "dim", "longest", "ids")


def needed_blocks(pairs: DataFrame, needs: DataFrame) -> DataFrame:
    """key, dim, row, column: of the blocks' headers dealt to all groups of queries, those that a query can need."""
    return pairs.join(needs, ["row", "dim"]).filter(F.col("longest") >= F.col("need")).select("key", "dim", "row", "column")


def top_inner_products(vectors: DataFrame, k: int = 5, query_every: int = 50, scale: float = 256.0,
                       id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK,
                       cell_blocks: int = 8, cell_queries: int = 2) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest integer inner products.

    Queries are the rows whose id is divisible by ``query_every``, candidates
    all rows with another id. Vectors are quantised to floor(scale * x). A null
    vector or id, or a null or non-finite component takes no part; vectors of
    different dimensions are not compared. Ties go to the smaller id. Rows
    repeated exactly count once; of several vectors under one id each is a
    candidate, and as a query their best scores are merged. Fewer than k
    candidates give fewer rows; an empty table gives none. Scores beyond 64
    bits are saturated.

    Query and data blocks meet in cells of about ``cell_queries`` x
    ``cell_blocks`` blocks, which bounds a task's memory.
    """
    data = stored(quantised(vectors, id_col, vector_col, scale).distinct())
    n_rows, n_queries = data.agg(F.count(F.lit(1)), F.count_if(F.col("id") % query_every == 0)).first()
    turned = rotations(data)
    blocks = stored(packed(data, block, max(1, math.ceil(n_rows / (block * 4)))))
    queries = packed(data.filter(F.col("id") % query_every == 0), block, max(1, math.ceil(n_queries / (block * 4))))
    queries = queries.select("dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    # One block per dimension, with the longest vectors.
    first = blocks.groupBy("dim").agg(F.max_by(F.struct("ids", "vectors"), F.struct("longest", "ids")).alias("b"))
    queries = stored(queries.join(F.broadcast(first.select("dim", "b.*")), "dim").mapInPandas(
        _first_bounds(k), "dim int, q_ids binary, q_vectors binary, at_least binary, need double"))
    columns, rows = (max(1, math.ceil(n / (block * m))) for n, m in ((n_rows, cell_blocks), (n_queries, cell_queries)))

    def dealt(df: DataFrame, own: str, by: str, n: int, other: str, m: int) -> DataFrame:
        return (df.withColumn(own, F.pmod(F.xxhash64(by), F.lit(n)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))))

    left = dealt(queries, "row", "q_ids", rows, "column", columns)
    needs = queries.withColumn("row", F.pmod(F.xxhash64("q_ids"), F.lit(rows)).cast("int")).groupBy("row", "dim").agg(F.min("need").alias("need"))
    sent = needed_blocks(dealt(headers(blocks), "column", "ids", columns, "row", rows).drop("ids"), needs)
    right = blocks.withColumn("key", F.md5("ids")).join(sent, ["key", "dim"]).drop("key")
    found = left.drop("need").groupBy("row", "column").cogroup(right.groupBy("row", "column")).applyInPandas(_search(k, turned), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return (found.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
