"""Logistic regressions of all costs and folds at once.

Every pass over the rows sums the gradient, the Hessian and the loss of each
(cost, fold) fit as one matrix per task; the matrices are added in two levels
and the driver solves the small systems. Some eight passes replace a
separate iterative fit per cost and fold. Fits that differ in the cost alone
soon have almost the same coefficients on many rows, and then one Hessian. Features are standardised with the
moments of the fold's own training rows, as a scaler fitted on them would.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: Tasks' matrices that are added together before the last sum.
MERGED = 32


def _matrices(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features (dense or sparse vectors as they are stored), label, fold and level of a batch."""
    vectors = batch.column("x")
    values, indices, sizes = vectors.field("values"), vectors.field("indices"), vectors.field("size")
    length = np.diff(values.offsets.to_numpy())
    own = np.where(sizes.is_valid().to_numpy(zero_copy_only=False), sizes.fill_null(0).to_numpy(), length)
    x = np.zeros((len(batch), int(own.max(initial=0))))
    row = np.repeat(np.arange(len(batch)), length)
    # A dense vector has no indices: its values stand one after the other.
    at = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
    sparse = np.repeat(indices.is_valid().to_numpy(zero_copy_only=False), length)
    at[sparse] = indices.flatten().to_numpy()
    x[row, at] = values.flatten().to_numpy()
    return x, *(batch.column(c).to_numpy() for c in ("label", "fold", "level"))


def _added(df: DataFrame) -> dict[int, np.ndarray]:
    """Sum per fit of the tasks' vectors (fit int, task int, sums binary)."""
    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_buffer(), np.float64) for v in table.column("sums"))
        return pa.table([table.column("fit")[:1], pa.array([total.tobytes()], pa.binary())], ["fit", "sums"])

    first = df.groupBy("fit", F.pmod("task", F.lit(MERGED))).applyInArrow(add, "fit int, sums binary")
    rows = first.groupBy("fit").applyInArrow(add, "fit int, sums binary").collect()  # a row per fit
    return {r["fit"]: np.frombuffer(r["sums"], np.float64) for r in rows}


def _emit(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    task = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([task] * len(sums), pa.int32()),
         pa.array([np.ascontiguousarray(v).tobytes() for v in sums.values()], pa.binary())], ["fit", "task", "sums"])


SUMS = "fit int, task int, sums binary"
#: More than there are folds: (level, fold) as one number.
CELLS = 1 << 16
#: Fits of a fold and level whose coefficients are this close take one Hessian; each keeps its own gradient.
NEAR = 1e-3


def fold_moments(rows: DataFrame, folds: int, levels: int = 1) -> dict[tuple[int, int], tuple[int, np.ndarray, np.ndarray]]:
    """Rows, mean and sample deviation of the features by (fold, level): outside the fold (-1: of all rows), up to the level."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x, _, fold, level = _matrices(batch)
            cell = level * CELLS + fold
            for k in np.unique(cell):
                own = x[cell == k]
                part = np.concatenate(([float(len(own))], own.sum(axis=0), (own * own).sum(axis=0)))
                sums[int(k)] = sums.get(int(k), 0) + part
        yield _emit(sums)

    by_cell = {(k // CELLS, k % CELLS): v for k, v in _added(rows.mapInArrow(run, SUMS)).items()}
    out = {}
    for j in range(levels):
        for f in (-1, *range(folds)):
            total = sum(v for (level, fold), v in by_cell.items() if level <= j and fold != f)
            if isinstance(total, int):
                continue
            n, (s, q) = total[0], np.split(total[1:], 2)
            mean = s / n
            out[f, j] = int(n), mean, np.sqrt(np.maximum(q - n * mean * mean, 0) / max(n - 1, 1))
    return out


@dataclass
class LogisticFit:
    cost: float
    fold: int
    mean: np.ndarray
    scale: np.ndarray
    reg: float
    #: Coefficients of the standardised features, the intercept last.
    theta: np.ndarray
    #: Rows up to this level take part.
    level: int = 0
    step: np.ndarray | None = None
    loss: float = np.inf
    done: bool = False

    def standardised(self, x: np.ndarray) -> np.ndarray:
        z = np.empty((len(x), x.shape[1] + 1))
        np.multiply(x - self.mean, self.scale, out=z[:, :-1])
        z[:, -1] = 1.0
        return z

    def margins(self, x: np.ndarray) -> np.ndarray:
        return self.standardised(x) @ self.theta

    def advance(self, hessian: np.ndarray, gradient: np.ndarray, loss: float, n: int, tolerance: float) -> None:
        """One Newton step from the summed Hessian, gradient and loss; half of the last step back if the loss rose."""
        d = len(self.theta)
        hessian, gradient, loss = hessian / n, gradient / n, loss / n
        penalty = np.append(np.full(d - 1, self.reg), 0.0)
        loss += 0.5 * float(penalty @ self.theta ** 2)
        if self.step is not None and loss > self.loss + 1e-12 * (1 + abs(self.loss)):
            self.step = self.step / 2
            self.theta = self.theta - self.step
            self.done = np.abs(self.step).max() < tolerance
            return
        self.loss = loss
        # Constant features have a zero row; the small ridge keeps the system regular.
        system = hessian + np.diag(penalty + 1e-12)
        self.step = -np.linalg.solve(system, gradient + penalty * self.theta)
        self.theta = self.theta + self.step
        self.done = np.abs(self.step).max() < tolerance


def _shared(fits: dict[int, LogisticFit]) -> dict[int, int]:
    """Per fit the one whose Hessian it takes: the first of its fold and level with almost the same coefficients."""
    out: dict[int, int] = {}
    for i, m in fits.items():
        near = (k for k in dict.fromkeys(out.values()) if (fits[k].fold, fits[k].level) == (m.fold, m.level)
                and np.abs(fits[k].theta - m.theta).max() < NEAR)
        out[i] = next(near, i)
    return out


def _rows(data: DataFrame, fold: str | None, level: str | None = None) -> DataFrame:
    place = F.col(fold).cast("int") if fold else F.lit(-2)
    return data.select(F.unwrap_udt("features").alias("x"), F.col("label").cast("double").alias("label"), place.alias("fold"),
                       (F.col(level).cast("int") if level else F.lit(0)).alias("level"))


def logistic_fits(data: DataFrame, costs: list[float], folds: int, fold: str | None = "__fold", tolerance: float = 1e-9,
                  most_passes: int = 50, level: str | None = None, levels: int = 1) -> list[LogisticFit]:
    """One fit per cost and fold (rows outside the fold); with ``folds=0`` one per cost on all rows.

    The loss is the mean log loss plus reg / 2 times the squared standardised
    coefficients, reg = 1 / (cost * rows). Constant features get coefficient 0.
    A fold that leaves no training rows has no fit. With ``level`` (a number from
    0 on, rows beyond ``levels`` - 1 in no fit) there is a fit per nested subset as
    well: of the rows up to each level.
    """
    rows = _rows(data, fold if folds else None, level)
    moments = fold_moments(rows, folds, levels)
    fits = []
    for c in costs:
        for j in range(levels):
            for f in range(folds) if folds else (-1,):
                if (f, j) in moments:
                    n, mean, deviation = moments[f, j]
                    scale = np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation > 1e-12 * (1 + np.abs(mean)))
                    fits.append(LogisticFit(float(c), f, mean, scale, 1.0 / (float(c) * n), np.zeros(len(mean) + 1), j))

    for _ in range(most_passes):
        open_fits = {i: m for i, m in enumerate(fits) if not m.done}
        if not open_fits:
            break
        shared = _shared(open_fits)

        def run(batches: Iterator[pa.RecordBatch], open_fits=open_fits, shared=shared) -> Iterator[pa.RecordBatch]:
            groups: dict[tuple[int, int], list[int]] = {}
            for i, m in open_fits.items():
                groups.setdefault((m.fold, m.level), []).append(i)
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                x, y, place, up_to = _matrices(batch)
                for (f, j), own in groups.items():
                    inside = np.flatnonzero((place != f) & (up_to <= j))
                    z, event = open_fits[own[0]].standardised(x[inside]), y[inside]
                    margins = z @ np.stack([open_fits[i].theta for i in own], axis=1)
                    small = np.exp(-np.abs(margins))
                    p = np.where(margins >= 0, 1.0, small) / (1 + small)
                    losses = (np.maximum(margins, 0) + np.log1p(small)).sum(axis=0) - event @ margins
                    gradients = (p - event[:, None]).T @ z
                    for k, i in enumerate(own):
                        part = np.append(gradients[k], losses[k])
                        if shared[i] == i:
                            part = np.append(part, ((z.T * (p[:, k] * (1 - p[:, k]))) @ z).ravel())
                        sums[i] = sums.get(i, 0) + part
            yield _emit(sums)

        found = _added(rows.mapInArrow(run, SUMS))
        for i, s in found.items():
            m = fits[i]
            d = len(m.theta)
            m.advance(found[shared[i]][d + 1:].reshape(d, d), s[:d], s[d], moments[m.fold, m.level][0], tolerance)
    return fits


def with_margins(data: DataFrame, fits: list[LogisticFit], fold: str | None = "__fold", out: str = "margins") -> DataFrame:
    """Adds an array: per cost, in the order of ``fits``, the margin of the fit that has not seen the row's fold."""
    costs = list(dict.fromkeys(m.cost for m in fits))
    by = {(m.cost, m.fold): m for m in fits}

    @pandas_udf("array<double>")
    def margins(features: pd.Series, place: pd.Series) -> pd.Series:
        x, result = np.stack(features.to_numpy()) if len(features) else np.empty((0, 0)), np.full((len(features), len(costs)), np.nan)
        for f in place.unique():
            own = (place == f).to_numpy()
            for j, c in enumerate(costs):
                m = by.get((c, int(f)), by.get((c, -1)))
                if m is not None:
                    result[own, j] = m.margins(x[own])
        return pd.Series(list(result))

    return data.withColumn(out, margins(vector_to_array("features"), F.col(fold).cast("int") if fold else F.lit(-1)))


def held_out_margins(data: DataFrame, fits: list[LogisticFit], fold: str = "__fold") -> DataFrame:
    """(cost int, fold int, margin, n, events): the margins of all rows under each cost, in the order of ``fits``, by the fit
    that has not seen the row's fold (0 without one). Equal margins of a batch are one row."""
    costs = list(dict.fromkeys(m.cost for m in fits))
    by = {(m.cost, m.fold): m for m in fits}
    names = ["cost", "fold", "margin", "n", "events"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, place, _ = _matrices(batch)
            for f in np.unique(place):
                own = place == f
                for j, c in enumerate(costs):
                    m = by.get((c, int(f)), by.get((c, -1)))
                    margin, at = np.unique(m.margins(x[own]) + 0.0 if m else np.zeros(own.sum()), return_inverse=True)
                    n, events = np.bincount(at), np.bincount(at, y[own] == 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), j, np.int32)), pa.array(np.full(len(n), f, np.int32)), pa.array(margin),
                         pa.array(n.astype(np.int64)), pa.array(events.astype(np.int64))], names)

    return _rows(data, fold).mapInArrow(run, "cost int, fold int, margin double, n long, events long")


def _areas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per (cost, fold) of a sorted part: rows, events, and pairs of an event over a non-event of the part, ties half."""
    sums: dict[tuple[int, int], np.ndarray] = {}

    def add(cost, fold, n, events):
        """Runs of equal margins, in order."""
        for j, f in dict.fromkeys(zip(cost.tolist(), fold.tolist())):
            own = (cost == j) & (fold == f)
            e, o = events[own].astype(float), (n - events)[own].astype(float)
            t = sums.setdefault((j, f), np.zeros(3))
            t[2] += float(e @ (t[0] - t[1] + np.cumsum(o) - o / 2))
            t[:2] += e.sum() + o.sum(), e.sum()

    held = None
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("cost", "fold", "margin", "n", "events")]
        if not len(batch):
            continue
        if held is not None:
            columns = [np.concatenate(c) for c in zip(held, columns, strict=True)]
        new = np.ones(len(columns[0]), bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:3]])
        first = np.flatnonzero(new)
        runs = [*(c[first] for c in columns[:3]), *(np.add.reduceat(c, first) for c in columns[3:])]
        held = [c[-1:] for c in runs]  # the last run may go on in the next batch
        add(*(runs[k][:-1] for k in (0, 1, 3, 4)))
    if held is not None:
        add(*(held[k] for k in (0, 1, 3, 4)))
    part = TaskContext.get().partitionId()
    yield pa.RecordBatch.from_arrays(
        [pa.array([part] * len(sums), pa.int32()), pa.array([j for j, _ in sums], pa.int32()), pa.array([f for _, f in sums], pa.int32()),
         *(pa.array([float(v[k]) for v in sums.values()], pa.float64()) for k in range(3))],
        ["part", "cost", "fold", "n", "events", "pairs"])


def areas_under_curve(scored: DataFrame) -> dict[tuple[int, int], float]:
    """Exact area under the ROC curve per (cost, fold) of ``held_out_margins``, ties half.

    One sort of all margins, dealt by range; a part sends its counts and the pairs inside it, and the pairs between
    parts follow from the counts. Without events the area is 0, without non-events 1.
    """
    keys = ["cost", "fold", "margin"]
    parts = (scored.repartitionByRange(*keys).sortWithinPartitions(*keys)
             .mapInArrow(_areas, "part int, cost int, fold int, n double, events double, pairs double").collect())  # a few rows a part
    sums: dict[tuple[int, int], list[float]] = {}
    for r in sorted(parts, key=lambda r: r["part"]):
        t = sums.setdefault((r["cost"], r["fold"]), [0.0, 0.0, 0.0])
        t[2] += r["pairs"] + r["events"] * t[1]
        t[0] += r["events"]
        t[1] += r["n"] - r["events"]
    return {k: pairs / (e * o) if e and o else float(e > 0) for k, (e, o, pairs) in sums.items()}


def log_losses(scored: DataFrame) -> dict[tuple[int, int], float]:
    """Minus the mean log loss per (cost, fold) of ``held_out_margins``."""
    m, tail = F.col("margin"), F.log1p(F.exp(-F.abs("margin")))
    loss = F.col("events") * (F.greatest(-m, F.lit(0.0)) + tail) + (F.col("n") - F.col("events")) * (F.greatest(m, F.lit(0.0)) + tail)
    found = scored.groupBy("cost", "fold").agg((-F.sum(loss) / F.sum("n")).alias("score")).collect()  # a row per cost and fold
    return {(r["cost"], r["fold"]): r["score"] for r in found}


def curve_counts(data: DataFrame, fits: list[LogisticFit], level: str, fold: str = "__fold") -> dict[tuple[int, int], tuple[int, int, int, int]]:
    """Per (level, fold) fit: rows and rightly predicted ones among its training rows, then in its fold; one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {i: np.zeros(4) for i in range(len(fits))}
        for batch in batches:
            x, y, place, up_to = _matrices(batch)
            for i, m in enumerate(fits):
                seen, out = (place != m.fold) & (up_to <= m.level), place == m.fold
                right = np.zeros(len(y), bool)
                right[seen | out] = (m.margins(x[seen | out]) > 0) == y[seen | out]
                sums[i] += (seen.sum(), right[seen].sum(), out.sum(), right[out].sum())
        yield _emit(sums)

    found = _added(_rows(data, fold, level).mapInArrow(run, SUMS))
    return {(fits[i].level, fits[i].fold): tuple(int(v) for v in s) for i, s in found.items()}
