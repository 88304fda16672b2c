"""Linear classifiers, many in one pass: every scan of the rows gives loss and gradient of all runs and classes.

A run is a loss, a strength C, and whether classes are balanced. Runs on the same rows share each scan: a
task multiplies its sparse rows with the coefficients of all runs at once, and its gradients are one matrix
of (term, run x class). Each run is minimised by limited-memory quasi-Newton steps of its own; a scan
evaluates the next trial point of every run that has not converged, so the number of jobs is that of the
slowest run, not the sum over runs, classes and line searches.

Objectives, for rows with weight w and K classes, W without the intercept b:
``logistic``: sum(w * -log softmax) / n + |W|^2 / (2 C n), with n the sum of row times class weights;
``squared_hinge``: per class, sum(v * max(0, 1 - s f)^2) / n + (|W|^2 + b^2) / (2 C n), s = +1 and v = class
weight for own rows, s = -1 and v = 1 for others. Both are smooth, and zero gradient is the condition for the optimum.

The driver holds the coefficients, terms x classes x runs, as it must to send them out, and up to ``2 * MEMORY``
steps of that size.
"""

from __future__ import annotations

import warnings
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOGISTIC, SQUARED_HINGE = "logistic", "squared_hinge"
#: Rows multiplied at a time, pairs kept by the quasi-Newton steps, and bytes of partial gradients that go straight to the driver.
STEP_ROWS = 2048
MEMORY = 12
DIRECT_BYTES = 32 << 20
CHUNK = 1 << 16


@dataclass(frozen=True)
class Run:
    """``bit`` is the number of the row set in the rows' ``keep`` words of 63 bits, if rows carry them; ``classes`` are
    the class weights of a balanced run whose rows are such a set, in place of the rows' own ``cw``."""

    loss: str
    C: float
    balanced: bool = False
    bit: int | None = None
    classes: tuple[float, ...] | None = None


def sparse(vector: str) -> list[Column]:
    """``size``, ``at`` and ``value`` of the nonzero entries of a vector column."""
    v = F.unwrap_udt(vector)
    dense = F.sequence(F.lit(0), F.size(v["values"]) - 1)
    at = F.when(v["indices"].isNotNull(), v["indices"]).when(F.size(v["values"]) > 0, dense).otherwise(F.array().cast("array<int>"))
    return [at.alias("at"), v["values"].alias("value")]


class Rows:
    """Some rows of (at, value) lists, with the rows' places sorted by term for the way back."""

    def __init__(self, batch: pa.RecordBatch, size: int):
        at, value = batch.column("at"), batch.column("value")
        self.n = batch.num_rows
        counts = np.diff(at.offsets.to_numpy())
        # the intercept is the last term, 1 in every row
        ends = np.cumsum(counts)
        self.at = np.insert(at.flatten().to_numpy().astype(np.int64), ends, size)
        self.value = np.insert(value.flatten().to_numpy(), ends, 1.0)
        self.begins = np.concatenate([[0], ends[:-1] + np.arange(1, self.n)]) if self.n else ends
        self.owner = np.repeat(np.arange(self.n), counts + 1)

    def times(self, coefficients: np.ndarray) -> np.ndarray:
        return np.add.reduceat(coefficients[self.at] * self.value[:, None], self.begins, axis=0)

    def back(self, slopes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(terms, their sums of value x slope)."""
        order = np.argsort(self.at, kind="stable")
        terms, first = np.unique(self.at[order], return_index=True)
        return terms, np.add.reduceat(slopes[self.owner[order]] * self.value[order, None], first, axis=0)


def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, STEP_ROWS):
            yield batch.slice(at, STEP_ROWS)


def _weights(batch: pa.RecordBatch, run: Run) -> tuple[np.ndarray, np.ndarray]:
    """(weight of the row, class weight of the row if the run is balanced)."""
    w = batch.column("w").to_numpy()
    if run.bit is not None:
        words = batch.column("keep").flatten().to_numpy().reshape(batch.num_rows, -1)
        w = w * (words[:, run.bit // 63] >> (run.bit % 63) & 1)
    if not run.balanced:
        return w, np.ones(batch.num_rows)
    return w, batch.column("cw").to_numpy() if run.classes is None else np.array(run.classes)[batch.column("y").to_numpy()]


def _slope(run: Run, f: np.ndarray, y: np.ndarray, w: np.ndarray, cw: np.ndarray) -> tuple[float, np.ndarray]:
    """(sum of losses, derivative by every score) of some rows."""
    rows = np.arange(len(y))
    if run.loss == LOGISTIC:
        shifted = f - f.max(axis=1, keepdims=True)
        total = np.exp(shifted).sum(axis=1, keepdims=True)
        p = np.exp(shifted) / total
        loss = float((w * cw * (np.log(total[:, 0]) - shifted[rows, y])).sum())
        p[rows, y] -= 1
        return loss, p * (w * cw)[:, None]
    sign = np.full(f.shape, -1.0)
    sign[rows, y] = 1.0
    short = np.maximum(0.0, 1.0 - sign * f)
    v = np.repeat(w[:, None], f.shape[1], axis=1)
    v[rows, y] *= cw
    return float((v * short * short).sum()), -2 * v * sign * short


def chunked(flat: np.ndarray) -> pa.RecordBatch:
    """A long vector as rows (chunk, sums)."""
    parts = [flat[i : i + CHUNK].tobytes() for i in range(0, len(flat), CHUNK)]
    return pa.RecordBatch.from_pydict({"chunk": pa.array(range(len(parts)), pa.int32()), "sums": pa.array(parts, pa.binary())})


CHUNKED = "chunk int, sums binary"
#: Vectors that one task adds up at a time.
FAN_IN = 32


def total(partial: DataFrame, tasks: int, length: int) -> np.ndarray:
    """Sum of the vectors that the tasks of ``partial`` gave as chunks; where they are large, added up on the cluster first.

    Chunks are few, so they are added up in levels of ``FAN_IN`` tasks: what a task reads does not grow with their number.
    """

    def add(group: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(b.as_py()) for b in group["sums"])
        return group.slice(0, 1).select(["part", "chunk"]).append_column("sums", pa.array([whole.tobytes()], pa.binary()))

    if tasks * length * 8 > DIRECT_BYTES:
        partial = partial.select(F.spark_partition_id().alias("part"), "chunk", "sums")
        while tasks > 1:
            tasks = -(-tasks // FAN_IN)
            higher = partial.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
            partial = higher.groupBy("part", "chunk").applyInArrow(add, f"part int, {CHUNKED}")
    flat = np.zeros(length)
    for r in partial.collect():
        part = np.frombuffer(r["sums"])
        flat[r["chunk"] * CHUNK : r["chunk"] * CHUNK + len(part)] += part
    return flat


def _scan(data: DataFrame, runs: list[Run], points: list[np.ndarray], size: int, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """(loss per run, gradients as (term, run, class)) of the data part of the objectives, in one pass."""
    together = np.concatenate(points, axis=1)
    width = together.shape[1]

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, losses = np.zeros((size + 1, width)), np.zeros(len(runs))
        seen = False
        for batch in steps(batches):
            seen = True
            rows, y = Rows(batch, size), batch.column("y").to_numpy()
            f = rows.times(together)
            slopes = np.empty_like(f)
            for i, run in enumerate(runs):
                here = slice(i * n_classes, (i + 1) * n_classes)
                loss, slopes[:, here] = _slope(run, f[:, here], y, *_weights(batch, run))
                losses[i] += loss
            terms, back = rows.back(slopes)
            sums[terms] += back
        if seen:
            yield chunked(np.concatenate([losses, sums.ravel()]))

    flat = total(data.mapInArrow(evaluate, CHUNKED), data.rdd.getNumPartitions(), len(runs) + (size + 1) * width)
    return flat[: len(runs)], flat[len(runs) :].reshape(size + 1, len(runs), n_classes)


class Descent:
    """Quasi-Newton steps of one run: ``trial`` is the next point to evaluate, ``take`` uses its value and gradient.

    ``bend`` is a bound on the second derivative by every coefficient: terms may be in most rows or in a handful."""

    def __init__(self, start: np.ndarray, bend: np.ndarray, tol: float, max_iter: int):
        self.trial, self.bend, self.tol, self.max_iter = start, bend, tol, max_iter
        self.x: np.ndarray | None = None
        self.pairs: deque = deque(maxlen=MEMORY)
        self.iterations, self.done, self.converged = 0, False, False

    def take(self, value: float, slope: np.ndarray) -> None:
        if self.x is not None and not value <= self.value + 1e-4 * self.step * self.along:
            self.step /= 2
            if self.step < 1e-12:  # no lower point along the way that doubles can tell
                self.done = self.converged = True
            self.trial = self.x + self.step * self.way
            return
        if self.x is not None:
            s, d = self.trial - self.x, slope - self.slope
            if (s * d).sum() > 1e-14 * (d * d).sum():
                self.pairs.append((s, d, 1.0 / (s * d).sum()))
            self.iterations += 1
        self.x, self.value, self.slope = self.trial, value, slope
        self.converged = float(np.abs(slope).max()) <= self.tol
        self.done = self.converged or self.iterations >= self.max_iter
        self.way = -self._newton(slope)
        self.along = float((self.way * slope).sum())
        self.step = 1.0
        self.trial = self.x + self.step * self.way

    def _newton(self, slope: np.ndarray) -> np.ndarray:
        q, factors = slope.copy(), []
        for s, d, r in reversed(self.pairs):
            a = r * (s * q).sum()
            factors.append(a)
            q -= a * d
        q /= self.bend
        if self.pairs:
            s, d, _ = self.pairs[-1]
            q *= (s * d).sum() / (d * d / self.bend).sum()
        for (s, d, r), a in zip(self.pairs, reversed(factors)):
            q += s * (a - r * (d * q).sum())
        return q


def _squares(data: DataFrame, runs: list[Run], size: int) -> np.ndarray:
    """Sum of weight x value squared per term and run."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((size + 1, len(runs)))
        for batch in steps(batches):
            rows = Rows(batch, size)
            rows.value = rows.value**2
            terms, back = rows.back(np.stack([np.multiply(*_weights(batch, run)) for run in runs], axis=1))
            sums[terms] += back
        yield pa.RecordBatch.from_pydict({"term": pa.array(range(size + 1), pa.int32()), "sums": pa.array(sums.tolist(), pa.list_(pa.float64()))})

    columns = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(len(runs))]
    rows = data.mapInArrow(add_up, "term int, sums array<double>").groupBy("term").agg(*columns).toArrow().to_pandas().sort_values("term")
    return rows.drop(columns="term").to_numpy() if len(rows) else np.zeros((size + 1, len(runs)))


def fit_runs(data: DataFrame, runs: list[Run], size: int, n_classes: int, max_iter: int, tol: float) -> list[np.ndarray]:
    """Coefficients (terms and the intercept last, classes) of every run on ``data(at, value, y, w, cw[, keep])``, a stored table.

    A run ends when no component of its gradient is above ``tol``; one that meets ``max_iter`` first gives a warning.
    """
    squares = _squares(data, runs, size)
    totals = np.maximum(squares[-1], 1e-300)  # the intercept is 1 in every row
    states = []
    for i, run in enumerate(runs):
        n = totals[i]
        bend = squares[:, i, None] * (0.25 if run.loss == LOGISTIC else 2.0) / n + 1 / (run.C * n)
        states.append(Descent(np.zeros((size + 1, n_classes)), bend, tol, max_iter))
    while not all(s.done for s in states):
        open_ = [i for i, s in enumerate(states) if not s.done]
        losses, slopes = _scan(data, [runs[i] for i in open_], [states[i].trial for i in open_], size, n_classes)
        for j, i in enumerate(open_):
            n, point = totals[i], states[i].trial
            pulled = point.copy()
            if runs[i].loss == LOGISTIC:
                pulled[-1] = 0.0
            states[i].take(losses[j] / n + float((pulled * pulled).sum()) / (2 * runs[i].C * n), slopes[:, j] / n + pulled / (runs[i].C * n))
    late = [runs[i] for i, s in enumerate(states) if not s.converged]
    if late:
        warnings.warn(f"stopped after {max_iter} iterations: {late}", RuntimeWarning, stacklevel=2)
    return [s.x for s in states]


def count_predictions(rows: DataFrame, models: list[np.ndarray], size: int) -> DataFrame:
    """(run, actual, predicted, n) of all models on ``rows(at, value, y)``, class numbers, in one pass."""
    together, n_classes = np.concatenate(models, axis=1), models[0].shape[1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((len(models), n_classes + 1, n_classes), np.int64)
        for batch in steps(batches):
            f = Rows(batch, size).times(together)
            y = batch.column("y").to_numpy()
            for i in range(len(models)):
                best = f[:, i * n_classes : (i + 1) * n_classes].argmax(axis=1)
                np.add.at(cells[i], (y, best), 1)  # unknown labels are -1, the last row
        run, actual, predicted = np.nonzero(cells)
        columns = [pa.array(v.astype(np.int32)) for v in (run, actual, predicted)] + [pa.array(cells[run, actual, predicted])]
        yield pa.RecordBatch.from_arrays(columns, ["run", "actual", "predicted", "n"])

    counts = rows.select("at", "value", "y").mapInArrow(count, "run int, actual int, predicted int, n long")
    return counts.groupBy("run", "actual", "predicted").agg(F.sum("n").alias("n"))


def score(rows: DataFrame, model: np.ndarray, size: int, labels: list[str], label: str, keep: list[str], probabilities: bool) -> DataFrame:
    """``rows(at, value)`` with cv_pred and true_label_prob: probability or margin of the own label, 0 for an unknown one."""
    places = {name: i for i, name in enumerate(labels)}

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            f = Rows(batch, size).times(model)
            if probabilities:
                f = np.exp(f - f.max(axis=1, keepdims=True))
                f /= f.sum(axis=1, keepdims=True)
            own = np.array([places.get(v, -1) for v in batch.column(label).to_pylist()])
            true = np.where(own >= 0, f[np.arange(len(own)), own], 0.0)
            columns = [batch.column(c) for c in keep] + [pa.array([labels[i] for i in f.argmax(axis=1)]), pa.array(true)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "cv_pred", "true_label_prob"])

    narrow = rows.select(*dict.fromkeys([*keep, label]), "at", "value")
    return narrow.mapInArrow(predict, narrow.select(*keep).schema.add("cv_pred", "string").add("true_label_prob", "double"))
