"""Leading right singular vectors of sparse rows, by block power iteration from a random start."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.operators.linear import CHUNKED, Rows, chunked, steps, total

OVERSAMPLE = 10
MAX_PASSES = 30


def _gram_times(data: DataFrame, basis: np.ndarray) -> np.ndarray:
    """A'(A Q) of the rows A in ``at`` and ``value``, in one scan; a task sums one matrix of the size of ``basis``."""
    size, width = basis.shape
    padded = np.vstack([basis, np.zeros(width)])  # the rows' constant term takes no part

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, seen = np.zeros((size + 1, width)), False
        for batch in steps(batches):
            seen = True
            rows = Rows(batch, size)
            terms, back = rows.back(rows.times(padded))
            sums[terms] += back
        if seen:
            yield chunked(sums[:-1].ravel())

    return total(data.select("at", "value").mapInArrow(multiply, CHUNKED), data.rdd.getNumPartitions(), size * width).reshape(size, width)


def right_vectors(data: DataFrame, size: int, rank: int, tol: float = 1e-7, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(size x rank orthonormal columns, singular values, largest first) of rows with ``at`` and ``value``.

    The range of a block of ``rank`` + 10 random columns is multiplied by A'A until the energy that the leading ``rank``
    capture rises by less than ``tol`` of itself, at most 30 times. The driver holds two such blocks. Of a vector and its
    negative the one whose largest entry (the first, if several are) is positive is taken. Without rows all values are 0.
    """
    rank = min(rank, size)
    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, min(size, rank + OVERSAMPLE))))[0]
    before = -1.0
    for _ in range(MAX_PASSES):
        image = _gram_times(data, block)
        small = block.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = np.maximum(values[::-1][:rank], 0.0), turn[:, ::-1][:, :rank]
        vectors, energy = block @ turn, float(values.sum())
        if energy - before <= tol * energy or block.shape[1] == size:
            break
        before, block = energy, np.linalg.qr(image)[0]
    largest = np.abs(np.round(vectors, 9)).argmax(axis=0)
    return vectors * np.where(vectors[largest, np.arange(rank)] < 0, -1.0, 1.0), np.sqrt(values)


def project(rows: DataFrame, vectors: np.ndarray, out: str = "embedding", rest: str | None = None, row_id: str = "row_id") -> DataFrame:
    """(row id, products of the row with the columns of ``vectors``, then the row's numbers in ``rest``)."""
    size, padded = len(vectors), np.vstack([vectors, np.zeros(vectors.shape[1])])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            products = Rows(batch, size).times(padded)
            if rest:
                products = np.hstack([products, batch.column(rest).flatten().to_numpy().reshape(batch.num_rows, -1)])
            ends = pa.array(np.arange(batch.num_rows + 1) * products.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(row_id), pa.ListArray.from_arrays(ends, products.ravel())], [row_id, out])

    kind = rows.schema[row_id].dataType.simpleString()
    return rows.select(row_id, "at", "value", *([rest] if rest else [])).mapInArrow(multiply, f"`{row_id}` {kind}, `{out}` array<double>")
