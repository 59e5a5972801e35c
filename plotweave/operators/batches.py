"""Numpy on Arrow batches of vectors, run inside tasks."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Tasks get these functions by value, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Size of the largest distance matrix a task holds.
BLOCK_VALUES = 2_000_000


def batch_matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The non-null vectors of a batch as rows of a matrix."""
    present = column.drop_null()
    lengths = pc.list_value_length(present)
    if len(present) and pc.min_max(lengths).as_py() != {"min": dims, "max": dims}:
        raise ValueError(f"a vector's length differs from the centroids' {dims}")
    return present.flatten().to_numpy(zero_copy_only=False).astype("float64", copy=False).reshape(-1, dims)


def blocks(x: np.ndarray, columns: int) -> Iterator[np.ndarray]:
    """Row blocks of ``x`` whose product with ``columns`` stays within ``BLOCK_VALUES``."""
    rows = max(1, BLOCK_VALUES // max(columns, 1))
    for start in range(0, len(x), rows):
        yield x[start : start + rows]


def nearest_rows(x: np.ndarray, c: np.ndarray, step: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index of and distance to the nearest row of ``c``; the first of equals.

    ``c`` is worked through ``step`` rows at a time.

    Candidates come from one matrix product. Where rounding of that form could hide the
    true order, the rows are decided by differences; reported distances always are.
    """
    if step is not None and step < len(c):
        best, least = nearest_rows(x, c[:step])
        for start in range(step, len(c), step):
            found, d = nearest_rows(x, c[start : start + step])
            best, least = np.where(d < least, found + start, best), np.minimum(d, least)
        return best, least
    parts = [_nearest_in_block(block, c) for block in blocks(x, len(c))]
    if not parts:
        return np.zeros(0, "int64"), np.zeros(0)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _nearest_in_block(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    xx, cc = (x * x).sum(1), (c * c).sum(1)
    rough = xx[:, None] - 2.0 * (x @ c.T) + cc
    best = rough.argmin(1)
    slack = 1e-12 * (xx + cc.max(initial=0.0))
    candidates = rough <= (rough[np.arange(len(x)), best] + slack)[:, None]
    close = candidates.sum(1) > 1
    if close.any():
        rows, allowed = x[close], candidates[close]
        columns = np.flatnonzero(allowed.any(0))
        exact = np.stack([((rows - c[j]) ** 2).sum(1) for j in columns], axis=1)
        exact[~allowed[:, columns]] = np.inf
        best[close] = columns[exact.argmin(1)]
    return best, np.sqrt(((x - c[best]) ** 2).sum(1))


def second_distances(x: np.ndarray, c: np.ndarray, best: np.ndarray) -> np.ndarray:
    """A lower bound on each row's distance to all rows of ``c`` but its ``best`` one, close to the least."""
    out = [np.zeros(0)]
    start = 0
    cc = (c * c).sum(1)
    for block in blocks(x, len(c)):
        own = best[start : start + len(block)]
        start += len(block)
        xx = (block * block).sum(1)
        rough = xx[:, None] - 2.0 * (block @ c.T) + cc
        rough[np.arange(len(block)), own] = np.inf
        slack = 1e-12 * (xx + cc.max(initial=0.0))
        out.append(np.sqrt(np.maximum(rough.min(1, initial=np.inf) - slack, 0.0)))
    return np.concatenate(out)


class Counted:
    """Sums per cluster in whole numbers of ``unit``, exact whatever the order.

    A number of 58 bits is cut into three pieces that a product of floating-point matrices adds up
    without rounding.
    """

    PIECE = 20

    def __init__(self, shape: tuple[int, ...], unit: float):
        self.unit, self.pieces = unit, [np.zeros(shape, "int64") for _ in range(3)]

    def _cut(self, values: np.ndarray) -> list[np.ndarray]:
        whole, mask = np.rint(values / self.unit).astype("int64"), (1 << self.PIECE) - 1
        return [whole & mask, (whole >> self.PIECE) & mask, whole >> (2 * self.PIECE)]

    def add_rows(self, rows: np.ndarray, cluster: np.ndarray) -> None:
        """Adds each row to the sum of its cluster."""
        k, start = len(self.pieces[0]), 0
        for block in blocks(rows, k):
            member = np.zeros((k, len(block)))
            member[cluster[start : start + len(block)], np.arange(len(block))] = 1.0
            start += len(block)
            for total, piece in zip(self.pieces, self._cut(block)):
                total += (member @ piece.astype("float64")).astype("int64")

    def add(self, values: np.ndarray, cluster: np.ndarray) -> None:
        for total, piece in zip(self.pieces, self._cut(values)):
            total += np.bincount(cluster, weights=piece, minlength=len(total)).astype("int64")

    def parts(self) -> tuple[np.ndarray, np.ndarray]:
        """High and low parts of the sums; both may be added up as integers."""
        low, middle, high = self.pieces
        middle = middle + (low >> self.PIECE)
        high = high + (middle >> self.PIECE)
        mask = (1 << self.PIECE) - 1
        return high, ((middle & mask) << self.PIECE) + (low & mask)

    @classmethod
    def value(cls, high: np.ndarray, low: np.ndarray, unit: float) -> np.ndarray:
        return (high.astype("float64") * float(1 << (2 * cls.PIECE)) + low.astype("float64")) * unit
