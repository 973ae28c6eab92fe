"""Exact search for the largest integer inner products, by multi-resolution segment statistics.

Every vector keeps the mean and deviation of each of its segments, at several resolutions.  For two vectors the squared
distance is at least the sum over segments of length * ((difference of means)^2 + (difference of deviations)^2), and
q.x = (q.q + x.x - distance^2) / 2, so a lower bound of the distance gives an upper bound of the product; as a vector's
squared length is the sum of length * (mean^2 + deviation^2), that bound is the inner product of the two rows of
statistics.  The cells of ``vectors`` are boxes of such statistics.  A query starts in the cell of the best bound, with the
rows of the best bounds there; its k-th product is the mark.  Cells, and rows of a part from coarse to fine, whose bound
stays below the mark are dropped, and the exact product is computed for those that are left, in doubles where these hold
all sums and else in integers.  A margin for rounding keeps the bounds safe.  Products beyond 64 bits are computed exactly
and held at the type's ends.  Nulls, ties and the like are defined in ``vectors``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from skeinwork.llm.common import Scratch
from skeinwork.llm.vectors import POINTS, Found, Kind, search

SEGMENTS, CELL_SEGMENTS = (1, 4, 16), POINTS // 2
MARGIN = 1e-9
LARGEST = 1 << 62


def scaled(x: np.ndarray) -> np.ndarray:
    """floor(256 * x) as 64-bit integers."""
    return np.clip(np.floor(256.0 * x), -float(LARGEST), float(LARGEST)).astype(np.int64)


def safe(marks: np.ndarray) -> np.ndarray:
    """Marks as doubles that are no larger than the products they stand for."""
    return np.where(np.isfinite(marks), marks - np.abs(marks) * 1e-15 * 4, marks)


def bounds_of(dims: int, segments: int) -> np.ndarray:
    n = min(segments, dims)
    return np.arange(n + 1) * dims // n


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, each times the root of the segment's length."""
    cut = bounds_of(x.shape[1], segments)
    length = np.diff(cut).astype(float)
    total, square = np.add.reduceat(x, cut[:-1], axis=1), np.add.reduceat(x * x, cut[:-1], axis=1)
    mean = total / length
    deviation = np.sqrt(np.maximum(square / length - mean * mean, 0))
    return np.concatenate([mean, deviation], axis=1) * np.sqrt(np.concatenate([length, length]))


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products; in Python's integers where 64 bits might not hold them."""
    if rows.size == 0 or float(np.abs(rows).max()) * float(np.abs(query).max()) * rows.shape[1] < 2.0**62:
        return rows @ query
    ends = np.iinfo(np.int64)
    return np.array([max(ends.min, min(ends.max, sum(a * b for a, b in zip(r, query.tolist(), strict=True)))) for r in rows.tolist()], np.int64)


class Product(Kind):
    """Integer inner products; a vector's points are its statistics at ``CELL_SEGMENTS`` segments."""

    score_type = "long"

    def points(self, x: np.ndarray) -> np.ndarray:
        own = statistics(scaled(x).astype(float), CELL_SEGMENTS)
        return np.pad(own, ((0, 0), (0, POINTS - own.shape[1])))

    def promise(self, points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The largest product with a vector whose statistics lie in a box."""
        return np.maximum(points, 0) @ high.T + np.minimum(points, 0) @ low.T

    def allowed(self, promise: np.ndarray, points: np.ndarray, marks: np.ndarray) -> np.ndarray:
        return promise + np.abs(promise) * MARGIN + np.abs(points).max(1, keepdims=True) * MARGIN + 1 >= safe(marks)[:, None]

    def block(self, x: np.ndarray) -> tuple:
        whole = scaled(x)
        real = whole.astype(float)
        return whole, real, [statistics(real, s) for s in SEGMENTS], np.sqrt((real * real).sum(1))

    def meet(self, block: tuple, q: np.ndarray, found: Found) -> None:
        whole, real, levels, size = block
        q = scaled(q)
        q_real = q.astype(float)
        q_levels, q_size = [statistics(q_real, s) for s in SEGMENTS], np.sqrt((q_real * q_real).sum(1))
        exact = float(np.abs(real).max()) * float(np.abs(q_real).max()) * q.shape[1] < 2.0**53
        score = lambda i, rows: (real[rows] @ q_real[i]).astype(np.int64) if exact else products(whole[rows], q[i])
        unmarked = np.flatnonzero(np.isneginf(found.marks))
        if len(unmarked):  # the rows of the best bounds give a mark
            n = min(4 * found.k, len(whole))
            bound = q_levels[-1][unmarked] @ levels[-1].T
            first = np.argpartition(-bound, n - 1, axis=1)[:, :n]
            found.add(np.repeat(unmarked, n), first.ravel(), np.concatenate([score(i, rows) for i, rows in zip(unmarked, first, strict=True)]))
            found.q, found.vec, found.score = found.q[:0], found.vec[:0], found.score[:0]  # they are met again below
        for at in range(0, len(q), 32):
            own = slice(at, min(at + 32, len(q)))
            marks = safe(found.marks[own])
            rows, left = np.arange(len(whole)), None
            for mine, theirs in zip(q_levels, levels, strict=True):  # coarse to fine
                bound = theirs[rows] @ mine[own].T
                ok = bound + size[rows, None] * q_size[own] * MARGIN + 1 >= marks
                left = ok if left is None else left & ok
                some = left.any(1)
                rows, left = rows[some], left[some]
            if exact:
                scores = (real[rows] @ q_real[own].T).astype(np.int64)
            else:
                scores = np.stack([score(i, rows) for i in range(own.start, own.stop)], 1)
            row, col = np.nonzero(left & (scores >= marks))
            found.add(at + col, rows[row], scores[row, col])


def largest_products(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The k largest products of each row whose vec_id is divisible by every: query_id, rank, vec_id, score."""
    return search(vectors, every, k, Product(), Scratch(vectors.sparkSession, "topk"))
