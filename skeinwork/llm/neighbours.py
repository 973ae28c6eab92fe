"""Approximate nearest neighbours by cosine, through a kd-tree over a low-dimensional stable projection.

Vectors are scaled to length one, so the nearest by angle is the nearest by Euclidean distance.  A fixed Gaussian
matrix, which is 2-stable, projects them to ``PROJECTED`` dimensions: the squared projected distance of two points is
their squared distance times a chi-square variable with that many degrees of freedom.  The projected points are indexed
by a kd-tree whose upper levels are the cells of ``vectors`` and whose lower ones are made in each part.  A query takes
cells, and leaves within a part, by their projected distance and verifies their points by the exact cosine; it stops where
a point as near as its k-th best would already have been met with probability ``SURE``, by the chi-square distribution.
All rows are indexed; recall is measured against brute force in the tests.  Ties of equal vectors go to the smaller
vec_id: a box at distance 0 never stops a query.  Nulls and the like are defined in ``vectors``.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from skeinwork.llm.common import Scratch
from skeinwork.llm.vectors import POINTS, Found, Kind, search

PROJECTED, LEAF, SURE, SEED = POINTS, 32, 0.99, 20240229


def chi_square_quantile(p: float, degrees: int) -> float:
    """For an even number of degrees, where the distribution has a closed form."""
    half = degrees // 2
    below = lambda x: 1 - math.exp(-x / 2) * sum((x / 2) ** j / math.factorial(j) for j in range(half))
    low, high = 0.0, 1.0
    while below(high) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


LIMIT = chi_square_quantile(SURE, PROJECTED)


@lru_cache(64)
def projection(dims: int, m: int = PROJECTED) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dims, m))


def kd_leaves(points: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """The leaves of a kd-tree: splits at the median of the widest dimension until a leaf is small."""
    todo, leaves = [np.arange(len(points))], []
    while todo:
        own = todo.pop()
        if len(own) <= leaf:
            leaves.append(own)
            continue
        x = points[own]
        along = x[:, int(np.argmax(x.max(0) - x.min(0)))]
        order = np.argpartition(along, len(own) // 2)
        todo += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
    return leaves


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, first by their largest component so that no square overflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


class Cosine(Kind):
    """Nearness by cosine; a vector's points are its projection."""

    zero = False

    def points(self, x: np.ndarray) -> np.ndarray:
        return unit(x) @ projection(x.shape[1])

    def promise(self, points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Squared projected distances to boxes, negated."""
        out = np.zeros((len(points), len(low)))
        for i in range(points.shape[1]):
            gap = np.maximum(np.maximum(low[:, i] - points[:, i : i + 1], points[:, i : i + 1] - high[:, i]), 0)
            out -= gap * gap
        return out

    def allowed(self, promise: np.ndarray, points: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """The stopping test, with a margin for rounding; boxes at distance 0 always pass."""
        near = np.where(np.isfinite(marks), np.maximum(2 - 2 * marks, 0), np.inf)
        return -promise <= LIMIT * near[:, None] + 1e-12

    def block(self, x: np.ndarray) -> tuple:
        leaves = kd_leaves(points := self.points(x))
        ends = np.cumsum([len(v) for v in leaves])
        starts, order = ends - np.array([len(v) for v in leaves]), np.concatenate(leaves)
        low, high = (f.reduceat(points[order], starts) for f in (np.minimum, np.maximum))
        return unit(x)[order], order, starts, ends, low, high

    def meet(self, block: tuple, q: np.ndarray, found: Found) -> None:
        """Leaves by rising distance, 1, 2, 4 and so on at a time, until none passes the stopping test."""
        r, order, starts, ends, low, high = block
        points, q = self.points(q), unit(q)
        promise = self.promise(points, low, high)
        by = np.argsort(-promise, axis=1, kind="stable")
        at, step = 0, 1
        while at < len(starts):
            leaf = by[:, at : at + step]
            ok = np.take_along_axis(self.allowed(promise, points, found.marks), leaf, 1)
            if not ok.any():
                return
            who, what = np.nonzero(ok)
            what = leaf[who, what]
            sort = np.argsort(what, kind="stable")
            who, what = who[sort], what[sort]
            cuts = np.flatnonzero(np.diff(what)) + 1
            pairs = []
            for own, one in zip(np.split(who, cuts), what[np.append(0, cuts)], strict=True):
                score = r[starts[one] : ends[one]] @ q[own].T
                row, col = np.nonzero(score >= found.marks[own] - 1e-12)
                pairs.append((own[col], starts[one] + row))
            who, row = (np.concatenate(x) for x in zip(*pairs, strict=True))
            found.add(who, order[row], np.einsum("ij,ij->i", q[who], r[row]))
            at, step = at + step, step * 2


def nearest(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The k nearest of each row whose vec_id is divisible by every: query_id, rank, vec_id, score."""
    return search(vectors, every, k, Cosine(), Scratch(vectors.sparkSession, "nearest"))
