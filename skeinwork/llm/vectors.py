"""Searches of a stated set of queries over all vectors, through cells with bounds, in two rounds.

Cells.  A kd-tree over a few numbers for each vector (its points) is fitted to at most ``SAMPLE`` vectors, those with the
smallest hashes of vec_id, and has at most ``CELLS`` leaves; every vector belongs to the cell of its leaf.  What is known
of a cell, its number of vectors and the box of their points, comes from all vectors, and there are at most ``CELLS`` cells
and one for each sampled vector's length, so that the tables of cells fit into every task.

Rounds.  First each query meets the cell that promises most, and the k-th best of what it finds there becomes its mark.
Then it meets all other cells whose box allows a vector as good as the mark.  In each round rows and the queries that want
their cell are shuffled together, each row once, to parts of at most about ``BLOCK`` rows; a part that more than
``QUERIES`` queries want is dealt out as many times as needed.  A task holds one part and streams its queries.

Equal vectors are one row of a part: those of a batch are put together before the shuffle.  Of their ids only the k + 1
least are needed (each at most k times), since all score alike and a query leaves out no id but its own.

Defined results: vectors that are null, empty or hold null or non-finite components take no part (nor do zero vectors
where a cosine is asked for); vectors meet only those of the same length; rows with a query's own vec_id are its own;
rows that occur twice count twice; ties go to the smaller vec_id; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType
from pyspark.sql.window import Window

BLOCK, QUERIES, CELLS, SAMPLE = 4096, 4096, 4096, 16_384
#: Numbers for each vector that cells are made of.
POINTS = 8
_MEETING = {"dims": pa.int32(), "cell": pa.int32(), "part": pa.int32(), "salt": pa.int32(), "kind": pa.int32(), "h": pa.int64(), "data": pa.binary(), "ids": pa.binary(), "mark": pa.float64()}
_MEETING_DDL = "dims int, cell int, part int, salt int, kind int, h long, data binary, ids binary, mark double"
_KEY = ["dims", "cell", "part", "salt"]


class Kind:
    """What a search is by: points, bounds of cells, and the meeting of queries with the rows of a part."""

    score_type = "double"
    zero = True

    def points(self, x: np.ndarray) -> np.ndarray:
        """POINTS numbers for each row."""
        raise NotImplementedError

    def promise(self, points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """How much each box (a column) promises each query (a row)."""
        raise NotImplementedError

    def allowed(self, promise: np.ndarray, points: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """Which boxes may hold something as good as the marks."""
        raise NotImplementedError

    def block(self, x: np.ndarray) -> object:
        """What meet() wants to know of the rows of a part."""
        raise NotImplementedError

    def meet(self, block: object, q: np.ndarray, found: Found) -> None:
        """Hands to found all rows of the block that may be among the best of the queries."""
        raise NotImplementedError


class Found:
    """The k best ids of each query so far, with marks below which nothing is of interest."""

    def __init__(self, queries: np.ndarray, marks: np.ndarray, ids: np.ndarray, ends: np.ndarray, k: int, score_type: type) -> None:
        self.queries, self.marks, self.ids, self.k = queries, marks.copy(), ids, k
        self.starts, self.counts = ends - np.diff(ends, prepend=0), np.diff(ends, prepend=0)
        self.q, self.vec, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, score_type)

    def add(self, q: np.ndarray, rows: np.ndarray, score: np.ndarray) -> None:
        """Places of queries and rows with their scores; the marks rise."""
        n = self.counts[rows]
        each = np.repeat(np.arange(len(rows)), n)
        at = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n) + self.starts[rows][each]
        vec, q, score = self.ids[at], q[each], score[each]
        other = vec != self.queries[q]
        q, vec, score = (np.concatenate([a, b[other]]) for a, b in ((self.q, q), (self.vec, vec), (self.score, score)))
        order = np.lexsort((vec, -score, q))
        q, vec, score = q[order], vec[order], score[order]
        first = np.searchsorted(q, q)
        rank = np.arange(len(q)) - first
        top = rank < self.k
        self.q, self.vec, self.score = q[top], vec[top], score[top]
        last = rank == self.k - 1
        self.marks[q[last]] = np.maximum(self.marks[q[last]], score[last])


def usable(vectors: DataFrame, zero: bool) -> DataFrame:
    """vec_id and embedding (floats as they are, other numbers as doubles) of the rows that take part."""
    x, own = F.col("embedding").cast("array<double>"), vectors.schema["embedding"].dataType
    ok = x.isNotNull() & F.col("vec_id").isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    if not zero:
        ok &= F.exists(x, lambda c: c != 0)
    narrow = isinstance(own, ArrayType) and isinstance(own.elementType, FloatType)
    return vectors.filter(ok).select(F.col("vec_id").cast("long"), (F.col("embedding") if narrow else x).alias("embedding"))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """ids and vectors of a batch, for each length."""
    ids, lists = np.asarray(batch.column(0)), batch.column(1)
    lengths = np.asarray(pc.list_value_length(lists))
    flat, ends = np.asarray(lists.flatten()), np.cumsum(lengths)
    for dims in np.unique(lengths):
        own = np.flatnonzero(lengths == dims)
        yield ids[own], flat[((ends[own] - dims)[:, None] + np.arange(dims))]


def least_ids(ids: np.ndarray, k: int) -> np.ndarray:
    """The k + 1 least ids, sorted, each at most k times."""
    ids = np.sort(ids)
    fresh = np.append(True, ids[1:] != ids[:-1])
    group = np.cumsum(fresh) - 1
    place = np.arange(len(ids)) - np.flatnonzero(fresh)[group]
    return ids[(group <= k) & (place < k)]


class Cells:
    """The kd-trees by length, and what is known of the cells."""

    def __init__(self, kind: Kind, sample: list[np.ndarray], total: int) -> None:
        self.trees: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.boxes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by: dict[int, list[np.ndarray]] = {}
        for x in sample:
            by.setdefault(len(x), []).append(x)
        for dims, rows in by.items():
            wanted = min(CELLS, len(rows), max(1, -(-total * len(rows) // (len(sample) * BLOCK))))
            self.trees[dims] = self._fit(kind.points(np.stack(rows)), (wanted - 1).bit_length())

    @staticmethod
    def _fit(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Axes and values of the splits, level by level, each at the median of the widest axis."""
        axis, value, level = [], [], [points]
        for _ in range(depth):
            below = []
            for own in level:
                wide = int(np.argmax(own.max(0) - own.min(0))) if len(own) else 0
                middle = float(np.median(own[:, wide])) if len(own) else 0.0
                if len(own) and middle == own[:, wide].max():  # nothing would lie above
                    smaller = own[:, wide][own[:, wide] < middle]
                    middle = float(smaller.max()) if len(smaller) else middle
                axis.append(wide)
                value.append(middle)
                up = own[:, wide] > middle
                below += [own[~up], own[up]]
            level = below
        return np.array(axis, np.int64), np.array(value)

    def of(self, dims: int, points: np.ndarray) -> np.ndarray:
        if dims not in self.trees:
            return np.zeros(len(points), np.int64)
        axis, value = self.trees[dims]
        at, each = np.zeros(len(points), np.int64), np.arange(len(points))
        for _ in range((len(axis) + 1).bit_length() - 1):  # the levels of the tree
            at = 2 * at + 1 + (points[each, axis[at]] > value[at])
        return at - len(axis)

    def know(self, rows: list) -> None:
        """Takes rows (dims, cell, n, low..., high...)."""
        for dims in {r[0] for r in rows}:
            own = sorted(r for r in rows if r[0] == dims)
            low, high = (np.array([r[a : a + POINTS] for r in own], float) for a in (3, 3 + POINTS))
            self.boxes[dims] = np.array([r[1] for r in own]), low, high
        self.parts = {(r[0], r[1]): max(1, -(-r[2] // BLOCK)) for r in rows}

    def wanted(self, kind: Kind, dims: int, q: np.ndarray, marks: np.ndarray, first: bool) -> Iterator[tuple[int, np.ndarray]]:
        """Cells with the places of the queries that want them in the first or the second round."""
        if dims not in self.boxes:
            if first:
                yield 0, np.arange(len(q))
            return
        cells, low, high = self.boxes[dims]
        for at in range(0, len(q), 256):
            points = kind.points(q[at : at + 256])
            promise = kind.promise(points, low, high)
            best, each = promise.argmax(1), np.arange(len(points))
            if first:
                ok = np.zeros(promise.shape, bool)
                ok[each, best] = True
            else:
                ok = kind.allowed(promise, points, marks[at : at + 256])
                ok[each, best] = False
            for c in np.flatnonzero(ok.any(0)):
                yield int(cells[c]), at + np.flatnonzero(ok[:, c])


def _binary(x: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    width = x.shape[1] * x.itemsize
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer((np.arange(len(x) + 1) * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])


def _merged(ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct rows of x and the ids of each that are needed."""
    x = np.ascontiguousarray(x + x.dtype.type(0))  # no -0.0
    _, first, place = np.unique(x.view(f"V{x.shape[1] * x.itemsize}").ravel(), return_index=True, return_inverse=True)
    order = np.argsort(place, kind="stable")
    cuts = np.flatnonzero(np.diff(place[order])) + 1
    return x[first], [own if len(own) == 1 else least_ids(own, k) for own in np.split(ids[order], cuts)]


def search(vectors: DataFrame, every: int, k: int, kind: Kind, scratch) -> DataFrame:
    """The k best rows of each query: query_id, rank, vec_id, score."""
    rows = usable(vectors, kind.zero)
    dtype = np.float32 if isinstance(rows.schema["embedding"].dataType.elementType, FloatType) else np.float64
    sample = [np.array(r[0], float) for r in rows.orderBy(F.xxhash64("vec_id")).limit(SAMPLE).select("embedding").collect()]  # at most SAMPLE vectors
    cells = Cells(kind, sample, rows.count() if len(sample) == SAMPLE else len(sample))

    def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, x in _matrices(batch):
                points = kind.points(x.astype(float))
                at = cells.of(x.shape[1], points)
                for c in np.unique(at):
                    own = points[at == c]
                    out.append((x.shape[1], int(c), len(own), *own.min(0), *own.max(0)))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True) if out else [[]] * len(shown), (pa.int32(), pa.int32(), pa.int64(), *[pa.float64()] * (2 * POINTS)), strict=True)], names=shown)

    shown = ["dims", "cell", "n", *(f"low{i}" for i in range(POINTS)), *(f"high{i}" for i in range(POINTS))]
    known = rows.mapInArrow(boxes, ", ".join(f"{c} {'int' if i < 2 else 'long' if i == 2 else 'double'}" for i, c in enumerate(shown)))
    known = known.filter(F.col("dims").isin([*cells.trees])).groupBy("dims", "cell").agg(F.sum("n").alias("n"), *(F.min(c).alias(c) for c in shown[3 : 3 + POINTS]), *(F.max(c).alias(c) for c in shown[3 + POINTS :]))
    cells.know([tuple(r) for r in known.collect()])  # a row for each cell

    asked = rows.filter(F.col("vec_id") % every == 0).select("vec_id", "embedding", F.lit(float("-inf")).alias("mark"))
    found = scratch.keep(_best(_round(rows, asked, kind, cells, k, dtype, True), k))
    marks = found.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("known"))
    asked = scratch.keep(asked.join(marks, "vec_id", "left").select("vec_id", "embedding", F.coalesce("known", "mark").alias("mark")))
    return _best(_round(rows, asked, kind, cells, k, dtype, False).unionAll(found.drop("rank")), k)


def _best(found: DataFrame, k: int) -> DataFrame:
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", "vec_id", "score").withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _round(rows: DataFrame, asked: DataFrame, kind: Kind, cells: Cells, k: int, dtype: type, first: bool) -> DataFrame:
    """query_id, vec_id and score of the best that queries find in the cells that they want in this round."""
    parts = cells.parts

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, out = np.asarray(batch.column(2)), []
            for own, x in _matrices(_placed(batch)):
                out += [(x.shape[1], c, len(at)) for c, at in cells.wanted(kind, x.shape[1], x.astype(float), marks[own], first)]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True) if out else [[]] * 3, (pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["dims", "cell", "n"])

    counted = asked.mapInArrow(load, "dims int, cell int, n long").filter(F.col("dims").isin([*cells.trees])).groupBy("dims", "cell").agg(F.sum("n").alias("n"))
    salts = {(r.dims, r.cell): -(-r.n // QUERIES) for r in counted.collect()}  # a row for each cell

    def deal_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in _matrices(batch):
                x, ids = _merged(ids, x, k)
                dims, data = x.shape[1], _binary(x)
                cell = cells.of(dims, kind.points(x.astype(float)))
                h = np.array([xxhash.xxh3_64_intdigest(r) for r in x.view(np.uint8).reshape(len(x), -1)], np.uint64).view(np.int64)
                part = h.view(np.uint64) % np.array([parts.get((dims, int(c)), 1) for c in cell], np.uint64)
                times = np.array([salts.get((dims, int(c)), 0 if dims in cells.trees else 1) for c in cell], np.int64)  # no query, no copy
                each = np.repeat(np.arange(len(x)), times)
                n, salt = len(each), np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                values = [np.full(n, dims), cell[each], part[each].astype(np.int64), salt, np.zeros(n, int), h[each], data.take(pa.array(each)), pa.array([i.tobytes() for i in ids], pa.binary()).take(pa.array(each)), pa.nulls(n, pa.float64())]
                yield pa.RecordBatch.from_arrays([v.cast(t) if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(values, _MEETING.values(), strict=True)], names=list(_MEETING))

    def deal_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = np.asarray(batch.column(0)), np.asarray(batch.column(2))
            for own, x in _matrices(_placed(batch)):
                dims, data = x.shape[1], _binary(x)
                h = ids[own]
                for c, at in cells.wanted(kind, dims, x.astype(float), marks[own], first):
                    of, salt = parts.get((dims, c), 1), h[at].view(np.uint64) // np.uint64(7) % np.uint64(salts.get((dims, c), 1))
                    for begin in range(0, of, 64):
                        p = np.arange(begin, min(of, begin + 64))
                        each = np.repeat(at, len(p))
                        n = len(each)
                        values = [np.full(n, dims), np.full(n, c), np.tile(p, len(at)), np.repeat(salt.astype(np.int64), len(p)), np.ones(n, int), h[each], data.take(pa.array(each)), pa.nulls(n, pa.binary()), marks[own][each]]
                        yield pa.RecordBatch.from_arrays([v.cast(t) if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(values, _MEETING.values(), strict=True)], names=list(_MEETING))

    score_type = np.int64 if kind.score_type == "long" else np.float64

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, data, ids = None, [], []
        block = flat = ends = None
        for whole in batches:
            for batch in (whole.slice(at, 1024) for at in range(0, whole.num_rows, 1024)):
                names = np.stack([np.asarray(batch.column(i)) for i in range(5)], 1)
                cuts = np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1
                for begin, end in zip([0, *cuts], [*cuts, len(names)], strict=True) if len(names) else ():
                    own, row = batch.slice(begin, end - begin), names[begin]
                    if tuple(row[:4]) != key:
                        key, data, ids, block = tuple(row[:4]), [], [], None
                    x = np.frombuffer(b"".join(own.column(6).to_pylist()), dtype).reshape(-1, row[0])
                    if row[4] == 0:
                        data.append(x)
                        ids += own.column(7).to_pylist()
                        continue
                    if not data:
                        continue
                    if block is None:
                        n = np.array([len(i) // 8 for i in ids])
                        every_x, each = np.concatenate(data), np.repeat(np.arange(len(ids)), n)
                        distinct, lists = _merged_lists(np.frombuffer(b"".join(ids), np.int64), every_x, each, k)
                        flat, ends = np.concatenate(lists), np.cumsum([len(v) for v in lists])
                        block, data = kind.block(distinct.astype(float)), [distinct[:0]]
                    found = Found(np.asarray(own.column(5)), np.asarray(own.column(8)), flat, ends, k, score_type)
                    kind.meet(block, x.astype(float), found)
                    yield pa.RecordBatch.from_arrays([pa.array(found.queries[found.q]), pa.array(found.vec), pa.array(found.score)], names=["query_id", "vec_id", "score"])

    met = rows.mapInArrow(deal_rows, _MEETING_DDL).unionAll(asked.mapInArrow(deal_queries, _MEETING_DDL))
    return met.repartition(*_KEY).sortWithinPartitions(*_KEY, "kind", "h").mapInArrow(meet, f"query_id long, vec_id long, score {kind.score_type}")


def _placed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A batch with places instead of ids."""
    return pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column(1)], names=["at", "embedding"])


def _merged_lists(ids: np.ndarray, x: np.ndarray, each: np.ndarray, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """As _merged, for rows that have lists of ids already; each tells the row of an id."""
    return _merged(ids, x[each], k)
