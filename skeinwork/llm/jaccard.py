"""Exact self-join of documents by the Jaccard similarity of their word shingles, with count-vector R-trees.

A document's set holds the 64-bit hashes of its distinct shingles of k words (ASCII letters in lower case, words split at
ASCII white space); with fewer than k words the whole sequence is its one shingle.  Two documents link when
100 * intersection >= percent * union.

Count vectors.  Hashes deal the shingles into groups, more of them for larger sets.  The overlap of two sets is at most
the sum over groups of the lesser count, and for an R-tree node at most the sum of the lesser of the count and the
node's largest; what survives this bound is verified on the sets themselves.

Who meets whom.  Linked sets of a and b shingles differ in at most (a + b) * (100 - percent) / (100 + percent) of them.
With one part more than that, some part is equal in both.  So each document is dealt out under the digests of its parts,
with a number of parts that follows from its band of sizes (and those of all bands below, where it can link down into
them), and no linked pair is missed.  There are some parts more, so that an empty part need not be dealt out, unless a document
has more empty ones than were added; then it is dealt out under them too.

Documents under one digest, their exact copies left out, are joined by an R-tree over their count vectors; those that the
bound leaves together are tied.  Of the digests with the same documents one is looked at.  (Beyond ``most`` documents under one digest all are tied to the least, by a grouped
minimum and a join; the vectors of such documents go to no task.)  The connected
sets of the ties hold all linked pairs.  A connected set is verified in one task, by an R-tree again; one with more than
``weight`` shingles is dealt into blocks by size band and hash, and each pair of blocks that can link is a task.

Defined results: null and empty texts have no shingles and link with nothing; a document's component is the least doc_id
that links reach, itself included; a doc_id stands for one document, so rows that repeat it repeat its result (and rows
with null doc_id have a null component); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.llm.common import Scratch, text_of
from skeinwork.llm.graph import components

LEAF, WEIGHT, MOST = 16, 1_500_000, 20_000
BAND, WORDS_KEPT = 1.5, 400_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _B
    return h ^ (h >> np.uint64(29))


class Shingles:
    """Sets of shingle hashes; the hashes of words are remembered."""

    def __init__(self, k: int) -> None:
        self.k, self.known = k, {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        known = self.known
        try:
            own = np.array(list(map(known.__getitem__, words)), np.uint64)
        except KeyError:
            if len(known) > WORDS_KEPT:
                known.clear()
            known.update((w, xxhash.xxh64_intdigest(w)) for w in set(words).difference(known))
            own = np.array(list(map(known.__getitem__, words)), np.uint64)
        if not len(own):
            return own
        k = min(self.k, len(own))
        out = np.zeros(len(own) - k + 1, np.uint64)
        for i in range(k):
            out = mix((out + own[i : len(own) - k + 1 + i]) * _A)
        return np.unique(out)


def band_starts(top: int = 1 << 40) -> np.ndarray:
    out = [1]
    while out[-1] < top:
        out.append(max(out[-1] + 1, int(out[-1] * BAND)))
    return np.array(out)


_STARTS = band_starts()


@lru_cache(None)
def parts_of(band: int, percent: int) -> tuple[int, int]:
    """The number of parts for a band of sizes, and how many of them were added for empty ones."""
    least, largest = int(_STARTS[band]), int(_STARTS[band + 1]) - 1
    needed = (largest + largest * 100 // percent) * (100 - percent) // (100 + percent) + 1
    more = 0
    for _ in range(20):
        empty = (needed + more) * math.exp(-least / (needed + more))
        more = math.ceil(empty + 5 * math.sqrt(empty) + 0.5) if needed > 1 else 0
    return needed + more, more


def part_digests(shingles: np.ndarray, percent: int) -> np.ndarray:
    """The digests under which a set is dealt out."""
    n = len(shingles)
    band = int(np.searchsorted(_STARTS, n, side="right")) - 1
    out = []
    for k in range(band, -1, -1):
        if k < band and n * percent > 100 * (int(_STARTS[k + 1]) - 1):
            break
        parts, more = parts_of(k, percent)
        at = (mix(shingles * _A) % np.uint64(parts)).astype(np.int64)
        total = np.zeros(parts, np.uint64)
        np.add.at(total, at, mix(shingles + _B))
        keys = mix(total + np.uint64(k * 1_000_003) + np.arange(parts, dtype=np.uint64) * _A)
        full = np.zeros(parts, bool)
        full[at] = True
        out.append(keys if parts - full.sum() > more else keys[full])
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def count_vector(shingles: np.ndarray) -> np.ndarray:
    """Counts of the shingles by group; the number of groups is a power of two, so that vectors fold to shorter ones."""
    bits = min(12, max(4, (len(shingles) // 8).bit_length()))
    return np.minimum(np.bincount((mix(shingles * _B) & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits), 65535).astype(np.uint16)


def folded(vectors: list[np.ndarray]) -> np.ndarray:
    """Vectors as one matrix with as many groups as the shortest."""
    width = min(map(len, vectors))
    return np.stack([v.reshape(-1, width).sum(0, dtype=np.int32) for v in vectors])


class CountTree:
    """An R-tree over count vectors: points in the order of size, leaves of LEAF points, and nodes of LEAF leaves."""

    def __init__(self, sizes: np.ndarray, vectors: list[np.ndarray]) -> None:
        self.sizes, self.points = sizes, folded(vectors)
        self.order = np.lexsort((*self.points.T[:2], self.sizes))
        self.points, self.sizes = self.points[self.order], self.sizes[self.order]
        self.starts = np.arange(0, len(sizes), LEAF)
        self.most = np.maximum.reduceat(self.points, self.starts)
        self.least_size = self.sizes[self.starts]
        self.upper = np.maximum.reduceat(self.most, np.arange(0, len(self.starts), LEAF))

    def after(self, i: int, percent: int, wanted: np.ndarray) -> np.ndarray:
        """Wanted places j > i, in the order of size, whose bounds allow a link with i."""
        end = int(np.searchsorted(self.sizes, self.sizes[i] * 100 // percent, side="right"))
        near = i + 1 + np.flatnonzero(wanted[i + 1 : end])
        if not len(near):
            return near
        of = near // LEAF
        leaves = of[np.append(True, of[1:] != of[:-1])]
        if len(leaves) > LEAF:  # first the upper nodes
            top = np.arange(leaves[0] // LEAF, leaves[-1] // LEAF + 1)
            ok = np.minimum(self.points[i], self.upper[top]).sum(1) * (100 + percent) >= percent * 2 * self.sizes[i]
            leaves = leaves[ok[leaves // LEAF - top[0]]]
        bound = np.minimum(self.points[i], self.most[leaves]).sum(1)
        leaves = leaves[bound * (100 + percent) >= percent * (self.sizes[i] + np.maximum(self.least_size[leaves], self.sizes[i]))]
        stays = np.zeros(of[-1] - of[0] + 1, bool)
        stays[leaves - of[0]] = True
        near = near[stays[of - of[0]]]
        bound = np.minimum(self.points[i], self.points[near]).sum(1)
        return near[bound * (100 + percent) >= percent * (self.sizes[i] + self.sizes[near])]


class Roots:
    """Which places are joined, kept flat."""

    def __init__(self, n: int) -> None:
        self.of = np.arange(n)

    def join(self, i: int, others: np.ndarray) -> None:
        old = np.append(self.of[others], self.of[i])
        now = np.arange(len(self.of))  # what each root becomes
        now[old] = old.min()
        self.of = now[self.of]

    def least(self, ids: np.ndarray) -> np.ndarray:
        out = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(out, self.of, ids)
        return out[self.of]


def tied(ids: np.ndarray, sizes: np.ndarray, vectors: list[np.ndarray], percent: int) -> np.ndarray:
    """For each document the least id that pairs reach which the bound of their count vectors allows."""
    tree, roots = CountTree(sizes, vectors), Roots(len(ids))
    for i in range(len(ids)):
        near = tree.after(i, percent, roots.of != roots.of[i])  # those that aren't tied to it already
        if len(near):
            roots.join(i, near)
    out = np.empty(len(ids), np.int64)
    out[tree.order] = roots.least(ids[tree.order])
    return out


#: A tree of at most LEAF documents is one leaf; the leaves of all such digests of a batch are looked at together.
FEW = LEAF


def tied_few(group: np.ndarray, sizes: np.ndarray, vectors: list[bytes], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows of one group that the bound of their count vectors allows; rows come sorted by group.

    It is the bound at the leaves of the tree, for many small groups at once.
    """
    bits = np.array([len(v).bit_length() - 2 for v in vectors])
    left, right = [], []
    for d in range(1, min(FEW, len(group))):
        a = np.flatnonzero(group[d:] == group[:-d])
        b = a + d
        ok = np.maximum(sizes[a], sizes[b]) * percent <= 100 * np.minimum(sizes[a], sizes[b])
        left.append(a[ok])
        right.append(b[ok])
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right))
    found = []
    width = np.minimum(bits[a], bits[b])
    for w in np.unique(width):
        for pairs in np.array_split(np.flatnonzero(width == w), max(1, int((width == w).sum() << int(w)) >> 22)):
            used, place = np.unique(np.concatenate([a[pairs], b[pairs]]), return_inverse=True)
            points = np.stack([np.frombuffer(vectors[i], np.uint16).reshape(-1, 1 << w).sum(0, dtype=np.int32) for i in used])
            x, y = place[: len(pairs)], place[len(pairs) :]
            bound = np.minimum(points[x], points[y]).sum(1)
            found.append(pairs[bound * (100 + percent) >= percent * (sizes[a[pairs]] + sizes[b[pairs]])])
    kept = np.concatenate(found) if found else np.empty(0, np.int64)
    return a[kept], b[kept]


def linked(ids: np.ndarray, sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> np.ndarray:
    """For each set the least id that links reach; with side, only sets of different sides are compared."""
    tree = CountTree(np.array([len(s) for s in sets]), [count_vector(s) for s in sets])
    sets, ids = [sets[i] for i in tree.order], ids[tree.order]
    side = None if side is None else side[tree.order]
    roots = Roots(len(ids))
    for i in range(len(ids)):
        wanted = roots.of != roots.of[i]  # those that aren't linked to it already
        near = tree.after(i, percent, wanted if side is None else wanted & (side != side[i]))
        for at in range(0, len(near), 64):
            part = near[at : at + 64]
            part = part[roots.of[part] != roots.of[i]]
            if not len(part):
                continue
            flat, lengths = np.concatenate([sets[j] for j in part]), tree.sizes[part]
            place = np.minimum(np.searchsorted(sets[i], flat), len(sets[i]) - 1)
            common = np.add.reduceat((sets[i][place] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(lengths)[:-1]]))
            roots.join(i, part[100 * common >= percent * (lengths + len(sets[i]) - common)])
    out = np.empty(len(ids), np.int64)
    out[tree.order] = roots.least(ids)
    return out


def _shared(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, size and doc_id, the distinct ones whose key has another document of a size that can link.

    In the order of size it is enough to look at the neighbours.
    """
    keys = ids = sizes = np.empty(0, np.int64)
    shown = False  # whether the row that is carried over has been given out
    for batch in batches:
        keys, sizes, ids = (np.append(x, np.asarray(batch.column(c))) for c, x in enumerate((keys, sizes, ids)))
        if not len(keys):
            continue
        fresh = np.append(True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1]))
        carried = shown
        keys, ids, sizes = keys[fresh], ids[fresh], sizes[fresh]
        same = (keys[1:] == keys[:-1]) & (sizes[1:] * percent <= 100 * sizes[:-1])
        out = np.append(same, False) | np.append(False, same)
        last = bool(out[-1])
        if carried:
            last = last or len(keys) == 1
            out[0] = False
        yield pa.RecordBatch.from_arrays([pa.array(keys[out]), pa.array(ids[out])], names=["key", "doc_id"])
        keys, ids, sizes, shown = keys[-1:], ids[-1:], sizes[-1:], last


def _groups(batches: Iterator[pa.RecordBatch], columns: int, by: int) -> Iterator[list[tuple]]:
    """Runs of rows that agree in their first `by` columns."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in range(columns)), strict=True):
            if held and row[:by] != held[0][:by]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _pairs(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Batches of the pairs that differ."""
    out: list[tuple[int, int]] = []
    for ids, least in found:
        out += [(int(a), int(b)) for a, b in zip(ids, least, strict=True) if a != b]
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["a", "b"])
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["a", "b"])


def crowded(rows: DataFrame, most: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Of distinct rows (key, doc_id) those of keys with at most `most` documents, and the ties of all others to the least of their key."""
    large = rows.groupBy("key").agg(F.count("*").alias("times"), F.min("doc_id").alias("least")).filter(F.col("times") > most)
    large = scratch.keep(large.select("key", "least"))  # at most one row for each `most` rows
    return rows.join(large, "key", "left_anti"), rows.join(large, "key").select(F.col("doc_id").alias("a"), F.col("least").alias("b")).filter("a <> b")


def unlike(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Of distinct rows (key, doc_id) those under which several documents meet, of the least key for each set of documents.

    Keys with the same documents give the same ties, so one of them is enough; a key with one document gives none.  Sets
    are told apart by their number of documents, their least one and 128 bits of hashes.
    """
    mark = lambda *salt: F.bit_xor(F.xxhash64("doc_id", *salt))
    keys = rows.groupBy("key").agg(F.count("*").alias("times"), F.min("doc_id").alias("least"), mark().alias("m0"), mark(F.lit(1)).alias("m1"))
    keys = scratch.keep(keys.filter("times > 1").groupBy("times", "least", "m0", "m1").agg(F.min("key").alias("key")).select("key"))
    return rows.join(keys, "key", "left_semi")


def join(docs: DataFrame, k: int = 5, percent: int = 80, weight: int = WEIGHT, most: int = MOST) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    texts = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(k)
        for whole in batches:
            for batch in (whole.slice(at, 512) for at in range(0, whole.num_rows, 512)):
                sets = [shingles(t) for t in batch.column(1).to_pylist()]
                sigs = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), np.int64).reshape(-1, 2)
                keys = [part_digests(s, percent) for s in sets]
                vectors = pa.array([count_vector(s).tobytes() for s in sets], pa.binary())
                ends = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys), pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(sigs[:, 0]), pa.array(sigs[:, 1]), listed, vectors], names=["doc_id", "n", "s0", "s1", "keys", "vector"])

    dealt = scratch.keep(texts.mapInArrow(deal, "doc_id long, n long, s0 long, s1 long, keys array<long>, vector binary"))
    own = dealt.filter("n > 0 and doc_id is not null")
    least = own.groupBy("s0", "s1").agg(F.min("doc_id").alias("rep"))  # exact copies
    member = scratch.keep(own.select("doc_id", "s0", "s1").distinct().join(least, ["s0", "s1"]).select("doc_id", "rep"))
    rows = own.select(F.explode("keys").alias("key"), "n", "doc_id").repartition("key").sortWithinPartitions("key", "n", "doc_id")
    rows = rows.mapInArrow(lambda batches: _shared(batches, percent), "key long, doc_id long").join(member, "doc_id").select("key", F.col("rep").alias("doc_id")).distinct()
    shared = scratch.keep(rows)
    rows, hot = crowded(shared, most, scratch)
    rows = unlike(rows, scratch)
    rows = rows.join(own.select("doc_id", "n", "vector").dropDuplicates(["doc_id"]), "doc_id").select("key", "doc_id", "n", "vector").repartition("key").sortWithinPartitions("key", "doc_id")

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def run(keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray, vectors: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            counts = np.diff(np.append(begin, len(keys)))
            few = np.repeat((counts > 1) & (counts <= FEW), counts)
            where = np.flatnonzero(few)
            if len(where):
                x, y = tied_few(keys[where], sizes[where], [vectors[i] for i in where], percent)
                pairs = np.unique(np.stack([ids[where[x]], ids[where[y]]], 1), axis=0)
                yield pairs[:, 0], pairs[:, 1]
            for at, n in zip(begin[counts > FEW], counts[counts > FEW], strict=True):
                own = slice(at, at + n)
                least = tied(ids[own], sizes[own], [np.frombuffer(v, np.uint16) for v in vectors[own]], percent)
                yield ids[own], least

        def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            keys = ids = sizes = np.empty(0, np.int64)
            vectors: list[bytes] = []
            for batch in batches:
                keys, ids, sizes = (np.append(x, np.asarray(batch.column(c))) for c, x in enumerate((keys, ids, sizes)))
                vectors += batch.column(3).to_pylist()
                if len(keys) < 5_000:
                    continue
                cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
                if cut:
                    yield from run(keys[:cut], ids[:cut], sizes[:cut], vectors[:cut])
                    keys, ids, sizes, vectors = keys[cut:], ids[cut:], sizes[cut:], vectors[cut:]
            if len(keys):
                yield from run(keys, ids, sizes, vectors)

        return _pairs(found())

    ties = scratch.keep(rows.mapInArrow(tie, "a long, b long").unionAll(hot).distinct())
    scratch.drop(shared)
    near = scratch.keep(components(ties, scratch))
    scratch.drop(ties)

    near = near.join(own.select(F.col("doc_id").alias("node"), "n").distinct(), "node")
    starts = F.array(*[F.lit(int(x)).cast("long") for x in percent_bands(percent)])
    near = near.withColumn("band", F.size(F.filter(starts, lambda s: s <= F.col("n"))))
    bands = near.groupBy("component", "band").agg(F.sum("n").alias("w"))
    plan = bands.groupBy("component").agg(F.sum("w").alias("w"), F.map_from_entries(F.collect_list(F.struct("band", F.ceil(F.col("w") / weight).alias("parts")))).alias("parts"))  # a row for each connected set, an entry for each size band
    placed = near.join(plan, "component").withColumn("small", F.col("w") <= weight)
    part, n_of = F.expr("cast(pmod(xxhash64(node), parts[band]) as long)"), lambda d: F.coalesce(F.try_element_at("parts", F.col("band") + d), F.lit(0))
    name = lambda b, x, c, y: F.struct(b.alias("b0"), x.alias("p0"), c.alias("b1"), y.alias("p1"))
    over = lambda d: F.filter(F.sequence(F.lit(0).cast("long"), F.greatest(n_of(d) - 1, F.lit(0))), lambda t: t < n_of(d))
    band, p = F.col("band"), F.col("part")
    pairs = F.concat(
        F.transform(over(0), lambda t: name(band, F.least(p, t), band, F.greatest(p, t))),
        F.transform(over(1), lambda t: name(band, p, band + 1, t)),
        F.transform(over(-1), lambda t: name(band - 1, t, band, p)),
    )
    whole = F.array(name(F.lit(0), F.lit(0).cast("long"), F.lit(0), F.lit(0).cast("long")))
    placed = placed.withColumn("part", part).withColumn("task", F.explode(F.when(F.col("small"), whole).otherwise(pairs)))
    # two sides where the task is a pair of different blocks
    one_block = F.col("small") | ((F.col("task.b0") == F.col("task.b1")) & (F.col("task.p0") == F.col("task.p1")))
    side = F.when(one_block, -1).when((band == F.col("task.b0")) & (p == F.col("task.p0")), 0).otherwise(1)
    placed = placed.select("node", "component", "small", F.xxhash64("component", "task").alias("task"), side.alias("side"))

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(k)
        for whole in batches:
            for batch in (whole.slice(at, 256) for at in range(0, whole.num_rows, 256)):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(t).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], names=["node", "shingles"])

    needed = texts.join(near.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    sets = needed.mapInArrow(shingle, "node long, shingles binary")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for group in _groups(batches, 5, 2):
                ids, side = np.array([r[2] for r in group]), np.array([r[3] for r in group])
                yield ids, linked(ids, [np.frombuffer(r[4], np.uint64) for r in group], percent, None if side[0] < 0 else side)

        return _pairs(found())

    work = placed.join(sets, "node").select("component", "task", "node", "side", "shingles").repartition("task").sortWithinPartitions("component", "task", "node")
    links = scratch.keep(work.mapInArrow(verify, "a long, b long").distinct())
    final = scratch.keep(components(links, scratch))
    scratch.drop(links)
    out = dealt.select("doc_id", "n").join(member.distinct(), "doc_id", "left").join(final.withColumnRenamed("node", "rep"), "rep", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"))


def percent_bands(percent: int) -> list[int]:
    """Starts of size bands such that linked sets lie in the same or in neighbouring ones."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * 100 // percent + 1)
    return out


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents, whole rows, without those that a linked one with a smaller doc_id stands for."""
    gone = join(docs, k, percent).filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
