"""Removal of bytes that repeated strings of a fixed length cover, by prefix-free parsing.

Triggers.  A rolling hash runs over all windows of ``TRIGGER`` bytes of a text.  The window with the least hash (the
leftmost of equals) of each string of ``length`` bytes is a trigger.  Equal strings have their trigger at the same
place, every string has one, and phrases from trigger to trigger are never longer than the strings looked for.

Dictionary and parse.  What may surround a trigger inside such a string, its context, reaches ``length - TRIGGER`` bytes
to the left, where it ends a phrase, and ``length`` bytes to the right, where the parse goes on.  Equal contexts are one
dictionary entry; an entry that occurs twice is wholly repeated.  The other entries of a trigger that has several are
put into two orders: that of their reversed left parts (the order of phrase suffixes) and that of their right parts (the
suffix order of the parse, which is needed to the depth of ``length`` bytes only).  Common prefixes of neighbours in
both orders cut the entries into classes for every start; two entries in the same pair of classes hold the same string
at that start.  All strings of a trigger overlap, so what an entry loses is one range.  Orders are made for each trigger
on its own and not for the corpus at once, since only strings with equal triggers can be equal.

Scale.  Tables hold a row for each trigger, about one for 150 bytes, and texts only of entries that are compared.  The
counts are summed up before the shuffle, and the rows of crowded triggers and entries are dealt to many tasks.  The
entries of a trigger are put into order in one task as long as they are at most ``most``.  Those of a larger one are
compared by digests of 128 bits instead, on many tasks.  Its starts are dealt into runs; entries that share a string
with a start in a run share what all strings of the run have in common, and entries that share the whole that the run's
strings cover share each of them.  An entry loses the range between its outermost repeated strings, so a run is dealt
again, down to single starts, only where it may widen the range of one of the entries that have the same in common; of
entries with the same whole one stands for all there.

Defined results: matches do not cross documents; a null text is an empty one; a text shorter than ``length`` loses
nothing; each row is a document of its own, known by a digest of doc_id and text, so that rows that share a doc_id lose
what their own text repeats; rows with a null doc_id are returned, and take part like all others where ``null_ids`` is
set (as in the registered query); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.llm.common import Scratch, crowded_keys, join_spread, text_of

LENGTH, TRIGGER, MOST, CHUNK = 400, 100, 4096, 1 << 20
PARTS = 7  # of a run of starts of a crowded trigger; three times this make single starts of 301
_PLACE = 24  # bits of a place within a segment
_ALL = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_random = np.random.default_rng(7)
_BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []
_PARSED = {"k0": pa.int64(), "k1": pa.int32(), "place": pa.int32(), "a": pa.int64(), "c": pa.int64()}  # a row, and the digests of trigger and context
_WORK = {"a": pa.int64(), "c": pa.int64(), "before": pa.binary(), "after": pa.binary()}
_DIGEST = {"a": pa.int64(), "c": pa.int64(), "low": pa.int32(), "high": pa.int32(), **dict.fromkeys(("common0", "common1", "whole0", "whole1"), pa.int64())}
_RANGE = {"a": pa.int64(), "c": pa.int64(), "least": pa.int32(), "most": pa.int32()}
_CUT = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "spans": pa.list_(pa.list_(pa.int64()))}


def _schema(columns: dict[str, pa.DataType]) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}
    return ", ".join(f"{c} {names[t]}" for c, t in columns.items())


def _batch(values: Iterable, columns: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(values, columns.values(), strict=True)], names=list(columns))


def _slices(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        yield from (whole.slice(at, n) for at in range(0, whole.num_rows, n))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK + 4 * LENGTH)
        _powers[:] = [np.cumprod(np.full(size, b, np.uint64)) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _powers[0][:n], _powers[1][:n]


def rolling_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of width bytes."""
    up, down = _power(len(data))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * down)])
    h = (total[width:] - total[:-width]) * up[: len(data) - width + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of every run of width keys."""
    n = len(keys)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def triggers(texts: list[bytes], length: int = LENGTH, width: int = TRIGGER) -> list[list[int]]:
    """The places of the triggers of each text, ascending."""
    out: list[list[int]] = [[] for _ in texts]
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def run() -> None:
        whole = np.frombuffer(b"".join(part for _, _, part in held), np.uint8)
        keys = rolling_hashes(whole, width)
        keys = (keys >> np.uint64(_PLACE) << np.uint64(_PLACE)) | np.arange(len(keys), dtype=np.uint64)
        least = window_minima(keys, length - width + 1)
        at = 0
        for text, first, part in held:
            places = np.unique(least[at : at + len(part) - length + 1] & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
            places = (places - at + first).tolist()
            own = out[text]
            while places and own and places[0] <= own[-1]:
                places.pop(0)
            own += places
            at += len(part)

    for i, text in enumerate(texts):
        for first in range(0, max(len(text) - length + 1, 0), CHUNK):
            part = text[first : first + CHUNK + length - 1]
            held.append((i, first, part))
            size += len(part)
            if size >= CHUNK:
                run()
                held, size = [], 0
    if held:
        run()
    return out


def entries(text: bytes, places: list[int], length: int, width: int) -> Iterator[tuple[int, int, int]]:
    """place and the digests of trigger and context."""
    for p in places:
        yield p, xxhash.xxh3_64_intdigest(text[p : p + width]) - (1 << 63), xxhash.xxh3_64_intdigest(text[max(0, p - length + width) : p + length], min(p, length - width)) - (1 << 63)


def _neighbours(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows (bytes with 0 after the end) within groups, and the common prefix of each with the one before; -1 at a group's first."""
    flat = np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()
    order = np.argsort(flat, kind="stable")
    order = order[np.argsort(group[order], kind="stable")]
    x = rows[order]
    same = (x[1:] == x[:-1]) & (x[1:] > 0)
    common = np.where(same.all(1), rows.shape[1], np.argmin(same, axis=1))
    return order, np.concatenate([[-1], np.where(group[order][1:] == group[order][:-1], common, -1)])


def combine(group: np.ndarray, left: list[bytes], right: list[bytes], length: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the least and the largest left reach of its repeated strings; -1 where there is none.

    left holds the bytes before the trigger, right those from the trigger on.
    """
    n, reach = len(group), length - width

    def table(parts: list[bytes], columns: int) -> np.ndarray:
        out = np.zeros((n, columns), np.uint8)
        lengths = np.array([len(p) for p in parts])
        flat = np.frombuffer(b"".join(parts), np.uint8) + np.uint8(1)  # UTF-8 has no byte 255
        out[np.arange(columns) < lengths[:, None]] = flat
        return out

    (lo, lcp), (ro, rcp) = _neighbours(table([p[::-1] for p in left], reach), group), _neighbours(table(right, length), group)
    least, most = np.full(n, -1), np.full(n, -1)
    left_class, right_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for l in range(reach + 1):  # noqa: E741
        left_class[lo] = np.cumsum(lcp < l)
        right_class[ro] = np.cumsum(rcp < length - l)
        both = left_class * (n + 1) + right_class
        order = np.argsort(both, kind="stable")
        x = both[order]
        twice = np.zeros(n, bool)
        twice[1:] = x[1:] == x[:-1]
        twice[:-1] |= twice[1:]
        found = order[twice]
        least[found] = np.where(least[found] < 0, l, least[found])
        most[found] = l
    return least, most


def _compare(batches: Iterator[pa.RecordBatch], length: int, width: int) -> Iterator[pa.RecordBatch]:
    """Rows (trigger, entry, before, after), sorted by trigger, to rows (trigger, entry, least, most)."""
    held: list[tuple] = []

    def run(rows: list[tuple]) -> pa.RecordBatch:
        trigger, entry, left, right = zip(*rows, strict=True)
        trigger = np.array(trigger, np.int64)
        least, most = combine(np.cumsum(np.concatenate([[0], np.diff(trigger) != 0])), left, right, length, width)
        ok = most >= 0
        return _batch([trigger[ok], np.array(entry, np.int64)[ok], least[ok], most[ok]], _RANGE)

    for batch in batches:
        held += zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)
        if len(held) >= 10_000:
            last, cut = held[-1][0], len(held)
            while cut and held[cut - 1][0] == last:  # the last group may go on
                cut -= 1
            if cut:
                yield run(held[:cut])
                held = held[cut:]
    if held:
        yield run(held)


def _dealt(low: int, high: int) -> Iterator[tuple[int, int]]:
    """The starts from low to high in ``PARTS`` runs at most."""
    step = -(-(high - low + 1) // PARTS)
    return ((first, min(first + step - 1, high)) for first in range(low, high + 1, step))


def _digests(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (trigger, entry, before, after, runs of starts) to two digests for each part of a run: of what all its strings have in common, and of the whole that they cover."""
    for batch in _slices(batches, 256):
        rows = []
        for a, c, before, after, runs in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            n, text = len(before), before + after
            for low, high in (part for r in runs for part in _dealt(r["low"], r["high"])):
                if n < low or len(after) < length - high:
                    continue  # too near an end of its text for any of these starts
                seed = (a + (low * 1024 + high)) & _ALL
                common = xxhash.xxh3_128_intdigest(text[n - low : n + length - high], seed)
                reached = n >= high and len(after) >= length - low
                whole = xxhash.xxh3_128_intdigest(text[n - high : n + length - low] if reached else c.to_bytes(8, "big", signed=True) + b"cut", seed)
                rows.append((a, c, low, high, *((x - (1 << 63)) for key in (common, whole) for x in (key & _ALL, key >> 64))))
        yield _batch(zip(*rows, strict=True) if rows else [[]] * 8, _DIGEST)


def _repeated_hot(hot: DataFrame, length: int, reach: int, scratch: Scratch) -> DataFrame:
    """trigger, entry and the least and the largest left reach of repeated strings, by digests; all entries of the triggers are given."""
    todo, width, state = hot.withColumn("runs", F.array(F.struct(F.lit(0).alias("low"), F.lit(reach).alias("high")))), reach + 1, None
    while True:
        parts = scratch.keep(todo.mapInArrow(lambda batches: _digests(batches, length), _schema(_DIGEST)))
        # entries of the same whole hold the same strings all over the run, so one stands for all
        wholes = scratch.keep(parts.groupBy("a", "low", "high", "common0", "common1", "whole0", "whole1").agg(F.count("*").alias("n"), F.min("c").alias("c")))
        twice = wholes.filter("n > 1").select("whole0", F.col("whole1").alias("own"), "n")
        sure = join_spread(parts, twice, "whole0", crowded_keys(twice, "whole0", "n")).filter("whole1 = own").select("a", "c", F.col("low").alias("least"), F.col("high").alias("most"))
        if state is not None:
            sure = sure.unionAll(state)
        state = scratch.keep(sure.groupBy("a", "c").agg(F.min("least").alias("least"), F.max("most").alias("most")))
        scratch.drop(parts)
        width = -(-width // PARTS)
        if width == 1:
            return state
        # what lies between two strings that are repeated is lost anyhow; a class of one whole, or of entries that all know their outer ends, is done
        open_ = scratch.keep(wholes.join(state, ["a", "c"], "left").withColumn("needs", F.expr("n = 1 and (least is null or low < least or high > most)")).drop("least", "most", "n"))
        scratch.drop(wholes)
        classes = scratch.keep(open_.groupBy("common0", F.col("common1").alias("own")).agg(F.count("*").alias("kinds"), F.max("needs").alias("needs")).filter("kinds > 1 and needs").drop("needs"))
        runs = join_spread(open_, classes, "common0", crowded_keys(classes, "common0", "kinds")).filter("common1 = own")
        todo = hot.join(runs.groupBy("a", "c").agg(F.collect_list(F.struct("low", "high")).alias("runs")), ["a", "c"])


def removed(docs: DataFrame, length: int = LENGTH, width: int = TRIGGER, most: int = MOST, null_ids: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (start and end of the removed runs) of every document.

    null_ids tells whether rows with a null doc_id take part; without, they neither lose bytes nor make others lose any.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    reach = length - width
    texts = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    texts = texts.withColumns({"k0": F.xxhash64("doc_id", "text"), "k1": F.hash("text", F.octet_length("text"))})  # 96 bits that name a row; equal rows lose the same

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 256):
            data = [t.encode() for t in batch.column(2).to_pylist()]
            rows = [(k0, k1, *e) for k0, k1, text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), data, triggers(data, length, width), strict=True) for e in entries(text, places, length, width)]
            yield _batch(zip(*rows, strict=True) if rows else [[]] * 5, _PARSED)

    whole_texts = F.octet_length("text") >= length
    parsed = scratch.keep(texts.filter(whole_texts if null_ids else whole_texts & F.col("doc_id").isNotNull()).select("k0", "k1", "text").mapInArrow(parse, _schema(_PARSED)))
    # min_by takes all its values from one row
    dictionary = parsed.groupBy("a", "c").agg(F.count("*").alias("times"), F.min("k0").alias("k0"), F.min_by("k1", "k0").alias("k1"), F.min_by("place", "k0").alias("place"))
    # a trigger with a single entry that occurs once is of no interest; the others are few
    kinds = scratch.keep(dictionary.groupBy("a").agg(F.count("*").alias("kinds"), F.min("times").alias("fewest"), F.sum("times").alias("all")).filter("all > 1"))
    known = scratch.keep(join_spread(dictionary, kinds, "a", crowded_keys(kinds, "a", "kinds")))
    compared = known.filter("kinds > 1 and fewest = 1")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 256):
            rows = []
            for text, listed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = text.encode()
                rows += [(e["a"], e["c"], text[max(0, e["place"] - reach) : e["place"]], text[e["place"] : e["place"] + length], e["hot"]) for e in listed]
            yield _batch(zip(*rows, strict=True) if rows else [[]] * 5, {**_WORK, "hot": pa.bool_()})

    wanted = compared.groupBy("k0", "k1").agg(F.collect_list(F.struct("a", "c", "place", (F.col("kinds") > most).alias("hot"))).alias("listed"))  # an entry for each trigger of a document at most
    shown = texts.join(wanted, ["k0", "k1"]).select("text", "listed").mapInArrow(contexts, f"{_schema(_WORK)}, hot boolean")
    hot = None
    if not kinds.filter(f"kinds > {most} and fewest = 1").isEmpty():
        shown = scratch.keep(shown)
        hot = scratch.keep(shown.filter("hot").select(*_WORK).dropDuplicates(["a", "c"]))
    work = shown.filter("not hot").select(*_WORK).repartition("a").sortWithinPartitions("a", "c")
    partly = work.mapInArrow(lambda batches: _compare(batches, length, width), _schema(_RANGE))
    if hot is not None:
        partly = partly.unionAll(_repeated_hot(hot, length, reach, scratch))
    whole = F.lit(None).cast("int")
    lost = known.filter("times > 1").select("a", "c", whole.alias("least"), whole.alias("most")).unionAll(partly.join(known.filter("times = 1").select("a", "c"), ["a", "c"]).select("a", "c", "least", "most"))
    # entries are told apart by both digests; the rows of one are dealt out by that of the context
    lost = lost.withColumnRenamed("a", "own")
    ranges = join_spread(parsed, lost, "c", crowded_keys(known.filter("times > 1"), "c", "times")).filter("a = own")
    ranges = ranges.select("k0", "k1", F.coalesce(F.col("place") - F.col("most"), F.greatest(F.col("place") - reach, F.lit(0))).alias("low"), F.coalesce(F.col("place") - F.col("least"), "place").alias("last"))
    ranges = ranges.groupBy("k0", "k1").agg(F.collect_set(F.struct("low", (F.col("last") + length).alias("high"))).alias("ranges"))  # a range for each trigger of a document at most

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 256):
            rows = []
            for doc, text, found in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                text, spans = text.encode(), []
                for low, high in sorted((r["low"], min(r["high"], len(text))) for r in found or []):
                    if spans and low <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], high)
                    else:
                        spans.append([low, high])
                kept, at = hashlib.sha256(), 0
                for low, high in spans:
                    kept.update(text[at:low])
                    at = high
                kept.update(text[at:])
                rows.append((doc, len(text), sum(b - a for a, b in spans), len(spans), kept.hexdigest(), spans))
            yield _batch(zip(*rows, strict=True) if rows else [[]] * 6, _CUT)

    return texts.join(ranges, ["k0", "k1"], "left").select("doc_id", "text", "ranges").mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>")
