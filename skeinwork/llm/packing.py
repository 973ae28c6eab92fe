"""Best-fit packing of token pieces into sequences of a fixed capacity.

Best-fit decreasing looks only at lengths, and pieces of one length may stand for each other.  So the plan is made on
the histogram of lengths, which has at most ``capacity`` rows however large the corpus is.  A segment tree over the
remaining capacities finds the tightest open bins in logarithmic time; bins with the same capacity left are kept as
runs of consecutive sequence numbers, and a run is filled with equal pieces in one step.  Every step that does not
finish a length uses up a whole run and leaves less than half of its room, so a plan for capacity C has
O(C log C) steps, whatever the number of pieces.

The pieces then find their places in parallel.  Each gets its rank among the pieces of its length; a length with many
pieces is split into salted parts, whose counts are summed beforehand, so no part exceeds ``part_rows`` by much.

Defined results: a null text is an empty one; an empty document is one piece that holds only the end id; texts longer
than a sequence are cut, others are never cut; repeated rows are packed as often as they occur; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skeinwork.llm.common import Scratch, text_of

CAPACITY = 2048
PART_ROWS = 20_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

#: Words whose ids are remembered in a worker; beyond that only those met again are.
WORDS_KEPT = 400_000
#: Characters of the texts that are split together; a longer text is split alone.
CHUNK = 1 << 20
#: Control characters that str.split() takes for white space and the tokenizer does not (and one that depends on its Unicode version).
_NOT_SPACE = re.compile("[\x1c-\x1f᠎]")
_LATIN = [chr(b) for b in range(256)]
#: Bytes of Latin-1 in lower case, with white space as a space.
_LOWER = "".join(" " if c in "\t\n\v\f\r\x85\xa0" else c.lower() for c in _LATIN).encode("latin-1")
_LETTER = np.array([c.isalpha() for c in _LATIN])


class CapacityTree:
    """Which remaining capacities have open bins: a segment tree of counts over 0..capacity."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, bins: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += bins
            at >>= 1

    def tightest(self, length: int) -> int | None:
        """The least capacity of at least length that has an open bin."""
        at = length + self.leaves
        if self.count[at]:
            return length
        while at > 1:
            if not at & 1 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


@dataclass
class Step:
    """Pieces first..first+pieces-1 of a length go, per_bin at a time, to sequences from sequence on, at offset base."""

    length: int
    first: int
    pieces: int
    per_bin: int
    sequence: int
    base: int


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Step]:
    """Best-fit decreasing over a histogram of lengths."""
    tree, runs, steps, opened = CapacityTree(capacity), {}, [], 0

    def leave(room: int, sequence: int, bins: int, front: bool = False) -> None:
        if room and bins:
            held = runs.setdefault(room, deque())
            held.appendleft((sequence, bins)) if front else held.append((sequence, bins))
            tree.add(room, bins)

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} does not fit into {capacity}")
        first, todo = 0, histogram[length]
        while todo:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                sequence, bins = opened, -(-todo // (capacity // length))
                opened += bins
            else:
                sequence, bins = runs[room].popleft()
                tree.add(room, -bins)
            per_bin = room // length
            full = min(bins, todo // per_bin)
            for used, each in ((full, per_bin), (1, todo - full * per_bin if full < bins else 0)):
                if used and each:
                    steps.append(Step(length, first, used * each, each, sequence, capacity - room))
                    leave(room - each * length, sequence, used)
                    first, todo, sequence, bins = first + used * each, todo - used * each, sequence + used, bins - used
                    if not todo:
                        break
            leave(room, sequence, bins, front=True)
    return steps


def pack(pieces: DataFrame, scratch: Scratch, capacity: int = CAPACITY, part_rows: int = PART_ROWS) -> DataFrame:
    """Adds sequence_id and offset to pieces (a written table with a column length and a key doc_id, piece)."""
    spark = pieces.sparkSession
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most capacity rows
    steps = packing_plan(histogram, capacity)
    parts = spark.createDataFrame([(n, -(-c // part_rows)) for n, c in histogram.items()], "length long, __parts long")
    salted = pieces.join(F.broadcast(parts), "length").withColumn("__part", F.expr("pmod(xxhash64(doc_id, piece, start), __parts)"))  # parts: a row for each length
    before = salted.groupBy("length", "__part").count()
    before = before.select("length", "__part", (F.sum("count").over(Window.partitionBy("length").orderBy("__part")) - F.col("count")).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("length", "__part").orderBy("doc_id", "piece")) - 1
    ranked = salted.withColumn("__rank", rank).join(before, ["length", "__part"]).withColumn("__rank", F.col("__rank") + F.col("__before"))

    table = np.array([(s.length, s.first, s.per_bin, s.sequence, s.base) for s in steps] or np.zeros((0, 5)), dtype=np.int64)
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = np.int64(1) << 44
        keys = table[:, 0] * wide + table[:, 1]
        order = np.argsort(keys)
        keys, rows = keys[order], table[order]
        for batch in batches:
            length, rank = (np.asarray(batch.column(n)) for n in ("length", "__rank"))
            step = rows[np.searchsorted(keys, length * wide + rank, side="right") - 1] if len(rank) else np.zeros((0, 5), np.int64)
            k = rank - step[:, 1]
            sequence, offset = step[:, 3] + k // np.maximum(step[:, 2], 1), step[:, 4] + k % np.maximum(step[:, 2], 1) * length
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.select(*names, "__rank").mapInArrow(place, f"{schema}, sequence_id long, offset long")


class WordIds:
    """Ids of whole texts, looked up by words between white space.

    The tokenizer turns every run of white space into one space, drops it when it splits a text, and has no rule that
    looks across it.  So a text's ids are those of its words, and a word is encoded once.  Texts of Latin-1, which no
    normal form changes, are put into lower case and cut after every run of letters, where a token sequence ends in any
    case; so a run of letters is one word whatever its case and the marks after it.  Such a run ends in the only id with
    a word end, so that many are encoded as one text, by the model alone.  The words of other texts are texts as well.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.wide: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn_runs(self, runs: list[bytes]) -> None:
        """Encodes runs of lower-case letters as one text."""
        ids = np.array(self.plain.encode_batch_fast([b" ".join(runs).decode("latin-1")], add_special_tokens=False)[0].ids, "<u4")
        after = (np.flatnonzero(self.ends[ids]) + 1) * 4
        whole, begin = ids.tobytes(), 0
        for run, end in zip(runs, after.tolist(), strict=True):
            self.known[run] = whole[begin:end]
            begin = end

    def learn(self, words: set[bytes]) -> None:
        """Puts words into the table; one that begins with a letter holds nothing else."""
        known, older = self.known, self.older
        if older:
            met = [w for w in words if w in older]
            known.update(zip(met, map(older.__getitem__, met), strict=True))
            words = words.difference(met)
        runs, others = [], []
        for word in words:
            (runs if _LETTER[word[0]] else others).append(word)
        if runs:
            self.learn_runs(runs)
        if others:
            known.update(zip(others, self.encode([w.decode("latin-1") for w in others]), strict=True))

    def latin(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of texts of Latin-1."""
        whole = b"\n".join(texts)
        data = np.frombuffer(whole.translate(_LOWER), np.uint8)
        letter = _LETTER[data]
        cuts = np.flatnonzero(letter[:-1] & ~letter[1:] & (data[1:] != 32)) + 1
        whole = np.insert(data, cuts, 32).tobytes()
        first = np.cumsum([0, *(len(t) + 1 for t in texts)])
        first = (first + np.searchsorted(cuts, first)).tolist()
        words, ends = [], [0]
        for a, b in zip(first, first[1:], strict=False):
            words += whole[a:b].split()
            ends.append(len(words))
        if len(self.known) > WORDS_KEPT:
            self.known, self.older = {}, self.known
        known = self.known
        ids = list(map(known.get, words))
        if new := [i for i, x in enumerate(ids) if x is None]:
            self.learn({words[i] for i in new})
            for i in new:
                ids[i] = known[words[i]]
        yield from (b"".join(ids[a:b]) for a, b in zip(ends, ends[1:], strict=False))

    def learn_wide(self, words: set[str]) -> None:
        narrow, others = [], []
        for word in words:
            try:
                narrow.append((word, word.encode("latin-1")))
            except UnicodeEncodeError:
                others.append(word)
        self.wide.update(zip((w for w, _ in narrow), self.latin([x for _, x in narrow]), strict=True))
        self.wide.update(zip(others, self.encode(others), strict=True))

    def part(self, texts: list[str]) -> Iterator[bytes]:
        narrow: list[bytes] = []
        split: list[list[str] | str | None] = []  # words, a text as it is, or None for one of Latin-1
        for text in texts:
            if any(s in text for s in self.specials):
                split.append(text)
                continue
            try:
                narrow.append(text.encode("latin-1"))
                split.append(None)
            except UnicodeEncodeError:
                split.append(text if _NOT_SPACE.search(text) else text.split())
        if len(self.wide) > WORDS_KEPT:
            self.wide.clear()
        new = set().union(*(x for x in split if isinstance(x, list))).difference(self.wide)
        if new:
            self.learn_wide(new)
        found = self.latin(narrow) if narrow else iter(())
        for x in split:
            yield next(found) if x is None else self.encode([x])[0] if isinstance(x, str) else b"".join(map(self.wide.__getitem__, x))

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        held, size = [], 0
        for text in texts:
            if held and size + len(text) > CHUNK:
                yield from self.part(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        if held:
            yield from self.part(held)


_encoders: dict[str, WordIds] = {}


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """A row for each piece of at most capacity ids of every document, the end id included."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.setdefault(tokenizer_path, None) or _encoders.update({tokenizer_path: WordIds(tokenizer_path)}) or _encoders[tokenizer_path]
        end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            rows: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder(batch.column(1).to_pylist()), strict=True):
                ids += end
                rows += [(doc, k, at // 4, len(part := ids[at : at + step]) // 4, zlib.crc32(part)) for k, at in enumerate(range(0, len(ids), step))]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(cut, PIECES)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Packs documents (doc_id, text) into as few sequences as best-fit decreasing finds."""
    scratch = Scratch(docs.sparkSession, "packing")
    return pack(scratch.keep(token_pieces(docs, tokenizer_path, capacity)), scratch, capacity)
