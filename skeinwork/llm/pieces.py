"""SentencePiece encoding and decoding with a merge-type vocabulary.

Encoding keeps an agenda of adjacent symbol pairs, ordered by score and then by place; the best pair is merged until no
pair of neighbours is in the vocabulary (a list of the ranks of neighbours for short words, a heap for long ones). What
is then no piece falls back to its UTF-8 bytes. No piece of the vocabularies accepted here has a word mark after another
character, so no merge reaches into the next word, and a word with the marks before it is encoded once and remembered.
Every word that is new in an Arrow batch is also given to the sentencepiece library, in one call for the batch; a
difference stops the query.

Defined results: a null text is an empty one, and an empty text has no ids; repeated rows are encoded each; an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.llm.common import text_of

MARK = "▁"
#: Words that are remembered in a worker; beyond that only those met again are.
WORDS_KEPT = 450_000
#: Symbols up to which the agenda is a list in the order of the places; that of longer words is a heap.
SHORT = 48
_NONE = 1 << 32  # more than any rank
_WORDS = re.compile(f"{MARK}+[^{MARK}]*")


class MergeVocabulary:
    """The pieces and scores of a model, with an agenda-based encoder and a decoder."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        self.pieces = [self.library.id_to_piece(i) for i in range(n)]
        self.numbers = [str(i) for i in range(n)]
        self.shown = [p.replace(MARK, " ") for p in self.pieces]
        special = [self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i) for i in range(n)]
        self.bytes = {i: int(self.pieces[i][3:5], 16) for i in range(n) if self.library.is_byte(i)}
        self.byte_id = {b: i for i, b in self.bytes.items()}
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        scores = {p: self.library.get_score(i) for p, i in self.ids.items()}
        place = {x: k for k, x in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {p: place[x] for p, x in scores.items()}
        self.pairs = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.merged: dict[str, list[int]] = {}
        self.unknown = self.library.unk_id()
        if any(MARK in p.lstrip(MARK) for p in self.ids) or self.library.normalize("a  ﬁ ") not in ("a  ﬁ ", f"{MARK}a{MARK}{MARK}ﬁ{MARK}"):
            raise ValueError("only vocabularies without marks inside pieces and without normalisation are supported")
        self.known: dict[str, str] = {}  # ids of words, without their first mark, joined by commas
        self.older: dict[str, str] = {}
        self.changed: dict[str, str] = {}  # words that decoding does not give back, and what it gives

    def merge(self, word: str) -> list[int]:
        """The ids of one word with its marks."""
        symbols = self.merge_short(word) if len(word) <= SHORT else self.merge_long(word)
        ids = self.ids
        out: list[int] = []
        for s in symbols:
            if s in ids:
                out.append(ids[s])
            elif self.byte_id:
                out += [self.byte_id[b] for b in s.encode()]
            else:
                out.append(self.unknown)
        return out

    def merge_short(self, word: str) -> list[str]:
        symbols, get = list(word), self.rank.get
        agenda = [get(pair, _NONE) for pair in map(add, word, word[1:])]
        while agenda and (best := min(agenda)) < _NONE:
            i = agenda.index(best)
            symbols[i] = joined = symbols[i] + symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = get(joined + symbols[i + 1], _NONE)
            if i:
                agenda[i - 1] = get(symbols[i - 1] + joined, _NONE)
        return symbols

    def merge_long(self, word: str) -> list[str]:
        symbols: list = list(word)
        rank = self.rank
        agenda = [rank[pair] << 32 | i for i, pair in enumerate(map(add, symbols, symbols[1:])) if pair in rank]
        if agenda:
            heapq.heapify(agenda)
            n = len(symbols)
            before, after = list(range(-1, n - 1)), [*range(1, n), -1]
            while agenda:
                top = heapq.heappop(agenda)
                left = top & 0xFFFFFFFF
                right = after[left]
                if right < 0 or (head := symbols[left]) is None or rank.get(joined := head + symbols[right]) != top >> 32:
                    continue
                symbols[left], symbols[right] = joined, None
                after[left] = far = after[right]
                if far >= 0:
                    before[far] = left
                    if (pair := joined + symbols[far]) in rank:
                        heapq.heappush(agenda, rank[pair] << 32 | left)
                if (near := before[left]) >= 0 and (pair := symbols[near] + joined) in rank:
                    heapq.heappush(agenda, rank[pair] << 32 | near)
        return [s for s in symbols if s is not None]

    def words(self, text: str) -> list[str]:
        """The text as words, each without the first of the marks before it; none for an empty text."""
        if not text:
            return []
        if "  " in text or MARK in text or text[0] == " ":
            return [w[1:] for w in _WORDS.findall(MARK + text.replace(" ", MARK))]
        return text.split(" ")

    def parts(self, word: str) -> list[str]:
        """The word cut wherever two neighbours stand together in no piece, so that no merge joins them."""
        if self.pairs.issuperset(map(add, word, word[1:])):
            return [word]
        cuts = [i for i, pair in enumerate(map(add, word, word[1:]), 1) if pair not in self.pairs]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)]

    def learn(self, words: set[str]) -> None:
        """Encodes new words, and checks them against the library."""
        new = list(words)
        theirs = self.library.encode([w.replace(MARK, " ") for w in new], num_threads=1)
        if len(self.merged) > WORDS_KEPT:
            self.merged.clear()
        merged = self.merged
        for word, there in zip(new, theirs, strict=True):
            found = []
            for part in self.parts(MARK + word):
                if (own := merged.get(part)) is None:
                    merged[part] = own = self.merge(part)
                found.append(own)
            ids = found[0] if len(found) == 1 else [i for own in found for i in own]
            if word and ids != there:
                raise ValueError(f"the library encodes {word!r} as {there}, not {ids}")
            self.known[word] = ",".join([self.numbers[i] for i in ids])
            shown = self.decode_pieces(ids)[1:]  # the first mark is a space
            if shown != word:
                self.changed[word] = shown

    def decode_pieces(self, ids: list[int]) -> str:
        """The text of ids, with marks as spaces; runs of byte pieces are read as UTF-8."""
        if self.bytes.keys().isdisjoint(ids):
            return "".join([self.shown[i] for i in ids])
        out, held = [], bytearray()
        for i in ids:
            if i in self.bytes:
                held.append(self.bytes[i])
                continue
            if held:
                out.append(held.decode(errors="replace"))
                held = bytearray()
            out.append(self.shown[i])
        if held:
            out.append(held.decode(errors="replace"))
        return "".join(out)

    def encode(self, text: str) -> list[int]:
        return [i for w in self.words(text) for i in self.merge(MARK + w)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space that encoding puts first is taken off."""
        return self.decode_pieces(ids).removeprefix(" ")


_vocabularies: dict[str, MergeVocabulary] = {}


def vocabulary(path: str) -> MergeVocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = MergeVocabulary(path)
    return _vocabularies[path]


def encode_documents(docs: DataFrame, model_path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document; with_ids adds ids and decoded."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] + ([("ids", pa.list_(pa.int32())), ("decoded", pa.string())] if with_ids else []))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model_path)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = [v.words(t) for t in batch.column(1).to_pylist()]
                if len(v.known) > WORDS_KEPT:
                    v.known, v.older = {}, v.known
                    v.changed = {w: x for w, x in v.changed.items() if w in v.older}
                known = v.known
                new = set().union(*texts).difference(known)
                if v.older:
                    known.update((w, v.older[w]) for w in new.intersection(v.older))
                    new = new.difference(known)
                if new:
                    v.learn(new)
                rows = []
                for doc, words in zip(batch.column(0).to_pylist(), texts, strict=True):
                    ids = ",".join(map(known.__getitem__, words))
                    decoded = " ".join(words if v.changed.keys().isdisjoint(words) else [v.changed.get(w, w) for w in words])
                    n = ids.count(",") + 1 if words else 0
                    row = (doc, n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
                    rows.append((*row, [int(i) for i in ids.split(",") if i], decoded) if with_ids else row)
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(encode, ddl)
