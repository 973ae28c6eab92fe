"""Text functions.  Positions count from 0, as in the query vocabulary; a null argument gives null unless said otherwise."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def length(x: Column) -> Column:
    return F.char_length(x)


def is_null_or_empty(x: Column) -> Column:
    return x.isNull() | (x == "")


def is_null_or_blank(x: Column) -> Column:
    """Null, empty or spaces only; a tab is no space."""
    return x.isNull() | (F.trim(x) == "")


def contains(x: Column, part: Column) -> Column:
    return F.contains(x, part)


def starts_with(x: Column, part: Column) -> Column:
    """False, not null, where an argument is null."""
    return F.coalesce(F.startswith(x, part), F.lit(False))


def ends_with(x: Column, part: Column) -> Column:
    """False, not null, where an argument is null."""
    return F.coalesce(F.endswith(x, part), F.lit(False))


def equals(x: Column, y: Column) -> Column:
    return x == y


def substring(x: Column, start: Column | int, count: Column | int | None = None) -> Column:
    start = start if isinstance(start, Column) else F.lit(start)
    return F.substring(x, start + 1, count if isinstance(count, Column) else F.lit(2147483647 if count is None else count))


def replace(x: Column, old: Column, new: Column) -> Column:
    return F.replace(x, old, new)


def upper(x: Column) -> Column:
    return F.upper(x)


def lower(x: Column) -> Column:
    return F.lower(x)


def trim(x: Column, chars: str = " ") -> Column:
    """Takes the characters off both ends; an empty set stands for spaces."""
    return F.btrim(x, F.lit(chars or " "))


def trim_start(x: Column, chars: str = " ") -> Column:
    return F.ltrim(x, F.lit(chars or " "))


def trim_end(x: Column, chars: str = " ") -> Column:
    return F.rtrim(x, F.lit(chars or " "))


def index_of(x: Column, part: Column, start: Column | int = 0) -> Column:
    """The place of the first match at or after start, or -1."""
    start = start if isinstance(start, Column) else F.lit(start)
    return F.call_function("locate", part, x, start + 1) - 1


def pad_left(x: Column, width: int, char: str = " ") -> Column:
    """Padded to the width; longer texts are cut to it."""
    return F.lpad(x, width, char)


def pad_right(x: Column, width: int, char: str = " ") -> Column:
    return F.rpad(x, width, char)


def concat(*parts: Column) -> Column:
    """Null if a part is null."""
    return F.concat(*parts)


def plus(*parts: Column) -> Column:
    """The + of texts: null parts count as empty."""
    return F.concat(*(F.coalesce(p, F.lit("")) for p in parts))


def first_char(x: Column) -> Column:
    return F.substring(x, 1, 1)


def last_char(x: Column) -> Column:
    return F.right(x, F.lit(1))


def join(separator: str, *parts: Column) -> Column:
    """Parts with a separator between them; null parts are empty ones."""
    return F.concat_ws(separator, *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))


def matches(x: Column, pattern: Column, ignore_case: bool = False) -> Column:
    """Whether a pattern matches somewhere; an empty pattern always does."""
    return F.when(pattern == "", x.isNotNull()).otherwise(F.regexp_like(x, F.concat(F.lit("(?i)"), pattern) if ignore_case else pattern))


def bool_text(x: Column) -> Column:
    """True, False or, for null, empty."""
    return F.when(x, "True").when(~x, "False").otherwise("")


def to_text(x: Column) -> Column:
    """The value as text, null as empty."""
    return F.coalesce(x.cast("string"), F.lit(""))


_TYPES = {"boolean": "boolean", "byte": "smallint", "decimal": "decimal(38,18)", "double": "double", "int16": "smallint", "int32": "int", "int64": "bigint", "string": "string"}


def convert(x: Column, target: str) -> Column:
    """A conversion by the name of its target: boolean, byte, decimal, double, int16, int32, int64 or string."""
    return x.cast(_TYPES[target])


# --- bytes


def byte_length(b: Column) -> Column:
    return F.octet_length(b)


def byte_at(b: Column, i: Column | int) -> Column:
    """The byte at a place as a number from 0 to 255; null outside."""
    i = i if isinstance(i, Column) else F.lit(i)
    return F.conv(F.nullif(F.hex(F.substring(b, i + 1, F.lit(1))), F.lit("")), 16, 10).cast("int")


def bytes_contain(b: Column, value: Column) -> Column:
    """Whether a byte, given as a number, is in the bytes."""
    return F.call_function("instr", b, F.unhex(F.lpad(F.hex(value.cast("long")), 2, "0"))) > 0


def bytes_equal(a: Column, b: Column) -> Column:
    return a == b


# --- GUIDs, as 16 bytes in the order of their text


def new_guid() -> Column:
    return F.unhex(F.replace(F.uuid(), F.lit("-"), F.lit("")))


def guid_from_text(x: Column) -> Column:
    return F.unhex(F.replace(x, F.lit("-"), F.lit("")))


def guid_text(b: Column) -> Column:
    """Lower-case canonical text; null for null."""
    h = F.lower(F.hex(b))
    return F.concat(F.substring(h, 1, 8), *(p for a, n in ((9, 4), (13, 4), (17, 4), (21, 12)) for p in (F.lit("-"), F.substring(h, a, n))))


# --- full text


def terms(x: Column) -> Column:
    """The distinct words of a text, in lower case."""
    return F.array_distinct(F.filter(F.split(F.lower(x), r"[^\p{L}\p{N}_]+"), lambda w: w != ""))


def match_natural(x: Column, query: str) -> Column:
    """Whether a text has any word of the query.  There is no index here and thus no relevance and no list of stop words."""
    wanted = F.filter(F.split(F.lower(F.lit(query)), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
    return F.arrays_overlap(terms(x), wanted)


def parse_boolean(query: str) -> list[tuple[str, str, bool, bool]]:
    """A boolean-mode query as (sign, text, whether a phrase, whether a prefix); signs are +, - and nothing."""
    out, i = [], 0
    while i < len(query):
        if query[i].isspace() or query[i] in "()<>~@":
            i += 1
            continue
        sign = query[i] if query[i] in "+-" else ""
        i += len(sign)
        if i < len(query) and query[i] == '"':
            end = query.find('"', i + 1)
            end = len(query) if end < 0 else end
            text, i, phrase = query[i + 1 : end], end + 1, True
        else:
            end = i
            while end < len(query) and not query[end].isspace():
                end += 1
            text, i, phrase = query[i:end], end, False
        prefix = text.endswith("*") and not phrase
        text = text.rstrip("*").lower()
        if text:
            out.append((sign, text, phrase, prefix))
    return out


def _has_prefix(prefix: str) -> Callable[[Column], Column]:
    return lambda word: F.startswith(word, F.lit(prefix))


def match_boolean(x: Column, query: str) -> Column:
    """Whether a text meets a boolean-mode query: +required, -excluded, others optional, "phrases" and prefix*.

    Without a required part one of the optional parts must be there.
    """
    parts = parse_boolean(query)
    some = any(sign == "+" for sign, *_ in parts)
    lower = F.lower(x)
    # a text that lacks a required word or a phrase's first one altogether is not cut into words
    likely = F.lit(True)
    for sign, text, phrase, _ in parts:
        if sign == "+" and (first := re.search(r"\w+", text) if phrase else re.fullmatch(r"\w+", text)):
            likely = likely & F.contains(lower, F.lit(first[0]))
    # one-element arrays hold the words, so that they are made once
    found = F.transform(F.array(F.filter(F.split(lower, r"[^\p{L}\p{N}_]+"), lambda w: w != "")), lambda w: _meets(w, parts, some))
    return F.when(x.isNotNull(), likely & F.element_at(found, 1))


def _meets(words: Column, parts: list[tuple[str, str, bool, bool]], some: bool) -> Column:
    """Whether the words of a text, in their order, meet the parts of a query; some tells whether any part is required."""
    flat = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    required, optional, excluded = F.lit(True), F.lit(False), F.lit(False)
    for sign, text, phrase, prefix in parts:
        if phrase:
            met = F.contains(flat, F.concat(F.lit(" "), F.array_join(F.filter(F.split(F.lit(text), r"[^\p{L}\p{N}_]+"), lambda w: w != ""), " "), F.lit(" ")))
        elif prefix:
            met = F.exists(words, _has_prefix(text))
        else:
            met = F.array_contains(words, F.lit(text))
        if sign == "+":
            required = required & met
        elif sign == "-":
            excluded = excluded | met
        else:
            optional = optional | met
    return (required if some else optional) & ~excluded

