"""JSON texts: paths, typed reads, rowsets, membership, and edits that keep the rest of a document.

Reads, lengths, keys, types and rowsets are built-in functions.  Edits, containment and depth walk a parsed document and
run in Arrow batches; numbers keep their digits (fractions are decimals, not doubles).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from decimal import Decimal
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinwork.errors import Unsupported
from skeinwork.sources.catalog import ordinal_name

Step = str | int


def parse_path(path: str) -> list[Step]:
    """A path like $.a[0]."odd name" as keys and places."""
    if not path.startswith("$"):
        raise Unsupported(f"a path starts with $: {path!r}")
    steps: list[Step] = []
    i = 1
    while i < len(path):
        if path[i] == "." and path[i + 1 : i + 2] == '"':
            name, end = json.JSONDecoder().raw_decode(path, i + 1)
            steps.append(name)
            i = end
        elif path[i] == ".":
            end = i + 1
            while end < len(path) and path[end] not in ".[":
                end += 1
            if end == i + 1:
                raise Unsupported(f"a name is missing: {path!r}")
            steps.append(path[i + 1 : end])
            i = end
        elif path[i] == "[":
            end = path.find("]", i)
            inside = path[i + 1 : end].strip() if end > 0 else ""
            if not inside.isdigit():
                raise Unsupported(f"a place is a number: {path!r}")
            steps.append(int(inside))
            i = end + 1
        else:
            raise Unsupported(f"no path: {path!r}")
    return steps


def build_path(*steps: Step) -> str:
    """A path from keys and places; odd names are quoted."""
    return "$" + "".join(f"[{s}]" if isinstance(s, int) else f".{s}" if s.replace("_", "a").isalnum() and not s[0].isdigit() else "." + json.dumps(s, ensure_ascii=False) for s in steps)


def spark_path(path: str) -> str:
    """The same path for get_json_object."""
    return "$" + "".join(f"[{s}]" if isinstance(s, int) else f"['{s}']" for s in parse_path(path))


def value(doc: Column, path: str, kind: str = "string") -> Column:
    """A typed scalar at a path; JSON null gives null.  binary is base64 text, boolean is the text true or false."""
    raw = F.get_json_object(doc, spark_path(path))
    return F.unbase64(raw) if kind == "binary" else raw.cast(kind)


def document(doc: Column, path: str) -> Column:
    """The JSON text of a part."""
    return F.get_json_object(doc, spark_path(path))


def element(doc: Column, place: Column, kind: str = "string") -> Column:
    """An element of a JSON array at a place that a column gives; null outside."""
    return F.get(F.from_json(doc, f"array<{kind}>"), place)


def length(doc: Column) -> Column:
    """Elements of an array, keys of an object, 1 for a scalar."""
    return F.when(F.try_parse_json(doc).isNotNull(), F.coalesce(F.json_array_length(doc), F.size(F.json_object_keys(doc)), F.lit(1)))


def type_name(doc: Column) -> Column:
    """OBJECT, ARRAY, STRING, INTEGER, DOUBLE, BOOLEAN or NULL."""
    kind = F.schema_of_variant(F.try_parse_json(doc))
    out = F.when(kind.startswith("OBJECT"), "OBJECT").when(kind.startswith("ARRAY"), "ARRAY").when(kind == "STRING", "STRING")
    return out.when(kind == "BIGINT", "INTEGER").when(kind == "BOOLEAN", "BOOLEAN").when(kind == "VOID", "NULL").when(kind.isNotNull(), "DOUBLE")


def keys(doc: Column) -> Column:
    """The keys of an object as a JSON array."""
    return F.to_json(F.json_object_keys(doc))


def array(*items: Column) -> Column:
    """A JSON array of values of any types."""
    return F.concat(F.lit("["), F.concat_ws(",", *map(literal, items)), F.lit("]"))


def object_(**items: Column) -> Column:
    """A JSON object; null values are kept."""
    parts = [F.concat(F.lit(json.dumps(k) + ":"), literal(v)) for k, v in items.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def literal(v: Column) -> Column:
    """A scalar as JSON text, null as null."""
    wrapped = F.to_json(F.array(v))
    return F.coalesce(F.substring(wrapped, F.lit(2), F.length(wrapped) - 2), F.lit("null"))


def rowset(df: DataFrame, column: str, kind: str, name: str = "value", outer: bool = False) -> DataFrame:
    """A row for each element of a JSON array: its ordinal, from 1, and the value, or its fields where kind is a struct."""
    ordinal = ordinal_name([*df.columns, name])
    explode = F.posexplode_outer if outer else F.posexplode
    out = df.select("*", explode(F.from_json(F.col(column), f"array<{kind}>")).alias("_pos", name)).withColumn(ordinal, F.col("_pos") + 1).drop("_pos")
    return out.select(*[c for c in out.columns if c != name], f"{name}.*") if kind.startswith("struct") else out


def has_element(doc: Column, item: Column, kind: str) -> Column:
    """Membership of a value in a JSON array; null matches null."""
    return F.coalesce(F.exists(F.from_json(doc, f"array<{kind}>"), lambda e: e.eqNullSafe(item)), F.lit(False))


def count_where(doc: Column, kind: str, predicate: Callable[[Column], Column]) -> Column:
    """How many elements of a JSON array meet a predicate."""
    return F.size(F.filter(F.from_json(doc, f"array<{kind}>"), predicate))


# --- documents, parsed


# made once: json.loads and json.dumps make a new one for each call with options
_decode, _encode = json.JSONDecoder(parse_float=Decimal).decode, json.JSONEncoder(ensure_ascii=False).encode


def load(text: str) -> Any:
    return _decode(text)


def dump(x: Any) -> str:
    """Compact JSON text with the digits that were read."""
    if isinstance(x, dict):
        return "{" + ", ".join([f"{_encode(k)}: {dump(v)}" for k, v in x.items()]) + "}"
    if isinstance(x, list):
        return "[" + ", ".join(map(dump, x)) + "]"
    return str(x) if type(x) in (Decimal, int) else _encode(x)


def edit(doc: Any, steps: Sequence[Step], mode: str, new: Any = None) -> Any:
    """A document after set (insert or replace), replace (only what is there) or remove at a path."""
    if not steps:
        if mode == "remove":
            raise Unsupported("the whole document can't be removed")
        return new
    at, parent = steps[-1], doc
    for s in steps[:-1]:
        if isinstance(s, str) and isinstance(parent, dict) and s in parent:
            parent = parent[s]
        elif isinstance(s, int) and isinstance(parent, list) and s < len(parent):
            parent = parent[s]
        elif s == 0 and not isinstance(parent, list):
            continue  # a scalar or object is its own first element
        else:
            return doc
    if isinstance(at, str) and isinstance(parent, dict):
        if mode == "remove":
            parent.pop(at, None)
        elif mode == "set" or at in parent:
            parent[at] = new
    elif isinstance(at, int) and isinstance(parent, list):
        if at < len(parent):
            if mode == "remove":
                del parent[at]
            else:
                parent[at] = new
        elif mode == "set":
            parent.append(new)
    return doc


def contained(target: Any, candidate: Any) -> bool:
    """Whether a document holds another: objects by key, arrays element by element, a scalar in an array by value."""
    if isinstance(target, list):
        return all(any(contained(t, c) for t in target) for c in candidate) if isinstance(candidate, list) else any(contained(t, candidate) for t in target)
    if isinstance(target, dict):
        return isinstance(candidate, dict) and all(k in target and contained(target[k], v) for k, v in candidate.items())
    return not isinstance(candidate, (dict, list)) and type(target) in _like(candidate) and target == candidate


def _like(x: Any) -> tuple[type, ...]:
    return (bool,) if isinstance(x, bool) else (int, Decimal) if isinstance(x, (int, Decimal)) else (type(x),)


def depth(x: Any) -> int:
    """1 for scalars and empty containers."""
    inner = x.values() if isinstance(x, dict) else x if isinstance(x, list) else ()
    return 1 + max(map(depth, inner), default=0)


#: A change of a document: set, replace or remove, the path, and the new value (None for remove).
Change = tuple[str, str, Column | None]


def _fresh(x: Any) -> Any:
    """A copy whose containers are new."""
    return {k: _fresh(v) for k, v in x.items()} if isinstance(x, dict) else [_fresh(v) for v in x] if isinstance(x, list) else x


def edits(doc: Column, **versions: Sequence[Change]) -> Column:
    """A struct with a version of the document for each list of changes, made one after the other; each document is parsed once."""
    plans, values = [], [F.lit(None).cast("string")]
    for changes in versions.values():
        plan = []
        for mode, path, new in changes:
            plan.append((parse_path(path), mode, len(values) if new is not None else 0))
            if new is not None:
                values.append(literal(new))
        plans.append(plan)
    names = list(versions)

    @F.pandas_udf(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    def run(docs: pd.Series, news: pd.Series) -> pd.DataFrame:
        out: list[list[str | None]] = []
        known: dict[tuple, list[str | None]] = {}  # equal documents of a batch with equal values are edited once
        for text, given in zip(docs, news, strict=True):
            if text is None:
                out.append([None] * len(plans))
                continue
            if (row := known.get((text, *given))) is not None:
                out.append(row)
                continue
            parsed, row = load(text), []
            for k, plan in enumerate(plans):
                x = parsed if k == len(plans) - 1 else _fresh(parsed)
                for steps, mode, at in plan:
                    x = edit(x, steps, mode, load(given[at]) if at and given[at] is not None else None)
                row.append(dump(x))
            known[text, *given] = row
            out.append(row)
        return pd.DataFrame(out, columns=names, dtype=object)

    return run(doc, F.array(*values))


def _edited(doc: Column, *changes: Change) -> Column:
    return edits(doc, out=changes)["out"]


def set_value(doc: Column, path: str, new: Column) -> Column:
    return _edited(doc, ("set", path, new))


def replace_value(doc: Column, path: str, new: Column) -> Column:
    return _edited(doc, ("replace", path, new))


def remove_value(doc: Column, path: str) -> Column:
    return _edited(doc, ("remove", path, None))


def set_many(doc: Column, changes: dict[str, Column]) -> Column:
    """A partial update of several paths, one after the other."""
    return _edited(doc, *(("set", path, new) for path, new in changes.items()))


@F.pandas_udf(T.BooleanType())
def _contains(targets: pd.Series, candidates: pd.Series) -> pd.Series:
    return pd.Series([None if t is None or c is None else contained(load(t), load(c)) for t, c in zip(targets, candidates, strict=True)], dtype=object)


@F.pandas_udf(T.IntegerType())
def _depth(docs: pd.Series) -> pd.Series:
    return pd.Series([None if d is None else depth(load(d)) for d in docs], dtype="Int32")


def contains(target: Column, candidate: Column) -> Column:
    return _contains(target, candidate)


def doc_depth(doc: Column) -> Column:
    return _depth(doc)
