"""Planar shapes, and their WKB and WKT forms.  Shapes have X and Y only.

A shape is a kind and its parts: a point has a pair of numbers (or none, when empty), a line a list of points, a polygon
a list of closed rings of which the first is the outer one, and the other kinds a list of shapes.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass
from typing import Any

from skeinwork.errors import Unsupported

# The WKB codes of the kinds, and their OGC names.
KINDS = {1: "POINT", 2: "LINESTRING", 3: "POLYGON", 4: "MULTIPOINT", 5: "MULTILINESTRING", 6: "MULTIPOLYGON", 7: "GEOMETRYCOLLECTION"}
OGC = {"POINT": "Point", "LINESTRING": "LineString", "POLYGON": "Polygon", "MULTIPOINT": "MultiPoint", "MULTILINESTRING": "MultiLineString", "MULTIPOLYGON": "MultiPolygon", "GEOMETRYCOLLECTION": "GeometryCollection"}
CODES = {v: k for k, v in KINDS.items()}
DEEPEST = 256


@dataclass(frozen=True)
class Shape:
    kind: str
    parts: Any

    @property
    def leaves(self) -> list[Shape]:
        """The points, lines and polygons it is made of."""
        return [self] if self.kind in ("POINT", "LINESTRING", "POLYGON") else [x for p in self.parts for x in p.leaves]

    @property
    def points(self) -> list[tuple[float, float]]:
        out: list[tuple[float, float]] = []
        for leaf in self.leaves:
            if leaf.kind == "POINT":
                out += [leaf.parts] if leaf.parts else []
            elif leaf.kind == "LINESTRING":
                out += leaf.parts
            else:
                out += [p for ring in leaf.parts for p in ring]
        return out

    @property
    def empty(self) -> bool:
        return not self.points

    @property
    def dimension(self) -> int:
        """-1 when empty."""
        return max(({"POINT": 0, "LINESTRING": 1, "POLYGON": 2}[x.kind] for x in self.leaves if x.parts), default=-1)


def point(x: float, y: float) -> Shape:
    return Shape("POINT", (float(x), float(y)))


def collect(shapes: list[Shape], kind: str | None = None) -> Shape:
    """Shapes as one: of the multiple kind if they are of one kind, else a collection."""
    kinds = {s.kind for s in shapes}
    if kind is None:
        kind = f"MULTI{kinds.pop()}" if len(kinds) == 1 and kinds <= {"POINT", "LINESTRING", "POLYGON"} else "GEOMETRYCOLLECTION"
    return Shape(kind, list(shapes))


def from_wkb(data: bytes, prefixed: bool = False) -> Shape:
    """Reads WKB, with four bytes of SRID before it if prefixed."""
    at = 4 if prefixed else 0

    def read(depth: int) -> Shape:
        nonlocal at
        if depth > DEEPEST:
            raise Unsupported(f"shapes are nested deeper than {DEEPEST}")
        order = "<" if data[at] else ">"
        (code,) = struct.unpack_from(f"{order}I", data, at + 1)
        at += 5
        if code & 0x20000000:
            at, code = at + 4, code & ~0x20000000
        if code not in KINDS:
            raise Unsupported(f"shapes with Z or M, or of code {code}")

        def count() -> int:
            nonlocal at
            at += 4
            return struct.unpack_from(f"{order}I", data, at - 4)[0]

        def pairs(n: int) -> list[tuple[float, float]]:
            nonlocal at
            flat = struct.unpack_from(f"{order}{2 * n}d", data, at)
            at += 16 * n
            return list(zip(flat[::2], flat[1::2], strict=True))

        kind = KINDS[code]
        if kind == "POINT":
            (p,) = pairs(1)
            return Shape(kind, None if p[0] != p[0] else p)
        if kind == "LINESTRING":
            return Shape(kind, pairs(count()))
        if kind == "POLYGON":
            return Shape(kind, [pairs(count()) for _ in range(count())])
        return Shape(kind, [read(depth + 1) for _ in range(count())])

    return read(1)


def to_wkb(s: Shape) -> bytes:
    head = struct.pack("<BI", 1, CODES[s.kind])
    line = lambda ps: struct.pack(f"<I{2 * len(ps)}d", len(ps), *(v for p in ps for v in p))
    if s.kind == "POINT":
        return head + struct.pack("<2d", *(s.parts or (float("nan"),) * 2))
    if s.kind == "LINESTRING":
        return head + line(s.parts)
    return head + struct.pack("<I", len(s.parts)) + b"".join(map(line if s.kind == "POLYGON" else to_wkb, s.parts))


def _number(v: float) -> str:
    return repr(int(v)) if v == int(v) and abs(v) < 1e15 else repr(v)


def to_wkt(s: Shape) -> str:
    return s.kind + _wkt_body(s)


def _wkt_body(s: Shape) -> str:
    pair = lambda p: f"{_number(p[0])} {_number(p[1])}"
    line = lambda ps: "(" + ",".join(map(pair, ps)) + ")"
    if not s.parts:
        return " EMPTY"
    if s.kind == "POINT":
        return f"({pair(s.parts)})"
    if s.kind == "LINESTRING":
        return line(s.parts)
    if s.kind == "POLYGON":
        return "(" + ",".join(map(line, s.parts)) + ")"
    return "(" + ",".join(map(to_wkt if s.kind == "GEOMETRYCOLLECTION" else _wkt_body, s.parts)) + ")"


def from_wkt(text: str) -> Shape:
    tokens = re.findall(r"[A-Za-z]+|[(),]|[-+0-9.eE]+", text)

    def listed(read) -> list:
        if tokens[0].upper() == "EMPTY":
            tokens.pop(0)
            return []
        out = []
        tokens.pop(0)
        while True:
            out.append(read())
            if tokens.pop(0) == ")":
                return out

    def pair() -> tuple[float, float]:
        return float(tokens.pop(0)), float(tokens.pop(0))

    def body(kind: str) -> Shape:
        if kind == "POINT":
            found = listed(pair)
            return Shape(kind, found[0] if found else None)
        if kind == "LINESTRING":
            return Shape(kind, listed(pair))
        if kind == "POLYGON":
            return Shape(kind, listed(lambda: listed(pair)))
        if kind == "GEOMETRYCOLLECTION":
            return Shape(kind, listed(lambda: body(tokens.pop(0).upper())))
        if kind == "MULTIPOINT":
            return Shape(kind, listed(lambda: body("POINT") if tokens[0] in ("(", "EMPTY") else Shape("POINT", pair())))
        if kind in CODES:
            return Shape(kind, listed(lambda: body(kind[5:])))
        raise Unsupported(f"no shape: {text[:40]!r}")

    return body(tokens.pop(0).upper())
