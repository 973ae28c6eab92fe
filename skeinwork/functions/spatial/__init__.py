"""Spatial functions over columns of WKB.  They are planar, and a null argument gives null.

Distances on the sphere and tests of bounding boxes are plain Column arithmetic; what needs the shape itself runs in
Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinwork.errors import Unsupported
from skeinwork.functions.spatial import measures, overlay, relations
from skeinwork.functions.spatial.shapes import OGC, Shape, collect, from_wkb, from_wkt, point, to_wkb, to_wkt

#: The mean radius of the Earth in metres that the spherical distance uses.
RADIUS = 6370986.0


def _run(result: T.DataType, f: Callable[..., Any], *args: Column) -> Column:
    """A function of shapes (binary arguments) and values as a column; shapes among the results become WKB."""

    @F.pandas_udf(result)
    def run(*columns: pd.Series) -> pd.Series:
        out = []
        for row in zip(*columns, strict=True):
            if any(v is None or isinstance(v, float) and v != v for v in row):
                out.append(None)
                continue
            found = f(*(from_wkb(bytes(v)) if isinstance(v, (bytes, bytearray, memoryview)) else v for v in row))
            out.append(to_wkb(found) if isinstance(found, Shape) else found)
        return pd.Series(out, dtype=object)

    return run(*args)


_SHAPE, _TRUTH, _REAL, _COUNT, _TEXT = T.BinaryType(), T.BooleanType(), T.DoubleType(), T.IntegerType(), T.StringType()


# --- making and showing


def make_point(x: Column, y: Column) -> Column:
    """WKB of a point."""
    return _run(_SHAPE, point, x.cast("double"), y.cast("double"))


def from_text(wkt: Column) -> Column:
    return _run(_SHAPE, from_wkt, wkt)


def as_text(g: Column) -> Column:
    return _run(_TEXT, to_wkt, g)


def as_binary(g: Column) -> Column:
    return g


def split_srid(g: Column) -> tuple[Column, Column]:
    """The SRID and the WKB of a value with four bytes of SRID, little endian, before it."""
    turned = F.reverse(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.hex(F.substring(g, i, F.lit(1)))))
    return F.conv(F.array_join(turned, ""), 16, 10).cast("int"), F.substring(g, 5, 2147483647)


def same_srid(a: Column, b: Column) -> Column:
    """Stops where two SRIDs differ, as mixed operands do."""
    return F.when(a.eqNullSafe(b), a).otherwise(F.raise_error(F.lit("shapes have different SRIDs")))


# --- predicates


def relation(name: str, a: Column, b: Column) -> Column:
    """contains, within, intersects, disjoint, overlaps, touches, crosses, equals, covers or covered_by."""
    return _run(_TRUTH, lambda x, y: relations.relate(name, x, y), a, b)


def within_distance(a: Column, b: Column, limit: float) -> Column:
    return distance(a, b) <= limit


def relate_pattern(*_: object) -> Column:
    raise Unsupported("matrix patterns are not supported; use the named predicates")


def normalize(*_: object) -> Column:
    raise Unsupported("normalisation is not supported")


def z_or_m(*_: object) -> Column:
    raise Unsupported("shapes have X and Y only")


# --- measures and parts


def distance(a: Column, b: Column) -> Column:
    return _run(_REAL, measures.distance, a, b)


def area(g: Column) -> Column:
    return _run(_REAL, lambda s: float(measures.area(s)), g)


def length(g: Column) -> Column:
    return _run(_REAL, lambda s: float(measures.length(s)), g)


def x(g: Column) -> Column:
    return _run(_REAL, lambda s: s.parts[0] if s.kind == "POINT" and s.parts else None, g)


def y(g: Column) -> Column:
    return _run(_REAL, lambda s: s.parts[1] if s.kind == "POINT" and s.parts else None, g)


def is_empty(g: Column) -> Column:
    return _run(_TRUTH, lambda s: s.empty, g)


def is_simple(g: Column) -> Column:
    return _run(_TRUTH, measures.is_simple, g)


def is_valid(g: Column) -> Column:
    return _run(_TRUTH, measures.is_valid, g)


def num_points(g: Column) -> Column:
    return _run(_COUNT, lambda s: len(s.points), g)


def num_interior_rings(g: Column) -> Column:
    return _run(_COUNT, lambda s: max(len(s.parts) - 1, 0) if s.kind == "POLYGON" else None, g)


def geometry_type(g: Column) -> Column:
    """The OGC name of the kind."""
    return _run(_TEXT, lambda s: OGC[s.kind], g)


def _nth(parts: list, i: int, kind: str | None) -> Shape | None:
    if not 0 <= i < len(parts):
        return None
    part = parts[i]
    return part if kind is None else point(*part) if kind == "POINT" else Shape(kind, part)


def geometry_n(g: Column, i: Column) -> Column:
    """A member, from 0; a single shape is its own first member."""
    return _run(_SHAPE, lambda s, n: (s if n == 0 else None) if s.kind in ("POINT", "LINESTRING", "POLYGON") else _nth(s.parts, n, None), g, i)


def point_n(g: Column, i: Column) -> Column:
    return _run(_SHAPE, lambda s, n: _nth(s.parts, n, "POINT") if s.kind == "LINESTRING" else None, g, i)


def interior_ring_n(g: Column, i: Column) -> Column:
    return _run(_SHAPE, lambda s, n: _nth(s.parts[1:], n, "LINESTRING") if s.kind == "POLYGON" else None, g, i)


def exterior_ring(g: Column) -> Column:
    return _run(_SHAPE, lambda s: _nth(s.parts, 0, "LINESTRING") if s.kind == "POLYGON" else None, g)


def start_point(g: Column) -> Column:
    return _run(_SHAPE, lambda s: _nth(s.parts, 0, "POINT") if s.kind == "LINESTRING" else None, g)


def end_point(g: Column) -> Column:
    return _run(_SHAPE, lambda s: _nth(s.parts, len(s.parts) - 1, "POINT") if s.kind == "LINESTRING" else None, g)


def shape_of(name: str, g: Column) -> Column:
    """envelope, boundary, centroid, convex_hull, point_on_surface or reverse."""
    return _run(_SHAPE, getattr(measures, name), g)


# --- overlays


def combined(name: str, a: Column, b: Column) -> Column:
    """intersection, union, difference or symmetric_difference."""
    return _run(_SHAPE, lambda p, q: overlay.overlay(name, p, q), a, b)


def unary_union(g: Column) -> Column:
    return _run(_SHAPE, lambda s: overlay.union_all(s.leaves), g)


def buffer(g: Column, size: float, quadrants: int = 8) -> Column:
    return _run(_SHAPE, lambda s: overlay.buffer(s, size, quadrants), g)


# --- aggregates


def aggregate(df: DataFrame, keys: list[str], column: str, name: str = "combine") -> DataFrame:
    """combine (all shapes as one), union or envelope of each group, in a column of the same name.

    An envelope needs bounds only, whose extremes are summed up before the shuffle.
    """
    if name == "envelope":
        box = bounds(df, column, "_b")
        ends = box.groupBy(*keys).agg(*(f(f"_b.{k}").alias(k) for k, f in (("x0", F.min), ("y0", F.min), ("x1", F.max), ("y1", F.max))))
        made = _run(_SHAPE, lambda *b: measures.envelope(collect([point(b[0], b[1]), point(b[2], b[3])])), *(F.col(k) for k in ("x0", "y0", "x1", "y1")))
        return ends.select(*keys, made.alias(column))
    if name not in ("combine", "union"):
        raise Unsupported(name)

    @F.pandas_udf(_SHAPE)
    def run(groups: pd.Series) -> pd.Series:
        out = []
        for group in groups:
            shapes = [from_wkb(bytes(g)) for g in group]
            out.append(to_wkb(overlay.union_all([leaf for s in shapes for leaf in s.leaves]) if name == "union" else collect(shapes)) if shapes else None)
        return pd.Series(out, dtype=object)

    grouped = df.groupBy(*keys).agg(F.sort_array(F.collect_list(column)).alias(column))  # null shapes are left out
    return grouped.select(*keys, run(column).alias(column))


# --- without the shape: columns of numbers


def bounds(df: DataFrame, column: str, name: str = "box") -> DataFrame:
    """Adds a struct x0, y0, x1, y1 with a shape's bounding box."""
    kind = T.StructType([T.StructField(k, T.DoubleType()) for k in ("x0", "y0", "x1", "y1")])

    @F.pandas_udf(kind)
    def run(shapes: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None,) * 4 if g is None else measures.bounds(from_wkb(bytes(g))) or (None,) * 4 for g in shapes], columns=["x0", "y0", "x1", "y1"], dtype=float)

    return df.withColumn(name, run(column))


def mbr(name: str, a: Column, b: Column) -> Column:
    """contains, within, intersects, overlaps or disjoint of two bounding boxes (structs x0, y0, x1, y1)."""
    meets = (a["x0"] <= b["x1"]) & (b["x0"] <= a["x1"]) & (a["y0"] <= b["y1"]) & (b["y0"] <= a["y1"])
    holds = lambda p, q: (p["x0"] <= q["x0"]) & (p["y0"] <= q["y0"]) & (p["x1"] >= q["x1"]) & (p["y1"] >= q["y1"])
    inner = (a["x0"] < b["x1"]) & (b["x0"] < a["x1"]) & (a["y0"] < b["y1"]) & (b["y0"] < a["y1"])
    return {"contains": holds(a, b), "within": holds(b, a), "intersects": meets, "disjoint": ~meets, "overlaps": inner & ~holds(a, b) & ~holds(b, a)}[name]


def distance_sphere(lon_a: Column, lat_a: Column, lon_b: Column, lat_b: Column) -> Column:
    """Metres between two places given in degrees, by the haversine formula."""
    half = F.pow(F.sin(F.radians(lat_b - lat_a) / 2), 2) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.pow(F.sin(F.radians(lon_b - lon_a) / 2), 2)
    return F.lit(2 * RADIUS) * F.asin(F.sqrt(F.least(half, F.lit(1.0))))
