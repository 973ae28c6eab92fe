"""Queries on spatial functions, over shapes made of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.functions import spatial as G
from skeinwork.plans.registry import query
from skeinwork.sources.catalog import Catalog

_LON, _LAT = "(c_custkey * 37 % 360 - 180)", "(c_custkey * 17 % 179 - 89)"


def _lon_lat() -> tuple[Column, Column]:
    k = F.col("c_custkey")
    return (k * 37 % 360 - 180).cast("double"), (k * 17 % 179 - 89).cast("double")


@query("G12", f"select c_custkey, round(2 * 6370986 * asin(sqrt(least(1.0, pow(sin(radians(52.52 - {_LAT}) / 2), 2) + cos(radians({_LAT})) * cos(radians(52.52)) * pow(sin(radians(13.405 - {_LON}) / 2), 2)))) / 1000, 3) km from customer")
def distance_sphere(c: Catalog) -> DataFrame:
    lon, lat = _lon_lat()
    return c.scan("customer").select("c_custkey", F.round(G.distance_sphere(lon, lat, F.lit(13.405), F.lit(52.52)) / 1000, 3).alias("km"))


def _box(k: str) -> Column:
    """A square of keys: its corner and its side."""
    x, y, side = F.col(k) * 7 % 20, F.col(k) * 3 % 20, F.col(k) % 6 + 1
    return F.struct(x.cast("double").alias("x0"), y.cast("double").alias("y0"), (x + side).cast("double").alias("x1"), (y + side).cast("double").alias("y1"))


_BOXES = """with b as (select n_nationkey k, n_nationkey * 7 % 20 x0, n_nationkey * 3 % 20 y0, n_nationkey * 7 % 20 + n_nationkey % 6 + 1 x1, n_nationkey * 3 % 20 + n_nationkey % 6 + 1 y1 from nation)
  select a.k a, b.k b, {} from b a, b b where a.k < b.k"""
_MEETS = "(a.x0 <= b.x1 and b.x0 <= a.x1 and a.y0 <= b.y1 and b.y0 <= a.y1)"
_INNER = "(a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1)"
_HOLDS = "({0}.x0 <= {1}.x0 and {0}.y0 <= {1}.y0 and {0}.x1 >= {1}.x1 and {0}.y1 >= {1}.y1)"
_AB, _BA = _HOLDS.format("a", "b"), _HOLDS.format("b", "a")


def _pairs(c: Catalog) -> DataFrame:
    n = c.scan("nation").select("n_nationkey")
    a, b = n.withColumnRenamed("n_nationkey", "a"), n.withColumnRenamed("n_nationkey", "b")
    return a.join(b, F.col("a") < F.col("b"))


@query("G13", _BOXES.format(f"{_AB} c, {_BA} w, {_MEETS} i, not {_MEETS} d, {_INNER} and not {_AB} and not {_BA} o"))
def mbr_predicates(c: Catalog) -> DataFrame:
    a, b = _box("a"), _box("b")
    names = {"c": "contains", "w": "within", "i": "intersects", "d": "disjoint", "o": "overlaps"}
    return _pairs(c).select("a", "b", *(G.mbr(v, a, b).alias(k) for k, v in names.items()))


def _square(k: str) -> Column:
    b = _box(k)
    p = lambda x, y: F.concat_ws(" ", b[x], b[y])
    return G.from_text(F.concat(F.lit("POLYGON(("), F.concat_ws(",", p("x0", "y0"), p("x1", "y0"), p("x1", "y1"), p("x0", "y1"), p("x0", "y0")), F.lit("))")))


@query("G3 G9", _BOXES.format(f"{_MEETS} i, not {_MEETS} d, {_AB} c, {_BA} w, {_AB} v, {_BA} vb, {_INNER} and not {_AB} and not {_BA} o, {_MEETS} and not {_INNER} t, {_AB} and {_BA} e"))
def spatial_predicates(c: Catalog) -> DataFrame:
    """Squares, of which the predicates follow from their bounds."""
    rows = _pairs(c).withColumns({"ga": _square("a"), "gb": _square("b")})
    names = {"i": "intersects", "d": "disjoint", "c": "contains", "w": "within", "v": "covers", "vb": "covered_by", "o": "overlaps", "t": "touches", "e": "equals"}
    return rows.select("a", "b", *(G.relation(v, F.col("ga"), F.col("gb")).alias(k) for k, v in names.items()))


_OVER = "(greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0))"
_AREA = "(({0}.x1 - {0}.x0) * ({0}.y1 - {0}.y0))"


@query(
    "G8 G4 G5",
    _BOXES.format(
        f"{_OVER}::double inter, ({_AREA.format('a')} + {_AREA.format('b')} - {_OVER})::double uni, ({_AREA.format('a')} - {_OVER})::double dif, ({_AREA.format('a')} + {_AREA.format('b')} - 2 * {_OVER})::double sym, "
        "round(sqrt(pow(greatest(a.x0 - b.x1, b.x0 - a.x1, 0), 2) + pow(greatest(a.y0 - b.y1, b.y0 - a.y1, 0), 2)), 6) dist, sqrt(pow(greatest(a.x0 - b.x1, b.x0 - a.x1, 0), 2) + pow(greatest(a.y0 - b.y1, b.y0 - a.y1, 0), 2)) <= 5 near"
    ),
)
def spatial_overlay(c: Catalog) -> DataFrame:
    """Areas of overlays and distances of squares."""
    rows = _pairs(c).withColumns({"ga": _square("a"), "gb": _square("b")})
    a, b = F.col("ga"), F.col("gb")
    names = {"inter": "intersection", "uni": "union", "dif": "difference", "sym": "symmetric_difference"}
    areas = [F.round(G.area(G.combined(v, a, b)), 6).alias(k) for k, v in names.items()]
    return rows.select("a", "b", *areas, F.round(G.distance(a, b), 6).alias("dist"), G.within_distance(a, b, 5.0).alias("near"))


@query("G1 G2 G14 G16", f"select c_custkey, {_LON}::double x, {_LAT}::double y, 'POINT(' || {_LON}::varchar || ' ' || {_LAT}::varchar || ')' wkt, 'Point' kind, 1 n, false e from customer")
def point_xy_text(c: Catalog) -> DataFrame:
    rows = c.scan("customer").select("c_custkey", G.make_point(*_lon_lat()).alias("g"))
    g = F.col("g")
    return rows.select("c_custkey", G.x(g).alias("x"), G.y(g).alias("y"), G.as_text(G.as_binary(g)).alias("wkt"), G.geometry_type(g).alias("kind"), G.num_points(g).alias("n"), G.is_empty(g).alias("e"))


@query(
    "G14 G15 G7",
    """select k, ((x1 - x0) * (y1 - y0))::double area, (2 * (x1 - x0 + y1 - y0))::double len, (x0 + x1) / 2.0::double cx, (y0 + y1) / 2.0::double cy, true hull, true box, true inside, true simple, true valid, 0 holes from
    (select n_nationkey k, n_nationkey * 7 % 20 x0, n_nationkey * 3 % 20 y0, n_nationkey * 7 % 20 + n_nationkey % 6 + 1 x1, n_nationkey * 3 % 20 + n_nationkey % 6 + 1 y1 from nation)""",
)
def area_length_parts(c: Catalog) -> DataFrame:
    """Of a square the hull and the envelope are the square itself."""
    g = F.col("g")
    rows = c.scan("nation").select(F.col("n_nationkey").alias("k")).withColumn("g", _square("k"))
    same = lambda h: G.relation("equals", g, h)
    middle = G.shape_of("centroid", g)
    return rows.select(
        "k", G.area(g).alias("area"), G.length(g).alias("len"), F.round(G.x(middle), 6).alias("cx"), F.round(G.y(middle), 6).alias("cy"), same(G.shape_of("convex_hull", g)).alias("hull"), same(G.shape_of("envelope", g)).alias("box"),
        G.relation("contains", g, G.shape_of("point_on_surface", g)).alias("inside"), G.is_simple(g).alias("simple"), G.is_valid(g).alias("valid"), G.num_interior_rings(g).alias("holes"),
    )


@query("G11 G15", "select n_nationkey k, 'POINT(' || n_nationkey::varchar || ' 0)' p0, 'POINT(5 ' || n_nationkey::varchar || ')' p1, null::varchar p9, true ring, 'POINT(' || n_nationkey::varchar || ' 0)' first, 'POINT(9 9)' last from nation")
def geometry_elements(c: Catalog) -> DataFrame:
    k = F.col("n_nationkey").cast("string")
    line = G.from_text(F.concat(F.lit("LINESTRING("), k, F.lit(" 0,5 "), k, F.lit(",9 9)")))
    poly = G.from_text(F.lit("POLYGON((0 0,9 0,9 9,0 9,0 0),(1 1,2 1,2 2,1 2,1 1))"))
    rows = c.scan("nation").select(F.col("n_nationkey").alias("k"), line.alias("l"), poly.alias("p"))
    at = lambda i: G.as_text(G.point_n(F.col("l"), F.lit(i)))
    ring = G.as_text(G.interior_ring_n(F.col("p"), F.lit(0))) == "LINESTRING(1 1,2 1,2 2,1 2,1 1)"
    return rows.select("k", at(0).alias("p0"), at(1).alias("p1"), at(9).alias("p9"), ring.alias("ring"), G.as_text(G.start_point(F.col("l"))).alias("first"), G.as_text(G.end_point(F.col("l"))).alias("last"))


@query("G6", "select n_nationkey k, true inside, true outside, round(pow(n_nationkey % 5 + 1, 2) * 16 * sin(pi() / 16) * cos(pi() / 16), 6) area from nation")
def buffer_points(c: Catalog) -> DataFrame:
    """A point's buffer is a regular polygon."""
    k = F.col("n_nationkey")
    rows = c.scan("nation").select(k.alias("k"), (k % 5 + 1).alias("r"), G.make_point(k, F.lit(2.0)).alias("g"))
    out: DataFrame | None = None
    for r in range(1, 6):
        b = G.buffer(F.col("g"), float(r), 4)
        part = rows.filter(F.col("r") == r).select("k", G.relation("contains", b, F.col("g")).alias("inside"), G.relation("disjoint", b, G.make_point(F.col("k") + r + 1, F.lit(2.0))).alias("outside"), F.round(G.area(b), 6).alias("area"))
        out = part if out is None else out.unionAll(part)
    return out


@query("G17 A13", "select n_regionkey r, count(*)::int n, true box, max(n_nationkey * 7 % 20)::double - min(n_nationkey * 7 % 20)::double width from nation group by 1")
def spatial_aggregates(c: Catalog) -> DataFrame:
    """All points of a region as one shape, and their envelope."""
    k = F.col("n_nationkey")
    points = c.scan("nation").select(F.col("n_regionkey").alias("r"), G.make_point(k * 7 % 20, k * 3 % 20).alias("g"))
    whole, box = G.aggregate(points, ["r"], "g", "combine"), G.aggregate(points, ["r"], "g", "envelope").withColumnRenamed("g", "box")
    union = G.aggregate(points, ["r"], "g", "union").withColumnRenamed("g", "u")
    rows = G.bounds(whole.join(box, "r").join(union, "r"), "g", "b")
    return rows.select("r", G.num_points(F.col("g")).alias("n"), (G.relation("covers", F.col("box"), F.col("g")) & G.relation("equals", F.col("g"), F.col("u"))).alias("box"), (F.col("b.x1") - F.col("b.x0")).alias("width"))
