"""Relational, temporal and change operators, sources, sinks and spatial functions."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from skeinwork.capabilities import STATUS, capabilities
from skeinwork.errors import NoElement, Unsupported
from skeinwork.functions import logic as L
from skeinwork.functions import spatial as G
from skeinwork.functions.builders import Builders
from skeinwork.functions.spatial import measures, overlay, relations
from skeinwork.functions.spatial.shapes import from_wkb, from_wkt, to_wkb, to_wkt
from skeinwork.operators import dml as X
from skeinwork.operators import relational as R
from skeinwork.operators import temporal as T
from skeinwork.sources import sinks
from skeinwork.sources.catalog import Catalog, ordinal_name, raw_sql, values

FOLDER = "/root/testdata/sf0.001"
T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def versions(spark):
    """One key with two versions, then deleted; a second key with equal payloads."""
    rows = [(1, "version-1", T0, T1), (1, "version-2", T1, T2), (2, "same", T0, T1), (2, "same", T1, T2)]
    history = spark.createDataFrame(rows, "id int, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    return T.Versioned(history.limit(0), history)


MIDDLE = T0 + (T1 - T0) / 2
BOTH = ["version-1", "version-2"]
GOLDEN = [
    ("as_of", (T0,), BOTH[:1]), ("as_of", (MIDDLE,), BOTH[:1]), ("as_of", (T1,), BOTH[1:]), ("as_of", (T1 + timedelta(days=3),), BOTH[1:]), ("as_of", (T2,), []),
    ("from_to", (T0, T0), []), ("from_to", (T0, T1), BOTH[:1]), ("from_to", (T1, T2), BOTH[1:]), ("from_to", (T0, T2), BOTH),
    ("between", (T0, T0), BOTH[:1]), ("between", (T1, T2), BOTH[1:]), ("between", (T0, T2), BOTH), ("between", (T0, T1), BOTH),
    ("contained_in", (T0, T1), BOTH[:1]), ("contained_in", (T1, T2), BOTH[1:]), ("contained_in", (T0, T2), BOTH), ("all", (), BOTH),
]


@pytest.mark.parametrize("name,bounds,expected", GOLDEN)
def test_temporal_boundaries(versions, name, bounds, expected):
    rows = getattr(versions, name)(*bounds).rows.collect()
    assert sorted(r.name for r in rows if r.id == 1) == expected
    assert len([r for r in rows if r.id == 2]) == len(expected)  # equal payloads stay apart


def test_temporal_rules(spark, versions):
    read = versions.as_of(T0)
    with pytest.raises(Unsupported):
        read.union(versions.as_of(T1))
    with pytest.raises(Unsupported):
        versions.from_to(T0, T1).navigate(versions, "id")
    with pytest.raises(Unsupported):
        read.navigate(spark.range(1), "id")
    with pytest.raises(Unsupported):
        versions.from_to(T1, T0)
    with pytest.raises(Unsupported):
        read.write()
    with pytest.raises(Unsupported):
        versions.as_of(datetime(2024, 1, 1, tzinfo=timezone(timedelta(hours=2))))
    assert versions.as_of(T0.replace(tzinfo=timezone.utc)).rows.count() == 2
    assert read.union(versions.as_of(T0)).count() == 2
    assert read.concat(versions.as_of(T0)).count() == 4


def test_portions(spark):
    """An update inside a row splits it in three, a delete inside the middle one leaves four."""
    df = spark.createDataFrame([(1, "original", T0, T2)], "id int, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    a, b = T0 + timedelta(days=10), T0 + timedelta(days=40)
    cut = X.update_portion(df, a, b, {"name": F.lit("updated")})
    names = lambda d: [r.name for r in d.orderBy("valid_from").collect()]
    assert names(cut) == ["original", "updated", "original"]
    cut = X.delete_portion(cut, a + timedelta(days=5), a + timedelta(days=6))
    assert names(cut) == ["original", "updated", "updated", "original"]
    assert X.overlaps(cut, ["id"]).count() == 0
    assert X.overlaps(cut.unionAll(df), ["id"]).count() == 4
    with pytest.raises(Unsupported):
        X.update_portion(df, b, a, {})


def test_history_upkeep_from_a_stream(spark, tmp_path):
    from skeinwork.streaming.history import history_writer

    kind = "id int, name string, valid_from timestamp_ntz, valid_to timestamp_ntz"
    for part in ("current", "history"):
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/{part}/-1")
    write = history_writer(str(tmp_path), ["id"], ["n"], lambda batch: [T0, T1, T2][batch])
    batches = [[(1, "a", "I", 1), (2, "x", "I", 2)], [(1, "b", "U", 1), (1, "c", "U", 2)], [(2, None, "D", 1)]]
    for n, batch in enumerate(batches):
        for _ in range(2):  # a batch may come again
            write(spark.createDataFrame(batch, "id int, name string, _op string, n int"), n)
    read = lambda part: sorted((r.id, r.name, r.valid_from) for r in spark.read.parquet(f"{tmp_path}/{part}/2").collect())
    assert read("current") == [(1, "c", T1)]
    assert read("history") == [(1, "a", T0), (2, "x", T0)]


def test_changes(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, None, 1)], "id int, name string, v int")
    assert {r.name for r in X.update(df, {"name": F.lit("z")}, F.col("name") == "a").collect()} == {"z", "b", None}
    assert X.delete(df, F.col("name") == "a").count() == 2  # unknown conditions delete nothing
    changes = spark.createDataFrame([(1, "A", 1, "U"), (2, "B", 0, "U"), (3, "x", 1, "D"), (4, "d", 1, "I"), (1, "again", 1, "I")], "id int, name string, v int, _op string")
    after, refused = X.save_changes(df, changes, ["id"], "v")
    assert sorted(map(tuple, after.collect())) == [(1, "A", 2), (2, "b", 1), (4, "d", 1)]
    assert sorted(r.id for r in refused.collect()) == [1, 2]
    assert [r.name for r in X.update_first(df, ["id"], F.lit(True), ["-id"], 1, {"name": F.lit("last")}, offset=1).orderBy("id").collect()] == ["a", "last", None]


def test_elements(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c")], "id int, x string")
    assert R.first(df, ["x"]).first().id == 2
    assert R.last(df, ["x"]).first().id == 3
    assert [r.id for r in R.reverse(df, ["x"]).collect()] == [3, 1, 2]
    assert R.first(df.limit(0), ["x"], default=True).count() == 0
    assert R.max_or_error(df, "id") == 3
    for call in (lambda: R.first(df.limit(0), ["x"]), lambda: R.single(df), lambda: R.max_or_error(df.limit(0), "id")):
        with pytest.raises(NoElement):
            call()
    with pytest.raises(Unsupported):
        R.concat_distinct_sources([("t", df), ("t", df)])
    with pytest.raises(Unsupported):
        R.concat(df, df.select("id"))


def test_not_in(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    right = lambda rows: spark.createDataFrame(rows, "b int")
    assert [r.a for r in R.not_in(left, right([(1,)]), "a", "b").collect()] == [2]
    assert R.not_in(left, right([(1,), (None,)]), "a", "b").count() == 0
    assert R.not_in(left, right([]), "a", "b").count() == 3


def test_string_join(spark):
    df = spark.createDataFrame([("G1", "Beta", 2), ("G1", "Alpha", 1), ("G2", None, 1), ("G1", "Beta", 0)], "g string, x string, n int")
    got = {r.g: (r.a, r.b, r.c) for r in df.groupBy("g").agg(R.string_join(F.col("x"), ",", ["n"]).alias("a"), R.string_join(F.col("x"), None, ["n"]).alias("b"), R.string_join(F.col("x"), ",", ["x"], distinct=True).alias("c")).collect()}
    assert got == {"G1": ("Beta,Alpha,Beta", "BetaAlphaBeta", "Alpha,Beta"), "G2": ("", "", "")}
    assert df.limit(0).agg(R.string_join(F.col("x"), ",").alias("a")).first().a == ""


def test_recursion(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 5)], "a int, b int")
    step = lambda level: level.join(edges, F.col("k") == F.col("a")).select(F.col("b").alias("k"))
    start = spark.createDataFrame([(1,)], "k int")
    assert sorted(r.k for r in R.recursive(start, step, ["k"]).collect()) == [1, 2, 3]
    with pytest.raises(Unsupported):
        R.recursive(start, step, ["k"], levels=4, distinct=False)


def test_sources(spark, tmp_path):
    c = Catalog(spark, FOLDER)
    found = {(r.table_name, r.column_name): r for r in c.discover().collect()}
    assert found["lineitem", "l_linenumber"].key_place == 2
    with pytest.raises(Unsupported):
        c.follow(c.scan("part"), "part", "region")
    with pytest.raises(Unsupported):
        values(spark, [])
    assert ordinal_name(["Key", "key0"]) == "key1"
    assert raw_sql(spark, "select :x as x", x="a'b").first().x == "a'b"
    assert L.in_values(spark.range(3000), "id", list(range(1500))).count() == 1500
    path = str(tmp_path / "t")
    sinks.insert(spark.range(100).select(F.col("id").alias("k")), path, max_rows_per_file=30)
    back = sinks.insert_returning(spark.range(5).select((F.col("id") * 2).alias("x")), str(tmp_path / "u"), "key", 11)
    assert sorted(r.key for r in back.collect()) == [11, 12, 13, 14, 15]
    assert spark.read.parquet(path).count() == 100
    c.register(["nation"])
    assert spark.table("nation").count() == 25


def test_filters_reach_the_scan(spark):
    c = Catalog(spark, FOLDER)
    plan = c.scan("orders").filter("o_totalprice > 1000").select("o_orderkey")._jdf.queryExecution().toString()  # noqa: SLF001
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_capabilities():
    rows = capabilities()
    assert len(rows) == len(STATUS)
    assert {s for _, s, _ in rows} == {"builtin", "composed", "udf", "extension", "absent", "unsupported", "delegated"}
    for call in (G.relate_pattern, G.normalize, G.z_or_m):
        with pytest.raises(Unsupported):
            call()


WKT = ["POINT(13.405 52.52)", "POINT EMPTY", "LINESTRING(0 0,1 1)", "POLYGON((0 0,4 0,4 4,0 4,0 0),(1 1,2 1,2 2,1 2,1 1))", "MULTIPOINT((1 2),(3 4))", "MULTIPOLYGON(((0 0,1 0,1 1,0 0)))", "GEOMETRYCOLLECTION(POINT(1 1),LINESTRING(0 0,2 2))"]


@pytest.mark.parametrize("text", WKT)
def test_shapes_round_trip(text):
    assert to_wkt(from_wkb(to_wkb(from_wkt(text)))) == text
    assert from_wkb(b"\xe6\x10\0\0" + to_wkb(from_wkt(text)), prefixed=True) == from_wkb(to_wkb(from_wkt(text)))


SQUARE, INNER, BESIDE, LINE = "POLYGON((0 0,4 0,4 4,0 4,0 0))", "POLYGON((1 1,2 1,2 2,1 2,1 1))", "POLYGON((4 0,6 0,6 4,4 4,4 0))", "LINESTRING(-1 2,5 2)"
RELATIONS = [
    ("contains", SQUARE, INNER, True), ("within", INNER, SQUARE, True), ("touches", SQUARE, BESIDE, True), ("overlaps", SQUARE, BESIDE, False), ("crosses", LINE, SQUARE, True), ("crosses", SQUARE, LINE, True),
    ("overlaps", SQUARE, "POLYGON((2 2,6 2,6 6,2 6,2 2))", True), ("contains", SQUARE, "POINT(0 0)", False), ("covers", SQUARE, "POINT(0 0)", True), ("touches", SQUARE, "POINT(0 0)", True),
    ("equals", SQUARE, "POLYGON((4 4,0 4,0 0,4 0,4 4))", True), ("disjoint", SQUARE, "POINT(9 9)", True), ("intersects", LINE, "LINESTRING(0 0,0 4)", True), ("crosses", LINE, "LINESTRING(0 0,0 4)", True),
    ("overlaps", LINE, "LINESTRING(0 2,9 2)", True), ("equals", "LINESTRING(0 0,2 2)", "LINESTRING(2 2,1 1,0 0)", True), ("within", "POINT(1 1)", "LINESTRING(0 0,2 2)", True), ("intersects", "POINT EMPTY", SQUARE, False),
]


@pytest.mark.parametrize("name,a,b,expected", RELATIONS)
def test_relations(name, a, b, expected):
    assert relations.relate(name, from_wkt(a), from_wkt(b)) is expected


def test_overlays():
    a, hole = from_wkt(SQUARE), from_wkt(INNER)
    ring = overlay.overlay("difference", a, hole)
    assert measures.area(ring) == 15 and len(ring.parts) == 2
    assert measures.area(overlay.overlay("union", ring, hole)) == 16
    assert overlay.overlay("intersection", a, from_wkt("POINT(9 9)")).empty
    assert measures.length(overlay.overlay("intersection", from_wkt(LINE), a)) == 4
    assert measures.length(overlay.overlay("difference", from_wkt(LINE), a)) == 2
    assert measures.area(overlay.union_all([a, from_wkt(BESIDE), hole])) == 24
    assert measures.area(overlay.buffer(a, -1)) == pytest.approx(4)
    assert measures.area(overlay.buffer(from_wkt("LINESTRING(0 0,10 0)"), 1, 32)) == pytest.approx(20 + 3.14, abs=0.02)
    assert measures.distance(a, from_wkt("POINT(7 8)")) == 5
    assert to_wkt(measures.convex_hull(from_wkt("MULTIPOINT((0 0),(2 0),(1 1),(2 2),(0 2))"))) == "POLYGON((0 0,2 0,2 2,0 2,0 0))"
    assert not measures.is_valid(from_wkt("POLYGON((0 0,2 2,2 0,0 2,0 0))"))
    assert measures.is_simple(from_wkt("LINESTRING(0 0,1 0,1 1,0 0)")) and not measures.is_simple(from_wkt("LINESTRING(0 0,2 2,2 0,0 2)"))
    assert to_wkt(measures.boundary(from_wkt(LINE))) == "MULTIPOINT((-1 2),(5 2))"


def test_builders_procedures_and_splits(spark):
    own = Builders()
    own.register("twice", lambda x: x * 2)
    with pytest.raises(Unsupported):
        own.register("twice", lambda x: x)
    own.register("twice", lambda x: x * 3, replace=True)
    assert spark.range(1, 2).select(own("twice", F.col("id"))).first()[0] == 3
    with pytest.raises(Unsupported):
        own("thrice", F.col("id"))
    c = Catalog(spark, FOLDER)
    named = c.with_procedure("above", lambda k, least: k.scan("customer").filter(F.col("c_acctbal") > least)).with_view("v", lambda k: k.scan("nation"))
    assert named.call("above", least=1e9).count() == 0
    with pytest.raises(Unsupported):
        c.call("above", least=1)
    with pytest.raises(Unsupported):
        c.split(c.scan("part"), "part", "orders")
    nobody = c.scan("customer").filter("c_custkey < 0")
    assert c.split(nobody, "customer", "orders").count() == 0
    assert c.split(c.scan("customer"), "customer", "orders").count() == c.scan("orders").filter("o_custkey is not null").count()
