"""Queries on JSON texts: reads, rowsets, membership and edits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.functions import jsons as J
from skeinwork.functions import logic as L
from skeinwork.plans.registry import query
from skeinwork.sources.catalog import Catalog

#: A nested document made of columns, in Spark's and in DuckDB's SQL.
_LIST = "case when event_id % 4 = 3 then '[]' else '[' || (event_id % 5)::varchar || ',2,null,' || (event_id % 7)::varchar || ']' end"
_ITEMS = """'[{"sku":"a' || (event_id % 3)::varchar || '","qty":' || (event_id % 9)::varchar || '},{"sku":"b","qty":1}]'"""


def _list() -> Column:
    k = lambda n: (F.col("event_id") % n).cast("string")
    return F.when(F.col("event_id") % 4 == 3, "[]").otherwise(F.concat(F.lit("["), k(5), F.lit(",2,null,"), k(7), F.lit("]")))


def _items() -> Column:
    k = lambda n: (F.col("event_id") % n).cast("string")
    return F.concat(F.lit('[{"sku":"a'), k(3), F.lit('","qty":'), k(9), F.lit('},{"sku":"b","qty":1}]'))


@query("N11 N12 N13", "select event_id, (props ->> '$.k')::int k, (props ->> '$.k')::double d, (props ->> '$.k') || '' t, props ->> '$.none' n from events")
def json_scalar_read(c: Catalog) -> DataFrame:
    p = F.col("props")
    return c.scan("events").select("event_id", J.value(p, "$.k", "int").alias("k"), J.value(p, "$.k", "double").alias("d"), J.value(p, "$.k").alias("t"), J.value(p, "$.none").alias("n"))


@query("N7 N8 N9", f"select event_id, json_array_length({_LIST})::int a, 1 o, 1 s, 'OBJECT' t, case when event_id % 2 = 0 then 'INTEGER' else 'NULL' end u, '[\"k\"]' keys from events")
def json_length_keys_type(c: Catalog) -> DataFrame:
    scalar = F.when(F.col("event_id") % 2 == 0, "7").otherwise("null")
    return c.scan("events").select("event_id", J.length(_list()).alias("a"), J.length(F.col("props")).alias("o"), J.length(F.lit('"x"')).alias("s"), J.type_name(F.col("props")).alias("t"), J.type_name(scalar).alias("u"), J.keys(F.col("props")).alias("keys"))


@query("P24 N17", f"select event_id, case when event_id % 4 = 3 then false else (event_id % 5 = 4 or event_id % 7 = 4) end four, event_id % 4 <> 3 nulls, case when event_id % 4 = 3 then false else event_id % 5 = 2 end page from events")
def json_contains_collection(c: Catalog) -> DataFrame:
    """Membership in a JSON array, where null matches null, and in its first page."""
    array = F.from_json(_list(), "array<int>")
    return c.scan("events").select("event_id", J.has_element(_list(), F.lit(4), "int").alias("four"), J.has_element(_list(), F.lit(None).cast("int"), "int").alias("nulls"), L.array_page_has(array, F.lit(2), 0, 1).alias("page"))


@query("S7 L10", f"select event_id, i::int \"key\", (x ->> '$')::int \"value\" from (select event_id, unnest(from_json({_LIST}, '[\"json\"]')) x, generate_subscripts(from_json({_LIST}, '[\"json\"]'), 1) i from events)")
def json_rowset(c: Catalog) -> DataFrame:
    """A row for each element, with its ordinal."""
    return J.rowset(c.scan("events").select("event_id", _list().alias("doc")), "doc", "int").select("event_id", "key", "value")


@query(
    "S8 A15 N17",
    f"""select x.sku, count(*) n, sum(x.qty)::bigint qty from (select unnest(from_json({_ITEMS}, '[{{"sku":"varchar","qty":"int"}}]')) x from events) group by x.sku""",
)
def json_rowset_aggregate(c: Catalog) -> DataFrame:
    rows = J.rowset(c.scan("events").select(_items().alias("doc")), "doc", "struct<sku:string,qty:int>")
    return rows.groupBy("sku").agg(F.count("*").alias("n"), F.sum("qty").alias("qty"))


@query("S9 A15", "select event_id, 1 + (event_id % 9 > 3)::int + case when event_id % 9 > 3 then 0 else -1 end n from events")
def json_count_where(c: Catalog) -> DataFrame:
    """How many elements meet a predicate."""
    many = J.count_where(_items(), "struct<sku:string,qty:int>", lambda x: x["qty"] > 3)
    return c.scan("events").select("event_id", (many + F.when(F.col("event_id") % 9 > 3, 1).otherwise(0)).alias("n"))


@query("S10 N14 L8", f"select event_id, json_extract_string({_LIST}, '$[' || (event_id % 3)::varchar || ']')::int x from events")
def json_dynamic_element(c: Catalog) -> DataFrame:
    """An element at a place that a column gives; null outside."""
    return c.scan("events").select("event_id", J.element(_list(), (F.col("event_id") % 3).cast("int"), "int").alias("x"))


@query("N4 N5 N15", """select event_id, '[' || event_id::varchar || ',"' || event_type || '",null,true]' a, '{"id":' || event_id::varchar || ',"type":"' || event_type || '","none":null}' o from events""")
def json_object_array(c: Catalog) -> DataFrame:
    none = F.lit(None).cast("string")
    return c.scan("events").select("event_id", J.array(F.col("event_id"), F.col("event_type"), none, F.lit(True)).alias("a"), J.object_(id=F.col("event_id"), type=F.col("event_type"), none=none).alias("o"))


@query("P18", "select event_id, true same, event_id % 2 = 0 other from events")
def json_equality(c: Catalog) -> DataFrame:
    """Keys may come in any order."""
    k = F.col("event_id").cast("string")
    a, b = F.concat(F.lit('{"a":'), k, F.lit(',"b":[1,{"c":2}]}')), F.concat(F.lit('{ "b": [1, {"c": 2}], "a":'), k, F.lit("}"))
    d = F.when(F.col("event_id") % 2 == 0, b).otherwise(F.lit('{"a":1.5}'))
    return c.scan("events").select("event_id", L.json_equal(a, b).alias("same"), L.json_equal(a, d).alias("other"))


@query(
    "N1 N2 N3 N16",
    """select event_id, '{"k": ' || k || ', "x": 5}' s, props r0, '{"k": "' || event_type || '"}' r, '{}' d, '{"k": 0, "y": [1]}' m from (select *, props ->> '$.k' k from events)""",
)
def json_set_replace_remove(c: Catalog) -> DataFrame:
    five, kind = F.lit(5), F.col("event_type")
    made = J.edits(
        F.col("props"),
        s=[("set", "$.x", five)], r0=[("replace", "$.x", five)], r=[("replace", "$.k", kind)], d=[("remove", "$.k", None)],
        m=[("set", "$.k", F.lit(0)), ("set", "$.y", F.array(F.lit(1)))],
    )
    return c.scan("events").select("event_id", made.alias("made")).select("event_id", "made.*")


@query("N6 N10", f"select event_id, case when event_id % 4 = 3 then 1 else 2 end::int a, 2::int o, (props ->> '$.k')::int = 7 has, case when event_id % 4 = 3 then false else true end two from events")
def json_depth_contains(c: Catalog) -> DataFrame:
    return c.scan("events").select("event_id", J.doc_depth(_list()).alias("a"), J.doc_depth(F.col("props")).alias("o"), J.contains(F.col("props"), F.lit('{"k": 7}')).alias("has"), J.contains(_list(), F.lit("2")).alias("two"))
