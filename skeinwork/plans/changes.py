"""Queries on temporal relations and on set-based changes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.operators import dml as X
from skeinwork.operators import temporal as T
from skeinwork.plans.registry import query
from skeinwork.sources import sinks
from skeinwork.sources.catalog import Catalog, raw_sql

A, B = datetime(1996, 1, 1), datetime(1997, 6, 1)
_VERSIONS = """(select o_orderkey, o_custkey, o_totalprice, o_orderdate valid_from,
    coalesce(lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey), timestamp '9999-12-31 23:59:59') valid_to from orders)"""


def _versions(c: Catalog) -> T.Versioned:
    """Each customer's orders as versions; the last is current, the others are history."""
    rows = c.scan("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    rows = T.from_changes(rows, ["o_custkey"], "o_orderdate", ["o_orderkey"]).drop("o_orderdate")
    last = F.col("valid_to") == F.lit(T.FOREVER).cast("timestamp_ntz")
    return T.Versioned(rows.filter(last), rows.filter(~last))


def _keys(read: T.TemporalRead) -> DataFrame:
    return read.rows.select("o_custkey", "o_orderkey")


@query("T1 T6 S11 T9", f"select o_custkey, o_orderkey from {_VERSIONS} where valid_from <= timestamp '{A}' and valid_to > timestamp '{A}'")
def temporal_as_of(c: Catalog) -> DataFrame:
    return _keys(_versions(c).as_of(A))


@query("T2", f"select o_custkey, o_orderkey from {_VERSIONS} where valid_from < timestamp '{B}' and valid_to > timestamp '{A}'")
def temporal_from_to(c: Catalog) -> DataFrame:
    return _keys(_versions(c).from_to(A, B))


@query("T3", f"select o_custkey, o_orderkey from {_VERSIONS} where valid_from <= timestamp '{B}' and valid_to > timestamp '{A}'")
def temporal_between(c: Catalog) -> DataFrame:
    return _keys(_versions(c).between(A, B))


@query("T4", f"select o_custkey, o_orderkey from {_VERSIONS} where valid_from >= timestamp '{A}' and valid_to <= timestamp '{B}'")
def temporal_contained_in(c: Catalog) -> DataFrame:
    return _keys(_versions(c).contained_in(A, B))


@query("T5 A14", f"select o_custkey, count(*) n, min(valid_from) first, max(valid_to) last from {_VERSIONS} group by o_custkey")
def temporal_all(c: Catalog) -> DataFrame:
    return _versions(c).all().rows.groupBy("o_custkey").agg(F.count("*").alias("n"), F.min("valid_from").alias("first"), F.max("valid_to").alias("last"))


@query("T7", f"with v as {_VERSIONS} select a.o_custkey, a.o_orderkey, b.o_orderkey other from v a join v b on a.o_custkey = b.o_custkey + 1 where a.valid_from <= timestamp '{A}' and a.valid_to > timestamp '{A}' and b.valid_from <= timestamp '{A}' and b.valid_to > timestamp '{A}'")
def temporal_navigation_as_of(c: Catalog) -> DataFrame:
    """A relation that is followed is read as of the same time."""
    v = _versions(c)
    rename = {"o_custkey": "b_custkey", "o_orderkey": "other", "o_totalprice": "b_price"}
    other = T.Versioned(v.current.withColumnsRenamed(rename), v.history.withColumnsRenamed(rename))
    return v.as_of(A).navigate(other, F.col("o_custkey") == F.col("b_custkey") + 1).select("o_custkey", "o_orderkey", "other")


@query("U6 T8", f"select o_orderkey from {_VERSIONS} where valid_from <= timestamp '{A}' and valid_to > timestamp '{A}'")
def temporal_union(c: Catalog) -> DataFrame:
    v = _versions(c)
    rows = [T.Versioned(v.current.filter(p).select("o_orderkey", "valid_from", "valid_to"), v.history.filter(p)) for p in ("o_custkey % 2 = 0", "o_custkey % 2 = 1", "o_custkey % 4 = 1")]
    return rows[0].as_of(A).concat(rows[1].as_of(A)).select("o_orderkey").unionAll(rows[2].as_of(A).rows.select("o_orderkey")).distinct()


@query(
    "T10",
    """select c_custkey, case when c_custkey % 5 = 0 then c_acctbal + 1 else c_acctbal end acctbal, true is_current from customer where c_custkey % 7 <> 0 or c_custkey % 5 = 0
    union all select c_custkey, c_acctbal, false from customer where c_custkey % 5 = 0 or c_custkey % 7 = 0""",
)
def temporal_history_upkeep(c: Catalog) -> DataFrame:
    """Updates and deletes at one time move the old rows to history."""
    rows = c.scan("customer").select("c_custkey", F.col("c_acctbal").alias("acctbal"))
    start, end = F.lit(A).cast("timestamp_ntz"), F.lit(T.FOREVER).cast("timestamp_ntz")
    current = rows.withColumns({"valid_from": start, "valid_to": end})
    changed = rows.filter("c_custkey % 5 = 0").withColumns({"acctbal": F.col("acctbal") + 1, "_op": F.lit("U")})
    gone = rows.filter("c_custkey % 7 = 0 and c_custkey % 5 <> 0").withColumn("_op", F.lit("D"))
    now, history = T.maintain(current, current.limit(0), changed.unionAll(gone), ["c_custkey"], B)
    return now.select("c_custkey", "acctbal", F.lit(True).alias("is_current")).unionAll(history.select("c_custkey", "acctbal", F.lit(False)))



def _portion_sql(inside: str | None) -> str:
    parts = [
        f"select o_orderkey, o_totalprice, valid_from, least(valid_to, timestamp '{A}') valid_to from v where valid_from < least(valid_to, timestamp '{A}')",
        f"select o_orderkey, o_totalprice, greatest(valid_from, timestamp '{B}'), valid_to from v where greatest(valid_from, timestamp '{B}') < valid_to",
    ]
    if inside:
        parts.append(f"select o_orderkey, {inside}, greatest(valid_from, timestamp '{A}'), least(valid_to, timestamp '{B}') from v where greatest(valid_from, timestamp '{A}') < least(valid_to, timestamp '{B}')")
    return f"with v as (select * from {_VERSIONS} where valid_from < valid_to) {' union all '.join(parts)}"


def _valid(c: Catalog) -> DataFrame:
    return _versions(c).all().rows.filter("valid_from < valid_to").select("o_orderkey", "o_totalprice", "valid_from", "valid_to")


@query("X7", _portion_sql("o_totalprice * 2"))
def portion_update(c: Catalog) -> DataFrame:
    return X.update_portion(_valid(c), A, B, {"o_totalprice": F.col("o_totalprice") * 2})


@query("X7", _portion_sql(None))
def portion_delete(c: Catalog) -> DataFrame:
    return X.delete_portion(_valid(c), A, B)


@query("X8", "select o_orderkey from (select o_orderkey, o_orderdate s, max(o_orderdate + interval 30 day) over (partition by o_custkey order by o_orderdate, o_orderdate + interval 30 day, o_orderkey rows between unbounded preceding and 1 preceding) e from orders) where s < e")
def without_overlaps(c: Catalog) -> DataFrame:
    """Orders that begin within thirty days of an earlier one of the customer."""
    rows = c.scan("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("s"), F.timestamp_add("DAY", F.lit(30), "o_orderdate").alias("e"))
    return X.overlaps(rows, ["o_custkey"], "s", "e", ["o_orderkey"]).select("o_orderkey")


@query("X1 X6", "select o_orderkey, case when c_mktsegment = 'BUILDING' then o_totalprice + 1 else o_totalprice end o_totalprice from orders left join customer on c_custkey = o_custkey")
def exec_update_join(c: Catalog) -> DataFrame:
    """An update from a joined relation."""
    building = c.scan("customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    rows = c.scan("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return X.update_from(rows, building, ["o_custkey"], {"o_totalprice": F.col("t.o_totalprice") + 1}).select("o_orderkey", "o_totalprice")


@query("X1", "select c_custkey, case when c_acctbal < 0 then 0 else c_acctbal end c_acctbal from customer")
def exec_update(c: Catalog) -> DataFrame:
    return X.update(c.scan("customer").select("c_custkey", "c_acctbal"), {"c_acctbal": F.lit(0.0)}, F.col("c_acctbal") < 0)


@query("X2 X5", "select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_quantity > 45)")
def exec_delete_exists(c: Catalog) -> DataFrame:
    large = c.scan("lineitem").filter("l_quantity > 45")
    return X.delete_where_exists(c.scan("orders"), large, F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey")


@query("X3 X4", "select o_orderkey from orders where o_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F' order by o_totalprice desc, o_orderkey limit 50 offset 5)")
def delete_limit_ordered(c: Catalog) -> DataFrame:
    rows = c.scan("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return X.delete_first(rows, ["o_orderkey"], F.col("o_orderstatus") == "F", ["-o_totalprice"], 50, 5).select("o_orderkey")


@query(
    "X9",
    """select n_nationkey, case when n_nationkey % 3 = 0 and n_nationkey % 2 = 0 then 'new' else n_name end n_name, case when n_nationkey % 3 = 0 and n_nationkey % 2 = 0 then 2 else 1 end v from nation where n_nationkey <> 7
    union all select 100, 'added', 1""",
)
def save_changes_versioned(c: Catalog) -> DataFrame:
    """Inserts, updates and deletes by key; updates with an old version are refused."""
    rows = c.scan("nation").select("n_nationkey", "n_name", F.lit(1).alias("v"))
    updates = rows.filter("n_nationkey % 3 = 0").select("n_nationkey", F.lit("new").alias("n_name"), F.when(F.col("n_nationkey") % 2 == 0, 1).otherwise(9).alias("v"), F.lit("U").alias("_op"))
    gone = rows.filter("n_nationkey = 7").withColumn("_op", F.lit("D"))
    added = c.spark.range(1).select(F.lit(100).alias("n_nationkey"), F.lit("added").alias("n_name"), F.lit(1).alias("v"), F.lit("I").alias("_op"))
    return X.save_changes(rows, updates.unionAll(gone).unionAll(added), ["n_nationkey"], "v")[0]


@query("X10", "select count(*) n, 26::bigint low, (25 + count(*))::bigint high, count(*) distinct_keys, true unique_blocks from customer")
def generated_keys(c: Catalog) -> DataFrame:
    """Dense keys after the largest one, and keys from leased blocks that never collide."""
    names = c.scan("customer").select("c_name").repartition(7)
    dense = sinks.with_keys(names, "id", 26).agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"), F.count_distinct("id").alias("distinct_keys"))
    leased = sinks.hi_lo(names, "id", 32, 5).agg((F.count_distinct("id") == F.count("*")).alias("unique_blocks"))
    return dense.join(F.broadcast(leased))


@query(
    "X12 X1",
    "with large as (select o_custkey, max(o_totalprice) top from orders where o_orderstatus = 'F' group by 1 having count(*) > 4) select c_custkey, case when top is null then c_acctbal else c_acctbal + top end c_acctbal from customer left join large on o_custkey = c_custkey",
)
def exec_update_cte(c: Catalog) -> DataFrame:
    """An update whose source is a CTE."""
    text = "with large as (select o_custkey, max(o_totalprice) top from {orders} where o_orderstatus = :status group by 1 having count(*) > 4) select o_custkey c_custkey, top from large"
    large = raw_sql(c.spark, text, {"orders": c.scan("orders")}, status="F")
    return X.update_from(c.scan("customer").select("c_custkey", "c_acctbal"), large, ["c_custkey"], {"c_acctbal": F.col("t.c_acctbal") + F.col("s.top")})


@query("S14 S16", "select c_custkey, c_acctbal, true as within_cap from customer where c_acctbal < 0 or c_acctbal > 5000")
def insert_rows(c: Catalog) -> DataFrame:
    """Two inserts into one table, with a cap on rows per file, read back with whether each file keeps to the cap."""
    path, rows = sinks.new_table(c.spark, "inserted"), c.scan("customer").select("c_custkey", "c_acctbal")
    for part in ("c_acctbal < 0", "c_acctbal > 5000"):
        sinks.insert(rows.filter(part), path, max_rows_per_file=20_000)
    inserted = c.spark.read.schema(rows.schema).parquet(path).withColumn("file", F.col("_metadata.file_path"))
    sizes = inserted.groupBy("file").agg((F.count("*") <= 20_000).alias("within_cap"))
    return inserted.join(sizes, "file").select("c_custkey", "c_acctbal", "within_cap")


@query("S15 X10", "select 1000000 + row_number() over (order by c_custkey) id, c_name from customer where c_custkey % 3 = 0")
def insert_returning_keys(c: Catalog) -> DataFrame:
    """An insert that returns the rows it wrote with their generated keys, which follow an order."""
    rows = c.scan("customer").filter("c_custkey % 3 = 0").orderBy("c_custkey").select("c_name")
    return sinks.insert_returning(rows, sinks.new_table(c.spark, "returned"), "id", 1_000_001)


@query("S12 S17", "select n_nationkey, case when n_regionkey = 2 then upper(n_name) || '!' else n_name end n_name from nation where n_nationkey in (select c_nationkey from customer where c_acctbal > 5000)")
def procedure_calls(c: Catalog) -> DataFrame:
    """A procedure that returns rows, composed further, and one that returns a changed relation."""
    own = c.with_procedure("customers_above", lambda k, least: k.scan("customer").filter(F.col("c_acctbal") > least))
    own = own.with_procedure("rename", lambda k, region: X.update(k.scan("nation"), {"n_name": F.concat(F.upper("n_name"), F.lit("!"))}, F.col("n_regionkey") == region))
    named = own.call("rename", region=2)
    return named.join(own.call("customers_above", least=5000), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("n_nationkey", "n_name")
