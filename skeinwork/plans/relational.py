"""Queries on scans, filters, joins, aggregates, order, sets and recursion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skeinwork.functions import logic
from skeinwork.functions.builders import Builders
from skeinwork.operators import relational as R
from skeinwork.plans.registry import query
from skeinwork.sources.catalog import Catalog, raw_sql, values


@query(
    "S1 S2 P1 P2 J1 J13 A1 A2 A5 A6 A7 L1 L2",
    """select n_name, count(*) n_orders, round(sum(o_totalprice), 2) total from orders join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey where o_totalprice > 1000 group by n_name having count(*) > 2 order by total desc, n_name limit 10""",
)
def inner_join_groupby_having(c: Catalog) -> DataFrame:
    """Orders by nation: two joins along foreign keys, a filter that reaches the scan, having, order and limit."""
    orders = c.scan("orders").filter(F.col("o_totalprice") > 1000).select("o_custkey", "o_totalprice")
    joined = c.follow(c.follow(orders, "orders", "customer"), "customer", "nation")
    out = joined.groupBy("n_name").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return R.skip_take(out.filter(F.col("n_orders") > 2), ["-total", "n_name"], 0, 10)


@query("J2 A1 J12", "select c_custkey, count(o_orderkey) n_orders from customer left join orders on o_custkey = c_custkey group by c_custkey")
def left_join_default_if_empty(c: Catalog) -> DataFrame:
    """Orders of every customer, counted before the join."""
    counts = c.scan("orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    out = c.scan("customer").join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    return out.select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query("J3", "select o_orderkey, c_custkey from orders right join customer on o_custkey = c_custkey and o_totalprice > 200000")
def right_join(c: Catalog) -> DataFrame:
    orders = c.scan("orders").filter(F.col("o_totalprice") > 200000)
    return orders.join(c.scan("customer"), F.col("o_custkey") == F.col("c_custkey"), "right").select("o_orderkey", "c_custkey")


@query("J5 J6", "select r_name, n_name from region cross join nation where r_regionkey < n_regionkey")
def cross_join_theta(c: Catalog) -> DataFrame:
    return c.scan("region").join(c.scan("nation"), F.col("r_regionkey") < F.col("n_regionkey")).select("r_name", "n_name")


@query("P23 J10", "select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F')")
def semi_any(c: Catalog) -> DataFrame:
    orders = c.scan("orders").filter("o_orderstatus = 'F'")
    return R.semi_any(c.scan("customer"), orders, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey")


@query("P23 J10", "select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and not (o_totalprice > 5000))")
def anti_all(c: Catalog) -> DataFrame:
    """Customers all of whose orders are large."""
    small = c.scan("orders").filter(~(F.col("o_totalprice") > 5000))
    return R.anti(c.scan("customer"), small, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey")


@query("P21", "select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders order by o_totalprice desc, o_orderkey limit 20)")
def in_subquery_limit(c: Catalog) -> DataFrame:
    top = R.skip_take(c.scan("orders"), ["-o_totalprice", "o_orderkey"], 0, 20)
    return R.semi_any(c.scan("customer"), top, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "c_name")


@query("P22 P29", "select c_custkey from customer where c_custkey not in (select nullif(o_custkey, -1) from orders)")
def not_in_null_aware(c: Catalog) -> DataFrame:
    keys = c.scan("orders").select(F.nullif("o_custkey", F.lit(-1)).alias("k"))
    return R.not_in(c.scan("customer"), keys, "c_custkey", "k").select("c_custkey")


@query("P22 P29", "select c_custkey from customer where c_custkey not in (select nullif(o_custkey, 1) from orders)")
def not_in_with_null(c: Catalog) -> DataFrame:
    """A null among the values leaves nothing."""
    keys = c.scan("orders").select(F.when(F.col("o_custkey") != 1, F.col("o_custkey")).alias("k"))
    return R.not_in(c.scan("customer"), keys, "c_custkey", "k").select("c_custkey")


@query("P20 P31", "select n_nationkey, n_name from nation where n_name in ('FRANCE', 'GERMANY', 'NATION_1', 'NATION_7') or n_nationkey in (3, 5)")
def in_list(c: Catalog) -> DataFrame:
    names = ["FRANCE", "GERMANY", "NATION_1", "NATION_7"]
    return c.scan("nation").filter(F.col("n_name").isin(names) | F.col("n_nationkey").isin(3, 5)).select("n_nationkey", "n_name")


_TOP2 = "select c_custkey, o_orderkey, o_totalprice from customer c {} join lateral (select o_orderkey, o_totalprice from orders where o_custkey = c.c_custkey order by o_totalprice desc, o_orderkey limit {}) x on true"


@query("J7 W2 J11", _TOP2.format("", 2))
def lateral_top2_orders(c: Catalog) -> DataFrame:
    on = F.col("o_custkey") == F.col("c_custkey")
    return R.apply_top(c.scan("customer"), c.scan("orders"), on, ["o_custkey"], ["-o_totalprice", "o_orderkey"], 2).select("c_custkey", "o_orderkey", "o_totalprice")


@query("J8 J9 A9", _TOP2.format("left", 1))
def outer_lateral_latest(c: Catalog) -> DataFrame:
    on = F.col("o_custkey") == F.col("c_custkey")
    return R.apply_top(c.scan("customer"), c.scan("orders"), on, ["o_custkey"], ["-o_totalprice", "o_orderkey"], 1, outer=True).select("c_custkey", "o_orderkey", "o_totalprice")


@query("J9 J11", "select n_name, r_name from nation join region on r_regionkey = n_regionkey where n_nationkey % 2 = 0")
def lateral_flattened(c: Catalog) -> DataFrame:
    """A correlated APPLY without limit, as the SQL root writes it; the optimizer makes it an equi-join."""
    text = "select n_name, r_name from {nation} n, lateral (select r_name from {region} where r_regionkey = n.n_regionkey) where n_nationkey % 2 = 0"
    return raw_sql(c.spark, text, {"nation": c.scan("nation"), "region": c.scan("region")})


@query("W1 L7", "select n_nationkey, c_custkey from nation join (select *, row_number() over (partition by c_nationkey order by c_custkey) - 1 p from customer) on c_nationkey = n_nationkey and p = n_regionkey")
def nth_order_dynamic_offset(c: Catalog) -> DataFrame:
    """The customer of each nation at a place that the nation's row gives."""
    on = F.col("c_nationkey") == F.col("n_nationkey")
    return R.element_at(c.scan("nation"), c.scan("customer"), on, ["c_nationkey"], ["c_custkey"], F.col("n_regionkey")).select("n_nationkey", "c_custkey")


@query("P30 A14", "select c_custkey, (select max(o_totalprice) from orders where o_custkey = c_custkey) top from customer where (select count(*) from orders where o_custkey = c_custkey) > 3")
def scalar_subquery_projection(c: Catalog) -> DataFrame:
    """Correlated scalar subqueries as one aggregate and a join."""
    agg = c.scan("orders").groupBy("o_custkey").agg(F.max("o_totalprice").alias("top"), F.count("*").alias("n")).filter("n > 3")
    return c.scan("customer").join(agg, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "top")


@query(
    "J14",
    "select c_custkey, coalesce(string_agg(o_orderkey::varchar, ',' order by o_orderdate, o_orderkey) filter (o_orderstatus <> 'P'), '') orders from customer left join orders on o_custkey = c_custkey group by c_custkey",
)
def include_orders_collection(c: Catalog) -> DataFrame:
    """A filtered, ordered child collection, shown as text."""
    out = c.gather(c.scan("customer"), "customer", "orders", "orders", F.col("o_orderkey"), ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") != "P")
    return out.select("c_custkey", F.array_join(F.col("orders").cast("array<string>"), ",").alias("orders"))


@query(
    "J15",
    "select 'customer' kind, c_custkey id, c_custkey parent from customer where c_acctbal > 5000 union all select 'orders', o_orderkey, o_custkey from orders join customer on c_custkey = o_custkey where c_acctbal > 5000 and o_orderstatus <> 'P'",
)
def include_orders_split(c: Catalog) -> DataFrame:
    """Parents and a filtered child collection as two queries, shown one after the other."""
    parents = c.scan("customer").filter("c_acctbal > 5000")
    children = c.split(parents, "customer", "orders", F.col("o_orderstatus") != "P")
    shown = parents.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_custkey").alias("parent"))
    return shown.unionAll(children.select(F.lit("orders"), "o_orderkey", "o_custkey"))


@query("J13", "select a.n_nationkey a, b.n_nationkey b from nation a join nation b on a.n_regionkey = b.n_regionkey and a.n_nationkey < b.n_nationkey")
def self_join(c: Catalog) -> DataFrame:
    a, b = c.scan("nation").alias("a"), c.scan("nation").alias("b")
    return a.join(b, (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey"))).select(F.col("a.n_nationkey").alias("a"), F.col("b.n_nationkey").alias("b"))


@query("J16 S6", "select n_nationkey, i.ord, n_name from nation join (values (0, 3), (1, 7), (2, 3)) i(ord, k) on n_nationkey = k")
def join_inline_rowset(c: Catalog) -> DataFrame:
    items = values(c.spark, [3, 7, 3], "int", "ord", "k")
    return c.scan("nation").join(F.broadcast(items), F.col("n_nationkey") == F.col("k")).select("n_nationkey", "ord", "n_name")


@query("J17 P29", "select count(*) n from (select nullif(o_orderstatus, 'F') s from orders) a join (select distinct nullif(o_orderstatus, 'F') s from orders) b on a.s is not distinct from b.s")
def join_null_keys(c: Catalog) -> DataFrame:
    """A join in which null keys are equal."""
    s = c.scan("orders").select(F.nullif("o_orderstatus", F.lit("F")).alias("s"))
    other = s.distinct().withColumnRenamed("s", "t")
    return s.join(other, logic.eq_objects(F.col("s"), F.col("t"))).agg(F.count("*").alias("n"))


@query("U1 P3", "select n_name x from nation union select r_name from region union select n_name from nation")
def union_distinct(c: Catalog) -> DataFrame:
    n, r = c.scan("nation").select(F.col("n_name").alias("x")), c.scan("region").select("r_name")
    return R.union_distinct(n, r, n)


@query("U2", "select n_nationkey k from nation union all select s_nationkey from supplier")
def concat_all(c: Catalog) -> DataFrame:
    return R.concat(c.scan("nation").select(F.col("n_nationkey").alias("k")), c.scan("supplier").select("s_nationkey"))


@query("U3", "select n_nationkey k from nation intersect select s_nationkey from supplier")
def intersect(c: Catalog) -> DataFrame:
    return c.scan("nation").select(F.col("n_nationkey").alias("k")).intersect(c.scan("supplier").select("s_nationkey"))


@query("U4", "select c_custkey k from customer except select o_custkey from orders")
def except_(c: Catalog) -> DataFrame:
    return c.scan("customer").select(F.col("c_custkey").alias("k")).subtract(c.scan("orders").select("o_custkey"))


@query("U5 S6", "select k from (values (1), (1), (2)) a(k) union select n_nationkey from nation where n_nationkey < 4")
def union_inline_operand(c: Catalog) -> DataFrame:
    return R.union_distinct(values(c.spark, [1, 1, 2], "int", name="k").select("k"), c.scan("nation").filter("n_nationkey < 4").select("n_nationkey"))


@query("P3", "select distinct o_orderstatus, o_orderpriority from orders")
def distinct_projection(c: Catalog) -> DataFrame:
    return c.scan("orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("L1 L2", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 15 offset 10")
def skip_take(c: Catalog) -> DataFrame:
    return R.skip_take(c.scan("orders").select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 10, 15)


@query("L4", "select o_orderkey from orders order by o_orderkey limit 7")
def take_take(c: Catalog) -> DataFrame:
    return R.skip_take(c.scan("orders").select("o_orderkey"), ["o_orderkey"], 0, 30, 7, 12)


@query("L3", "select n_nationkey from nation order by n_nationkey offset 20")
def skip_only(c: Catalog) -> DataFrame:
    return R.skip_take(c.scan("nation").select("n_nationkey"), ["n_nationkey"], 20)


@query("L6 L9", "select o_orderkey, o_orderdate from orders order by o_orderdate desc, o_orderkey desc limit 1")
def last_by_key(c: Catalog) -> DataFrame:
    return R.last(c.scan("orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"])


@query("L5 J14", "select x.o_orderkey, l_linenumber from (select o_orderkey from orders order by o_orderkey limit 25) x join lineitem on l_orderkey = x.o_orderkey")
def limited_parent_with_children(c: Catalog) -> DataFrame:
    parents = R.skip_take(c.scan("orders").select("o_orderkey"), ["o_orderkey"], 0, 25)
    return parents.join(c.scan("lineitem"), F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", "l_linenumber")


@query("A12 A10", "select n_regionkey, string_agg(n_name, '; ' order by n_name desc) names from nation group by n_regionkey")
def string_join_agg(c: Catalog) -> DataFrame:
    items = F.sort_array(F.collect_list("n_name"), asc=False)
    return c.scan("nation").groupBy("n_regionkey").agg(F.array_join(items, "; ").alias("names"))


@query("A12 A10 A11", "select c_nationkey, coalesce(string_agg(distinct c_mktsegment, '' order by c_mktsegment) filter (c_acctbal > 0), '') segments from customer group by c_nationkey")
def string_concat_distinct_agg(c: Catalog) -> DataFrame:
    positive = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))
    items = F.array_sort(F.array_distinct(F.collect_list(positive)))  # collect_list leaves out nulls
    return c.scan("customer").groupBy("c_nationkey").agg(F.array_join(items, "").alias("segments"))


@query("A12", "select o_custkey, string_agg(case when o_orderstatus = 'P' then '' else o_orderstatus end, '|' order by o_orderdate, o_orderkey) statuses from orders group by o_custkey")
def string_join_nulls_ordered(c: Catalog) -> DataFrame:
    """Null elements stand as empty texts, in the order of columns that aren't shown."""
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return c.scan("orders").groupBy("o_custkey").agg(R.string_join(status, "|", ["o_orderdate", "o_orderkey"]).alias("statuses"))


@query(
    "A1 A11 P4",
    "select l_returnflag, count(*) filter (l_quantity > 25) large, round(sum(case when l_discount > 0.05 then l_extendedprice else 0 end), 2) discounted, round(avg(l_quantity) filter (l_linestatus = 'F'), 6) quantity from lineitem group by l_returnflag",
)
def filtered_aggregates(c: Catalog) -> DataFrame:
    large, price = F.count_if(F.col("l_quantity") > 25), F.when(F.col("l_discount") > 0.05, F.col("l_extendedprice")).otherwise(0)
    quantity = F.avg(F.when(F.col("l_linestatus") == "F", F.col("l_quantity")))
    return c.scan("lineitem").groupBy("l_returnflag").agg(large.alias("large"), F.round(F.sum(price), 2).alias("discounted"), F.round(quantity, 6).alias("quantity"))


@query("A3 A2", "select p_brand, round(avg(p_size), 6) size, sum(p_size)::bigint total from part group by p_brand")
def avg_int_as_double(c: Catalog) -> DataFrame:
    return c.scan("part").groupBy("p_brand").agg(F.round(F.avg("p_size"), 6).alias("size"), F.sum("p_size").alias("total"))


@query("A2", "select l_linenumber, round(sum(l_tax::float)::float, 1)::double tax from lineitem where l_linenumber <= 2 group by l_linenumber")
def float_sum(c: Catalog) -> DataFrame:
    """A sum of floats is a float again."""
    tax = F.sum(F.col("l_tax").cast("float")).cast("float")
    return c.scan("lineitem").filter("l_linenumber <= 2").groupBy("l_linenumber").agg(F.round(tax, 1).cast("double").alias("tax"))


@query("A4", "select o_orderpriority, min(o_orderdate) first, max(o_orderdate) last, min(o_totalprice) low, max(o_totalprice) high from orders group by o_orderpriority")
def min_max(c: Catalog) -> DataFrame:
    return c.scan("orders").groupBy("o_orderpriority").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))


@query("A10", "select l_shipmode_year y, count(distinct l_partkey) parts, count(distinct l_suppkey) suppliers from (select year(l_shipdate) l_shipmode_year, l_partkey, l_suppkey from lineitem) group by y")
def count_distinct(c: Catalog) -> DataFrame:
    return c.scan("lineitem").groupBy(F.year("l_shipdate").cast("long").alias("y")).agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"))


@query("A8 A6", "select floor(o_totalprice / 50000)::bigint bucket, upper(o_orderstatus) status, count(*) n from orders group by 1, 2")
def groupby_expression_key(c: Catalog) -> DataFrame:
    return c.scan("orders").groupBy(F.floor(F.col("o_totalprice") / 50000).alias("bucket"), F.upper("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))


@query("A5 S4", "with t as (select o_custkey, sum(o_totalprice) s from orders group by 1) select round(max(s), 2) top, round(avg(s), 2) mean, count(*) n from t")
def aggregate_over_aggregate(c: Catalog) -> DataFrame:
    text = "with t as (select o_custkey, sum(o_totalprice) s from {orders} group by 1) select round(max(s), 2) top, round(avg(s), 2) mean, count(*) n from t"
    return raw_sql(c.spark, text, {"orders": c.scan("orders")})


@query("A19 A9 W2", "select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) r from orders) where r = 1")
def groupby_first_element(c: Catalog) -> DataFrame:
    return R.top_per_group(c.scan("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 1).select("o_custkey", "o_orderkey")


@query("P4 P6", "select o_orderkey, case when o_totalprice > 200000 then 'large' when o_totalprice > 100000 then case when o_orderstatus = 'F' then 'closed' else 'medium' end else 'small' end size from orders")
def case_nested(c: Catalog) -> DataFrame:
    inner = F.when(F.col("o_orderstatus") == "F", "closed").otherwise("medium")
    return c.scan("orders").select("o_orderkey", F.when(F.col("o_totalprice") > 200000, "large").when(F.col("o_totalprice") > 100000, inner).otherwise("small").alias("size"))


@query("P5", "select c_custkey, coalesce(nullif(c_nationkey, 3)::double, c_acctbal) x from customer")
def coalesce_promoted(c: Catalog) -> DataFrame:
    return c.scan("customer").select("c_custkey", logic.coalesce_promoted("double", F.nullif("c_nationkey", F.lit(3)), F.col("c_acctbal")).alias("x"))


@query("P29 P6", "select o_orderkey, s is not distinct from t same, s is distinct from t other, s = t three from (select o_orderkey, nullif(o_orderstatus, 'F') s, nullif(left(o_orderpriority, 1), '1') t from orders)")
def null_semantics(c: Catalog) -> DataFrame:
    s, t = F.nullif("o_orderstatus", F.lit("F")), F.nullif(F.left("o_orderpriority", F.lit(1)), F.lit("1"))
    return c.scan("orders").select("o_orderkey", logic.eq_objects(s, t).alias("same"), logic.ne_objects(s, t).alias("other"), logic.eq_sql(s, t).alias("three"))


@query(
    "P7",
    "select l_orderkey, l_linenumber, l_quantity * 2 - 1 a, l_extendedprice / nullif(l_discount, 0) b, l_orderkey // nullif(l_linenumber - 2, 0) q, l_orderkey % nullif(l_linenumber - 2, 0) r from lineitem",
)
def arithmetic(c: Catalog) -> DataFrame:
    """Division by zero gives null; integers divide to integers."""
    k, n = F.col("l_orderkey"), (F.col("l_linenumber") - 2).cast("long")
    return c.scan("lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 2 - 1).alias("a"), logic.divide(F.col("l_extendedprice"), F.col("l_discount")).alias("b"), logic.divide_integers(k, n).alias("q"), logic.modulo(k, n).alias("r"))


@query("P19", r"select p_partkey from part where p_name like '%a%' and p_brand like 'Brand#_%' and p_type not like '50!%%' escape '!'")
def like_escape(c: Catalog) -> DataFrame:
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    return c.scan("part").filter(logic.like(name, "%a%") & logic.like(brand, "Brand#_%") & ~logic.like(kind, "50!%%", "!")).select("p_partkey")


@query("P26", "select l_orderkey, l_linenumber, case when d is null then null else greatest(l_tax, d) end hi, case when d is null then null else least(l_tax, d) end lo from (select *, nullif(l_discount, 0) d from lineitem)")
def greatest_least_nulls(c: Catalog) -> DataFrame:
    d = F.nullif("l_discount", F.lit(0.0))
    return c.scan("lineitem").select("l_orderkey", "l_linenumber", logic.greatest(F.col("l_tax"), d).alias("hi"), logic.least(F.col("l_tax"), d).alias("lo"))


@query("P25", "select o_orderkey from orders where o_orderstatus in ('O', 'P')")
def enum_in_set(c: Catalog) -> DataFrame:
    return c.scan("orders").filter(logic.in_set(F.col("o_orderstatus"), F.lit("O,P"))).select("o_orderkey")


@query("P16", "select count(*) n from customer where lower(c_mktsegment) = 'building'")
def collate_case_insensitive(c: Catalog) -> DataFrame:
    return c.scan("customer").filter(logic.collate(F.col("c_mktsegment"), "UTF8_LCASE") == F.lit("building")).agg(F.count("*").alias("n"))


@query("P27", "select c_nationkey, count(*) n from customer where c_acctbal >= 0 group by 1 union all select -1, count(*) from customer")
def query_filters(c: Catalog) -> DataFrame:
    """A standing filter on scans, and a scan that ignores it."""
    own = c.with_filter("customer", lambda t: t["c_acctbal"] >= 0)
    total = own.scan("customer", ignore_filters=True).agg(F.lit(-1).alias("c_nationkey"), F.count("*").alias("n"))
    return own.scan("customer").groupBy("c_nationkey").agg(F.count("*").alias("n")).unionAll(total)


@query("P28 S12", "select n_name, count(*) n from nation join customer on c_nationkey = n_nationkey group by n_name")
def keyless_view(c: Catalog) -> DataFrame:
    """A relation without key, defined by a query, and a tag on the job."""
    c.spark.sparkContext.setJobDescription("customers by nation")
    view = c.with_view("nation_sizes", lambda k: k.follow(k.scan("customer"), "customer", "nation").groupBy("n_name").agg(F.count("*").alias("n")))
    return view.scan("nation_sizes")


@query("S3 P31", "select o_orderkey, o_totalprice from orders where o_totalprice > 150000 and o_orderstatus = 'O'")
def raw_sql_parameters(c: Catalog) -> DataFrame:
    """A raw SQL root with bound values, composed further."""
    root = raw_sql(c.spark, "select * from {orders} where o_totalprice > :least", {"orders": c.scan("orders")}, least=150000)
    return root.filter("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice")


@query("S4", "with big as (select o_custkey, count(*) n from orders group by 1 having count(*) > 5) select c_custkey, n from customer join big on o_custkey = c_custkey where c_acctbal > 0")
def cte_composed(c: Catalog) -> DataFrame:
    root = raw_sql(c.spark, "with big as (select o_custkey, count(*) n from {orders} group by 1 having count(*) > 5) select * from big", {"orders": c.scan("orders")})
    return root.join(c.scan("customer").filter("c_acctbal > 0"), F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "n")


@query("S5 S4", "with recursive t(i) as (select 1 union all select i + 1 from t where i < 150) select i, n_name from t left join nation on n_nationkey = i")
def recursive_numbers(c: Catalog) -> DataFrame:
    text = "with recursive t(i) max recursion level 200 as (select 1 union all select i + 1 from t where i < :top) select i, n_name from t left join {nation} on n_nationkey = i"
    return raw_sql(c.spark, text, {"nation": c.scan("nation")}, top=150)


_EDGES = "select n_nationkey a, (n_nationkey * 7 + 3) % 25 b from nation union all select n_nationkey, (n_nationkey + 5) % 25 from nation where n_regionkey = 2"


@query("S5", f"with recursive e as ({_EDGES}), t(k) as (select 4 union select b from t join e on a = k) select k::int k from t")
def recursive_hierarchy(c: Catalog) -> DataFrame:
    """What can be reached over cyclic edges: level by level, without rows seen before."""
    edges = raw_sql(c.spark, _EDGES.replace("from nation", "from {nation}"), {"nation": c.scan("nation")})
    return R.recursive(c.spark.range(4, 5).select(F.col("id").cast("int").alias("k")), lambda level: level.join(edges, F.col("a") == F.col("k")).select(F.col("b").cast("int").alias("k")), ["k"])


@query("W3", "select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) n from orders")
def window_row_number_raw_sql(c: Catalog) -> DataFrame:
    text = "select o_custkey, o_orderkey, cast(row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as bigint) n from {orders}"
    return raw_sql(c.spark, text, {"orders": c.scan("orders")})


@query("T8 J13", "select 'c' || c_custkey id, 'customer' kind, c_mktsegment segment from customer union all select 's' || s_suppkey, 'supplier', null from supplier")
def hierarchy_union(c: Catalog) -> DataFrame:
    """A hierarchy with a table for each type."""
    customers = c.scan("customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    return R.hierarchy_union({"customer": customers, "supplier": c.scan("supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("id"))}, "kind").select("id", "kind", "segment")


@query("K1", "select p_partkey, p_retailprice * 2 + 0.5 gross from part")
def scalar_sql_function(c: Catalog) -> DataFrame:
    """A scalar function declared in SQL, which the optimizer inlines."""
    c.spark.sql("create or replace temporary function skein_gross(x double) returns double return x * 2 + 0.5D")
    return c.scan("part").select("p_partkey", F.call_function("skein_gross", F.col("p_retailprice")).alias("gross"))


@query("S13 K2", "select n_nationkey, i::int i from nation, lateral (select unnest(range(0, n_regionkey)) i)")
def table_function(c: Catalog) -> DataFrame:
    """Extension: a table-valued function in FROM."""
    c.spark.sql("create or replace temporary function skein_upto(n int) returns table(i int) return select explode(case when n > 0 then sequence(0, n - 1) else array() end) i")
    return raw_sql(c.spark, "select n_nationkey, i from {nation}, lateral skein_upto(n_regionkey)", {"nation": c.scan("nation")})


@query(
    "W4",
    "select o_orderkey, rank() over w r, lag(o_totalprice) over w before, round(sum(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey), 2) running from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)",
)
def window_frames_extension(c: Catalog) -> DataFrame:
    """Extension: ranks, neighbours and running sums."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return c.scan("orders").select("o_orderkey", F.rank().over(w).cast("long").alias("r"), F.lag("o_totalprice").over(w).alias("before"), F.round(F.sum("o_totalprice").over(w), 2).alias("running"))


@query("A16 A17", "select l_returnflag, l_linestatus, count(*) n, round(stddev_samp(l_quantity), 6) spread from lineitem group by cube (l_returnflag, l_linestatus)")
def cube_extension(c: Catalog) -> DataFrame:
    """Extension: a cube with a deviation."""
    return c.scan("lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.stddev_samp("l_quantity"), 6).alias("spread"))


@query(
    "U7 J14",
    """select 'n' || n_nationkey id, coalesce(string_agg(s_suppkey::varchar, ',' order by s_suppkey), '') items from nation left join supplier on s_nationkey = n_nationkey group by n_nationkey
    union all select 'c' || c_custkey, coalesce(string_agg(o_orderkey::varchar, ',' order by o_orderkey), '') from customer left join orders on o_custkey = c_custkey group by c_custkey""",
)
def concat_with_collections(c: Catalog) -> DataFrame:
    """Concat under a collection projection, whose branches read different tables."""
    shown = lambda df, kind, key: df.select(F.concat(F.lit(kind), key).alias("id"), F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))
    nations = c.gather(c.scan("nation"), "nation", "supplier", "items", F.col("s_suppkey"), ["s_suppkey"])
    customers = c.gather(c.scan("customer"), "customer", "orders", "items", F.col("o_orderkey"), ["o_orderkey"])
    return R.concat_distinct_sources([("nation", shown(nations, "n", "n_nationkey")), ("customer", shown(customers, "c", "c_custkey"))])


@query(
    "K9",
    """select table_name, column_name, case data_type when 'INTEGER' then 'int' when 'VARCHAR' then 'string' when 'TIMESTAMP' then 'timestamp_ntz' else lower(data_type) end data_type
    from information_schema.columns where table_name in ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem')""",
)
def discovered_schema(c: Catalog) -> DataFrame:
    """Names and types of the columns of the relational tables."""
    found = c.discover().filter(F.col("table_name").isin("region", "nation", "customer", "supplier", "part", "orders", "lineitem"))
    return found.select("table_name", "column_name", "data_type")


@query("K4", "select n_nationkey, n_name || '/' || n_regionkey || '/' || length(n_name) label from nation")
def registered_builders(c: Catalog) -> DataFrame:
    """Column builders that a user registers by name, one made of another."""
    own = Builders()
    own.register("labelled", lambda name, *parts: F.concat_ws("/", name, *parts))
    own.register("measured", lambda name, *parts: own("labelled", name, *parts, F.length(name)))
    return c.scan("nation").select("n_nationkey", own("measured", F.col("n_name"), F.col("n_regionkey")).alias("label"))
