"""Connected components of a graph of any size, by alternating large-star and small-star steps on DataFrames.

Each step moves the neighbours of a node to the least node it knows (Kiveris and others, "Connected Components in
MapReduce and Beyond", 2014).  A step is a grouped minimum, summed up before the shuffle, and a join that deals the edges
of a hub to many tasks; tables are written between steps, and nothing but two counts and the names of the hubs, at most
``common.SHARE`` of them, reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.llm.common import Scratch, crowded_keys, join_spread


def _moved(edges: DataFrame, least: DataFrame, total: int) -> DataFrame:
    """For each edge u, v the edge from v to the least node m that u knows, repeated rows included."""
    out = join_spread(edges, least.drop("degree"), "u", crowded_keys(least, "u", "degree", total))
    return out.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _look(edges: DataFrame) -> tuple[int, bool]:
    """The number of distinct edges u > v, and whether they are stars: each u has one v, and no v is the u of another edge."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionAll(edges.select("v", F.lit(0)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    row = nodes.agg(F.coalesce(F.sum("up"), F.lit(0)).alias("n"), F.count_if((F.col("up") > 1) | (F.col("up") == 1) & (F.col("least") == 0)).alias("others")).first()
    return row.n, row.others == 0


def components(edges: DataFrame, scratch: Scratch, limit: int = 60) -> DataFrame:
    """node and component (its least node) for every node of the edges a, b; loops are ignored.

    Stars are what no step changes any more, so rounds end with them, and edges that are stars already take none.
    """
    e = scratch.keep(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    n, stars = _look(e)
    while not stars:
        if not limit:
            raise RuntimeError("no components after the last round")
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        up = F.col("v") > F.col("u")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count_if(up).alias("degree"))
        large = scratch.keep(_moved(both.filter(up), least, n))  # no more rows than e
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree"))
        after = scratch.keep(_moved(large, low, n).unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        scratch.drop(e)
        scratch.drop(large)
        e, limit = after, limit - 1
        n, stars = _look(e)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
