"""Tables: their keys and links, scans with standing filters, discovery of schemas, raw SQL and literal rowsets."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinwork.errors import Unsupported


@dataclass(frozen=True)
class Link:
    """A foreign key: columns of this table that name rows of another one."""

    columns: tuple[str, ...]
    table: str
    target: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    name: str
    key: tuple[str, ...]
    links: tuple[Link, ...] = field(default=())


def _link(column: str, table: str, target: str) -> Link:
    return Link((column,), table, (target,))


TABLES = {
    t.name: t
    for t in (
        Table("region", ("r_regionkey",)),
        Table("nation", ("n_nationkey",), (_link("n_regionkey", "region", "r_regionkey"),)),
        Table("supplier", ("s_suppkey",), (_link("s_nationkey", "nation", "n_nationkey"),)),
        Table("customer", ("c_custkey",), (_link("c_nationkey", "nation", "n_nationkey"),)),
        Table("part", ("p_partkey",)),
        Table("orders", ("o_orderkey",), (_link("o_custkey", "customer", "c_custkey"),)),
        Table("lineitem", ("l_orderkey", "l_linenumber"), (_link("l_orderkey", "orders", "o_orderkey"), _link("l_partkey", "part", "p_partkey"), _link("l_suppkey", "supplier", "s_suppkey"))),
        Table("events", ("event_id",)),
        Table("documents", ("doc_id",)),
        Table("embeddings", ("vec_id",)),
        Table("pages", ("page_id",)),
        Table("benchmark", ("item_id",)),
        Table("labels", ("doc_id",), (_link("doc_id", "documents", "doc_id"),)),
        Table("conversations", ("conv_id", "turn")),
    )
}


class Catalog:
    """Scans of a folder of Parquet tables.  Standing filters apply to every scan unless it is asked to ignore them."""

    def __init__(self, spark: SparkSession, folder: str, tables: dict[str, Table] = TABLES) -> None:
        self.spark, self.folder, self.tables = spark, folder, tables
        self.filters: dict[str, Callable[[DataFrame], Column]] = {}
        self.views: dict[str, Callable[[Catalog], DataFrame]] = {}
        self.procedures: dict[str, Callable[..., DataFrame]] = {}

    def scan(self, name: str, ignore_filters: bool = False) -> DataFrame:
        """A table or view by name."""
        if name in self.views:
            return self.views[name](self)
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return df.filter(self.filters[name](df)) if name in self.filters and not ignore_filters else df

    def _copy(self) -> Catalog:
        out = Catalog(self.spark, self.folder, self.tables)
        out.filters, out.views, out.procedures = dict(self.filters), dict(self.views), dict(self.procedures)
        return out

    def with_filter(self, name: str, predicate: Callable[[DataFrame], Column]) -> Catalog:
        """A catalog in which scans of a table keep only rows that meet the predicate (a tenant, rows not deleted)."""
        out = self._copy()
        out.filters[name] = predicate
        return out

    def with_view(self, name: str, view: Callable[[Catalog], DataFrame]) -> Catalog:
        """A catalog with a keyless relation computed from others."""
        out = self._copy()
        out.views[name] = view
        return out

    def with_procedure(self, name: str, procedure: Callable[..., DataFrame]) -> Catalog:
        """A catalog with a procedure: a callable of the catalog and named arguments that returns rows or a changed relation."""
        out = self._copy()
        out.procedures[name] = procedure
        return out

    def call(self, name: str, **args: object) -> DataFrame:
        """The rows of a procedure; they have no key and can be composed further."""
        if name not in self.procedures:
            raise Unsupported(f"there is no procedure {name}")
        return self.procedures[name](self, **args)

    def follow(self, df: DataFrame, table: str, link_to: str, optional: bool = False) -> DataFrame:
        """Joins the row that a foreign key of table names; optional keeps rows without one."""
        link = next((x for x in self.tables[table].links if x.table == link_to), None)
        if link is None:
            raise Unsupported(f"{table} has no link to {link_to}")
        other = self.scan(link_to)
        on = [df[a] == other[b] for a, b in zip(link.columns, link.target, strict=True)]
        return df.join(other, on, "left" if optional else "inner")

    def gather(self, df: DataFrame, table: str, child: str, name: str, value: Column, order: Sequence[str], where: Column | None = None) -> DataFrame:
        """Adds an array column with the values of the child rows of each row, in the order given; empty without children."""
        link = next((x for x in self.tables[child].links if x.table == table), None)
        if link is None:
            raise Unsupported(f"{child} has no link to {table}")
        rows = self.scan(child)
        rows = rows.filter(where) if where is not None else rows
        packed = F.array_sort(F.collect_list(F.struct(*order, value.alias("_value"))))
        grouped = rows.groupBy(*link.columns).agg(F.transform(packed, lambda x: x["_value"]).alias(name))
        on = [df[b] == grouped[a] for a, b in zip(link.columns, link.target, strict=True)]
        out = df.join(grouped, on, "left").drop(*[grouped[a] for a in link.columns])
        kind = out.schema[name].dataType
        return out.withColumn(name, F.coalesce(name, F.array().cast(kind)))

    def split(self, df: DataFrame, table: str, child: str, where: Column | None = None) -> DataFrame:
        """The child rows of the rows of df as a query of their own, instead of one join that repeats the parents.

        Both queries read the same files; the parents are reduced to their keys, so the semi join moves little.
        """
        link = next((x for x in self.tables[child].links if x.table == table), None)
        if link is None:
            raise Unsupported(f"{child} has no link to {table}")
        rows = self.scan(child)
        rows = rows.filter(where) if where is not None else rows
        keys = df.select(*(F.col(k).alias(f"_{k}") for k in link.target))
        return rows.join(keys, [F.col(a) == F.col(f"_{b}") for a, b in zip(link.columns, link.target, strict=True)], "left_semi")

    def register(self, names: Iterable[str] | None = None) -> None:
        """Temporary views for raw SQL."""
        for name in names or [*self.tables, *self.views]:
            self.scan(name).createOrReplaceTempView(name)

    def discover(self) -> DataFrame:
        """table, column, type, nullable and place in key of every table, from the Parquet footers."""
        rows = [(t.name, f.name, f.dataType.simpleString(), f.nullable, t.key.index(f.name) + 1 if f.name in t.key else None) for t in self.tables.values() for f in self.scan(t.name, True).schema]
        return self.spark.createDataFrame(rows, "table_name string, column_name string, data_type string, nullable boolean, key_place int")


def raw_sql(spark: SparkSession, text: str, tables: dict[str, DataFrame] | None = None, **args: object) -> DataFrame:
    """A composable SQL root.  Values are bound by name and never spliced into the text; {name} stands for a table."""
    return spark.sql(text, args=args or None, **(tables or {}))


def values(spark: SparkSession, rows: Sequence[object], kind: str = "string", ordinal: str = "_ord", name: str = "value") -> DataFrame:
    """A literal rowset that keeps its order in an ordinal column; an empty one is an error, as for VALUES."""
    if not rows:
        raise Unsupported("an inline rowset needs a row")
    column = T.StructType([T.StructField(ordinal, T.IntegerType(), False), T.StructField(name, T._parse_datatype_string(kind))])
    return spark.createDataFrame([(i, v) for i, v in enumerate(rows)], column)


def ordinal_name(taken: Iterable[str], base: str = "key") -> str:
    """A column name for ordinals that differs from the others by more than case."""
    used, name, n = {t.lower() for t in taken}, base, 0
    while name.lower() in used:
        name, n = f"{base}{n}", n + 1
    return name
