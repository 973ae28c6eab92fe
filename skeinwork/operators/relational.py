"""Relational operators with the element, grouping and set semantics of the query vocabulary."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skeinwork.errors import NoElement, Unsupported

Order = Sequence[Column | str]


def _columns(order: Order) -> list[Column]:
    """Sort columns; a name with - before it is descending."""
    return [(F.col(o[1:]).desc() if o[0] == "-" else F.col(o)) if isinstance(o, str) else o for o in order]


def semi_any(left: DataFrame, right: DataFrame, on: Column | str | list) -> DataFrame:
    """Rows with at least one match (Any, EXISTS, IN)."""
    return left.join(right, on, "left_semi")


def anti(left: DataFrame, right: DataFrame, on: Column | str | list) -> DataFrame:
    """Rows without a match (NOT EXISTS); All(p) is the anti join with the negation of p."""
    return left.join(right, on, "left_anti")


def not_in(left: DataFrame, right: DataFrame, column: str, other: str) -> DataFrame:
    """NOT IN with three-valued logic: a null on the right leaves no row, a null on the left only rows if the right is empty.

    Two counts decide about nulls, so that the join itself is a plain equi-join.
    """
    counts = right.agg(F.count("*").alias("_all"), F.count_if(F.col(other).isNull()).alias("_nulls"))
    rows = left.join(right.select(F.col(other).alias("_other")), F.col(column) == F.col("_other"), "left_anti")
    flagged = rows.join(F.broadcast(counts))  # one row
    return flagged.filter((F.col("_all") == 0) | (F.col("_nulls") == 0) & F.col(column).isNotNull()).select(*left.columns)


def apply_top(left: DataFrame, right: DataFrame, on: Column, partition: Sequence[str], order: Order, n: int, outer: bool = False) -> DataFrame:
    """CROSS or OUTER APPLY of the first n matches of each row: a window over the right side's keys and an equi-join.

    partition names the columns of the right side that the condition equates, so each group is cut before it is joined.
    """
    rank = F.row_number().over(Window.partitionBy(*partition).orderBy(*_columns(order)))
    first = right.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
    return left.join(first, on, "left" if outer else "inner")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Order, n: int) -> DataFrame:
    """The first n rows of each group."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_columns(order)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def element_at(left: DataFrame, right: DataFrame, on: Column, partition: Sequence[str], order: Order, offset: Column, outer: bool = False) -> DataFrame:
    """The row at a place (from 0) that a column of the left side gives, among the matches of each row."""
    place = F.row_number().over(Window.partitionBy(*partition).orderBy(*_columns(order))) - 1
    return left.join(right.withColumn("_place", place), on & (F.col("_place") == offset), "left" if outer else "inner").drop("_place")


def skip_take(df: DataFrame, order: Order, skip: int = 0, *takes: int) -> DataFrame:
    """Skip, then any number of takes, of which the least counts; the order should end with a key."""
    out = df.orderBy(*_columns(order))
    if skip:
        out = out.offset(skip)
    return out.limit(min(takes)) if takes else out


def flipped(order: Sequence[str]) -> list[str]:
    """The reverse order (Last, Reverse); nulls change sides too."""
    return [o[1:] if o[0] == "-" else f"-{o}" for o in order]


def reverse(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*_columns(flipped(order)))


def first(df: DataFrame, order: Order, default: bool = False) -> DataFrame:
    """The first row as a DataFrame; without default an empty input is an error."""
    out = df.orderBy(*_columns(order)).limit(1)
    if not default and out.isEmpty():
        raise NoElement("the sequence has no element")
    return out


def last(df: DataFrame, order: Sequence[str], default: bool = False) -> DataFrame:
    return first(df, flipped(order), default)


def single(df: DataFrame, default: bool = False) -> DataFrame:
    """The only row; two rows are an error, and none unless default."""
    n = len(df.limit(2).collect())
    if n > 1 or not n and not default:
        raise NoElement("the sequence has no element" if not n else "the sequence has more than one element")
    return df.limit(1)


def max_or_error(df: DataFrame, column: str) -> object:
    """Max of a column without nulls; an empty input is an error."""
    value = df.agg(F.max(column)).first()[0]
    if value is None:
        raise NoElement("the sequence has no element")
    return value


def string_join(value: Column, separator: str | None, order: Order = (), distinct: bool = False) -> Column:
    """An ordered string aggregate: null values count as empty, a null separator is empty, no rows give an empty text.

    With distinct, each value stands at the place of the least of its order keys.
    """
    text = F.coalesce(value.cast("string"), F.lit(""))
    keys = [c.alias(f"_k{i}") for i, c in enumerate(_columns(order))]
    items = F.array_sort(F.collect_list(F.struct(*keys, text.alias("_v"))))
    shown = F.transform(items, lambda x: x["_v"])
    return F.coalesce(F.array_join(F.array_distinct(shown) if distinct else shown, separator or ""), F.lit(""))


def union_distinct(*parts: DataFrame) -> DataFrame:
    return concat(*parts).distinct()


def concat(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, by place."""
    out = parts[0]
    for part in parts[1:]:
        if len(part.columns) != len(out.columns):
            raise Unsupported("set operands need the same number of columns")
        out = out.unionAll(part)
    return out


def concat_distinct_sources(parts: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Concat under a collection projection: branches must read different tables, since their keys identify rows."""
    names = [name for name, _ in parts]
    if len(set(names)) < len(names):
        raise Unsupported("branches read the same table, so their keys don't identify rows")
    return concat(*(df for _, df in parts))


def hierarchy_union(parts: dict[str, DataFrame], discriminator: str) -> DataFrame:
    """One relation of a type hierarchy kept in a table for each type; missing columns are null."""
    out: DataFrame | None = None
    for name, df in parts.items():
        df = df.withColumn(discriminator, F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise Unsupported("a hierarchy needs a type")
    return out


def recursive(start: DataFrame, step: Callable[[DataFrame], DataFrame], key: Sequence[str], levels: int = 100, distinct: bool = True, folder: str | None = None) -> DataFrame:
    """A recursive query: step maps the last level's rows to the next level's.

    With distinct, rows whose key has been seen are dropped, so that cyclic data end; without it, levels must run out
    before the limit.  Each level is written out, which cuts the lineage; folder defaults to spark.checkpoint.dir.
    """
    spark = start.sparkSession
    base = folder or spark.conf.get("spark.checkpoint.dir", None)

    def cut(df: DataFrame) -> DataFrame:
        return df.checkpoint() if base else df.cache()

    level = cut(start.dropDuplicates(list(key)) if distinct else start)
    found = level
    for _ in range(levels):
        rows = step(level).select(*start.columns)
        if distinct:
            rows = rows.dropDuplicates(list(key)).join(found.select(*key), list(key), "left_anti")
        level = cut(rows)
        if level.isEmpty():
            return found
        found = found.unionAll(level)
    raise Unsupported(f"the recursion has more than {levels} levels")
