"""Set-based changes as rewrites: each returns the changed relation as a new DataFrame and leaves its input alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skeinwork.errors import Unsupported
from skeinwork.operators.relational import Order, _columns


def update(df: DataFrame, changes: dict[str, Column], where: Column | None = None) -> DataFrame:
    """New values for the rows that meet a condition; all are computed from the old ones."""
    met = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    return df.select(*(F.when(met, changes[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c) if c in changes else F.col(c) for c in df.columns))


def update_from(df: DataFrame, other: DataFrame, keys: Sequence[str], changes: dict[str, Column]) -> DataFrame:
    """An update from a joined relation with one row for each key; its columns are those of other, in changes too."""
    right = other.withColumn("_met", F.lit(True))
    joined = df.alias("t").join(right.alias("s"), list(keys), "left")
    return joined.select(*(F.when(F.col("_met"), changes[c]).otherwise(F.col(f"t.{c}")).cast(df.schema[c].dataType).alias(c) if c in changes else F.col(c if c in keys else f"t.{c}").alias(c) for c in df.columns))


def update_where_exists(df: DataFrame, other: DataFrame, on: Sequence[str], changes: dict[str, Column]) -> DataFrame:
    """An update of the rows with a match, however many."""
    return update_from(df, other.select(*on).distinct(), on, changes)


def delete(df: DataFrame, where: Column) -> DataFrame:
    """Without the rows that meet a condition; rows for which it is unknown stay."""
    return df.filter(~F.coalesce(where, F.lit(False)))


def delete_where_exists(df: DataFrame, other: DataFrame, on: Column | str | list) -> DataFrame:
    return df.join(other, on, "left_anti")


def delete_first(df: DataFrame, key: Sequence[str], where: Column, order: Order, n: int, offset: int = 0) -> DataFrame:
    """Without the first n rows, in an order, of those that meet a condition; the key breaks ties."""
    doomed = df.filter(where).orderBy(*_columns(order), *key).offset(offset).limit(n).select(*key)
    return df.join(doomed, list(key), "left_anti").select(*df.columns)


def update_first(df: DataFrame, key: Sequence[str], where: Column, order: Order, n: int, changes: dict[str, Column], offset: int = 0) -> DataFrame:
    chosen = df.filter(where).orderBy(*_columns(order), *key).offset(offset).limit(n).select(*key)
    return update_where_exists(df, chosen, key, changes)


def _portions(df: DataFrame, start: str, end: str, a: Column, b: Column) -> DataFrame:
    """Each row cut at a and b into at most three parts, with _inside telling which of them lies between."""
    s, e = F.col(start), F.col(end)
    part = lambda low, high, inside: F.when(low < high, F.struct(low.alias("s"), high.alias("e"), F.lit(inside).alias("i")))
    parts = F.array(part(s, F.least(e, a), False), part(F.greatest(s, a), F.least(e, b), True), part(F.greatest(s, b), e, False))
    out = df.withColumn("_p", F.explode(F.filter(parts, lambda p: p.isNotNull())))
    return out.withColumns({start: F.col("_p.s"), end: F.col("_p.e"), "_inside": F.col("_p.i")}).drop("_p")


def _range(a: Column, b: Column) -> tuple[Column, Column]:
    return a.cast("timestamp_ntz"), b.cast("timestamp_ntz")


def update_portion(df: DataFrame, a: object, b: object, changes: dict[str, Column], where: Column | None = None, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """An update for the time from a to, but without, b: rows are split where they reach beyond it."""
    if a >= b:
        raise Unsupported("a portion of time starts before it ends")
    met = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    flagged = df.withColumn("_met", met)
    cut = _portions(flagged.filter("_met"), start, end, *_range(F.lit(a), F.lit(b)))
    changed = update(cut, changes, F.col("_inside")).select(*df.columns)
    return flagged.filter("not _met").select(*df.columns).unionAll(changed)


def delete_portion(df: DataFrame, a: object, b: object, where: Column | None = None, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """A delete for the time from a to, but without, b; what lies outside stays."""
    if a >= b:
        raise Unsupported("a portion of time starts before it ends")
    met = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    flagged = df.withColumn("_met", met)
    cut = _portions(flagged.filter("_met"), start, end, *_range(F.lit(a), F.lit(b))).filter("not _inside").select(*df.columns)
    return flagged.filter("not _met").select(*df.columns).unionAll(cut)


def overlaps(df: DataFrame, key: Sequence[str], start: str = "valid_from", end: str = "valid_to", order: Sequence[str] = ()) -> DataFrame:
    """Rows that begin before an earlier row of their key has ended: violations of a key without overlaps."""
    before = Window.partitionBy(*key).orderBy(start, end, *order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_before", F.max(end).over(before)).filter(F.col(start) < F.col("_before")).drop("_before")


def save_changes(df: DataFrame, changes: DataFrame, key: Sequence[str], version: str | None = None, operation: str = "_op") -> tuple[DataFrame, DataFrame]:
    """The relation after inserts, updates and deletes by key, and the changes that were refused.

    With a version column, updates and deletes count only where their version is the stored one; it rises by one.
    """
    stored = df.select(*key, *([F.col(version).alias("_stored")] if version else []), F.lit(True).alias("_there"))
    checked = changes.join(stored, list(key), "left")
    there = F.coalesce(F.col("_there"), F.lit(False))
    fits = there & (F.col(version).eqNullSafe(F.col("_stored")) if version else F.lit(True))
    ok = F.when(F.col(operation) == "I", ~there).otherwise(fits)
    good, bad = checked.filter(ok), checked.filter(~ok).select(*changes.columns)
    if version:
        good = good.withColumn(version, F.when(F.col(operation) == "U", F.col(version) + 1).otherwise(F.col(version)).cast(df.schema[version].dataType))
    rest = df.join(good.filter(F.col(operation) != "I").select(*key), list(key), "left_anti").select(*df.columns)
    return rest.unionAll(good.filter(F.col(operation).isin("I", "U")).select(*df.columns)), bad


def next_keys(df: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows with keys after the largest of a relation, in the order of their other columns."""
    from skeinwork.sources.sinks import with_keys

    top = df.agg(F.coalesce(F.max(key), F.lit(0)).alias("m")).first().m
    return with_keys(rows, key, top + 1)


def row_numbers(df: DataFrame, keys: Sequence[str], order: Order, name: str = "row_number") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*_columns(order))))
