"""Comparison, null, cast and bit operators with the semantics of the query vocabulary."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.errors import Unsupported


def eq_sql(a: Column, b: Column) -> Column:
    """Three-valued equality."""
    return a == b


def eq_objects(a: Column, b: Column) -> Column:
    """Two-valued equality: nulls are equal to each other and to nothing else."""
    return a.eqNullSafe(b)


def ne_objects(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def greatest(*values: Column) -> Column:
    """The largest, null if any is null."""
    return F.when(_any_null(values), None).otherwise(F.greatest(*values))


def least(*values: Column) -> Column:
    """The smallest, null if any is null."""
    return F.when(_any_null(values), None).otherwise(F.least(*values))


def _any_null(values: Sequence[Column]) -> Column:
    out = values[0].isNull()
    for v in values[1:]:
        out = out | v.isNull()
    return out


def coalesce_promoted(kind: str, *values: Column) -> Column:
    """Coalesce after every operand is promoted to one type."""
    return F.coalesce(*(v.cast(kind) for v in values))


def divide(a: Column, b: Column) -> Column:
    """Division with null for a zero divisor."""
    return F.try_divide(a, b)


def divide_integers(a: Column, b: Column) -> Column:
    """Integer division towards zero, null for a zero divisor."""
    return F.when(b != 0, F.call_function("div", a, F.nullif(b, F.lit(0).cast("long"))))


def modulo(a: Column, b: Column) -> Column:
    """Remainder with the dividend's sign, null for a zero divisor."""
    return F.try_mod(a, b)


def complement(a: Column) -> Column:
    return F.bitwise_not(a)


def bit_and(a: Column, b: Column) -> Column:
    return a.bitwiseAND(b)


def bit_or(a: Column, b: Column) -> Column:
    return a.bitwiseOR(b)


def bit_xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


_UINT = 4294967295
_BITS = {"int": 31, "long": 63, "uint": 31, "ulong": 63}
_TWO_64 = "18446744073709551616"


def _unsigned_bits(a: Column) -> Column:
    """The bit pattern of a decimal(20,0) as bigint."""
    return F.when(a >= F.lit("9223372036854775808").cast("decimal(20,0)"), (a - F.lit(_TWO_64).cast("decimal(20,0)")).cast("long")).otherwise(a.cast("long"))


def _from_bits(a: Column) -> Column:
    return F.when(a < 0, a.cast("decimal(20,0)") + F.lit(_TWO_64).cast("decimal(20,0)")).otherwise(a.cast("decimal(20,0)")).cast("decimal(20,0)")


def shift_left(a: Column, count: Column, kind: str = "int") -> Column:
    """a << count, the count masked to the width; int wraps, uint is held in a bigint, ulong in a decimal(20,0)."""
    by = count.cast("int").bitwiseAND(_mask(kind))
    if kind == "uint":
        return F.call_function("shiftleft", a.cast("long"), by).bitwiseAND(_UINT)
    if kind == "ulong":
        return _from_bits(F.call_function("shiftleft", _unsigned_bits(a.cast("decimal(20,0)")), by))
    return F.call_function("shiftleft", a.cast(kind), by)


def shift_right(a: Column, count: Column, kind: str = "int") -> Column:
    """a >> count: arithmetic for signed kinds, logical for unsigned ones."""
    by = count.cast("int").bitwiseAND(_mask(kind))
    if kind == "uint":
        return F.call_function("shiftright", a.cast("long"), by)
    if kind == "ulong":
        return _from_bits(F.call_function("shiftrightunsigned", _unsigned_bits(a.cast("decimal(20,0)")), by))
    return F.call_function("shiftright", a.cast(kind), by)


def _mask(kind: str) -> int:
    if kind not in _BITS:
        raise Unsupported(f"shifts of {kind}")
    return _BITS[kind]


def to_number(a: Column, kind: str) -> Column:
    """A cast that stops on invalid text; fractions are cut off."""
    return a.cast(kind)


def try_number(a: Column, kind: str) -> Column:
    """A cast with null for invalid text."""
    return a.try_cast(kind)


def to_decimal(a: Column) -> Column:
    """A fraction as decimal through its shortest text, so that 0.1 stays 0.1."""
    return a.cast("string").cast("decimal(38,18)")


def code_point(a: Column) -> Column:
    """The number of a one-character text."""
    return F.ascii(a)


def collate(a: Column, name: str) -> Column:
    """A text with a collation for its comparisons."""
    if not re.fullmatch(r"[A-Za-z0-9_]+", name):
        raise Unsupported(f"{name!r} is no name of a collation")
    return F.collate(a, name)


def compare_with_culture(*_: object) -> Column:
    """Comparisons by culture have no counterpart in collations."""
    raise Unsupported("comparison overloads with a culture are not supported; use collate()")


def like(a: Column, pattern: str, escape: str | None = None) -> Column:
    return F.like(a, F.lit(pattern), F.lit(escape)) if escape else a.like(pattern)


#: Lists up to this length are tested inline; longer ones become a table that is joined.
INLINE_VALUES = 1000


def in_values(df: DataFrame, column: str, items: Sequence[object]) -> DataFrame:
    """Rows whose value is in a list."""
    if len(items) <= INLINE_VALUES:
        return df.filter(F.col(column).isin(list(items)))
    kind = df.schema[column].dataType.simpleString()
    return df.join(df.sparkSession.createDataFrame([(x,) for x in items], f"_item {kind}"), F.col(column) == F.col("_item"), "left_semi")


def array_has(array: Column, item: Column) -> Column:
    """Membership in an array where a null item matches a null element; false without a match."""
    return F.coalesce(F.exists(array, lambda e: e.eqNullSafe(item)), F.lit(False))


def array_page_has(array: Column, item: Column, skip: int, take: int) -> Column:
    """Membership in a page of an array."""
    return array_has(F.slice(array, skip + 1, take), item)


def in_set(name: Column, listed: Column) -> Column:
    """Whether a name is in a comma-separated list."""
    return F.find_in_set(name, listed) > 0


def has_flag(a: Column, flag: int) -> Column:
    return a.bitwiseAND(F.lit(flag)) == flag


def enum_name(a: Column, names: dict[int, str]) -> Column:
    """The name of an enum's value, or its number as text."""
    out = a.cast("string")
    for value, name in names.items():
        out = F.when(a == value, name).otherwise(out)
    return out


def compare_to(a: Column, b: Column) -> Column:
    """-1, 0 or 1."""
    return F.when(a < b, -1).when(a == b, 0).when(a > b, 1)


def json_equal(a: Column, b: Column) -> Column:
    """Structural equality of JSON texts: the order of keys and white space don't count."""
    return F.to_json(F.try_parse_json(a)) == F.to_json(F.try_parse_json(b))
