"""Mathematical functions.  Arguments outside a function's domain give null, not NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skeinwork.functions.logic import greatest, least

max2, min2 = greatest, least


def _real(x: Column) -> Column:
    return F.nanvl(x, F.lit(None).cast("double"))


def absolute(x: Column) -> Column:
    return F.abs(x)


def acos(x: Column) -> Column:
    return _real(F.acos(x))


def asin(x: Column) -> Column:
    return _real(F.asin(x))


def atan(x: Column) -> Column:
    return F.atan(x)


def atan2(y: Column, x: Column) -> Column:
    return F.atan2(y, x)


def acosh(x: Column) -> Column:
    return _real(F.acosh(x))


def asinh(x: Column) -> Column:
    return F.asinh(x)


def atanh(x: Column) -> Column:
    return F.when(F.abs(x) < 1, F.atanh(x))


def ceiling(x: Column) -> Column:
    return F.ceil(x)


def floor(x: Column) -> Column:
    return F.floor(x)


def cos(x: Column) -> Column:
    return F.cos(x)


def sin(x: Column) -> Column:
    return F.sin(x)


def tan(x: Column) -> Column:
    return F.tan(x)


def cosh(x: Column) -> Column:
    return F.cosh(x)


def sinh(x: Column) -> Column:
    return F.sinh(x)


def tanh(x: Column) -> Column:
    return F.tanh(x)


def radians(x: Column) -> Column:
    return F.radians(x)


def degrees(x: Column) -> Column:
    return F.degrees(x)


def exp(x: Column) -> Column:
    return F.exp(x)


def log(x: Column, base: Column | None = None) -> Column:
    """Natural logarithm, or to a base; null for arguments that are not positive and for base 1."""
    return F.ln(x) if base is None else F.when((x > 0) & (base > 0) & (base != 1), F.try_divide(F.ln(x), F.ln(base)))


def log10(x: Column) -> Column:
    return F.log10(x)


def log2(x: Column) -> Column:
    return F.log2(x)


def power(x: Column, y: Column) -> Column:
    return _real(F.pow(x, y))


def rounded(x: Column, digits: int = 0) -> Column:
    """Halves away from zero."""
    return F.round(x, digits)


def sign(x: Column) -> Column:
    return F.signum(x).cast("int")


def sqrt(x: Column) -> Column:
    return _real(F.sqrt(x))


def truncate(x: Column) -> Column:
    """Towards zero."""
    return F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x)).cast("double")
