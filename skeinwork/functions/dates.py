"""Dates, times of day, spans and offset timestamps.

Timestamps are timestamp_ntz.  A time of day is a bigint of microseconds since midnight, and arithmetic on it wraps at
midnight.  A span is a bigint of ticks of 100 nanoseconds.  An offset timestamp is a sortable text
``yyyy-MM-dd HH:mm:ss.fffffff+hh:mm``, which keeps the seventh digit that a timestamp can't hold.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400_000_000  # microseconds
TICKS = {"days": 864_000_000_000, "hours": 36_000_000_000, "minutes": 600_000_000, "seconds": 10_000_000, "milliseconds": 10_000, "microseconds": 10}


# --- timestamps and dates


def add(ts: Column, unit: str, n: Column | int) -> Column:
    """Adds whole units (YEAR, MONTH, DAY, HOUR, MINUTE, SECOND); month ends are kept within the month."""
    return F.timestamp_add(unit, n if isinstance(n, Column) else F.lit(n), ts)


def add_to_date(d: Column, unit: str, n: Column | int) -> Column:
    """Adds DAY, MONTH or YEAR to a date."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.date_add(d, n) if unit == "DAY" else F.add_months(d, n * (12 if unit == "YEAR" else 1))


def micros(ts: Column) -> Column:
    """Microseconds of a timestamp's time of day."""
    return F.timestamp_diff("MICROSECOND", F.date_trunc("day", ts).cast("timestamp_ntz"), ts)


def year(ts: Column) -> Column:
    return F.year(ts)


def month(ts: Column) -> Column:
    return F.month(ts)


def day(ts: Column) -> Column:
    return F.dayofmonth(ts)


def hour(ts: Column) -> Column:
    return F.hour(ts)


def minute(ts: Column) -> Column:
    return F.minute(ts)


def second(ts: Column) -> Column:
    return F.second(ts)


def millisecond(ts: Column) -> Column:
    return F.floor(micros(ts) % 1_000_000 / 1000).cast("int")


def microsecond(ts: Column) -> Column:
    return (micros(ts) % 1000).cast("int")


def nanosecond(ts: Column) -> Column:
    """Always 0, since timestamps hold microseconds."""
    return F.when(ts.isNotNull(), 0)


def day_of_year(ts: Column) -> Column:
    return F.dayofyear(ts)


def day_of_week(ts: Column) -> Column:
    """0 for Sunday."""
    return F.dayofweek(ts) - 1


def date_part(ts: Column) -> Column:
    """Midnight of the day, as a timestamp."""
    return F.to_date(ts).cast("timestamp_ntz")


def time_of_day(ts: Column) -> Column:
    """Ticks since midnight."""
    return micros(ts) * 10


def day_number(d: Column) -> Column:
    """Days since 0001-01-01."""
    return F.unix_date(d.cast("date")) + 719162


def now() -> Column:
    return F.localtimestamp()


def utc_now() -> Column:
    """With the session's time zone UTC this is now()."""
    return F.localtimestamp()


def today() -> Column:
    return F.current_date()


def difference(a: Column, b: Column) -> Column:
    """Ticks from b to a."""
    return F.timestamp_diff("MICROSECOND", b, a) * 10


def date_from(ts: Column) -> Column:
    return F.to_date(ts)


def timestamp_from(d: Column, time: Column) -> Column:
    """A date and a time of day."""
    return F.timestamp_add("MICROSECOND", time, d.cast("timestamp_ntz"))


def parse(x: Column) -> Column:
    """A timestamp from text like 3/14/2021 09:26:53; null for other text."""
    return F.try_to_timestamp(x, F.lit("M/d/yyyy HH:mm:ss")).cast("timestamp_ntz")


def unix_seconds(ts: Column) -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


# --- times of day


def time(hours: int, minutes: int = 0, seconds: int = 0, microseconds: int = 0) -> Column:
    return F.lit(((hours * 60 + minutes) * 60 + seconds) * 1_000_000 + microseconds).cast("long")


def time_from(ts: Column) -> Column:
    return micros(ts)


def time_from_span(ticks: Column) -> Column:
    return F.floor(ticks / 10)


def time_add(t: Column, ticks: Column) -> Column:
    """Wraps at midnight."""
    return F.pmod(t + truncated(ticks, 10), F.lit(DAY))


def time_add_hours(t: Column, n: Column) -> Column:
    return F.pmod(t + (n.cast("double") * 3.6e9).cast("long"), F.lit(DAY))


def time_add_minutes(t: Column, n: Column) -> Column:
    return F.pmod(t + (n.cast("double") * 6e7).cast("long"), F.lit(DAY))


def time_difference(a: Column, b: Column) -> Column:
    """Ticks from b to a, within the day."""
    return (a - b) * 10


def time_between(t: Column, start: Column, end: Column) -> Column:
    """Start included, end excluded; a range that starts after its end goes over midnight."""
    return F.when(start <= end, (t >= start) & (t < end)).otherwise((t >= start) | (t < end))


# --- spans


def truncated(a: Column, by: int) -> Column:
    """Integer division towards zero."""
    return F.call_function("div", a, F.lit(by).cast("long"))


def span_part(ticks: Column, unit: str) -> Column:
    """A component of a span, with its sign: days, hours, minutes, seconds, milliseconds, microseconds or nanoseconds."""
    if unit == "nanoseconds":
        return (ticks % 10 * 100).cast("int")
    limit = {"days": None, "hours": 24, "minutes": 60, "seconds": 60, "milliseconds": 1000, "microseconds": 1000}[unit]
    whole = truncated(ticks, TICKS[unit])
    return (whole if limit is None else whole % limit).cast("int")


def span_total(ticks: Column, unit: str) -> Column:
    """A whole span in one unit, as a double."""
    return ticks * 100.0 if unit == "nanoseconds" else ticks / float(TICKS[unit])


def span_add(a: Column, b: Column) -> Column:
    return a + b


# --- offset timestamps


def offset_text(ts: Column, offset: str = "+00:00") -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("0" + offset))


_PLACES = {"year": (1, 4), "month": (6, 2), "day": (9, 2), "hour": (12, 2), "minute": (15, 2), "second": (18, 2), "millisecond": (21, 3), "microsecond": (24, 3)}


def offset_part(x: Column, unit: str) -> Column:
    """A component of an offset timestamp, in its own offset; nanoseconds come from the seventh digit."""
    if unit == "nanosecond":
        return F.substring(x, 27, 1).cast("int") * 100
    return F.substring(x, *_PLACES[unit]).cast("int")


def offset_date(x: Column) -> Column:
    return F.left(x, F.lit(10)).cast("timestamp_ntz")


def offset_day_of_year(x: Column) -> Column:
    return F.dayofyear(F.left(x, F.lit(10)).cast("date"))


def _offset_micros(x: Column) -> Column:
    size = (F.substring(x, 29, 2).cast("long") * 60 + F.substring(x, 32, 2).cast("long")) * 60_000_000
    return F.when(F.substring(x, 28, 1) == "-", -size).otherwise(size)


def _epoch_micros(x: Column) -> Column:
    local = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.left(x, F.lit(26)).cast("timestamp_ntz"))
    return local - _offset_micros(x)


def offset_unix_seconds(x: Column) -> Column:
    return F.floor(_epoch_micros(x) / 1_000_000)


def offset_unix_milliseconds(x: Column) -> Column:
    return F.floor(_epoch_micros(x) / 1000)


def offset_minus(x: Column, ticks: Column) -> Column:
    """An offset timestamp less a span; the offset and the seventh digit stay exact."""
    local = F.left(x, F.lit(26)).cast("timestamp_ntz")
    digit = F.substring(x, 27, 1).cast("long") - ticks
    moved = F.timestamp_add("MICROSECOND", F.floor(digit / 10), local)
    return F.concat(F.date_format(moved, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.pmod(digit, F.lit(10)).cast("string"), F.substring(x, 28, 6))
