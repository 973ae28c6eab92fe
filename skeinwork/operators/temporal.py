"""System-versioned relations: reads at points and ranges in time, and the upkeep of history.

A relation keeps its current rows and its history apart, each row valid from its start to, but without, its end.  Reads
filter both sides and concatenate them; equal payloads of different versions stay apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skeinwork.errors import Unsupported

#: The end of rows that are still current.
FOREVER = datetime(9999, 12, 31, 23, 59, 59)


@dataclass(frozen=True)
class Period:
    start: str = "valid_from"
    end: str = "valid_to"


def _utc(t: datetime) -> Column:
    if t.tzinfo is not None:
        if t.utcoffset() != timezone.utc.utcoffset(None):
            raise Unsupported("points in time are UTC")
        t = t.replace(tzinfo=None)
    return F.lit(t).cast("timestamp_ntz")


@dataclass(frozen=True)
class Versioned:
    """A system-versioned relation.  Reads carry how they were made, so that they combine only with reads made alike."""

    current: DataFrame
    history: DataFrame | None = None
    period: Period = Period()

    def _read(self, operation: str, bounds: tuple[datetime, ...], keep) -> TemporalRead:
        start, end = F.col(self.period.start), F.col(self.period.end)
        parts = [self.current] + ([self.history.select(*self.current.columns)] if self.history is not None else [])
        parts = [p if keep is None else p.filter(keep(start, end)) for p in parts]
        out = parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])
        return TemporalRead(out, operation, bounds)

    def as_of(self, t: datetime) -> TemporalRead:
        """Versions valid at t."""
        return self._read("as of", (t,), lambda s, e: (s <= _utc(t)) & (e > _utc(t)))

    def from_to(self, a: datetime, b: datetime) -> TemporalRead:
        """Versions valid at some time from a to, but without, b."""
        self._ordered(a, b)
        return self._read("from to", (a, b), lambda s, e: (s < _utc(b)) & (e > _utc(a)))

    def between(self, a: datetime, b: datetime) -> TemporalRead:
        """Like from_to, with versions that start at b."""
        self._ordered(a, b)
        return self._read("between", (a, b), lambda s, e: (s <= _utc(b)) & (e > _utc(a)))

    def contained_in(self, a: datetime, b: datetime) -> TemporalRead:
        """Versions that start and end within a and b, both included."""
        self._ordered(a, b)
        return self._read("contained in", (a, b), lambda s, e: (s >= _utc(a)) & (e <= _utc(b)))

    def all(self) -> TemporalRead:
        return self._read("all", (), None)

    @staticmethod
    def _ordered(a: datetime, b: datetime) -> None:
        if a > b:
            raise Unsupported("a range in time ends before it starts")


@dataclass(frozen=True)
class TemporalRead:
    rows: DataFrame
    operation: str
    bounds: tuple[datetime, ...]

    def _same(self, other: TemporalRead) -> None:
        if (self.operation, self.bounds) != (other.operation, other.bounds):
            raise Unsupported("temporal reads combine only with the same operation and points in time")

    def union(self, other: TemporalRead) -> DataFrame:
        self._same(other)
        return self.rows.unionAll(other.rows).distinct()

    def concat(self, other: TemporalRead) -> DataFrame:
        self._same(other)
        return self.rows.unionAll(other.rows)

    def navigate(self, other: Versioned | DataFrame, on: Column | str | list, how: str = "inner") -> DataFrame:
        """Joins a related relation as of the same time; ranges in time and relations without versions can't be followed."""
        if self.operation != "as of" or not isinstance(other, Versioned):
            raise Unsupported("only as-of reads can be followed, and only to versioned relations")
        return self.rows.join(other.as_of(*self.bounds).rows, on, how)

    def write(self, *_: object) -> None:
        raise Unsupported("a temporal read can't be changed")


def from_changes(df: DataFrame, key: Sequence[str], at: str, order: Sequence[str], period: Period = Period()) -> DataFrame:
    """Rows with their time of change as versions: each is valid until the next of its key."""
    following = F.lead(at).over(Window.partitionBy(*key).orderBy(at, *order))
    return df.withColumns({period.start: F.col(at), period.end: F.coalesce(following, F.lit(FOREVER).cast("timestamp_ntz"))})


def maintain(current: DataFrame, history: DataFrame, changes: DataFrame, key: Sequence[str], at: datetime, period: Period = Period(), operation: str = "_op") -> tuple[DataFrame, DataFrame]:
    """Current and history after a batch of changes (I, U or D in the operation column), all made at one time.

    Replaced and deleted rows go to history with their end set; versions that would be empty are not kept.
    """
    now = _utc(at)
    touched = current.join(changes.filter(F.col(operation).isin("U", "D")).select(*key), list(key), "left_semi")
    closed = touched.withColumn(period.end, now).filter(F.col(period.start) < now).select(*history.columns)
    fresh = changes.filter(F.col(operation).isin("I", "U")).withColumns({period.start: now, period.end: F.lit(FOREVER).cast("timestamp_ntz")}).select(*current.columns)
    return current.join(changes.select(*key), list(key), "left_anti").select(*current.columns).unionAll(fresh), history.unionAll(closed)
