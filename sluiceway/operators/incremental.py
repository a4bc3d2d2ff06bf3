"""Cursor-based incremental loading as a pushed-down filter."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Boundary mode -> (start included, end included).
BOUNDARY_MODES = {
    None: (False, False),
    "start-end": (True, True),
    "start": (True, False),
    "end": (False, True),
    "between": (False, False),
}


@dataclass(frozen=True)
class Cursor:
    """What to load: the rows of `key` between the start (or stored) value and the end."""

    key: str
    start: int | datetime | date | str | None = None
    end: int | datetime | date | str | None = None
    lag: float | None = None
    boundary: str | None = None
    direction: str = "max"

    def __post_init__(self):
        if not self.key or not self.key.strip():
            raise ValueError("incremental_key must be provided")
        if self.boundary not in BOUNDARY_MODES:
            raise ValueError(f"boundary_mode must be one of start-end, start, end, between; got {self.boundary!r}")
        if self.direction not in ("max", "min"):
            raise ValueError(f"direction must be 'max' or 'min', got {self.direction!r}")

    @property
    def is_backfill(self) -> bool:
        """An end value makes the run a backfill, which leaves the stored cursor alone."""
        return self.end is not None


def cursor_text(value: Column, dtype: T.DataType) -> Column:
    """A cursor value as it is stored. An instant is its microseconds since 1970 in UTC, whatever the session's zone."""
    return (F.unix_micros(value) if isinstance(dtype, T.TimestampType) else value).cast("string")


def _bound(value, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType) and isinstance(value, str) and value.lstrip("-").isdigit():
        return F.timestamp_micros(F.lit(int(value)))
    return F.lit(value if isinstance(value, (int, float, str)) else str(value)).cast(dtype)


def _lagged(last: Column, lag: float, dtype: T.DataType, direction: str) -> Column:
    """The stored value moved back by the lag: seconds for timestamps, days for dates."""
    back = lag if direction == "max" else -lag
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        moved = last - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(back))
    elif isinstance(dtype, T.DateType):
        moved = F.date_sub(last, int(back))
    elif isinstance(dtype, T.IntegralType):
        moved = last - F.lit(int(back))
    else:
        moved = last - F.lit(back)
    return moved.cast(dtype)


def cursor_predicate(cursor: Cursor, dtype: T.DataType, last=None) -> Column:
    """The filter of one run, from literals only, so it reaches the scan.

    `last` is the stored cursor. The lower bound is the later of the start value
    and `last - lag`; for direction `min` everything is mirrored.
    """
    col = F.col(f"`{cursor.key}`")
    rising = cursor.direction == "max"
    start_in, end_in = BOUNDARY_MODES[cursor.boundary]
    lower = []
    if cursor.start is not None:
        lower.append(_bound(cursor.start, dtype))
    if last is not None and not cursor.is_backfill:
        stored = _bound(last, dtype)
        lower.append(_lagged(stored, cursor.lag, dtype, cursor.direction) if cursor.lag else stored)
    keep = col.isNotNull()
    if lower:
        pick = F.greatest if rising else F.least
        bound = pick(*lower) if len(lower) > 1 else lower[0]
        if rising:
            keep = keep & (col >= bound if start_in else col > bound)
        else:
            keep = keep & (col <= bound if start_in else col < bound)
    if cursor.end is not None:
        bound = _bound(cursor.end, dtype)
        if rising:
            keep = keep & (col <= bound if end_in else col < bound)
        else:
            keep = keep & (col >= bound if end_in else col > bound)
    return keep


def new_rows(df: DataFrame, cursor: Cursor, last=None) -> DataFrame:
    """Rows of this run. A NULL cursor is never loaded; see `cursor_metrics` for its count."""
    return df.filter(cursor_predicate(cursor, df.schema[cursor.key].dataType, last))


def cursor_metrics(cursor: Cursor) -> list[Column]:
    """Aggregates to observe while the rows pass: the next cursor and the NULL count."""
    col = F.col(f"`{cursor.key}`")
    pick = F.max if cursor.direction == "max" else F.min
    return [pick(col).cast("string").alias("cursor"), F.count_if(col.isNull()).alias("null_cursor")]


def whole_ties(df: DataFrame, key: str, limit: int, rising: bool = True, last=None) -> DataFrame:
    """About `limit` rows beyond `last` in cursor order, with every row that ties with the furthest of them.

    A cursor stored after such a run has no unread row behind it, so runs with a limit load
    everything, once. Rows up to `last` that the filter let through (a lag, a closed bound) stay.
    """
    dtype, col = df.schema[key].dataType, F.col(f"`{key}`")
    fresh = df
    if last is not None:
        fresh = df.filter(col > _bound(last, dtype) if rising else col < _bound(last, dtype))
    pick = F.max if rising else F.min
    first = fresh.select(col.alias("value")).orderBy(F.col("value").asc() if rising else F.col("value").desc()).limit(abs(limit))
    furthest = first.agg(cursor_text(pick("value"), dtype)).first()[0]  # one value
    if furthest is None:
        return df
    return df.filter(col <= _bound(furthest, dtype) if rising else col >= _bound(furthest, dtype))


def ordered(df: DataFrame, cursor: Cursor, row_order: str | None, tie_break: list[str], limit: int | None) -> DataFrame:
    """Cursor order with an optional limit, planned as one top-k."""
    if row_order not in ("asc", "desc", None):
        raise ValueError(f"row_order must be 'asc' or 'desc', got {row_order!r}")
    col = F.col(f"`{cursor.key}`")
    forward = (row_order or "asc") == "asc"
    if cursor.direction == "min":
        forward = not forward
    by = [col.asc() if forward else col.desc()] + [F.col(f"`{c}`").asc() for c in tie_break]
    return df.orderBy(*by).limit(abs(limit)) if limit else df.orderBy(*by)
