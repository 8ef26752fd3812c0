"""Epoch milliseconds, timestamps and their calendar parts.

Timestamps are ``TIMESTAMP_NTZ``: a start time is the UTC wall clock whatever the session's time
zone is, so the same log gives the same dates on every cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def epoch_ms_to_ts(column: Column | str, unit: str = "second") -> Column:
    """Epoch milliseconds to a timestamp, to the whole second unless ``unit="ms"``."""
    if unit == "second":
        return F.expr(_EPOCH) + F.expr("interval '1' second") * F.call_function(
            "div", _col(column), F.lit(1000)
        )
    if unit == "ms":
        return F.expr(_EPOCH) + F.expr("interval '0.001' second") * _col(column)
    raise ValueError(f"unit is 'second' or 'ms', not {unit!r}")


def _since_epoch(column: Column | str) -> Column:
    return _col(column).cast("timestamp_ntz") - F.expr(_EPOCH)


def ts_to_epoch_seconds(column: Column | str) -> Column:
    """Whole seconds since 1970, cut towards it."""
    return _since_epoch(column).cast("interval second").cast("bigint")


def ts_to_epoch_ms(column: Column | str) -> Column:
    """Whole milliseconds since 1970, cut towards it."""
    # A thousand times the interval has the milliseconds as its seconds: integers throughout.
    return (_since_epoch(column) * F.lit(1000)).cast("interval second").cast("bigint")


CALENDAR_PARTS: dict[str, Callable[[Column], Column]] = {
    "hour": F.hour,
    "day": F.dayofmonth,
    "week": F.weekofyear,
    "month": F.month,
    "year": F.year,
}
_WEEKDAYS: dict[str, Callable[[Column], Column]] = {
    "iso": lambda ts: F.weekday(ts) + 1,  # Monday 1 .. Sunday 7
    "sun0": lambda ts: F.dayofweek(ts) - 1,  # Sunday 0 .. Saturday 6
}


def calendar_part(column: Column | str, part: str, weekday: str = "iso") -> Column:
    ts = _col(column)
    return _WEEKDAYS[weekday](ts) if part == "weekday" else CALENDAR_PARTS[part](ts)


def calendar_parts(
    df: DataFrame,
    ts: str,
    parts: Iterable[str] = ("hour", "day", "week", "month", "year", "weekday"),
    weekday: str = "iso",
) -> DataFrame:
    """Add one integer column per calendar part of ``ts``; weeks are ISO weeks."""
    return df.withColumns({part: calendar_part(ts, part, weekday) for part in parts})
