"""Time helpers on TIMESTAMP_NTZ trip times (wall clock, zone-independent)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pickup_hour(ts="tpep_pickup_datetime") -> Column:
    """Hour of day, 0-23 (X1); NULL for a NULL time."""
    return F.hour(_c(ts))


def elapsed_seconds(start: str, end: str) -> Column:
    """Whole seconds from ``start`` to ``end``, cut towards zero; whole seconds match the source's resolution.

    TIMESTAMP_NTZ cannot be cast to epoch seconds; its difference is an
    interval, which can (faster than ``timestampdiff``, with the same result).
    """
    return F.expr(f"CAST(CAST(`{end}` - `{start}` AS INTERVAL SECOND) AS BIGINT)")


def elapsed_minutes(start: str, end: str) -> Column:
    """Minutes from ``start`` to ``end`` as a double (X3)."""
    return elapsed_seconds(start, end) / F.lit(60.0)


def in_hour_window(ts, start_hour: int, end_hour: int) -> Column:
    """True when the hour of ``ts`` is in [start_hour, end_hour], wrapping midnight.

    Written as one ``hour(ts) IN (...)`` test so ``ts`` is referenced once:
    when the predicate is pushed below a projection that parses ``ts`` from
    text, a two-sided range would inline (and run) that parse twice per row.
    A NULL (unparseable) time yields NULL, which a filter treats as false.
    """
    if start_hour <= end_hour:
        hours = list(range(start_hour, end_hour + 1))
    else:
        hours = list(range(start_hour, 24)) + list(range(0, end_hour + 1))
    return F.hour(_c(ts)).isin(hours)


# The night window is 23:00 through 06:59.
NIGHT_START_HOUR = 23
NIGHT_END_HOUR = 6


def is_night(ts="tpep_pickup_datetime") -> Column:
    """Night trip predicate: hour 23 or hours 0-6 (F8)."""
    return in_hour_window(ts, NIGHT_START_HOUR, NIGHT_END_HOUR)
