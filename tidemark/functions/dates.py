"""Date arithmetic with warehouse semantics, all JVM-side expressions.

``days_between``/``hours_between`` count whole *elapsed* units from ``start``
to ``end``, cut toward zero (23:00 -> 01:00 next day is 0 days, 2 hours).
This is ``timestampdiff``, not ``datediff`` (which counts midnights).
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    """Columns pass through, strings name columns, anything else is a literal."""
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


def add_days(n, ts) -> Column:
    """``ts`` plus ``n`` days; NULL ``n`` gives NULL."""
    return F.timestamp_add("DAY", _c(n), _c(ts))


def add_hours(n, ts) -> Column:
    """``ts`` plus ``n`` hours; NULL ``n`` gives NULL."""
    return F.timestamp_add("HOUR", _c(n), _c(ts))


def days_between(start, end) -> Column:
    """Whole days elapsed from ``start`` to ``end`` (bigint)."""
    return F.timestamp_diff("DAY", _c(start), _c(end))


def hours_between(start, end) -> Column:
    """Whole hours elapsed from ``start`` to ``end`` (bigint)."""
    return F.timestamp_diff("HOUR", _c(start), _c(end))


def keep_timestamp(c) -> Column:
    """TO_TIMESTAMP of a value that already is a zone-less timestamp.

    ``to_timestamp`` would turn it into a session-zone timestamp; parsing to
    ``timestamp_ntz`` keeps the wall clock (identity on timestamps).
    """
    return F.to_timestamp_ntz(_c(c))


def central_time(ts) -> Column:
    """UTC instant shown in US Central time (daylight saving applies)."""
    return F.from_utc_timestamp(_c(ts), "America/Chicago")


def batch_id(ts) -> Column:
    """``yyyyMMddHHmmss`` text of a timestamp."""
    return F.date_format(_c(ts), "yyyyMMddHHmmss")
