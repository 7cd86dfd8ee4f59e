"""Aggregate expressions; all support partial (map-side) aggregation."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def max_if_complete(c) -> Column:
    """MAX of ``c``, or NULL when any row of the group has ``c`` NULL.

    ``count(*) = count(c)`` holds exactly when no value is NULL.
    """
    c = _col(c)
    return F.when(F.count(F.lit(1)) == F.count(c), F.max(c))


def max_where(cond: Column, value) -> Column:
    """Conditional MAX: MAX over the rows where ``cond`` holds."""
    return F.max(F.when(cond, _col(value)))
