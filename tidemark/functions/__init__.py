"""Column-level helpers: dates, predicates, aggregates, run clock."""
from .dates import add_days, add_hours, days_between, hours_between, keep_timestamp
from .predicates import non_blank, drop_unshipped_international
from .aggregates import max_if_complete, max_where

__all__ = [
    "add_days", "add_hours", "days_between", "hours_between", "keep_timestamp",
    "non_blank", "drop_unshipped_international",
    "max_if_complete", "max_where",
]
