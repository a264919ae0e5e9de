"""Column helpers: every one returns a built-in Spark expression."""

from .calendar import calendar_columns, days_between, local_to_utc_date, weekday
from .documents import document_text
from .numbers import clamped_difference, round_ratio, safe_ratio, share_of_rows, weighted_mean

__all__ = [
    "calendar_columns",
    "clamped_difference",
    "days_between",
    "document_text",
    "local_to_utc_date",
    "round_ratio",
    "safe_ratio",
    "share_of_rows",
    "weekday",
    "weighted_mean",
]
