"""Dates: local wall time to UTC day, weekday with Sunday = 0, calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SATURDAY, SUNDAY = 6, 0


def local_to_utc_date(wall_time: Column, zone: Column) -> Column:
    """UTC calendar day of a zone-less local time whose zone is in a column."""
    return F.convert_timezone(zone, F.lit("UTC"), wall_time.cast("timestamp_ntz")).cast("date")


def weekday(day: Column) -> Column:
    """0 = Sunday .. 6 = Saturday (Spark itself counts from 1)."""
    return F.dayofweek(day) - F.lit(1)


def days_between(start: Column, end: Column) -> Column:
    """Whole days from `start` to `end`; negative if `end` is earlier."""
    return F.datediff(end, start)


def calendar_columns(day: Column) -> list[Column]:
    return [
        weekday(day).alias("day_of_week"),
        F.dayofmonth(day).alias("day_of_month"),
        F.month(day).alias("month_num"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofyear(day).alias("day_of_year"),
        weekday(day).isin(SUNDAY, SATURDAY).cast("int").alias("is_weekend"),
    ]
