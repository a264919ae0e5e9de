"""Distance to the nearest marked day, and event counts in trailing day spans.

Both are range conditions. They are rewritten so that no join compares all
pairs: marked days are spread over the days they reach (an equi-join follows),
and event counts become a day-range window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def days_to_nearest(marked: DataFrame, marked_day: str, day: str, reach: int) -> DataFrame:
    """For every day within `reach` of a marked one: distance to the nearest.

    One row per day: its size follows the calendar, not the data.
    """
    at = F.col(marked_day)
    reached = F.sequence(F.date_sub(at, reach), F.date_add(at, reach))
    spread = marked.where(at.isNotNull()).select(at, F.explode(reached).alias(day))
    distance = F.abs(F.datediff(F.col(day), at))
    return spread.groupBy(day).agg(F.min(distance).alias("days_to_nearest"))


def with_holiday_distance(
    df: DataFrame, day: str, holidays: DataFrame, reach: int = 30, default: int = 60
) -> DataFrame:
    """Adds `is_holiday` and `days_to_nearest_holiday` (`default` beyond `reach`).

    The broadcast side has one row per calendar day at most, whatever the data.
    """
    nearest = F.broadcast(days_to_nearest(holidays, "holiday_date", day, reach))
    distance = F.col("days_to_nearest")
    return (
        df.join(nearest, [day], "left")
        .withColumn("is_holiday", F.coalesce((distance == 0).cast("int"), F.lit(0)))
        .withColumn("days_to_nearest_holiday", F.coalesce(distance, F.lit(default)))
        .drop("days_to_nearest")
    )


def _count_of(channel: str | None):
    counted = F.col("msg_count")
    return counted if channel is None else F.when(F.col("channel") == channel, counted)


def trailing_counts_by_window(
    spine: DataFrame,
    messages: DataFrame,
    key: str,
    day: str,
    spans: Mapping[str, tuple[str | None, int]],
) -> DataFrame:
    """Message counts in the `n` days before each (`key`, `day`) of the spine.

    `messages` has `key`, `msg_date`, `channel`, `msg_count`; `spans` maps an
    output column to (channel, or None for all channels, n).
    One pass over both inputs: union, day-range windows per key, keep the spine.
    """
    marked = spine.select(key, day).distinct().withColumn("on_spine", F.lit(True))
    sent = messages.select(key, F.col("msg_date").alias(day), "channel", "msg_count")
    both = marked.unionByName(sent, allowMissingColumns=True)
    ordered = Window.partitionBy(key).orderBy(F.unix_date(day))
    counts = [
        F.coalesce(F.sum(_count_of(channel)).over(ordered.rangeBetween(-n, -1)), F.lit(0)).alias(name)
        for name, (channel, n) in spans.items()
    ]
    return both.select(key, day, "on_spine", *counts).where("on_spine").drop("on_spine")


def daily_counts(df: DataFrame, keys: Sequence[str], at: str, channel: str) -> DataFrame:
    """Rows per key and day of `at`, tagged with `channel`; rows lacking a key are left out."""
    day = F.col(at).cast("date").alias("msg_date")
    present = df.dropna(subset=[*keys, at])
    counted = present.groupBy(*keys, day).agg(F.count("*").alias("msg_count"))
    return counted.withColumn("channel", F.lit(channel))
