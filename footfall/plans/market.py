"""Demand of the market a location belongs to: all locations that share a code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clamped_difference
from ..operators.trailing import Series
from .demand import DAY
from .dimensions import ZIP3_LENGTH

SHARED_MEASURES = tuple(
    f"{prefix}_{suffix}"
    for prefix in ("count_appts", "hours_provider")
    for suffix in ("l7d", "l30d", "lag_7d", "lag_28d")
)


def market_daily(daily: DataFrame, profile: DataFrame, market: str) -> DataFrame:
    """Daily totals per market and category; `market` is a column of the location profile."""
    members = profile.where(F.col(market).isNotNull()).select("location_id", market)
    return (
        daily.select("location_id", "service_category", DAY, "demand_count", "provider_hours_demanded")
        .join(members, "location_id")
        .groupBy(market, "service_category", DAY)
        .agg(
            # The panel has one row per location, category and day.
            F.count("*").alias("num_locations"),
            F.sum("demand_count").alias("demand_count"),
            F.sum("provider_hours_demanded").alias("hours_demanded"),
        )
    )


def widened(narrow: DataFrame) -> DataFrame:
    """Totals of the wide market from those of the narrow one: a location has one postal code, a code one prefix."""
    totals = ("num_locations", "demand_count", "hours_demanded")
    prefix = F.left("location_zip", F.lit(ZIP3_LENGTH)).alias("location_zip3")
    return narrow.groupBy(prefix, "service_category", DAY).agg(*[F.sum(c).alias(c) for c in totals])


def market_rolling(totals: DataFrame, market: str, prefix: str, calendar: bool = False) -> DataFrame:
    """Trailing windows over market days, columns named `prefix_*`. Totals include every member."""
    series = Series((market, "service_category"), DAY, calendar)
    features = [F.col("num_locations").alias(f"{prefix}_num_locations")]
    for measure, name in (("demand_count", "count_appts"), ("hours_demanded", "hours_provider")):
        features += [series.total(measure, n).alias(f"{prefix}_{name}_l{n}d") for n in (7, 30)]
        features.append(series.weekday_mean(measure).alias(f"{prefix}_{name}_dow_avg"))
        features += [series.lag(measure, n).alias(f"{prefix}_{name}_lag_{n}d") for n in (7, 28)]
    return totals.select(market, "service_category", DAY, *features)


def market_features(daily: DataFrame, profile: DataFrame, calendar: bool = False) -> DataFrame:
    """Windows of both market levels, one row per postal code, category and day.

    Every postal code lies in one prefix, so the wide totals are sums of the narrow
    ones, the wide market is attached to the narrow one, and the far larger location
    panel is read, joined and moved once for both.
    """
    totals = market_daily(daily, profile, "location_zip")
    narrow = market_rolling(totals, "location_zip", "zip", calendar)
    wide = market_rolling(widened(totals), "location_zip3", "zip3", calendar)
    prefix = F.left("location_zip", F.lit(ZIP3_LENGTH))
    return narrow.withColumn("location_zip3", prefix).join(
        wide, ["location_zip3", "service_category", DAY], "left"
    ).drop("location_zip3")


def competitor_columns(prefix: str):
    """Market minus own demand, market-level weekday averages, and the member count."""
    own = [
        clamped_difference(F.col(f"{prefix}_{m}"), F.col(m)).alias(f"comp_{prefix}_{m}") for m in SHARED_MEASURES
    ]
    return [
        *own,
        F.col(f"{prefix}_count_appts_dow_avg"),
        F.col(f"{prefix}_hours_provider_dow_avg"),
        F.coalesce(f"{prefix}_num_locations", F.lit(1)).alias(f"{prefix}_num_locations"),
    ]
