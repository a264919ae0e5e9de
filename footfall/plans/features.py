"""The feature table: every stage joined to one row per location, category and day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_columns, days_between, round_ratio
from ..operators.nearby import with_holiday_distance
from ..session import cut
from . import dimensions
from .demand import BEHAVIOUR, DAY, PANEL_KEYS, demand_from_sources, rolling_demand
from .market import competitor_columns, market_features

# Start of history, menu defaults, plausibility bound.
FIRST_DAY = date(2023, 1, 1)
DEFAULT_DURATION_MIN = 60.0
DEFAULT_PRICE_CENTS = 5000.0
MAX_HOURS_PER_BOOKING = 8

KEY_ATTRIBUTES = (
    "location_city",
    "location_zip3",
    "license_tier",
    "avg_provider_tenure_days",
    "sf_industry",
    "sf_segment",
)

HISTORY = (
    "count_appts_l7d", "count_appts_l30d", "count_appts_dow_avg",
    "count_appts_lag_7d", "count_appts_lag_14d", "count_appts_lag_28d", "hours_provider_lag_7d",
    "count_appts_lag_364d", "count_appts_trend_4w",
    "hours_provider_l7d", "hours_provider_l30d", "hours_provider_lag_14d", "hours_provider_lag_28d",
    "hours_provider_lag_364d", "hours_provider_trend_4w", "hours_provider_per_appt_l30d",
    "hours_provider_dow_avg",
)
ACCOUNT = (
    "sf_active_locations", "sf_total_arr", "sf_avg_gmv_per_loc", "sf_gpv_per_appt", "sf_take_rate",
    "sf_initial_acv", "sf_vertical", "sf_segment", "sf_plan_type", "sf_is_enterprise", "sf_is_franchise",
    "sf_is_corporate", "sf_payment_processing", "sf_account_tenure", "sf_est_monthly_appts",
    "sf_industry", "sf_account_type",
)
REFERENCE = ("location_country", "location_province", "location_zip", "location_tz", "sf_created_date")


def utilisation_rate() -> Column:
    """Recent booked hours per day against the hours the team offers."""
    duration = F.coalesce("avg_menu_duration_min", F.lit(DEFAULT_DURATION_MIN))
    booked = F.col("count_appts_l7d") / F.lit(7.0) * duration / F.lit(60.0)
    offered = F.col("total_available_hours")
    return F.when(offered > 0, round_ratio(booked / F.nullif(offered, F.lit(0.0)))).otherwise(F.lit(0.0))


def feature_columns() -> list[Column | str]:
    """The 103 output columns in their fixed order."""
    return [
        *PANEL_KEYS,
        "provider_hours_demanded",
        "demand_count",
        *calendar_columns(F.col(DAY)),
        "is_holiday",
        "days_to_nearest_holiday",
        days_between(F.col("location_created_date"), F.col(DAY)).alias("location_age_days"),
        "latitude", "longitude", "location_state", "location_city", "location_zip3", "license_tier",
        "location_staff_count", "avg_provider_tenure_days", "num_providers_scheduled", "total_available_hours",
        utilisation_rate().alias("utilization_rate_recent"),
        F.coalesce("num_services_offered", F.lit(0)).alias("num_services_offered"),
        F.coalesce("avg_menu_duration_min", F.lit(DEFAULT_DURATION_MIN)).alias("avg_service_duration_min"),
        F.coalesce("avg_menu_price_cents", F.lit(DEFAULT_PRICE_CENTS)).alias("avg_service_price_cents"),
        F.coalesce("num_qualified_providers", F.lit(0)).alias("num_qualified_providers"),
        *HISTORY,
        *competitor_columns("zip3"),
        *competitor_columns("zip"),
        *BEHAVIOUR,
        *dimensions.MESSAGE_SPANS,
        *ACCOUNT,
        *REFERENCE,
    ]


def location_dimension(tables: dict[str, DataFrame], profile: DataFrame) -> DataFrame:
    """Everything known per location, for locations with all key attributes."""
    account = dimensions.account_profile(tables["locations"], tables["crm_account"])
    offered = dimensions.services_per_location(tables["locations"], tables["services"])
    capacity = dimensions.scheduled_capacity(tables["staff_locations"], tables["staff"])
    return (
        profile.join(account, "location_id")
        .join(offered, "location_id", "left")
        .join(capacity, "location_id", "left")
        .dropna(subset=list(KEY_ATTRIBUTES))
    )


def feature_table(
    tables: dict[str, DataFrame],
    holidays: DataFrame,
    as_of: date,
    first_day: date = FIRST_DAY,
    calendar: bool = False,
) -> DataFrame:
    """Features of all days in [`first_day`, `as_of`).

    The daily panel feeds five branches (own history, two markets, messages,
    spine). It is cut once, so the fact tables are scanned and shuffled once.
    The location profile is cut as well: its stored size tells Catalyst whether
    the market joins may broadcast it.
    Day bounds apply after the windows: early rows still see earlier history.
    """
    daily = cut(demand_from_sources(tables))
    profile = cut(
        dimensions.location_profile(tables["locations"], tables["staff_locations"], tables["staff"], as_of)
    )
    markets = market_features(daily, profile, calendar)
    messages = dimensions.messages_daily(tables["marketing_email"], tables["marketing_sms"])
    sent = dimensions.message_window(daily, messages)
    menu = dimensions.menu_stats(
        tables["locations"], tables["services"], tables["service_categories"], tables["service_rules"]
    )

    day, hours = F.col(DAY), F.col("provider_hours_demanded")
    panel = rolling_demand(daily, calendar).where(
        day.between(F.lit(first_day), F.date_sub(F.lit(as_of), 1))
        & hours.isNotNull()
        & (hours / F.col("demand_count") <= MAX_HOURS_PER_BOOKING)
    )
    # The panel keeps the placement of its windows for the menu, then moves once
    # for what is known per location and day and once for the markets. No move
    # is by location alone, so a location with very many rows stays spread out.
    located_days = sent.join(location_dimension(tables, profile), "location_id")
    located = (
        panel.join(menu, ["location_id", "service_category"], "left")
        .join(located_days, ["location_id", DAY])
        .join(markets, ["location_zip", "service_category", DAY], "left")
    )
    return with_holiday_distance(located, DAY, holidays).select(*feature_columns())
