"""From booked visits to one row per location, category and day, and its history."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import days_between, document_text, local_to_utc_date, share_of_rows, weighted_mean
from ..operators.trailing import Series

SERIES_KEYS = ("location_id", "service_category")
DAY = "target_date"
PANEL_KEYS = (*SERIES_KEYS, DAY)

# What counts as organic demand.
FINAL_STATE = "final"
STAFF_CANCEL = "staff_cancel"
NON_ORGANIC_SOURCES = ("external", "migration")
ONLINE_SOURCE = "sched_booking_widget"

BEHAVIOUR = (
    "avg_lead_time_days",
    "booked_internally_ratio",
    "self_booked_ratio",
    "booked_online_ratio",
    "staff_requested_ratio",
    "avg_price_cents",
    "avg_discount_cents",
    "avg_discount_pct",
    "discount_adoption_ratio",
)


def qualifying_visits(appointments: DataFrame, cancellations: DataFrame) -> DataFrame:
    """Completed organic visits with their UTC day.

    A visit joins every one of its cancellation records and the result keeps
    those that pass. The records are counted per visit before the join, and
    `copies` says how many joined rows a visit stands for.
    """
    by_staff = F.col("reason") == STAFF_CANCEL
    records = cancellations.groupBy("appointment_id").agg(
        F.count("*").alias("records"), F.count_if(by_staff).alias("staff_records")
    )
    organic = appointments.where(
        (F.col("state") == FINAL_STATE)
        & ~F.col("source").isin(*NON_ORGANIC_SOURCES)
        & F.col("client_id").isNotNull()
    )
    took_place = F.col("cancelled") == F.lit(False)
    copies = F.when(took_place, F.coalesce("records", F.lit(1))).otherwise(F.coalesce("staff_records", F.lit(0)))
    return (
        organic.withColumnRenamed("id", "appointment_id")
        .join(records, "appointment_id", "left")
        .select(
            "appointment_id",
            "location_id",
            local_to_utc_date(F.col("time"), F.col("tz")).alias(DAY),
            "tz",
            "booked_by_id",
            "booked_by_client_id",
            "source",
            F.col("inserted_at").alias("booked_at"),
            copies.cast("bigint").alias("copies"),
        )
        .where("copies > 0")
    )


def with_service_label(
    df: DataFrame, services: DataFrame, categories: DataFrame, curated: DataFrame
) -> DataFrame:
    """Rows of `df` whose service is active, with the curated label of its category.

    The three dimensions are joined one after the other: each is a plain scan
    whose size Catalyst knows, so those that are small are broadcast and `df`
    is not shuffled for them.
    """
    offered = services.where("active").select(F.col("id").alias("service_id"), "category_id")
    active = categories.where("active").select(F.col("id").alias("category_id"), "name")
    label = document_text("service_classification", "$.labels[0]")
    labels = curated.select("name", label.alias("service_category")).where("service_category is not null")
    return (
        df.join(offered, "service_id").join(active, "category_id").join(labels, "name").drop("category_id", "name")
    )


OPTION_DELTAS = ("price", "duration", "finish_duration", "post_staff_duration", "post_client_duration")


def option_totals(options: DataFrame) -> DataFrame:
    """Options of a service line summed to one row, so a line with many does not fan out."""
    deltas = [F.sum(F.coalesce(f"{part}_delta", F.lit(0))).alias(f"{part}_delta") for part in OPTION_DELTAS]
    return options.groupBy(F.col("appointment_service_id").alias("line_id")).agg(
        F.count("*").alias("option_rows"), *deltas
    )


def with_options(lines: DataFrame, options: DataFrame) -> DataFrame:
    """Service lines with option sums; `option_rows` is how many option rows each line meets."""
    joined = lines.withColumnRenamed("id", "line_id").join(option_totals(options), "line_id", "left")
    filled = {f"{part}_delta": F.coalesce(f"{part}_delta", F.lit(0)) for part in OPTION_DELTAS}
    return joined.withColumns({"option_rows": F.coalesce("option_rows", F.lit(1)), **filled})


def _over_options(part: str):
    """Sum over a line's option rows of the base value plus each row's delta."""
    return F.col("option_rows") * F.col(part) + F.col(f"{part}_delta")


def daily_demand(visited_lines: DataFrame) -> DataFrame:
    """One row per location, category and day: counts, behaviour and hours.

    Every line of a visit, with its option sums, stands for `copies * option_rows`
    identical rows of the plain join, so all sums carry that weight and agree with
    it exactly.
    """
    copies = F.col("copies")
    weight = copies * F.col("option_rows")
    lead_days = days_between(F.col("booked_at").cast("date"), F.col(DAY))
    discount = F.coalesce("discount_cents", F.lit(0))
    discount_pct = F.coalesce("discount_percentage", F.lit(0.0))
    after_client = F.when(F.col("requires_focus"), _over_options("post_client_duration")).otherwise(F.lit(0))
    minutes = (
        _over_options("duration")
        + _over_options("finish_duration")
        + _over_options("post_staff_duration")
        + after_client
    )
    return (
        visited_lines.groupBy(*PANEL_KEYS)
        .agg(
            F.sum(weight).alias("demand_count"),
            weighted_mean(weight * lead_days, lead_days, weight).alias("avg_lead_time_days"),
            share_of_rows(F.col("booked_by_id").isNotNull(), weight).alias("booked_internally_ratio"),
            share_of_rows(F.col("booked_by_client_id").isNotNull(), weight).alias("self_booked_ratio"),
            share_of_rows(F.col("source") == ONLINE_SOURCE, weight).alias("booked_online_ratio"),
            share_of_rows(F.col("staff_requested"), weight).alias("staff_requested_ratio"),
            weighted_mean(copies * _over_options("price"), F.col("price"), weight).alias("avg_price_cents"),
            weighted_mean(weight * discount, discount, weight).alias("avg_discount_cents"),
            weighted_mean(weight * discount_pct, discount_pct, weight).alias("avg_discount_pct"),
            share_of_rows(discount > 0, weight).alias("discount_adoption_ratio"),
            weighted_mean(copies * _over_options("duration"), F.col("duration"), weight).alias("avg_duration_min"),
            (F.sum(copies * minutes) / F.lit(60.0)).alias("provider_hours_demanded"),
        )
    )


def labelled_lines(tables: Mapping[str, DataFrame]) -> DataFrame:
    return with_service_label(
        tables["appointment_services"],
        tables["services"],
        tables["service_categories"],
        tables["service_categories_curated"],
    )


def booked_lines(tables: Mapping[str, DataFrame]) -> DataFrame:
    return with_options(labelled_lines(tables), tables["appointment_service_options"])


def demand_from_sources(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Visits come before options: lines of visits that do not count never move to the option join."""
    visits = qualifying_visits(tables["appointments"], tables["appointment_cancellations"])
    visited = labelled_lines(tables).join(visits, "appointment_id")
    return daily_demand(with_options(visited, tables["appointment_service_options"]))


LAGS = (7, 14, 28, 364)


def rolling_demand(daily: DataFrame, calendar: bool = False) -> DataFrame:
    """History features of each series; same-day behaviour becomes a trailing average."""
    series = Series(SERIES_KEYS, DAY, calendar)
    features = []
    for measure, prefix in (("demand_count", "count_appts"), ("provider_hours_demanded", "hours_provider")):
        features += [series.total(measure, n).alias(f"{prefix}_l{n}d") for n in (7, 30)]
        features.append(series.weekday_mean(measure).alias(f"{prefix}_dow_avg"))
        features += [series.lag(measure, n).alias(f"{prefix}_lag_{n}d") for n in LAGS]
        features.append(series.trend(measure).alias(f"{prefix}_trend_4w"))
    features.append(
        series.ratio("provider_hours_demanded", "demand_count", 30).alias("hours_provider_per_appt_l30d")
    )
    features += [series.mean(measure, 30).alias(measure) for measure in BEHAVIOUR]
    return daily.select(*PANEL_KEYS, "demand_count", "provider_hours_demanded", "avg_duration_min", *features)
