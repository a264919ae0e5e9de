"""What is known of a location: profile, menu, capacity, account, messages."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import days_between, document_text, safe_ratio
from ..operators.nearby import daily_counts, trailing_counts_by_window
from ..session import cut

ADDRESS_FIELDS = ("country", "state", "province", "city", "zip")
ZIP3_LENGTH = 3
SHIFT_HOURS = 8.0


def location_profile(
    locations: DataFrame, staff_locations: DataFrame, staff: DataFrame, as_of: date
) -> DataFrame:
    """Address, tier and team of each location that is not deleted.

    The team is summed per location before the join, so a location with very
    many links stays one row on either side.
    """
    tenure = days_between(F.col("inserted_at").cast("date"), F.lit(as_of))
    tenures = staff.where("active").select(F.col("id").alias("staff_id"), tenure.alias("tenure_days"))
    team = (
        staff_locations.where("active")
        .select("location_id", "staff_id")
        .join(tenures, "staff_id", "left")
        .groupBy("location_id")
        .agg(
            F.count("staff_id").alias("location_staff_count"),
            F.avg("tenure_days").alias("avg_provider_tenure_days"),
        )
    )
    address = {name: document_text("address", f"$.{name}").alias(f"location_{name}") for name in ADDRESS_FIELDS}
    return (
        locations.where("deleted_at is null")
        .select(
            F.col("id").alias("location_id"),
            "license_tier",
            "latitude",
            "longitude",
            F.col("tz").alias("location_tz"),
            F.col("inserted_at").cast("date").alias("location_created_date"),
            *address.values(),
        )
        .withColumn("location_zip3", F.left("location_zip", F.lit(ZIP3_LENGTH)))
        .join(team, "location_id", "left")
        .withColumn("location_staff_count", F.coalesce("location_staff_count", F.lit(0)))
    )


def _active_menu(services: DataFrame, categories: DataFrame) -> DataFrame:
    active = categories.where("active").select(
        F.col("id").alias("category_id"), F.col("name").alias("service_category")
    )
    return (
        services.where("active")
        .select(
            "business_id", "category_id", F.col("id").alias("service_id"),
            F.col("duration").alias("menu_duration"), F.col("default_price").alias("menu_price"),
        )
        .join(active, "category_id")
        .drop("category_id")
    )


_RULED = (("duration", "set_duration"), ("price", "set_price"))


def rules_per_staff(rules: DataFrame) -> DataFrame:
    """Per location, service and staff member (NULL for rules of the location): its rules and what they set."""
    of_location = F.col("staff_id").isNull() & F.col("staff_role_id").isNull()
    of_staff = F.col("staff_id").isNotNull() & F.coalesce("set_bookable", F.lit(False))
    sums = []
    for name, column in _RULED:
        given = of_location & F.col(column).isNotNull()
        sums.append(F.sum(F.when(given, F.col(column))).alias(f"{name}_set"))
        sums.append(F.count_if(given).alias(f"{name}_given"))
    return (
        rules.where("deleted_at is null")
        .groupBy("location_id", "service_id", "staff_id")
        .agg(
            F.count_if(of_location).alias("own_rules"),
            F.count_if(of_staff).alias("staff_rules"),
            *sums,
        )
        .where("own_rules > 0 or staff_rules > 0")
    )


def rules_per_service(per_staff: DataFrame) -> DataFrame:
    """Per location and service: its own price and duration rules, and how many staff rules meet them."""
    names = ["own_rules", "staff_rules", *[f"{name}_{part}" for name, _ in _RULED for part in ("set", "given")]]
    return per_staff.groupBy("location_id", "service_id").agg(*[F.sum(n).alias(n) for n in names])


def menu_stats(
    locations: DataFrame, services: DataFrame, categories: DataFrame, rules: DataFrame
) -> DataFrame:
    """Menu averages per location and category under the rule cascade.

    A location offers every service of its business, and each such pair meets
    the location's rules for it, then the staff rules. Instead of forming the
    pairs, the menu is summed once per business and category, and only pairs
    that do have rules add the difference the rules make. Rules are read once
    and reduced to location, service and staff member before they meet the
    menu, so a much-ruled service is no hot join key of raw rules.
    """
    menu = cut(_active_menu(services, categories))
    # Two columns of a small table; writing it costs more than reading it again.
    sites = locations.select(F.col("id").alias("location_id"), "business_id")
    per_staff = cut(rules_per_staff(rules))
    grain = ["location_id", "service_category"]

    plain = []
    for name, _ in _RULED:
        plain.append(F.coalesce(F.sum(f"menu_{name}"), F.lit(0)).alias(f"{name}_total"))
        plain.append(F.count(f"menu_{name}").alias(f"{name}_rows"))
    per_business = menu.groupBy("business_id", "service_category").agg(
        F.countDistinct("service_id").alias("num_services_in_category"), *plain
    )
    base = sites.join(per_business, "business_id")

    # Rules outside the location's business or the active menu have no pair.
    ruled = (
        rules_per_service(per_staff)
        .join(menu, "service_id")
        .join(sites, ["location_id", "business_id"])
    )
    staff_rows = F.greatest("staff_rules", F.lit(1))
    own_rows = F.greatest("own_rules", F.lit(1))
    changes = []
    for name, _ in _RULED:
        standard = F.coalesce(f"menu_{name}", F.lit(0))
        has_standard = F.col(f"menu_{name}").isNotNull().cast("bigint")
        open_rows = own_rows - F.col(f"{name}_given")
        total = staff_rows * (F.coalesce(f"{name}_set", F.lit(0)) + open_rows * standard)
        rows = staff_rows * (F.col(f"{name}_given") + open_rows * has_standard)
        changes.append(F.sum(total - standard).alias(f"{name}_total_change"))
        changes.append(F.sum(rows - has_standard).alias(f"{name}_rows_change"))
    change = ruled.groupBy(*grain).agg(*changes)

    qualified = (
        per_staff.where("staff_rules > 0")
        .select("location_id", "service_id", "staff_id")
        .join(menu, "service_id")
        .join(sites, ["location_id", "business_id"])
        .groupBy(*grain)
        .agg(F.countDistinct("staff_id").alias("num_qualified_providers"))
    )

    def mean(name: str):
        changed = {
            part: F.col(f"{name}_{part}") + F.coalesce(f"{name}_{part}_change", F.lit(0)) for part in ("total", "rows")
        }
        return safe_ratio(changed["total"], changed["rows"])

    return (
        base.join(change, grain, "left")
        .join(qualified, grain, "left")
        .select(
            *grain,
            mean("duration").alias("avg_menu_duration_min"),
            mean("price").alias("avg_menu_price_cents"),
            "num_services_in_category",
            F.coalesce("num_qualified_providers", F.lit(0)).alias("num_qualified_providers"),
        )
    )


def services_per_location(locations: DataFrame, services: DataFrame) -> DataFrame:
    """Number of active services of the location's business, counted once per business."""
    offered = (
        services.where("active").groupBy("business_id").agg(F.countDistinct("id").alias("num_services_offered"))
    )
    return locations.select(F.col("id").alias("location_id"), "business_id").join(offered, "business_id").drop(
        "business_id"
    )


def scheduled_capacity(staff_locations: DataFrame, staff: DataFrame, shift_hours: float = SHIFT_HOURS) -> DataFrame:
    """Active staff of each location and the hours they offer per day."""
    active = staff.where("active").select(F.col("id").alias("staff_id"))
    return (
        staff_locations.where("active")
        .join(active, "staff_id")
        .groupBy("location_id")
        .agg(F.countDistinct("staff_id").alias("num_providers_scheduled"))
        .withColumn("total_available_hours", F.col("num_providers_scheduled") * F.lit(shift_hours))
    )


# Output column -> (account column, value where the account has none).
ACCOUNT_NUMBERS = {
    "sf_active_locations": ("no_of_active_locations_c", 1),
    "sf_total_arr": ("total_arr_c", 0.0),
    "sf_avg_gmv_per_loc": ("avg_gmv_per_location_c", 0.0),
    "sf_gpv_per_appt": ("gpv_per_appointment_c", 0.0),
    "sf_take_rate": ("take_rate_c", 0.0),
    "sf_initial_acv": ("initial_acv_c", 0.0),
    "sf_est_monthly_appts": ("est_monthly_appointments_c", 0),
    "sf_account_tenure": ("tenure_c", 0),
}
ACCOUNT_FLAGS = {
    "sf_is_enterprise": "enterprise_c",
    "sf_is_franchise": "franchise_c",
    "sf_is_corporate": "corporate_account_c",
    "sf_payment_processing": "payment_processing_c",
}
ACCOUNT_TEXTS = {
    "sf_industry": "industry",
    "sf_account_type": "type",
    "sf_segment": "segment_c",
    "sf_plan_type": "plan_type_c",
    "sf_created_date": "created_date",
}


def account_profile(locations: DataFrame, accounts: DataFrame) -> DataFrame:
    """CRM attributes per location, with neutral defaults where there is no account."""
    numbers = [F.coalesce(c, F.lit(d)).alias(name) for name, (c, d) in ACCOUNT_NUMBERS.items()]
    flags = [F.coalesce(c, F.lit(False)).cast("int").alias(name) for name, c in ACCOUNT_FLAGS.items()]
    texts = [F.col(c).alias(name) for name, c in ACCOUNT_TEXTS.items()]
    vertical = F.coalesce("sales_vertical_c", F.lit("Unknown")).alias("sf_vertical")
    present = locations.where("deleted_at is null").select(
        F.col("id").alias("location_id"), F.col("crm_account_id")
    )
    account = accounts.withColumnRenamed("id", "crm_account_id")
    return present.join(account, "crm_account_id", "left").select(
        "location_id", vertical, *texts, *numbers, *flags
    )


MESSAGE_SPANS = {
    "email_msgs_l30d": ("email", 30),
    "sms_msgs_l7d": ("sms", 7),
    "total_msgs_l30d": (None, 30),
}


def messages_daily(email: DataFrame, sms: DataFrame) -> DataFrame:
    """Messages per location, day and channel."""
    return daily_counts(email, ["location_id"], "sent_at", "email").unionByName(
        daily_counts(sms, ["location_id"], "sent_at", "sms")
    )


def message_window(panel: DataFrame, messages: DataFrame) -> DataFrame:
    """Messages a location sent in the days before each day of the panel."""
    return trailing_counts_by_window(panel, messages, "location_id", "target_date", MESSAGE_SPANS)
