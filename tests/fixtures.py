"""Small hand-made source tables; callers override single tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from footfall.sources.tables import SOURCE_SCHEMAS, conform, source_columns

from .conftest import at

DEFAULTS = {
    "appointments": dict(
        id="a1", location_id="L1", time=at("2026-04-03 10:00"), tz="UTC", booked_by_id=None,
        booked_by_client_id=None, source="front", inserted_at=at("2026-04-01 08:00"), state="final",
        cancelled=False, client_id="c1",
    ),
    "appointment_cancellations": dict(appointment_id="a1", reason="staff_cancel"),
    "appointment_services": dict(
        id="s1", appointment_id="a1", service_id="svc1", staff_requested=False, price=1000, discount_cents=0,
        discount_percentage=0.0, duration=60, finish_duration=0, post_staff_duration=0, post_client_duration=0,
        requires_focus=False,
    ),
    "appointment_service_options": dict(
        appointment_service_id="s1", price_delta=None, duration_delta=None, finish_duration_delta=None,
        post_staff_duration_delta=None, post_client_duration_delta=None,
    ),
    "services": dict(id="svc1", active=True, category_id="cat1", business_id="B1", duration=45, default_price=900),
    "service_categories": dict(id="cat1", active=True, name="Hair"),
    "service_categories_curated": dict(name="Hair", service_classification='{"labels": ["Hair", "Other"]}'),
    "locations": dict(
        id="L1", license_tier="growth", latitude=1.0, longitude=2.0, tz="UTC", inserted_at=at("2020-01-01"),
        address='{"country": "US", "state": "CA", "city": "Town", "zip": 90210}', deleted_at=None,
        business_id="B1", crm_account_id="crm1",
    ),
    "staff_locations": dict(location_id="L1", staff_id="st1", active=True),
    "staff": dict(id="st1", active=True, inserted_at=at("2025-01-01")),
    "service_rules": dict(
        location_id="L1", service_id="svc1", staff_id=None, staff_role_id=None, deleted_at=None,
        set_duration=None, set_price=None, set_bookable=None,
    ),
    "crm_account": dict(
        id="crm1", sales_vertical_c=None, industry="Salon", type="Customer", segment_c="SMB", plan_type_c="p",
        no_of_active_locations_c=2, total_arr_c=10.0, avg_gmv_per_location_c=1.0, gpv_per_appointment_c=None,
        take_rate_c=0.1, initial_acv_c=5.0, est_monthly_appointments_c=None, enterprise_c=True, franchise_c=None,
        corporate_account_c=False, payment_processing_c=True, tenure_c=12, created_date=at("2021-01-01"),
    ),
    "marketing_email": dict(location_id="L1", sent_at=at("2026-04-02 09:00")),
    "marketing_sms": dict(location_id="L1", sent_at=at("2026-04-02 09:00")),
}
EMPTY = ("appointment_cancellations", "appointment_service_options", "service_rules", "marketing_email", "marketing_sms")


def make(spark: SparkSession, table: str, *overrides: dict):
    """A source table whose rows are the defaults with each of `overrides`."""
    schema = ", ".join(
        f"{name} {'string' if kind == 'variant' else kind}" for name, kind in source_columns(table)
    )
    data = [tuple({**DEFAULTS[table], **changes}.values()) for changes in overrides]
    return conform(spark.createDataFrame(data, schema), table)


def make_all(spark: SparkSession, **overrides) -> dict:
    """All source tables; one default row each, none for the optional ones."""
    return {
        table: make(spark, table, *overrides.get(table, [] if table in EMPTY else [{}]))
        for table in SOURCE_SCHEMAS
    }
