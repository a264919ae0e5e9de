"""Typed readers for the source tables.

The schemas name the columns the feature job reads; a source may hold more.
`conform` selects and casts, so column pruning reaches the scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE_SCHEMAS: dict[str, str] = {
    "appointments": """
        id string, location_id string, time timestamp_ntz, tz string,
        booked_by_id string, booked_by_client_id string, source string,
        inserted_at timestamp_ntz, state string, cancelled boolean, client_id string""",
    "appointment_cancellations": "appointment_id string, reason string",
    "appointment_services": """
        id string, appointment_id string, service_id string, staff_requested boolean,
        price bigint, discount_cents bigint, discount_percentage double,
        duration bigint, finish_duration bigint, post_staff_duration bigint,
        post_client_duration bigint, requires_focus boolean""",
    "appointment_service_options": """
        appointment_service_id string, price_delta bigint, duration_delta bigint,
        finish_duration_delta bigint, post_staff_duration_delta bigint,
        post_client_duration_delta bigint""",
    "services": """
        id string, active boolean, category_id string, business_id string,
        duration bigint, default_price bigint""",
    "service_categories": "id string, active boolean, name string",
    "service_categories_curated": "name string, service_classification variant",
    "locations": """
        id string, license_tier string, latitude double, longitude double, tz string,
        inserted_at timestamp_ntz, address variant, deleted_at timestamp_ntz,
        business_id string, crm_account_id string""",
    "staff_locations": "location_id string, staff_id string, active boolean",
    "staff": "id string, active boolean, inserted_at timestamp_ntz",
    "service_rules": """
        location_id string, service_id string, staff_id string, staff_role_id string,
        deleted_at timestamp_ntz, set_duration bigint, set_price bigint,
        set_bookable boolean""",
    "crm_account": """
        id string, sales_vertical_c string, industry string, type string,
        segment_c string, plan_type_c string, no_of_active_locations_c bigint,
        total_arr_c double, avg_gmv_per_location_c double, gpv_per_appointment_c double,
        take_rate_c double, initial_acv_c double, est_monthly_appointments_c bigint,
        enterprise_c boolean, franchise_c boolean, corporate_account_c boolean,
        payment_processing_c boolean, tenure_c bigint, created_date timestamp_ntz""",
    "marketing_email": "location_id string, sent_at timestamp_ntz",
    "marketing_sms": "location_id string, sent_at timestamp_ntz",
}


def source_columns(table: str) -> list[tuple[str, str]]:
    fields = (field.split() for field in SOURCE_SCHEMAS[table].split(","))
    return [(name, kind) for name, kind in fields]


def conform(df: DataFrame, table: str, renames: Mapping[str, str] | None = None) -> DataFrame:
    """The declared columns of `table` in their declared types.

    `renames` maps a declared column to its name in `df`. A document column
    may arrive as a variant, as JSON text, or as a struct.
    """
    renames = renames or {}
    kinds = {name.lower(): kind for name, kind in df.dtypes}
    selected = []
    for name, kind in source_columns(table):
        actual = renames.get(name, name)
        column = F.col(actual)
        if kind == "variant":
            found = kinds[actual.lower()]
            if found == "string":
                column = F.try_parse_json(column)
            elif found != "variant":
                column = F.to_variant_object(column)
        else:
            column = column.cast(kind)
        selected.append(column.alias(name))
    return df.select(*selected)


def read_sources(
    spark: SparkSession,
    root: str | None = None,
    database: str | None = None,
    names: Mapping[str, str] | None = None,
    renames: Mapping[str, Mapping[str, str]] | None = None,
) -> dict[str, DataFrame]:
    """All source tables, from parquet folders under `root` or from `database`.

    `names` gives a table's own folder or table name, `renames` its own column
    names, where they differ from the declared ones.
    """
    names, renames = names or {}, renames or {}
    tables = {}
    for table in SOURCE_SCHEMAS:
        actual = names.get(table, table)
        if root is not None:
            df = spark.read.parquet(f"{root.rstrip('/')}/{actual}")
        else:
            df = spark.table(f"{database}.{actual}" if database else actual)
        tables[table] = conform(df, table, renames.get(table))
    return tables
