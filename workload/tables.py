"""The test tables seen as the source tables of the daily job.

An order is a visit to the location that serves a block of 15 customers, a line
item is a service line, a part a service, a supplier a location, a customer a
staff member or a CRM account. Keys stay the integers they are. Every view covers its whole table; conditions
below only separate the kinds of record one table stands for.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from footfall.sources.holidays import holiday_table

FIRST_DAY = date(1996, 1, 1)
AS_OF = date(2002, 1, 1)
QUARTER_DAYS = [date(year, month, 1) for year in range(1995, 2002) for month in (1, 4, 7, 10)]
ZONES = ("America/Los_Angeles", "America/New_York", "Asia/Tokyo")


# Declared, so that opening a table starts no job to infer its columns.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def holidays(spark: SparkSession) -> DataFrame:
    return holiday_table(spark, QUARTER_DAYS)


def zone_of(key: str) -> str:
    return f"element_at(array{ZONES}, cast({key} % 3 as int) + 1)"


CENTS = "cast(round({} * 100) as bigint)"
PRICE = "cast(round(l_extendedprice / 100) as bigint)"

VIEWS: dict[str, tuple[str, str, list[str]]] = {
    # source table -> (test table, row condition, columns)
    "appointments": (
        "orders",
        "true",
        [
            "o_orderkey id",
            "o_custkey div 15 location_id",
            "o_orderdate + make_dt_interval(0, cast(cast(o_totalprice as bigint) % 24 as int)) time",
            zone_of("(o_custkey div 15)") + " tz",
            "case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'desk' end booked_by_id",
            "case when o_orderpriority = '4-NOT SPECIFIED' then o_custkey end booked_by_client_id",
            "case when o_totalprice < 20000 then null when o_orderpriority = '5-LOW' then 'migration'"
            " when o_orderpriority = '4-NOT SPECIFIED' then 'sched_booking_widget' else 'front_desk' end source",
            "o_orderdate - make_dt_interval(cast(cast(o_totalprice as bigint) % 30 as int)) inserted_at",
            "case when o_orderstatus = 'P' then 'pending' else 'final' end state",
            "o_orderstatus = 'O' and o_orderpriority = '1-URGENT' cancelled",
            "case when o_totalprice <= 495000 then o_custkey end client_id",
        ],
    ),
    "appointment_cancellations": (
        "lineitem",
        "l_returnflag = 'R'",
        [
            "l_orderkey appointment_id",
            "case when l_linestatus = 'F' then 'staff_cancel' else 'client_cancel' end reason",
        ],
    ),
    "appointment_services": (
        "lineitem",
        "true",
        [
            "l_orderkey * 8 + l_linenumber id",
            "l_orderkey appointment_id",
            "l_partkey service_id",
            "l_returnflag = 'A' staff_requested",
            PRICE + " price",
            "nullif(" + CENTS.format("l_discount") + " * 100, 500) discount_cents",
            "round(l_discount * 100) discount_percentage",
            "cast(l_quantity as bigint) duration",
            "cast(nullif(l_linenumber, 7) as bigint) finish_duration",
            "cast(l_linenumber * 5 as bigint) post_staff_duration",
            "10L post_client_duration",
            "l_linestatus = 'F' requires_focus",
        ],
    ),
    "appointment_service_options": (
        "lineitem",
        "l_tax >= 0.04",
        [
            "l_orderkey * 8 + l_linenumber appointment_service_id",
            CENTS.format("l_tax") + " price_delta",
            "nullif(" + CENTS.format("l_tax") + ", 6) duration_delta",
            "1L finish_duration_delta",
            "cast(null as bigint) post_staff_duration_delta",
            "2L post_client_duration_delta",
        ],
    ),
    "services": (
        "part",
        "true",
        [
            "p_partkey id",
            "p_size > 5 active",
            "p_type category_id",
            "p_brand business_id",
            "cast(nullif(p_size, 50) as bigint) duration",
            CENTS.format("p_retailprice") + " default_price",
        ],
    ),
    "staff_locations": (
        "customer",
        "true",
        [
            "c_custkey div 15 location_id",
            "c_custkey staff_id",
            "c_acctbal > 0 active",
        ],
    ),
    "staff": (
        "customer",
        "true",
        [
            "c_custkey id",
            "c_mktsegment <> 'MACHINERY' active",
            "timestamp_ntz'1993-01-01 09:00:00' + make_dt_interval(c_nationkey) inserted_at",
        ],
    ),
    "service_rules": (
        "lineitem",
        "true",
        [
            "l_suppkey location_id",
            "l_partkey service_id",
            "case when l_returnflag = 'R' then l_orderkey end staff_id",
            "case when l_returnflag = 'A' and l_linestatus = 'F' then 'role' end staff_role_id",
            "case when l_discount < 0.01 then l_shipdate end deleted_at",
            "case when l_tax >= 0.03 then cast(l_quantity as bigint) end set_duration",
            "case when l_tax <= 0.06 then " + PRICE + " end set_price",
            "l_linestatus = 'O' set_bookable",
        ],
    ),
    "crm_account": (
        "customer",
        "true",
        [
            "c_custkey id",
            "case when c_acctbal > 5000 then c_mktsegment end sales_vertical_c",
            "case when c_acctbal > -900 then c_mktsegment end industry",
            "case when c_acctbal > 0 then 'Customer' else 'Prospect' end type",
            "case when c_acctbal < -800 then null when c_acctbal < 4000 then 'small' else 'large' end segment_c",
            "case when c_nationkey < 12 then 'basic' else 'plus' end plan_type_c",
            "cast(nullif(c_nationkey, 3) as bigint) no_of_active_locations_c",
            "case when c_acctbal > 0 then c_acctbal end total_arr_c",
            "c_acctbal / 2 avg_gmv_per_location_c",
            "cast(null as double) gpv_per_appointment_c",
            "cast(c_nationkey as double) take_rate_c",
            "c_acctbal * 2 initial_acv_c",
            "cast(c_nationkey * 10 as bigint) est_monthly_appointments_c",
            "c_mktsegment = 'FURNITURE' enterprise_c",
            "case when c_acctbal > 1000 then c_mktsegment = 'HOUSEHOLD' end franchise_c",
            "cast(null as boolean) corporate_account_c",
            "c_acctbal > 3000 payment_processing_c",
            "cast(c_nationkey as bigint) tenure_c",
            "timestamp_ntz'1994-06-01 00:00:00' + make_dt_interval(c_nationkey) created_date",
        ],
    ),
    "marketing_email": (
        "lineitem",
        "l_linestatus = 'F'",
        ["l_suppkey location_id", "l_shipdate sent_at"],
    ),
    "marketing_sms": (
        "lineitem",
        "l_linestatus = 'O'",
        ["l_suppkey location_id", "l_shipdate sent_at"],
    ),
}


def _categories(kinds: DataFrame) -> DataFrame:
    return kinds.selectExpr("p_type id", "p_type <> 'PROMO' active", "p_type name")


def _curated(kinds: DataFrame) -> DataFrame:
    label = "case when p_type in ('ECONOMY', 'SMALL') then 'VALUE' else p_type end"
    document = f"if(p_type = 'STANDARD', '{{\"labels\": []}}', concat('{{\"labels\": [\"', {label}, '\"]}}'))"
    return kinds.selectExpr("p_type name", f"parse_json({document}) service_classification")


def _locations(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    placed = supplier.join(nation.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey").join(
        region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"
    )
    address = (
        "to_json(named_struct('country', r_name, 'state', n_name,"
        " 'city', case when s_acctbal not between 0 and 100 then concat(n_name, ' City') end,"
        " 'zip', case when s_acctbal >= -500 then 10000 + n_regionkey * 1000 + s_nationkey end))"
    )
    return placed.selectExpr(
        "s_suppkey id",
        "case when s_acctbal < -700 then null when s_acctbal < 3000 then 'starter'"
        " when s_acctbal < 6000 then 'growth' else 'scale' end license_tier",
        "s_nationkey * 1.5D latitude",
        "s_nationkey * -2.5D longitude",
        zone_of("s_suppkey") + " tz",
        "timestamp_ntz'1994-01-01 00:00:00' + make_dt_interval(s_nationkey) inserted_at",
        f"parse_json({address}) address",
        "case when s_acctbal > 9900 then timestamp_ntz'2001-01-01 00:00:00' end deleted_at",
        "concat('Brand#', s_nationkey + 1) business_id",
        "case when s_acctbal not between 100 and 200 then s_suppkey end crm_account_id",
    )


class Sources(dict):
    """Source tables of the daily job over `sf_dir`, each defined on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir, self.opened = spark, sf_dir, {}

    def opened_table(self, name: str) -> DataFrame:
        if name not in self.opened:
            self.opened[name] = table(self.spark, self.sf_dir, name)
        return self.opened[name]

    def __missing__(self, name: str) -> DataFrame:
        if name == "service_categories":
            df = _categories(self.opened_table("part").select("p_type").distinct())
        elif name == "service_categories_curated":
            df = _curated(self.opened_table("part").select("p_type").distinct())
        elif name == "locations":
            df = _locations(*[self.opened_table(t) for t in ("supplier", "nation", "region")])
        else:
            origin, condition, columns = VIEWS[name]
            df = self.opened_table(origin).where(condition).selectExpr(*columns)
        self[name] = df
        return df


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(spark, sf_dir)
