"""The same answers in plain SQL for an independent engine.

The SQL joins records as they are (no pre-aggregation, no weights) and uses
ordinary window frames, so it checks the rewrites the Spark plans make.
"""

from __future__ import annotations

import re

from footfall.plans.training import CATEGORY_INPUTS, NUMERIC_INPUTS
from footfall.sources.holidays import US_HOLIDAYS

from .tidy import tidy_sql

QUARTERS = ", ".join(
    f"(date '{year}-{month:02d}-01')" for year in range(1995, 2002) for month in (1, 4, 7, 10)
)


def zone(key: str) -> str:
    return f"(['America/Los_Angeles', 'America/New_York', 'Asia/Tokyo'])[{key} % 3 + 1]"


def share(condition: str) -> str:
    """Share of rows to 4 digits, rounded as an exact decimal."""
    return f"cast(round(cast(count(*) filter ({condition}) / count(*) as decimal(20, 12)), 4) as double)"


def cents(column: str) -> str:
    return f"cast(round({column} * 100) as bigint)"


PRICE = "cast(round(l_extendedprice / 100) as bigint)"

CTES: dict[str, str] = {
    "holidays": f"select holiday_date from (values {QUARTERS}) as h(holiday_date)",
    "visit": f"""
        select o_orderkey as visit_key, o_custkey // 15 as location_id,
            cast(((o_orderdate + to_hours(cast(trunc(o_totalprice) as bigint) % 24)) at time zone
                {zone('(o_custkey // 15)')}) at time zone 'UTC' as date) as target_date,
            {zone('(o_custkey // 15)')} as tz,
            o_orderpriority as priority, o_custkey as customer,
            o_orderdate - to_days(cast(trunc(o_totalprice) as integer) % 30) as booked_at,
            o_orderstatus as status, o_totalprice as amount
        from orders""",
    "good_visit": """
        select v.visit_key, v.location_id, v.target_date, v.tz, v.booked_at,
            case when priority in ('1-URGENT', '2-HIGH') then 'desk' end as booked_by_id,
            case when priority = '4-NOT SPECIFIED' then customer end as booked_by_client_id,
            case when priority = '4-NOT SPECIFIED' then 'sched_booking_widget' else 'front_desk' end as source
        from visit as v left join (select * from lineitem where l_returnflag = 'R') as c on c.l_orderkey = v.visit_key
        where status <> 'P' and amount between 20000 and 495000 and priority <> '5-LOW'
            and (not (status = 'O' and priority = '1-URGENT') or c.l_linestatus = 'F')""",
    "menu": f"""
        select p_partkey as service_key, p_type as raw_category, p_brand as business,
            nullif(p_size, 50) as duration, {cents('p_retailprice')} as price
        from part where p_size > 5 and p_type <> 'PROMO'""",
    "labelled": """
        select service_key, case when raw_category in ('ECONOMY', 'SMALL') then 'VALUE' else raw_category end
            as service_category
        from menu where raw_category <> 'STANDARD'""",
    "line": f"""
        select concat(l_orderkey, '-', l_linenumber) as line_id, l_orderkey as visit_key, service_category,
            l_returnflag = 'A' as staff_requested, {PRICE} as price,
            coalesce(nullif({cents('l_discount')} * 100, 500), 0) as discount_cents,
            round(l_discount * 100) as discount_pct, cast(l_quantity as bigint) as duration,
            nullif(l_linenumber, 7) as finish, l_linenumber * 5 as post_staff, l_linestatus = 'F' as focus
        from lineitem join labelled on service_key = l_partkey""",
    "option_row": f"""
        select concat(l_orderkey, '-', l_linenumber) as line_id, {cents('l_tax')} as price_delta,
            coalesce(nullif({cents('l_tax')}, 6), 0) as duration_delta
        from lineitem where l_tax >= 0.04""",
    "line_option": """
        select l.*, price + coalesce(price_delta, 0) as full_price,
            duration + coalesce(duration_delta, 0) as full_duration,
            duration + coalesce(duration_delta, 0) + finish + (case when o.line_id is null then 0 else 1 end)
                + post_staff
                + case when focus then 10 + (case when o.line_id is null then 0 else 2 end) else 0 end as minutes
        from line as l left join option_row as o on o.line_id = l.line_id""",
    "daily": f"""
        select v.location_id, l.service_category, v.target_date, count(*) as demand_count,
            avg(date_diff('day', cast(booked_at as date), target_date)) as avg_lead_time_days,
            {share('booked_by_id is not null')} as booked_internally_ratio,
            {share('booked_by_client_id is not null')} as self_booked_ratio,
            {share("source = 'sched_booking_widget'")} as booked_online_ratio,
            {share('staff_requested')} as staff_requested_ratio,
            avg(full_price) as avg_price_cents, avg(discount_cents) as avg_discount_cents,
            avg(discount_pct) as avg_discount_pct,
            {share('discount_cents > 0')} as discount_adoption_ratio,
            avg(full_duration) as avg_duration_min,
            cast(sum(minutes) as double) / 60 as provider_hours_demanded
        from good_visit as v join line_option as l on l.visit_key = v.visit_key
        group by all""",
    "site": f"""
        select s_suppkey as location_id, s_suppkey as site_key, concat('Brand#', s_nationkey + 1)
            as business, case when s_acctbal < -700 then null when s_acctbal < 3000 then 'starter'
                when s_acctbal < 6000 then 'growth' else 'scale' end as license_tier,
            s_nationkey * 1.5 as latitude, s_nationkey * -2.5 as longitude, {zone('s_suppkey')} as location_tz,
            date '1994-01-01' + s_nationkey as location_created_date, r_name as location_country,
            n_name as location_state, cast(null as varchar) as location_province,
            case when s_acctbal between 0 and 100 then null else n_name || ' City' end as location_city,
            case when s_acctbal >= -500 then cast(10000 + n_regionkey * 1000 + s_nationkey as varchar) end as location_zip,
            s_acctbal > 9900 as deleted,
            case when s_acctbal between 100 and 200 then null else s_suppkey end as account_key
        from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey""",
    "profile": """
        select s.location_id, license_tier, latitude, longitude, location_tz, location_created_date,
            location_country, location_state, location_province, location_city, location_zip,
            left(location_zip, 3) as location_zip3, count(l.c_custkey) as location_staff_count,
            avg(date_diff('day', date '1993-01-01' + t.c_nationkey, date '2002-01-01')) as avg_provider_tenure_days
        from site as s
        left join customer as l on l.c_custkey // 15 = s.site_key and l.c_acctbal > 0
        left join customer as t on t.c_custkey = l.c_custkey and t.c_mktsegment <> 'MACHINERY'
        where not deleted group by all""",
    "rule": f"""
        select l_suppkey as location_id, l_partkey as service_key,
            case when l_returnflag = 'R' then l_orderkey end as staff_id,
            case when l_returnflag = 'A' and l_linestatus = 'F' then 'role' end as role_id,
            case when l_tax >= 0.03 then cast(l_quantity as bigint) end as set_duration,
            case when l_tax <= 0.06 then {PRICE} end as set_price, l_linestatus = 'O' as bookable
        from lineitem where l_discount >= 0.01""",
    "own_rule": "select * from rule where staff_id is null and role_id is null",
    "staff_rule": "select * from rule where staff_id is not null and bookable",
    "menu_stats": """
        select s.location_id, m.raw_category as service_category,
            avg(coalesce(o.set_duration, m.duration)) as avg_menu_duration_min,
            avg(coalesce(o.set_price, m.price)) as avg_menu_price_cents,
            count(distinct m.service_key) as num_services_in_category,
            count(distinct f.staff_id) as num_qualified_providers
        from site as s join menu as m on m.business = s.business
        left join own_rule as o on o.location_id = s.location_id and o.service_key = m.service_key
        left join staff_rule as f on f.location_id = s.location_id and f.service_key = m.service_key
        group by all""",
    "offered": """
        select location_id, count(distinct p_partkey) as num_services_offered
        from site join part on p_brand = business and p_size > 5 group by all""",
    "capacity": """
        select c_custkey // 15 as location_id, count(distinct c_custkey) as num_providers_scheduled,
            count(distinct c_custkey) * 8.0 as total_available_hours
        from customer where c_acctbal > 0 and c_mktsegment <> 'MACHINERY' group by all""",
    "account": """
        select location_id,
            coalesce(case when c_acctbal > 5000 then c_mktsegment end, 'Unknown') as sf_vertical,
            case when c_acctbal > -900 then c_mktsegment end as sf_industry,
            case when c_acctbal > 0 then 'Customer' when c_acctbal <= 0 then 'Prospect' end as sf_account_type,
            case when c_acctbal < -800 then null when c_acctbal < 4000 then 'small'
                when c_acctbal >= 4000 then 'large' end as sf_segment,
            case when c_nationkey < 12 then 'basic' when c_nationkey >= 12 then 'plus' end as sf_plan_type,
            coalesce(nullif(c_nationkey, 3), 1) as sf_active_locations,
            coalesce(case when c_acctbal > 0 then c_acctbal end, 0) as sf_total_arr,
            coalesce(c_acctbal / 2, 0) as sf_avg_gmv_per_loc, 0.0 as sf_gpv_per_appt,
            coalesce(c_nationkey, 0) as sf_take_rate, coalesce(c_acctbal * 2, 0) as sf_initial_acv,
            coalesce(c_nationkey * 10, 0) as sf_est_monthly_appts,
            coalesce(cast(c_mktsegment = 'FURNITURE' as integer), 0) as sf_is_enterprise,
            case when c_acctbal > 1000 and c_mktsegment = 'HOUSEHOLD' then 1 else 0 end as sf_is_franchise,
            0 as sf_is_corporate, case when c_acctbal > 3000 then 1 else 0 end as sf_payment_processing,
            coalesce(c_nationkey, 0) as sf_account_tenure,
            timestamp '1994-06-01' + to_days(c_nationkey) as sf_created_date
        from site left join customer on c_custkey = account_key where not deleted""",
    "message": """
        select l_suppkey as location_id, cast(l_shipdate as date) as msg_date, count(*) as msg_count,
            case when l_linestatus = 'F' then 'email' else 'sms' end as channel
        from lineitem group by all""",
    "sent": """
        select d.location_id, d.target_date,
            coalesce(sum(msg_count) filter (channel = 'email'), 0) as email_msgs_l30d,
            coalesce(sum(msg_count) filter (channel = 'sms' and msg_date >= target_date - 7), 0) as sms_msgs_l7d,
            coalesce(sum(msg_count), 0) as total_msgs_l30d
        from (select distinct location_id, target_date from daily) as d
        left join message as m on m.location_id = d.location_id
            and m.msg_date < d.target_date and m.msg_date >= d.target_date - 30
        group by all""",
    "nearest": """
        select location_id, service_category, target_date,
            coalesce(cast(min(abs(date_diff('day', target_date, holiday_date))) = 0 as integer), 0) as is_holiday,
            coalesce(min(abs(date_diff('day', target_date, holiday_date))), 60) as days_to_nearest_holiday
        from daily left join holidays on abs(date_diff('day', target_date, holiday_date)) <= 30
        group by all""",
}

BEHAVIOUR = (
    "avg_lead_time_days booked_internally_ratio self_booked_ratio booked_online_ratio staff_requested_ratio "
    "avg_price_cents avg_discount_cents avg_discount_pct discount_adoption_ratio"
).split()

PANEL = "location_id:t service_category:t target_date:t"


def frame(kind: str, first: int, last: int = 1) -> str:
    """Window frame in rows, or in days when `kind` is 'range'."""
    unit = " days" if kind == "range" else ""
    low, high = (f"interval '{n}{unit}'" if unit else str(n) for n in (first, last))
    return f"{kind} between {low} preceding and {high} preceding"


def windows(measure: str, name: str, lags: tuple[int, ...], trend: bool = True, kind: str = "rows") -> list[str]:
    back = 364 if kind == "range" else 52

    def lag(n):
        return f"max({measure}) over (s {frame(kind, n, n)})" if kind == "range" else f"lag({measure}, {n}) over s"

    columns = [f"coalesce(sum({measure}) over (s {frame(kind, n)}), 0) as {name}_l{n}d" for n in (7, 30)]
    columns.append(f"coalesce(avg({measure}) over (w {frame(kind, back)}), 0) as {name}_dow_avg")
    columns += [f"coalesce({lag(n)}, 0) as {name}_lag_{n}d" for n in lags]
    if trend:
        columns.append(
            f"coalesce(avg({measure}) over (s {frame(kind, 14)}), 0)"
            f" - coalesce(avg({measure}) over (s {frame(kind, 28, 15)}), 0) as {name}_trend_4w"
        )
    return columns


def rolled(kind: str) -> str:
    month = f"over (s {frame(kind, 30)})"
    columns = [
        *windows("demand_count", "count_appts", (7, 14, 28, 364), kind=kind),
        *windows("provider_hours_demanded", "hours_provider", (7, 14, 28, 364), kind=kind),
        f"coalesce(sum(provider_hours_demanded) {month} / nullif(sum(demand_count) {month}, 0), 0)"
        " as hours_provider_per_appt_l30d",
        *[f"coalesce(avg({c}) {month}, 0) as {c}" for c in BEHAVIOUR],
    ]
    return (
        "select location_id, service_category, target_date, demand_count, provider_hours_demanded, avg_duration_min, "
        + ", ".join(columns)
        + " from daily window s as (partition by location_id, service_category order by target_date),"
        " w as (partition by location_id, service_category, dayofweek(target_date) order by target_date)"
    )


def market(code: str, prefix: str) -> dict[str, str]:
    columns = [
        *windows("demand_count", f"{prefix}_count_appts", (7, 28), trend=False),
        *windows("hours_demanded", f"{prefix}_hours_provider", (7, 28), trend=False),
    ]
    return {
        f"{prefix}_daily": f"""
            select {code}, service_category, target_date, count(distinct d.location_id) as num_locations,
                sum(demand_count) as demand_count, sum(provider_hours_demanded) as hours_demanded
            from daily as d join profile as p on p.location_id = d.location_id
            where {code} is not null group by all""",
        f"{prefix}_rolled": f"""
            select {code}, service_category, target_date, num_locations as {prefix}_num_locations, {', '.join(columns)}
            from {prefix}_daily window s as (partition by {code}, service_category order by target_date),
                w as (partition by {code}, service_category, dayofweek(target_date) order by target_date)""",
    }


CTES["rolled"] = rolled("rows")
CTES["rolled_days"] = rolled("range")
CTES |= market("location_zip3", "zip3") | market("location_zip", "zip")
CTES["minutes"] = "select *, round(provider_hours_demanded * 60) as actual from daily"
CTES["forecast"] = f"""
    select location_id, service_category, cast(target_date as timestamp) as prediction_timestamp, actual,
        round(coalesce(avg(actual) over (s {frame('rows', 30)}), 0)) as predicted
    from minutes window s as (partition by location_id, service_category order by target_date)"""
CTES["residual"] = """
    select abs(actual - predicted) as r, row_number() over (order by abs(actual - predicted)) - 1 as i,
        count(*) over () as n from forecast where actual is not null"""
CTES["spot"] = """
    select *, (n - 1) * least(1.0::double, (1 - 0.1::double) * (1 + 1.0::double / n)) as p from residual"""
CTES["q"] = """
    select max(n) as n, max(r) filter (i = floor(p)) + (max(r) filter (i = least(floor(p) + 1, n - 1))
        - max(r) filter (i = floor(p))) * (max(p) - floor(max(p))) as q from spot"""

SHARED = [f"{p}_{s}" for p in ("count_appts", "hours_provider") for s in ("l7d", "l30d", "lag_7d", "lag_28d")]


def competitor(prefix: str) -> list[str]:
    return [f"greatest({prefix}_{m} - {m}, 0) as comp_{prefix}_{m}" for m in SHARED] + [
        f"{prefix}_count_appts_dow_avg",
        f"{prefix}_hours_provider_dow_avg",
        f"coalesce({prefix}_num_locations, 1) as {prefix}_num_locations",
    ]


UTILISATION = """case when total_available_hours > 0 then round(cast(count_appts_l7d / 7.0::double
    * coalesce(avg_menu_duration_min, 60) / 60.0::double / total_available_hours as decimal(20, 12)), 4) else 0 end"""

CALENDAR = """dayofweek({d}) as day_of_week, dayofmonth({d}) as day_of_month, month({d}) as month_num,
    quarter({d}) as quarter, weekofyear({d}) as week_of_year, dayofyear({d}) as day_of_year,
    cast(dayofweek({d}) in (0, 6) as integer) as is_weekend"""
CALENDAR_KINDS = "day_of_week:i day_of_month:i month_num:i quarter:i week_of_year:i day_of_year:i is_weekend:i"

HISTORY = [
    f"{p}_{s}"
    for p in ("count_appts", "hours_provider")
    for s in ("l7d", "l30d", "dow_avg", "lag_7d", "lag_14d", "lag_28d", "lag_364d", "trend_4w")
] + ["hours_provider_per_appt_l30d"]
ACCOUNT = (
    "sf_vertical sf_industry sf_account_type sf_segment sf_plan_type sf_active_locations sf_total_arr "
    "sf_avg_gmv_per_loc sf_gpv_per_appt sf_take_rate sf_initial_acv sf_est_monthly_appts sf_is_enterprise "
    "sf_is_franchise sf_is_corporate sf_payment_processing sf_account_tenure sf_created_date"
).split()
PLACE = (
    "latitude longitude location_state location_city location_zip3 license_tier location_staff_count "
    "avg_provider_tenure_days location_country location_province location_zip location_tz"
).split()

CTES["features"] = f"""
    select r.location_id, r.service_category, r.target_date, provider_hours_demanded, demand_count,
        {CALENDAR.format(d='r.target_date')}, is_holiday, days_to_nearest_holiday,
        date_diff('day', location_created_date, r.target_date) as location_age_days,
        {', '.join('p.' + c for c in PLACE)}, num_providers_scheduled, total_available_hours,
        {UTILISATION} as utilization_rate_recent, coalesce(num_services_offered, 0) as num_services_offered,
        coalesce(avg_menu_duration_min, 60) as avg_service_duration_min,
        coalesce(avg_menu_price_cents, 5000) as avg_service_price_cents,
        coalesce(num_qualified_providers, 0) as num_qualified_providers,
        {', '.join([*HISTORY, *competitor('zip3'), *competitor('zip'), *BEHAVIOUR])},
        email_msgs_l30d, sms_msgs_l7d, total_msgs_l30d, {', '.join(ACCOUNT)}
    from rolled as r
    join profile as p on p.location_id = r.location_id
    join account as a on a.location_id = r.location_id
    join nearest as h on h.location_id = r.location_id and h.service_category = r.service_category
        and h.target_date = r.target_date
    left join menu_stats as m on m.location_id = r.location_id and m.service_category = r.service_category
    left join offered as o on o.location_id = r.location_id
    left join capacity as c on c.location_id = r.location_id
    left join sent as s on s.location_id = r.location_id and s.target_date = r.target_date
    left join zip3_rolled as z3 on z3.location_zip3 = p.location_zip3 and z3.service_category = r.service_category
        and z3.target_date = r.target_date
    left join zip_rolled as z on z.location_zip = p.location_zip and z.service_category = r.service_category
        and z.target_date = r.target_date
    where r.target_date between date '1996-01-01' and date '2001-12-31' and p.location_city is not null
        and p.location_zip3 is not null and license_tier is not null and avg_provider_tenure_days is not null
        and sf_industry is not null and sf_segment is not null and provider_hours_demanded / demand_count <= 8"""

INTEGERS = set(
    "num_providers_scheduled num_services_offered num_qualified_providers location_staff_count location_age_days "
    "is_holiday days_to_nearest_holiday email_msgs_l30d sms_msgs_l7d total_msgs_l30d sf_active_locations "
    "sf_est_monthly_appts sf_is_enterprise sf_is_franchise sf_is_corporate sf_payment_processing "
    "sf_account_tenure demand_count zip3_num_locations zip_num_locations".split()
)
TEXTS = set(
    "location_state location_city location_zip3 license_tier location_country location_province location_zip "
    "location_tz sf_vertical sf_industry sf_account_type sf_segment sf_plan_type sf_created_date".split()
)


def kind_of(name: str) -> str:
    if name in TEXTS:
        return "t"
    counted = "count_appts" in name and not name.endswith(("dow_avg", "trend_4w"))
    return "i" if name in INTEGERS or counted else "d"


def kinds(names) -> str:
    return " ".join(f"{name}:{kind_of(name)}" for name in names)


COMPETITOR_NAMES = {p: [c.rpartition(" ")[2] for c in competitor(p)] for p in ("zip3", "zip")}
FEATURES = f"{PANEL} {CALENDAR_KINDS} " + kinds(
    [
        "provider_hours_demanded", "demand_count", "is_holiday", "days_to_nearest_holiday", "location_age_days",
        *PLACE, "num_providers_scheduled", "total_available_hours", "utilization_rate_recent",
        "num_services_offered", "avg_service_duration_min", "avg_service_price_cents", "num_qualified_providers",
        *HISTORY, *COMPETITOR_NAMES["zip3"], *COMPETITOR_NAMES["zip"], *BEHAVIOUR,
        "email_msgs_l30d", "sms_msgs_l7d", "total_msgs_l30d", *ACCOUNT,
    ]
)
SLICE_NAMES = [
    "is_holiday", "days_to_nearest_holiday", "location_age_days", "location_staff_count", *HISTORY,
    "avg_lead_time_days", "email_msgs_l30d", "sms_msgs_l7d", "sf_account_tenure", "location_city", "sf_segment",
    "sf_industry", "provider_hours_demanded",
]
SLICE = (
    f"{PANEL} day_of_week:i day_of_month:i week_of_year:i day_of_year:i is_weekend:i " + kinds(SLICE_NAMES)
)
DAILY = f"{PANEL} " + kinds(["demand_count", *BEHAVIOUR, "avg_duration_min", "provider_hours_demanded"])
ROLLED = f"{PANEL} " + kinds(
    ["demand_count", "provider_hours_demanded", "avg_duration_min", *HISTORY, *BEHAVIOUR]
)


# One round of one split over all model inputs: the gain of every cut, with missing rows on either side, by running sums.
TRAIN_DAYS = "target_date between date '1996-01-01' and date '2000-06-30'"
TEST_DAYS = "target_date between date '2000-07-01' and date '2001-12-31'"
PANEL_ROW = "location_id, service_category, target_date, provider_hours_demanded as y"


def listed(names) -> str:
    return "unnest([" + ", ".join(f"'{name}'" for name in names) + "]) as feature"


WHOLE = ", ".join(
    f"case when {c} is not null then least(greatest(round(round(cast({c} as double), 6)), -20), 200) end" for c in NUMERIC_INPUTS
)
AS_TEXT = ", ".join(f"coalesce(cast({c} as varchar), 'None')" for c in CATEGORY_INPUTS)
CTES["stump_block"] = f"""
    select target_date, floor(coalesce(sum(count(*)) over (order by target_date rows between unbounded preceding
        and 1 preceding), 0) * 3 / sum(count(*)) over ()) as block
    from features where {TRAIN_DAYS} group by target_date"""
CTES["stump_row"] = f"""
    select f.*, b.block from features as f left join stump_block as b on b.target_date = f.target_date
    where f.{TRAIN_DAYS} or f.{TEST_DAYS}"""
CTES["stump_number"] = f"""
    select {PANEL_ROW}, block, {listed(NUMERIC_INPUTS)}, unnest([{WHOLE}]) as value from stump_row"""
CTES["stump_category"] = f"""
    select {PANEL_ROW}, block, {listed(CATEGORY_INPUTS)}, unnest([{AS_TEXT}]) as category from stump_row"""
CTES["stump_daily"] = """
    select feature, category, target_date, block, sum(y) as s, count(*) as n from stump_category
    where block is not null group by all"""
CTES["stump_earlier"] = """
    select feature, category, target_date, round(round(sum(s) over w / sum(n) over w, 6)) as value from stump_daily
    window w as (partition by feature, category order by target_date rows between unbounded preceding and 1 preceding)"""
CTES["stump_trained"] = """
    select y, block, feature, value from stump_number where block is not null
    union all
    select c.y, c.block, c.feature, e.value from stump_category as c join stump_earlier as e on e.feature = c.feature
        and e.category = c.category and e.target_date = c.target_date"""


def _stump(name: str, blocks: int, scored: str) -> None:
    """Relations for the split of the rows of the first `blocks` blocks, and its forecast of the rows `scored`."""
    CTES[f"{name}_base"] = f"select avg(y) as base from stump_trained where block < {blocks}"
    CTES[f"{name}_mean"] = f"""
        select feature, category, round(round(sum(s) / sum(n), 6)) as value from stump_daily where block < {blocks} group by all"""
    CTES[f"{name}_cell"] = f"""
        select feature, value, count(*) as n, sum(y - base) as g from stump_trained, (select base from {name}_base)
        where block < {blocks} group by all"""
    CTES[f"{name}_cut"] = f"""
        select c.feature, c.value, side, sum(c.n) over w + side * coalesce(m.n, 0) as ln, sum(c.g) over w + side * coalesce(m.g, 0) as lg,
            sum(c.n) over a + coalesce(m.n, 0) as n, sum(c.g) over a + coalesce(m.g, 0) as g
        from (select * from {name}_cell where value is not null) as c
        left join (select * from {name}_cell where value is null) as m on m.feature = c.feature, (values (0), (1)) as v(side)
        window w as (partition by c.feature, side order by c.value), a as (partition by c.feature, side)"""
    CTES[f"{name}_gain"] = f"""
        select *, (lg * lg / (ln + 1) + (g - lg) * (g - lg) / (n - ln + 1) - g * g / (n + 1)) / 2 as gain
        from {name}_cut where ln >= 5 and n - ln >= 5"""
    CTES[f"{name}_split"] = f"""
        select feature, value as threshold, side, base + lg / (ln + 1) as low, base + (g - lg) / (n - ln + 1) as high
        from {name}_gain, (select base from {name}_base) where gain >= (select max(gain) from {name}_gain) * (1 - 1e-9)
        order by list_position([{', '.join(f"'{c}'" for c in (*NUMERIC_INPUTS, *CATEGORY_INPUTS))}], feature), value, side limit 1"""
    CTES[f"{name}_input"] = f"""
        select location_id, service_category, target_date, y, feature, value from stump_number where {scored}
        union all
        select location_id, service_category, target_date, y, c.feature, value from stump_category as c
        left join {name}_mean as m on m.feature = c.feature and m.category = c.category where {scored}"""
    CTES[f"{name}_forecast"] = f"""
        select location_id, service_category, cast(target_date as timestamp) as prediction_timestamp, y as actual,
            case when value <= threshold or value is null and side = 1 then low else high end as predicted
        from {name}_input as i join {name}_split as t on t.feature = i.feature"""


_stump("stump", 3, TEST_DAYS)
_stump("early", 1, "block = 1")
_stump("late", 2, "block = 2")
CTES["stump_residual"] = CTES["residual"].replace("from forecast", "from stump_forecast")
CTES["stump_spot"] = CTES["spot"].replace("from residual", "from stump_residual")
CTES["stump_q"] = CTES["q"].replace("from spot", "from stump_spot")


def sql(final: str, columns: str) -> str:
    """`final` with the common table expressions it needs, tidied."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(from|join) {name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(final)
    clauses = ",\n".join(f"{name} as ({CTES[name]})" for name in needed)
    return tidy_sql(f"with {clauses}\n{final}" if clauses else final, columns)


def of(relation: str, columns: str, where: str = "") -> str:
    """The named columns of one relation."""
    names = ", ".join(item.partition(":")[0] for item in columns.split())
    return sql(f"select {names} from {relation} {where}", columns)


EVENT_COUNTS = sql(
    """select p.user_id, p.day, count(*) filter (event_type = 'view') as views_30,
        count(*) filter (event_type = 'click' and cast(ts as date) >= day - 7) as clicks_7,
        count(event_id) as all_30
    from (select distinct user_id, cast(ts as date) as day from events where event_type = 'purchase') as p
    left join events as e on e.user_id = p.user_id and event_type in ('view', 'click', 'signup', 'error')
        and cast(ts as date) < day and cast(ts as date) >= day - 30
    group by all""",
    "user_id:i day:t views_30:i clicks_7:i all_30:i",
)

ERROR_SQL = {
    "rmse": "sqrt(avg((actual - predicted) ** 2))",
    "mae": "avg(abs(actual - predicted))",
    "wape_pct": "100 * sum(abs(actual - predicted)) / sum(actual)",
    "mape_pct": "100 * avg(abs(actual - predicted) / actual) filter (actual > 0)",
}
ERROR_NAMES = tuple(ERROR_SQL)
ERRORS = ", ".join(f"round({text}, 4) as {name}" for name, text in ERROR_SQL.items())
EXACT_ERRORS = ", ".join(f"{text} as {name}" for name, text in ERROR_SQL.items())
ERROR_KINDS = "rmse:d mae:d wape_pct:d mape_pct:d"
PREDICTION = "location_id:t service_category:t prediction_timestamp:t actual:d predicted:d pred_lower_05:d pred_upper_95:d"

CATEGORIES = """(select l_orderkey, l_linenumber, l_shipdate,
    concat_ws('-', p_brand, nullif(p_size, 1)) as category from lineitem join part on p_partkey = l_partkey)"""
VOCABULARY = f"""(select category, row_number() over (order by left(md5(category), 3), category) - 1 as code
    from (select distinct category from {CATEGORIES} where l_shipdate < date '1995-07-01'))"""


def _psi() -> str:
    levels = ", ".join(str(i / 10) for i in range(1, 10))
    return f"""
        with e as (select *, cast(ts as date) as day from events),
        edge as (select quantile_cont(value, [{levels}]) as cuts from e where day < date '2024-01-16'),
        placed as (select day, len(list_filter(cuts, lambda c: value > c)) as b from e, edge),
        base as (select b, count(*) as n from placed where day < date '2024-01-16' group by b),
        today as (select day, b, count(*) as n from placed where day >= date '2024-01-16' group by day, b),
        days as (select day, sum(n) as n_rows from today group by day),
        shares as (select d.day, d.n_rows,
                greatest(base.n / (select sum(n) from base), 0.0001) as p,
                greatest(coalesce(t.n, 0) / d.n_rows, 0.0001) as q
            from days as d cross join base left join today as t on t.day = d.day and t.b = base.b)
        select day, n_rows, sum((q - p) * ln(q / p)) as psi from shares group by all"""


ORACLE: dict[str, str] = {
    "holiday_calendar": sql(
        """select h.holiday_date, n_orders from holidays as h left join
            (select cast(o_orderdate as date) as day, count(*) as n_orders from orders group by all) as o
            on o.day = h.holiday_date""",
        "holiday_date:t n_orders:i",
    ),
    "literal_union": sql(
        """select id, count(*) as n_rows from (select o_custkey as id from orders union all select 1
            union all select null) group by all""",
        "id:i n_rows:i",
    ),
    "ref_filter": sql(
        """select l_linenumber as id, l_orderkey, l_partkey from lineitem where l_linenumber = 1
            union all select 1, null, null""",
        "id:i l_orderkey:i l_partkey:i",
    ),
    "qualifying_rows": sql(
        """select visit_key as appointment_id, location_id, target_date, tz, booked_by_id,
            booked_by_client_id, source, booked_at, count(*) as copies from good_visit group by all""",
        "appointment_id:t location_id:t target_date:t tz:t booked_by_id:t booked_by_client_id:t source:t "
        "booked_at:t copies:i",
    ),
    "conditional_ratio": sql(
        f"""select l_suppkey, {share("l_returnflag = 'R'")} as returned_ratio,
            {share('l_discount > 0')} as discount_ratio from lineitem group by all""",
        "l_suppkey:i returned_ratio:d discount_ratio:d",
    ),
    "prefix_market": sql(
        """select left(o_orderpriority, 1) as prefix, count(*) as n_orders, count(distinct o_custkey) as n_customers
            from orders group by all""",
        "prefix:t n_orders:i n_customers:i",
    ),
    "local_to_utc_date": sql(
        f"""select event_id, {zone('user_id')} as tz,
            cast((ts at time zone {zone('user_id')}) at time zone 'UTC' as date) as utc_date from events""",
        "event_id:i tz:t utc_date:t",
    ),
    "date_features": sql(
        f"select o_orderkey, {CALENDAR.format(d='o_orderdate')} from orders", f"o_orderkey:i {CALENDAR_KINDS}"
    ),
    "json_extract": sql(
        "select event_id, json_extract_string(props, '$.k') as k from events", "event_id:i k:i"
    ),
    "defaults_fill": of("account", "location_id:t " + kinds(ACCOUNT)),
    "left_fanout": sql(
        """select visit_key as appointment_id, service_category, count(*) as n_rows,
            sum(full_price) as total_price from line_option group by all""",
        "appointment_id:t service_category:t n_rows:i total_price:i",
    ),
    "left_on_predicate": sql(
        """select n_name, count(c_custkey) as n_customers from nation left join customer
            on c_nationkey = n_nationkey and c_acctbal > 0 and c_mktsegment = 'BUILDING' group by all""",
        "n_name:t n_customers:i",
    ),
    "double_role_join": sql(
        """select location_id, service_key as service_id, own_rules, staff_rules, joined_rows from (
            select k.location_id, k.service_key, count(*) as joined_rows,
                (select count(*) from own_rule as o where o.location_id = k.location_id
                    and o.service_key = k.service_key) as own_rules,
                (select count(*) from staff_rule as f where f.location_id = k.location_id
                    and f.service_key = k.service_key) as staff_rules
            from (select location_id, service_key from own_rule union
                select location_id, service_key from staff_rule) as k
            left join own_rule as a on a.location_id = k.location_id and a.service_key = k.service_key
            left join staff_rule as b on b.location_id = k.location_id and b.service_key = k.service_key
            group by k.location_id, k.service_key)""",
        "location_id:t service_id:t own_rules:i staff_rules:i joined_rows:i",
    ),
    "holiday_proximity": of("nearest", f"{PANEL} is_holiday:i days_to_nearest_holiday:i"),
    "default_holidays": sql(
        f"""select event_type, day, n_events, cast(coalesce(min(abs(day - h)) = 0, false) as integer) as is_holiday,
            coalesce(min(abs(day - h)), 60) as days_to_nearest_holiday
            from (select event_type, cast(ts as date) as day, count(*) as n_events from events group by all)
            left join (select unnest([{', '.join(f"date '{d}'" for d in US_HOLIDAYS.split())}]) as h) on abs(day - h) <= 30
            group by all""",
        "event_type:t day:t n_events:i is_holiday:i days_to_nearest_holiday:i",
    ),
    "trailing_event_counts": EVENT_COUNTS,
    "trailing_event_counts_range": EVENT_COUNTS,
    "message_window": of(
        "sent", "location_id:t target_date:t email_msgs_l30d:i sms_msgs_l7d:i total_msgs_l30d:i"
    ),
    "channel_union": of("message", "location_id:t msg_date:t msg_count:i channel:t"),
    "demand_daily": of("daily", DAILY),
    "location_profile": of("profile", "location_id:t location_created_date:t " + kinds(PLACE)),
    "service_menu_stats": of(
        "menu_stats",
        "location_id:t service_category:t avg_menu_duration_min:d avg_menu_price_cents:d "
        "num_services_in_category:i num_qualified_providers:i",
    ),
    "services_per_location": of("offered", "location_id:t num_services_offered:i"),
    "scheduled_capacity": of(
        "capacity", "location_id:t num_providers_scheduled:i total_available_hours:d"
    ),
    "market_daily": of(
        "zip3_daily",
        "location_zip3:t service_category:t target_date:t num_locations:i demand_count:i hours_demanded:d",
    ),
    "rolling_features": of("rolled", ROLLED),
    "rolling_calendar": of(
        "rolled_days",
        f"{PANEL} " + kinds(
            [
                "count_appts_l7d", "count_appts_l30d", "count_appts_dow_avg", "count_appts_lag_7d",
                "count_appts_lag_364d", "count_appts_trend_4w", "hours_provider_l30d", "hours_provider_per_appt_l30d",
            ]
        ),
    ),
    "rolling_sums": of(
        "rolled",
        f"{PANEL} "
        + kinds(["count_appts_l7d", "count_appts_l30d", "hours_provider_l7d", "hours_provider_l30d"]),
    ),
    "weekday_average": of("rolled", f"{PANEL} count_appts_dow_avg:d hours_provider_dow_avg:d"),
    "rolling_trend": of("rolled", f"{PANEL} count_appts_trend_4w:d hours_provider_trend_4w:d"),
    "rolling_ratio": of("rolled", f"{PANEL} hours_provider_per_appt_l30d:d"),
    "behaviour_averages": of("rolled", f"{PANEL} " + kinds(BEHAVIOUR)),
    "row_lags": sql(
        "select location_zip3, service_category, target_date, demand_count, "
        + ", ".join(f"coalesce(lag(demand_count, {n}) over s, 0) as lag_{n}" for n in (7, 14, 28, 364))
        + " from zip3_daily window s as (partition by location_zip3, service_category order by target_date)",
        "location_zip3:t service_category:t target_date:t demand_count:i lag_7:i lag_14:i lag_28:i lag_364:i",
    ),
    "market_rolling": of(
        "zip_rolled",
        "location_zip:t service_category:t target_date:t "
        + kinds(
            ["zip_num_locations", "zip_count_appts_dow_avg", "zip_hours_provider_dow_avg", *[f"zip_{m}" for m in SHARED]]
        ),
    ),
    "competitor_residual": sql(
        f"""select r.location_id, r.service_category, r.target_date, {', '.join(competitor('zip3'))}
            from rolled as r join profile as p on p.location_id = r.location_id
            left join zip3_rolled as z on z.location_zip3 = p.location_zip3
                and z.service_category = r.service_category and z.target_date = r.target_date""",
        f"{PANEL} " + kinds(COMPETITOR_NAMES["zip3"]),
    ),
    "utilisation_rate": sql(
        f"""select r.location_id, r.service_category, target_date, {UTILISATION} as utilization_rate_recent
            from rolled as r
            left join menu_stats as m on m.location_id = r.location_id and m.service_category = r.service_category
            left join capacity as c on c.location_id = r.location_id""",
        f"{PANEL} utilization_rate_recent:d",
    ),
    "clustered_panel": sql(
        """select p.location_id, p.service_category, count(*) as n_days, max(recent) as busiest,
            max(avg_menu_price_cents) as avg_menu_price_cents
            from (select *, coalesce(sum(demand_count) over (partition by location_id, service_category
                order by target_date rows between 7 preceding and 1 preceding), 0) as recent from daily) as p
            left join menu_stats as m on m.location_id = p.location_id and m.service_category = p.service_category
            group by all""",
        "location_id:t service_category:t n_days:i busiest:i avg_menu_price_cents:d",
    ),
    "feature_table": of("features", FEATURES),
    "training_slice": of("features", SLICE, "where target_date <= date '2000-06-30'"),
    "temporal_split": sql(
        """select case when target_date between date '1996-01-01' and date '2000-06-30' then 'train'
                when target_date between date '2000-07-01' and date '2001-12-31' then 'test' end as split,
            count(*) as n_rows, min(target_date) as first_day, max(target_date) as last_day
            from daily group by all""",
        "split:t n_rows:i first_day:t last_day:t",
    ),
    "cv_fold_assignment": sql(
        """select target_date, n_rows, rows_before, floor(rows_before * 3 / sum(n_rows) over ()) as block from (
            select target_date, count(*) as n_rows,
                coalesce(sum(count(*)) over (order by target_date rows between unbounded preceding
                    and 1 preceding), 0) as rows_before
            from daily group by target_date)""",
        "target_date:t n_rows:i rows_before:i block:i",
    ),
    "category_vocabulary": sql(f"select category, code from {VOCABULARY}", "category:t code:i"),
    "category_encode": sql(
        f"""select l_orderkey, l_linenumber, c.category, code from {CATEGORIES} as c
            left join {VOCABULARY} as v on v.category = c.category""",
        "l_orderkey:i l_linenumber:i category:t code:i",
    ),
    "category_rank": sql(
        """select l_orderkey, l_linenumber, l.category, round(value, 6) as value
            from (select *, case when p_size <> 1 then p_brand || '-' || p_size end as category
                from lineitem join part on p_partkey = l_partkey) as l
            join (
                select known, l_shipdate, sum(s) over w / sum(n) over w as value from (
                    select coalesce(case when p_size <> 1 then p_brand || '-' || p_size end, 'None') as known,
                        l_shipdate, sum(l_quantity) as s, count(*) as n
                    from lineitem join part on p_partkey = l_partkey group by all)
                window w as (partition by known order by l_shipdate rows between unbounded preceding and 1 preceding)) as e
            on e.known = coalesce(l.category, 'None') and e.l_shipdate = l.l_shipdate""",
        "l_orderkey:i l_linenumber:i category:t value:d",
    ),
    "error_metrics": sql(
        f"select service_category, count(*) as n_rows, {ERRORS} from forecast group by all",
        f"service_category:t n_rows:i {ERROR_KINDS}",
    ),
    "conformal_quantile": sql(
        "select n as n_rows, n as n_calibration, q from q", "n_rows:i n_calibration:i q:d"
    ),
    "conformal_coverage": sql(
        "select avg(cast(r <= (select q from q) as integer)) as coverage from residual", "coverage:d"
    ),
    "conformal_interval": sql(
        """select f.*, greatest(predicted - q, 0) as pred_lower_05, predicted + q as pred_upper_95
            from forecast as f, (select q from q)""",
        PREDICTION,
    ),
    "flatten_prediction": sql(
        "select *, greatest(predicted - 1.5, 0) as pred_lower_05, predicted + 1.5 as pred_upper_95 from forecast",
        PREDICTION,
    ),
    "training_summary": sql(
        f"select 'V1' as version, {ERRORS}, round((select q from q), 4) as conformal_q from forecast",
        f"version:t {ERROR_KINDS} conformal_q:d",
    ),
    "importance_share": sql(
        """select *, round(100 * importance_gain / sum(importance_gain) over (), 2) as importance_gain_pct,
            round(100 * importance_split / sum(importance_split) over (), 2) as importance_split_pct from (
            select p_brand as feature, cast(sum(cast(l_quantity as bigint)) as double) as importance_gain,
                cast(count(*) as double) as importance_split
            from lineitem join part on p_partkey = l_partkey group by all)
            order by importance_gain desc, feature limit 10""",
        "feature:t importance_gain:d importance_split:d importance_gain_pct:d importance_split_pct:d",
    ),
    "train_score": sql(
        f"select service_category, count(*) as n_rows, {ERRORS} from stump_forecast group by all",
        f"service_category:t n_rows:i {ERROR_KINDS}",
    ),
    "batch_score": sql(
        """select f.*, greatest(predicted - q, 0) as pred_lower_05, predicted + q as pred_upper_95
            from stump_forecast as f, (select q from stump_q)""",
        PREDICTION,
    ),
    "training_run": sql(
        f"""select 'V1' as version, s.*, round((select q from stump_q), 4) as conformal_q,
            {', '.join(f'round((a.{m} + b.{m}) / 2, 4) as cv_{m}' for m in ERROR_NAMES)}
            from (select {ERRORS} from stump_forecast) as s,
                (select {EXACT_ERRORS} from early_forecast) as a, (select {EXACT_ERRORS} from late_forecast) as b""",
        f"version:t {ERROR_KINDS} conformal_q:d " + " ".join(f"cv_{m}:d" for m in ERROR_NAMES),
    ),
    "importance_trees": sql(
        f"""select feature, cast(chosen as double) as importance_split, 100.0 * chosen as importance_gain_pct,
            100.0 * chosen as importance_split_pct
            from (select feature, cast(feature = (select feature from stump_split) as integer) as chosen
                from (select {listed([*NUMERIC_INPUTS, *CATEGORY_INPUTS])}))""",
        "feature:t importance_split:d importance_gain_pct:d importance_split_pct:d",
    ),
    "incremental_rows": of("daily", DAILY, "where target_date >= date '1999-01-01'"),
    "upsert_by_key": sql(
        """select location_id, service_category, target_date,
            case when target_date >= date '1999-01-01' then demand_count * 10 else demand_count end as demand_count
            from daily""",
        f"{PANEL} demand_count:i",
    ),
    "next_version": sql(
        """select p_type, p_brand, concat('V', 1 + coalesce(max(p_size) filter (p_size > 5), 0)) as next_version
            from part group by all""",
        "p_type:t p_brand:t next_version:t",
    ),
    "monitor_daily": sql(
        """select cast(prediction_timestamp as date) as day, count(*) as n_rows,
            sqrt(avg((actual - predicted) ** 2)) as rmse, avg(abs(actual - predicted)) as mae
            from forecast group by all""",
        "day:t n_rows:i rmse:d mae:d",
    ),
    "monitor_psi": sql(_psi(), "day:t n_rows:i psi:d"),
    "prediction_view": sql(
        """select location_id, service_category, count(*) as n_rows, sum(predicted) as total_predicted,
            'Predicted provider hours' as predicted_comment from forecast group by all""",
        "location_id:t service_category:t n_rows:i total_predicted:d predicted_comment:t",
    ),
    "check_unique": sql(
        """select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by all having count(*) > 1""",
        "l_orderkey:i l_linenumber:i n_rows:i",
    ),
    "check_not_null": sql(
        """select * from (select o_orderkey as id,
            case when o_totalprice < 20000 then null when o_orderpriority = '5-LOW' then 'migration'
                when o_orderpriority = '4-NOT SPECIFIED' then 'sched_booking_widget' else 'front_desk' end as source,
            case when o_totalprice <= 495000 then o_custkey end as client_id from orders)
            where source is null or client_id is null""",
        "id:t source:t client_id:t",
    ),
}
