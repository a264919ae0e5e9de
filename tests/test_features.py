from footfall.plans import features
from footfall.sources.holidays import holiday_table

from .conftest import at, day
from .fixtures import make_all

# The contract: 103 columns in this order.
COLUMNS = """
location_id service_category target_date provider_hours_demanded demand_count
day_of_week day_of_month month_num quarter week_of_year day_of_year is_weekend is_holiday days_to_nearest_holiday
location_age_days latitude longitude location_state location_city location_zip3 license_tier
location_staff_count avg_provider_tenure_days num_providers_scheduled total_available_hours utilization_rate_recent
num_services_offered avg_service_duration_min avg_service_price_cents num_qualified_providers
count_appts_l7d count_appts_l30d count_appts_dow_avg count_appts_lag_7d count_appts_lag_14d count_appts_lag_28d
hours_provider_lag_7d count_appts_lag_364d count_appts_trend_4w hours_provider_l7d hours_provider_l30d
hours_provider_lag_14d hours_provider_lag_28d hours_provider_lag_364d hours_provider_trend_4w
hours_provider_per_appt_l30d hours_provider_dow_avg
comp_zip3_count_appts_l7d comp_zip3_count_appts_l30d comp_zip3_count_appts_lag_7d comp_zip3_count_appts_lag_28d
comp_zip3_hours_provider_l7d comp_zip3_hours_provider_l30d comp_zip3_hours_provider_lag_7d
comp_zip3_hours_provider_lag_28d zip3_count_appts_dow_avg zip3_hours_provider_dow_avg zip3_num_locations
comp_zip_count_appts_l7d comp_zip_count_appts_l30d comp_zip_count_appts_lag_7d comp_zip_count_appts_lag_28d
comp_zip_hours_provider_l7d comp_zip_hours_provider_l30d comp_zip_hours_provider_lag_7d
comp_zip_hours_provider_lag_28d zip_count_appts_dow_avg zip_hours_provider_dow_avg zip_num_locations
avg_lead_time_days booked_internally_ratio self_booked_ratio booked_online_ratio staff_requested_ratio
avg_price_cents avg_discount_cents avg_discount_pct discount_adoption_ratio
email_msgs_l30d sms_msgs_l7d total_msgs_l30d
sf_active_locations sf_total_arr sf_avg_gmv_per_loc sf_gpv_per_appt sf_take_rate sf_initial_acv
sf_vertical sf_segment sf_plan_type sf_is_enterprise sf_is_franchise sf_is_corporate sf_payment_processing
sf_account_tenure sf_est_monthly_appts sf_industry sf_account_type
location_country location_province location_zip location_tz sf_created_date
""".split()


def build(spark, as_of="2026-05-01", **overrides):
    table = features.feature_table(make_all(spark, **overrides), holiday_table(spark), day(as_of))
    assert table.columns == COLUMNS and len(COLUMNS) == 103
    return table.orderBy("location_id", "service_category", "target_date").collect()


def visits(*days, location="L1", minutes=60, tag="a"):
    times = [at(f"{d} 10:00") for d in days]
    return (
        [dict(id=f"{tag}{i}", location_id=location, time=t) for i, t in enumerate(times)],
        [dict(id=f"{tag}s{i}", appointment_id=f"{tag}{i}", duration=minutes) for i in range(len(times))],
    )


def test_history_market_and_messages(spark):
    own, own_lines = visits("2022-12-31", "2026-04-02", "2026-04-03")
    near, near_lines = visits("2026-04-01", "2026-04-02", location="L2", tag="b")
    result = build(
        spark,
        appointments=own + near,
        appointment_services=own_lines + near_lines,
        locations=[dict(), dict(id="L2", address='{"city": "Town", "zip": "90211"}')],
        staff_locations=[dict(), dict(location_id="L2")],
        marketing_email=[dict(sent_at=at("2026-04-02 09:00")), dict(sent_at=at("2026-04-03 09:00"))],
        marketing_sms=[dict(sent_at=at("2026-03-20 09:00"))],
        service_rules=[dict(set_duration=30), dict(staff_id="st1", set_bookable=True)],
    )
    by_key = {(r["location_id"], r["target_date"].isoformat()): r for r in result}
    assert len(result) == 4  # 2022 is history only
    last = by_key["L1", "2026-04-03"]
    assert (last["count_appts_l7d"], last["hours_provider_l30d"], last["count_appts_lag_7d"]) == (2, 2.0, 0)
    assert (last["comp_zip3_count_appts_l7d"], last["zip3_num_locations"]) == (4 - 2, 1)
    assert (last["comp_zip_count_appts_l7d"], last["zip_num_locations"]) == (0, 1)
    assert by_key["L1", "2026-04-02"]["zip3_num_locations"] == 2
    assert (last["email_msgs_l30d"], last["sms_msgs_l7d"], last["total_msgs_l30d"]) == (1, 0, 2)
    assert (last["day_of_week"], last["is_weekend"], last["week_of_year"], last["is_holiday"]) == (5, 0, 14, 0)
    assert (last["avg_service_duration_min"], last["avg_service_price_cents"], last["num_qualified_providers"]) == (30.0, 900.0, 1)
    assert last["utilization_rate_recent"] == round(2 / 7 * 30 / 60 / 8, 4)
    assert last["location_age_days"] == (day("2026-04-03") - day("2020-01-01")).days


def test_menu_defaults_where_names_differ(spark):
    own, lines = visits("2026-04-02")
    row = build(
        spark, appointments=own, appointment_services=lines,
        service_categories_curated=[dict(service_classification='{"labels": ["Styling"]}')],
    )[0]
    assert (row["service_category"], row["avg_service_duration_min"], row["avg_service_price_cents"]) == ("Styling", 60.0, 5000.0)
    assert (row["num_qualified_providers"], row["num_services_offered"]) == (0, 1)


def test_filters(spark):
    full, full_lines = visits("2026-04-02", minutes=480)
    over, over_lines = visits("2026-04-03", minutes=481, tag="b")
    today, today_lines = visits("2026-05-01", tag="c")
    lonely, lonely_lines = visits("2026-04-02", location="L2", tag="d")
    no_city, no_city_lines = visits("2026-04-02", location="L3", tag="e")
    result = build(
        spark,
        appointments=full + over + today + lonely + no_city,
        appointment_services=full_lines + over_lines + today_lines + lonely_lines + no_city_lines,
        locations=[dict(), dict(id="L2"), dict(id="L3", address='{"zip": "90210"}')],
        staff_locations=[dict(), dict(location_id="L2", staff_id="idle"), dict(location_id="L3")],
        staff=[dict(), dict(id="idle", active=False)],
    )
    assert [(r["location_id"], r["target_date"]) for r in result] == [("L1", day("2026-04-02"))]
