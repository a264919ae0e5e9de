import random

import pandas as pd
import pytest

from footfall.plans import demand

from .conftest import at, day
from .fixtures import make, make_all


def test_qualifying_rules(spark, rows):
    appointments = make(
        spark,
        "appointments",
        dict(id="plain"),
        dict(id="by_staff", cancelled=True),
        dict(id="by_client", cancelled=True),
        dict(id="unknown_staff", cancelled=None),
        dict(id="null_source", source=None),
        dict(id="migrated", source="migration"),
        dict(id="null_client", client_id=None),
        dict(id="pending", state="booked"),
    )
    cancellations = make(
        spark,
        "appointment_cancellations",
        dict(appointment_id="by_staff"),
        dict(appointment_id="by_staff"),
        dict(appointment_id="by_staff", reason="client_cancel"),
        dict(appointment_id="by_client", reason="client_cancel"),
        dict(appointment_id="unknown_staff"),
        dict(appointment_id="plain", reason="client_cancel"),
        dict(appointment_id="plain", reason="other"),
    )
    kept = demand.qualifying_visits(appointments, cancellations)
    assert rows(kept, "appointment_id", "copies") == [("by_staff", 2), ("plain", 2), ("unknown_staff", 1)]


@pytest.mark.parametrize(
    "time, tz, expected",
    [
        ("2026-04-03 22:00", "America/Los_Angeles", "2026-04-04"),
        ("2026-04-03 22:00", "Asia/Tokyo", "2026-04-03"),
        ("2026-03-08 02:30", "America/Los_Angeles", "2026-03-08"),
    ],
)
def test_utc_day(spark, time, tz, expected):
    appointments = make(spark, "appointments", dict(time=at(time), tz=tz))
    kept = demand.qualifying_visits(appointments, make(spark, "appointment_cancellations"))
    assert kept.first()["target_date"] == day(expected)


def test_options_repeat_a_line(spark):
    tables = make_all(
        spark,
        appointment_service_options=[dict(duration_delta=10, price_delta=100), dict(duration_delta=None)],
    )
    row = demand.demand_from_sources(tables).first()
    assert row["demand_count"] == 2
    assert row["provider_hours_demanded"] == (60 + 10 + 60) / 60
    assert row["avg_price_cents"] == (1100 + 1000) / 2
    assert row["avg_lead_time_days"] == 2


def test_null_part_voids_the_line_but_not_the_count(spark):
    tables = make_all(
        spark,
        appointment_services=[dict(), dict(id="s2", finish_duration=None), dict(id="s3", post_client_duration=None)],
    )
    row = demand.demand_from_sources(tables).first()
    assert (row["demand_count"], row["provider_hours_demanded"]) == (3, 2.0)


def test_label_rules(spark, rows):
    tables = make_all(
        spark,
        services=[dict(), dict(id="svc2", category_id="cat2"), dict(id="svc3", active=False), dict(id="svc4", category_id="cat4")],
        service_categories=[dict(), dict(id="cat2", name="Nails"), dict(id="cat4", name="Brows", active=False)],
        service_categories_curated=[dict(), dict(name="Nails", service_classification='{"labels": []}')],
        appointment_services=[dict(id=f"s{i}", service_id=f"svc{i}") for i in (1, 2, 3, 4)],
    )
    assert rows(demand.demand_from_sources(tables), "service_category", "demand_count") == [("Hair", 1)]


def test_weights_equal_the_plain_join(spark):
    """Random tables with hot keys: the weighted aggregate equals the row-by-row join."""
    rng = random.Random(5)
    visits = [f"a{i}" for i in range(30)]
    pick = lambda keys: keys[0] if rng.random() < 0.35 else rng.choice(keys)
    maybe = lambda value: None if rng.random() < 0.15 else value
    lines = [f"s{i}" for i in range(80)]
    tables = make_all(
        spark,
        appointments=[
            dict(
                id=v, cancelled=rng.choice([True, False, False]), booked_by_id=maybe("x"), source=rng.choice(["front", "sched_booking_widget"]),
                time=at(f"2026-04-0{rng.randint(1, 3)} 10:00"), inserted_at=maybe(at("2026-03-20 08:00")),
            )
            for v in visits
        ],
        appointment_cancellations=[
            dict(appointment_id=pick(visits), reason=rng.choice(["staff_cancel", "client"])) for _ in range(40)
        ],
        appointment_services=[
            dict(
                id=s, appointment_id=pick(visits), price=maybe(rng.randint(1, 99)), duration=maybe(rng.randint(5, 90)),
                discount_cents=maybe(rng.randint(0, 3)), staff_requested=maybe(rng.random() < 0.5),
                requires_focus=maybe(rng.random() < 0.5), post_client_duration=maybe(7),
            )
            for s in lines
        ],
        appointment_service_options=[
            dict(appointment_service_id=pick(lines), price_delta=maybe(5), duration_delta=maybe(3), post_client_duration_delta=maybe(1))
            for _ in range(90)
        ],
    )
    got = demand.demand_from_sources(tables).toPandas().set_index("target_date").sort_index()

    a, c, s, o = (
        tables[t].toPandas().astype(object)
        for t in ("appointments", "appointment_cancellations", "appointment_services", "appointment_service_options")
    )
    joined = a.merge(c, left_on="id", right_on="appointment_id", how="left")
    joined = joined[(joined.cancelled == False) | (joined.reason == "staff_cancel")]  # noqa: E712
    joined = joined.drop(columns="appointment_id").merge(s, left_on="id", right_on="appointment_id", suffixes=("", "_line"))
    joined = joined.merge(o, left_on="id_line", right_on="appointment_service_id", how="left")
    joined["day"] = pd.to_datetime(joined.time).dt.date
    number = lambda column: pd.to_numeric(joined[column])
    delta = lambda column: number(column).fillna(0)
    focus = joined.requires_focus.map(lambda v: v is True)
    minutes = number("duration") + delta("duration_delta") + (
        number("post_client_duration") + delta("post_client_duration_delta")
    ).where(focus, 0)
    lead = (pd.to_datetime(joined.day) - pd.to_datetime(joined.inserted_at).dt.normalize()).dt.days
    by = joined.day
    expected = {
        "demand_count": by.groupby(by).size(),
        "provider_hours_demanded": minutes.groupby(by).sum() / 60,
        "avg_price_cents": (number("price") + delta("price_delta")).groupby(by).mean(),
        "avg_discount_cents": delta("discount_cents").groupby(by).mean(),
        "avg_lead_time_days": lead.groupby(by).mean(),
        "booked_internally_ratio": joined.booked_by_id.notna().groupby(by).mean().round(4),
        "staff_requested_ratio": joined.staff_requested.map(lambda v: v is True).groupby(by).mean().round(4),
        "avg_duration_min": (number("duration") + delta("duration_delta")).groupby(by).mean(),
    }
    for name, values in expected.items():
        assert got[name].astype(float).tolist() == pytest.approx(values.astype(float).tolist(), abs=1e-4), name
