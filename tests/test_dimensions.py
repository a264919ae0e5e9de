import random

import pandas as pd
import pytest

from footfall.plans import dimensions

from .conftest import at, day
from .fixtures import make


def test_location_profile(spark):
    locations = make(
        spark, "locations",
        dict(), dict(id="L2"), dict(id="L3", deleted_at=at("2025-01-01")), dict(id="L4", address='{"zip": "M5H 2N2"}'),
    )
    links = make(
        spark, "staff_locations",
        dict(), dict(staff_id="st2"), dict(staff_id="idle"), dict(staff_id="gone", active=False),
        dict(location_id="L2", staff_id="idle"),
    )
    staff = make(
        spark, "staff", dict(), dict(id="st2", inserted_at=at("2025-01-11 23:00")), dict(id="idle", active=False),
    )
    found = {r["location_id"]: r for r in dimensions.location_profile(locations, links, staff, day("2025-02-01")).collect()}
    assert sorted(found) == ["L1", "L2", "L4"]
    assert (found["L1"]["location_staff_count"], found["L1"]["avg_provider_tenure_days"]) == (3, (31 + 21) / 2)
    assert (found["L2"]["location_staff_count"], found["L2"]["avg_provider_tenure_days"]) == (1, None)
    assert (found["L4"]["location_staff_count"], found["L4"]["location_zip3"], found["L4"]["location_city"]) == (0, "M5H", None)
    assert (found["L1"]["location_zip"], found["L1"]["location_zip3"]) == ("90210", "902")


def test_menu_stats_equal_the_plain_join(spark):
    rng = random.Random(9)
    maybe = lambda v: None if rng.random() < 0.3 else v
    sites = [dict(id=f"L{i}", business_id=f"B{i % 2}") for i in range(5)]
    services = [
        dict(id=f"v{i}", business_id=f"B{i % 2}", category_id=f"c{i % 3}", duration=maybe(10 * i), default_price=maybe(100 + i), active=i != 7)
        for i in range(14)
    ]
    categories = [dict(id=f"c{i}", name=f"N{i}", active=i != 2) for i in range(3)]
    rules = [
        dict(
            location_id=f"L{rng.choice([0, 0, 0, 1, 2, 3])}", service_id=f"v{rng.choice([0, 0, 1, 2, 3, 4, 7])}",
            staff_id=rng.choice([None, None, "p1", "p2", "p3"]), staff_role_id=rng.choice([None, None, "r"]),
            deleted_at=rng.choice([None, None, None, at("2025-01-01")]), set_duration=maybe(rng.randint(1, 50)),
            set_price=maybe(rng.randint(1, 500)), set_bookable=rng.choice([True, True, False, None]),
        )
        for _ in range(120)
    ]
    tables = [make(spark, t, *d) for t, d in (
        ("locations", sites), ("services", services), ("service_categories", categories), ("service_rules", rules))]
    got = dimensions.menu_stats(*tables).toPandas().set_index(["location_id", "service_category"]).sort_index()

    rule = pd.DataFrame(rules).astype(object)
    rule = rule[rule.deleted_at.isna()]
    keep = ["location_id", "service_id"]
    own = rule[rule.staff_id.isna() & rule.staff_role_id.isna()][[*keep, "set_duration", "set_price"]]
    staff = rule[rule.staff_id.notna() & (rule.set_bookable == True)][[*keep, "staff_id"]]  # noqa: E712
    menu = pd.DataFrame(services).merge(pd.DataFrame(categories), left_on="category_id", right_on="id", suffixes=("", "_c"))
    menu = menu[menu.active & menu.active_c].rename(columns={"id": "service_id"})
    pairs = pd.DataFrame(sites).rename(columns={"id": "location_id"}).merge(menu, on="business_id")
    pairs = pairs.merge(own, on=keep, how="left").merge(staff, on=keep, how="left")
    pairs["d"] = pd.to_numeric(pairs.set_duration).fillna(pd.to_numeric(pairs.duration))
    pairs["p"] = pd.to_numeric(pairs.set_price).fillna(pd.to_numeric(pairs.default_price))
    expected = pairs.groupby(["location_id", "name"]).agg(
        d=("d", "mean"), p=("p", "mean"), n=("service_id", "nunique"), q=("staff_id", "nunique"))
    assert list(got.index) == list(expected.index)
    assert got.avg_menu_duration_min.tolist() == pytest.approx(expected.d.tolist(), nan_ok=True)
    assert got.avg_menu_price_cents.tolist() == pytest.approx(expected.p.tolist(), nan_ok=True)
    assert got.num_services_in_category.tolist() == expected.n.tolist()
    assert got.num_qualified_providers.tolist() == expected.q.tolist()


def test_menu_stats_read_rules_and_menu_once(spark, tmp_path, monkeypatch):
    names = ("locations", "services", "service_categories", "service_rules")
    for name in names:
        make(spark, name, dict(), dict()).write.parquet(f"{tmp_path}/{name}")
    plans = []
    written = dimensions.cut
    monkeypatch.setattr(dimensions, "cut", lambda df: plans.append(df) or written(df))
    result = dimensions.menu_stats(*[spark.read.parquet(f"{tmp_path}/{name}") for name in names])
    read = []
    for df in [*plans, result]:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        read += [leaves.apply(i).relation().location().rootPaths().mkString() for i in range(leaves.size())]
    assert [sum(path.endswith(f"/{name}") for path in read) for name in names[1:]] == [1, 1, 1], read


def test_capacity_counts_active_staff_once(spark, rows):
    links = make(spark, "staff_locations", dict(), dict(), dict(staff_id="idle"), dict(staff_id="st2", active=False))
    staff = make(spark, "staff", dict(), dict(id="idle", active=False), dict(id="st2"))
    assert rows(dimensions.scheduled_capacity(links, staff)) == [("L1", 1, 8.0)]


def test_account_defaults(spark):
    locations = make(spark, "locations", dict(), dict(id="L2", crm_account_id=None))
    found = {r["location_id"]: r for r in dimensions.account_profile(locations, make(spark, "crm_account", {})).collect()}
    hit, miss = found["L1"], found["L2"]
    assert (hit["sf_vertical"], hit["sf_is_enterprise"], hit["sf_is_franchise"], hit["sf_active_locations"]) == ("Unknown", 1, 0, 2)
    assert (miss["sf_industry"], miss["sf_active_locations"], miss["sf_total_arr"], miss["sf_account_tenure"]) == (None, 1, 0.0, 0)
