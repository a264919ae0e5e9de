"""Every registered query against its SQL, and the shape of the plans."""

import math
import random
import re

import pytest

import __spark_entry__ as driver
from workload import tidy
from workload.oracle import ORACLE
from workload.queries import QUERIES
from workload.verify import connect, difference

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query(spark, connection, key):
    assert difference(QUERIES[key](spark, SMALL).toPandas(), connection.sql(ORACLE[key]).df()) == ""


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for large tables."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_all_pairs_join(spark, no_broadcast, key):
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan_of(QUERIES[key](spark, SMALL)))


def test_history_windows_need_one_exchange(spark, no_broadcast):
    from footfall.plans.demand import rolling_demand
    from footfall.session import cut
    from workload.queries import daily

    panel = cut(daily(spark, SMALL))
    plan = plan_of(rolling_demand(panel))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert len(re.findall(r"Window \[", plan)) == 2


def test_clustered_panel_moves_no_row(spark, no_broadcast):
    plan = plan_of(QUERIES["clustered_panel"](spark, SMALL))
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["trailing_event_counts"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,purchase)" in plan
    assert not re.search(r"ReadSchema: struct<[^>]*props", plan)


def test_panel_moves_twice_after_its_windows(spark, no_broadcast):
    """Once for location days and once for markets, never by location alone."""
    plan = plan_of(QUERIES["feature_table"](spark, SMALL)).splitlines()
    depth = [len(re.match(r"[\s:|]*", line).group()) for line in plan]
    window = next(i for i, line in enumerate(plan) if "Window [" in line)
    moves, limit = [], depth[window]
    for i in range(window - 1, 0, -1):  # the ancestors of the panel's windows
        if depth[i] < limit:
            limit = depth[i]
            moves += re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan[i])
    keys = [re.findall(r"(\w+)#", move) for move in moves]
    assert keys == [["location_id", "target_date"], ["location_zip", "service_category", "target_date"]]


def test_rounding_without_decimals_gives_the_same_doubles(spark):
    chance = random.Random(4)
    values = [chance.uniform(-1, 1) * 10 ** chance.randrange(-8, 14) for _ in range(4000)]
    values += [k / 2 * 10.0**-d + e for k in range(-40, 41) for d in (6, 9) for e in (0.0, -tidy.NUDGE, 1e-15, -1e-15)]
    values += [k / 60 for k in range(5000)] + [0.0, -0.0, math.nan, math.inf, -math.inf, None]
    df = spark.createDataFrame([(v, v) for v in values], "price double, hours double")
    for name, digits in (("price", 6), ("hours", 9)):
        same = df.selectExpr(f"({tidy.rounded(name)}) + 0D as a", f"round({name} + {tidy.NUDGE}D, {digits}) + 0D as b")
        assert same.where("not (a <=> b)").count() == 0
    plan = tidy.tidy(df)._jdf.queryExecution().analyzed().toString()
    assert plan.count("rint") >= 2
