import random
from datetime import timedelta

import pytest

from footfall.operators.trailing import Series

from .conftest import day


def rolled(spark, data, calendar):
    df = spark.createDataFrame(data, "k string, d date, x bigint, y double")
    series = Series(("k",), "d", calendar)
    return {
        (r["k"], r["d"]): r
        for r in df.select(
            "k", "d",
            series.total("x", 7).alias("total7"), series.mean("y", 14).alias("mean14"), series.lag("x", 7).alias("lag7"),
            series.weekday_mean("y").alias("weekday"), series.trend("y").alias("trend"), series.ratio("y", "x", 30).alias("ratio"),
        ).collect()
    }


def test_first_row_is_zero(spark):
    row = rolled(spark, [("a", day("2026-01-01"), 5, 2.0)], False)[("a", day("2026-01-01"))]
    assert row[2:] == (0, 0.0, 0, 0.0, 0.0, 0.0)


def test_rows_and_days_differ_on_gaps(spark):
    data = [("a", day(f"2026-01-0{d}"), d, 1.0) for d in (1, 2, 9)]
    last = ("a", day("2026-01-09"))
    by_row, by_day = rolled(spark, data, False)[last], rolled(spark, data, True)[last]
    assert (by_row["total7"], by_day["total7"]) == (3, 2)
    assert (by_row["lag7"], by_day["lag7"]) == (0, 2)


@pytest.mark.parametrize("calendar", [False, True])
def test_against_brute_force(spark, calendar):
    rng = random.Random(3)
    data = []
    for key in "ab":
        days = sorted(rng.sample(range(500), 160))
        data += [(key, day("2024-01-01") + timedelta(d), rng.randint(0, 4), rng.random()) for d in days]
    got = rolled(spark, data, calendar)
    for key in "ab":
        series = [r for r in data if r[0] == key]
        for i, (_, d, *_rest) in enumerate(series):

            def span(first, last=1, pool=None, steps=None):
                pool = series if pool is None else pool
                at = [r[1] for r in pool].index(d)
                if calendar:
                    return [r for r in pool if first * (steps or 1) >= (d - r[1]).days >= last]
                return pool[max(0, at - first) : max(0, at - last + 1)]

            mean = lambda part: sum(r[3] for r in part) / len(part) if part else 0.0
            same = [r for r in series if r[1].weekday() == d.weekday()]
            month = span(30)
            lag = span(7, 7)
            counted = sum(r[2] for r in month)
            row = got[(key, d)]
            assert row["total7"] == sum(r[2] for r in span(7))
            assert row["lag7"] == (lag[0][2] if lag else 0)
            assert row["mean14"] == pytest.approx(mean(span(14)))
            assert row["weekday"] == pytest.approx(mean(span(52, 1, same, 7)))
            assert row["trend"] == pytest.approx(mean(span(14)) - mean(span(28, 15)))
            assert row["ratio"] == pytest.approx(sum(r[3] for r in month) / counted if counted else 0.0)
