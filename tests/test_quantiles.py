import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from footfall.operators import errors
from footfall.operators.quantiles import exact_quantiles

LEVELS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]


def check(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert exact_quantiles(df, "x", LEVELS) == pytest.approx(list(np.quantile(values, LEVELS)), rel=1e-12, abs=1e-12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60))
def test_small_lists(spark, values):
    check(spark, values)


def test_ties_and_outliers(spark):
    rng = np.random.default_rng(0)
    check(spark, np.concatenate([np.zeros(4000), rng.exponential(1, 3000), [1e15, -1e12]]))


def test_many_passes(spark):
    check(spark, np.concatenate([1e-9 * np.arange(5000), [1e12]]))


def test_empty_and_missing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert exact_quantiles(df, "x", [0.5]) == [None]


def test_conformal_quantile_and_coverage(spark):
    rng = np.random.default_rng(2)
    actual, predicted = rng.normal(10, 3, 997), np.full(997, 10.0)
    df = spark.createDataFrame(list(zip(actual.tolist(), predicted.tolist())), "a double, p double")
    q, n = errors.conformal_quantile(df, "a", "p")
    assert n == 997
    assert q == pytest.approx(np.quantile(abs(actual - predicted), min(1, 0.9 * (1 + 1 / n))))
    assert errors.coverage(df, "a", "p", q).first()["coverage"] >= 0.9 - 1 / n
    assert errors.conformal_level(5) == 1.0


def test_error_metrics(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0), (4.0, 4.0)], "a double, p double")
    row = errors.error_metrics(df, "a", "p").first()
    assert row[1:] == (round(math.sqrt(2 / 3), 4), 0.6667, 33.3333, 25.0)
    none = errors.error_metrics(df.where("a = 0"), "a", "p").first()
    assert math.isnan(none["wape_pct"]) and math.isnan(none["mape_pct"])
    assert errors.error_metrics(df.where("a = 0"), "a", "p", empty=0.0).first()["wape_pct"] == 0.0


def test_infinite_values_and_wide_spans(spark):
    """Infinite values take the first and last ranks, and a span wider than any number is still narrowed."""

    def at_ranks(values):
        df = spark.createDataFrame([(float(v),) for v in values], "x double")
        ranks = [i / (len(values) - 1) for i in range(len(values))]
        assert exact_quantiles(df, "x", ranks) == sorted(map(float, values))

    at_ranks([1, 2, 3, math.inf, 5])
    at_ranks([-math.inf, 4, -math.inf, 2, math.inf])
    at_ranks([math.inf, math.inf, -math.inf])
    at_ranks([-1.2e308, 1, 2, 3, 1.2e308])
