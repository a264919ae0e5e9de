"""Regression error measures and conformal intervals as plain aggregates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import safe_ratio
from .quantiles import quantiles_with_count

DIGITS = 4
ALPHA = 0.10


def error_columns(actual: str, predicted: str, empty: float = math.nan) -> dict[str, Column]:
    """Aggregates: RMSE, MAE, and WAPE and MAPE in percent.

    WAPE is the total absolute error over the total actual; MAPE averages over
    rows with a positive actual. Both are `empty` where no actual is positive.
    """
    y = F.col(actual)
    error = y - F.col(predicted)
    relative = F.when(y > 0, F.abs(error) / F.nullif(y, F.lit(0.0)))
    total = F.sum(y)
    wape = F.when(total > 0, safe_ratio(F.sum(F.abs(error)), total) * 100).otherwise(F.lit(empty))
    return {
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "wape_pct": wape,
        "mape_pct": F.coalesce(F.avg(relative) * 100, F.lit(empty)),
    }


def error_metrics(df: DataFrame, actual: str, predicted: str, by: tuple[str, ...] = (), empty: float = math.nan):
    """Rounded error measures of all rows, or per group of `by`."""
    rounded = [F.round(c, DIGITS).alias(n) for n, c in error_columns(actual, predicted, empty).items()]
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), *rounded)


def conformal_level(n: int, alpha: float = ALPHA) -> float:
    """Quantile level that gives coverage 1 - alpha with `n` calibration rows."""
    return min(1.0, (1 - alpha) * (1 + 1 / n)) if n else 1.0


def conformal_quantile(df: DataFrame, actual: str, predicted: str, alpha: float = ALPHA) -> tuple[float | None, int]:
    """Half-width of the prediction interval, and the number of calibration rows."""
    residuals = df.select(F.abs(F.col(actual) - F.col(predicted)).alias("residual"))
    (q,), n = quantiles_with_count(residuals, "residual", lambda n: [conformal_level(n, alpha)])
    return q, n


def coverage(df: DataFrame, actual: str, predicted: str, q: float) -> DataFrame:
    """Share of rows whose actual lies within `q` of the prediction."""
    inside = F.abs(F.col(actual) - F.col(predicted)) <= F.lit(q)
    return df.agg(F.avg(inside.cast("double")).alias("coverage"))


def interval_columns(predicted: Column, q: float) -> list[Column]:
    """Prediction with its symmetric interval; the lower bound stops at zero."""
    return [
        predicted.alias("predicted"),
        F.greatest(predicted - F.lit(q), F.lit(0.0)).alias("pred_lower_05"),
        (predicted + F.lit(q)).alias("pred_upper_95"),
    ]
