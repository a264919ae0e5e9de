"""Ratios that neither fail nor divide by zero under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RATIO_DIGITS = 4


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """`numerator / denominator` in double; NULL where the denominator is 0."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def round_ratio(ratio: Column) -> Column:
    """Ratio to four digits, half away from zero, as exact decimals round.

    The detour over a decimal drops the noise that a chain of double
    operations leaves on a value that lies on a tie.
    """
    return F.round(ratio.cast("decimal(28,12)"), RATIO_DIGITS).cast("double")


def share_of_rows(condition: Column, weight: Column | None = None) -> Column:
    """Aggregate: rounded share of rows for which `condition` is true.

    `weight` says how many identical rows each input row stands for.
    """
    weight = F.lit(1) if weight is None else weight
    hits = F.sum(F.when(condition, weight).otherwise(F.lit(0)))
    return round_ratio(safe_ratio(hits, F.sum(weight)))


def weighted_mean(total: Column, value: Column, weight: Column) -> Column:
    """Aggregate: mean over rows standing for `weight` copies each.

    `total` is the sum over a row's copies; rows with a NULL `value` count
    neither above nor below the line, as in a plain AVG.
    """
    return safe_ratio(F.sum(total), F.sum(F.when(value.isNotNull(), weight)))


def clamped_difference(left: Column, right: Column) -> Column:
    """`left - right`, not below zero; zero as well where a side is missing."""
    difference = left - right
    return F.greatest(difference, F.lit(0).cast("bigint"))
