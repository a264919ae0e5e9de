"""Data checks: each returns the offending rows, so an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; NULL keys are ignored."""
    present = df.dropna(subset=list(keys))
    return present.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of `columns`."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))
