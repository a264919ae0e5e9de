"""Small literal relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def literal_ids(spark: SparkSession) -> DataFrame:
    """Two rows: id 1, and a NULL id that a not-null check must find."""
    return spark.createDataFrame([(1,), (None,)], "id bigint")
