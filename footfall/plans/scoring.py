"""Incremental scoring: only days after the last scored one, merged by key."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.errors import interval_columns
from ..sources.sinks import VersionedTable, between_days, upsert
from .demand import DAY
from .training import TARGET, DemandModel

PREDICTION_KEYS = ("location_id", "service_category", "prediction_timestamp")
PREDICTION_COLUMNS = (*PREDICTION_KEYS, "actual", "predicted", "pred_lower_05", "pred_upper_95")
PREDICTION_DAY = "prediction_date"


def high_water_mark(spark: SparkSession, path: str) -> date | None:
    """The last day stored at `path`, from its commit record: no row and no folder is read, however long the history."""
    latest = VersionedTable(spark, path, PREDICTION_DAY).latest()
    return latest and date.fromisoformat(latest)


def rows_after(features: DataFrame, day: str, latest: date | None) -> DataFrame:
    """Rows of days later than `latest`; all rows if that is None."""
    return features if latest is None else between_days(features, day, latest + timedelta(days=1))


def prediction_record(predicted: Column, q: float) -> Column:
    """Point forecast and interval as one struct, the model call's result."""
    return F.struct(*interval_columns(predicted, q))


def flatten_prediction(df: DataFrame, record: str) -> DataFrame:
    """The fields of a prediction struct as double columns beside the other columns."""
    fields = [F.col(f"{record}.{name}").cast("double").alias(name) for name in PREDICTION_COLUMNS[-3:]]
    return df.select(*[c for c in df.columns if c != record], *fields)


def score(features: DataFrame, model: DemandModel) -> DataFrame:
    """The seven prediction columns for rows with a known actual."""
    known = features.where(F.col(TARGET).isNotNull())
    scored = model.predict(known).select(
        "location_id",
        "service_category",
        F.col(DAY).cast("timestamp_ntz").alias("prediction_timestamp"),
        F.col(TARGET).alias("actual"),
        prediction_record(F.col("prediction"), model.conformal_q).alias("record"),
    )
    return flatten_prediction(scored, "record")


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return VersionedTable(spark, path, PREDICTION_DAY).read().select(*PREDICTION_COLUMNS)


def score_incrementally(
    features: DataFrame,
    model: DemandModel,
    path: str,
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """Scores new days into the prediction table at `path` and returns the table.

    The first run scores `first`..`last` (everything if not given); later runs
    score the days after the latest one stored.
    """
    latest = high_water_mark(features.sparkSession, path)
    due = between_days(features, DAY, first, last) if latest is None else rows_after(features, DAY, latest)
    stored = score(due, model).withColumn(PREDICTION_DAY, F.col("prediction_timestamp").cast("date"))
    return upsert(stored, path, PREDICTION_KEYS, PREDICTION_DAY).select(*PREDICTION_COLUMNS)
