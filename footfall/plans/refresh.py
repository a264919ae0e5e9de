"""The whole daily job: features, model, scores, monitor."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import temporary
from ..sources.holidays import holiday_table
from ..sources.sinks import replace_table, write_sorted
from . import features as feature_plan
from . import monitoring, scoring, training
from .demand import DAY, PANEL_KEYS


def refresh_features(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    path: str,
    as_of: date,
    holidays: DataFrame | None = None,
    first_day: date = feature_plan.FIRST_DAY,
) -> DataFrame:
    """Rebuilds the feature table, stored by month and sorted by key inside each file.

    The result has the column `month` beside the features: day bounds set by `between_days` prune its folders.
    """
    holidays = holidays if holidays is not None else holiday_table(spark)
    table = feature_plan.feature_table(tables, holidays, as_of, first_day)
    write_sorted(table, path, DAY, PANEL_KEYS)
    return spark.read.schema(f"{_ddl(table)}, month string").parquet(path)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def refresh(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    root: str,
    as_of: date,
    windows: training.Windows,
    boosting: training.Boosting = training.Boosting(),
    holidays: DataFrame | None = None,
    first_day: date = feature_plan.FIRST_DAY,
    retrain: bool = True,
) -> dict[str, DataFrame]:
    """Runs every stage under `root` and returns the resulting tables; scratch files of the stages are gone by then."""
    with temporary(spark):
        return _refreshed(spark, tables, root, as_of, windows, boosting, holidays, first_day, retrain)


def _refreshed(spark, tables, root, as_of, windows, boosting, holidays, first_day, retrain) -> dict[str, DataFrame]:
    table = refresh_features(spark, tables, f"{root}/features", as_of, holidays, first_day)
    store = training.ModelStore(spark, f"{root}/model")
    result = {"features": table.drop("month")}
    if retrain:
        result["summary"] = training.train(table, store, windows, boosting)
        replace_table(result["summary"], f"{root}/training_summary")
    model = store.load()
    predictions = scoring.score_incrementally(
        table, model, f"{root}/predictions", windows.test_start, windows.test_end
    )
    horizon = windows.test_start + timedelta(days=(windows.test_end - windows.test_start).days // 2)
    baseline = predictions.where(F.col("prediction_timestamp").cast("date") <= F.lit(horizon))
    quality = monitoring.update_monitor(spark, f"{root}/predictions", scoring.PREDICTION_DAY, f"{root}/monitor", baseline)
    result.update(predictions=predictions, monitor=quality)
    return result
