"""Training: time-ordered split, boosted trees, calibration, versioned model store."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.boosting import BoostedTrees, Growth, fit_trees
from ..operators.errors import ALPHA, conformal_quantile, coverage, error_columns, error_metrics
from ..operators.vocabulary import earlier_means, target_means, values_by_row
from ..session import cut, temporary
from ..sources.sinks import append_rows, between_days, claim, path_exists, replace_table

TARGET = "provider_hours_demanded"
DAY = "target_date"

# The model's input contract, in order.
NUMERIC_INPUTS = (
    "day_of_week", "day_of_month", "week_of_year", "day_of_year", "is_weekend", "is_holiday",
    "days_to_nearest_holiday", "location_age_days", "location_staff_count",
    "count_appts_l7d", "count_appts_l30d", "count_appts_dow_avg", "count_appts_lag_7d",
    "count_appts_lag_14d", "count_appts_lag_28d", "count_appts_lag_364d", "count_appts_trend_4w",
    "hours_provider_l7d", "hours_provider_l30d", "hours_provider_dow_avg", "hours_provider_lag_7d",
    "hours_provider_lag_14d", "hours_provider_lag_28d", "hours_provider_lag_364d",
    "hours_provider_trend_4w", "hours_provider_per_appt_l30d",
    "avg_lead_time_days", "email_msgs_l30d", "sms_msgs_l7d", "sf_account_tenure",
)
CATEGORY_INPUTS = ("service_category", "location_city", "sf_segment", "sf_industry")
# Number of a row inside one stored table.
ROW = "_row"
# Scored rows that are stored beside a model, for `ModelStore.differing`.
SAMPLE_ROWS = 100
FOLDS = 2


@dataclass(frozen=True)
class Windows:
    train_start: date = date(2025, 1, 1)
    train_end: date = date(2026, 3, 31)
    test_start: date = date(2026, 4, 1)
    test_end: date = date(2026, 4, 30)


@dataclass(frozen=True)
class Boosting(Growth):
    """As `Growth`; category means are rounded to `mean_digits` digits if that is given."""

    mean_digits: int | None = None


@dataclass
class DemandModel:
    trees: BoostedTrees
    vocabularies: DataFrame
    conformal_q: float = 0.0
    version: str = ""
    metrics: dict[str, float] = field(default_factory=dict)

    def predict(self, df: DataFrame) -> DataFrame:
        """`df` with the column `prediction`; a missing number or an unseen category takes a split's missing side."""
        numbered = cut(df.withColumn(ROW, F.monotonically_increasing_id()))
        values = values_by_row(numbered, ROW, self.vocabularies, CATEGORY_INPUTS)
        inputs = model_inputs([f"code_{c}" for c in CATEGORY_INPUTS])
        return numbered.join(values, ROW).withColumn("prediction", self.trees.column(inputs)).select(*df.columns, "prediction")


def training_slice(features: DataFrame, first: date, last: date, extra: tuple[str, ...] = ()) -> DataFrame:
    """Model columns only, of the days from `first` to `last`."""
    columns = dict.fromkeys((*NUMERIC_INPUTS, *CATEGORY_INPUTS, TARGET, DAY, *extra))
    return between_days(features, DAY, first, last).select(*columns)


def split_label(day: Column, windows: Windows) -> Column:
    """'train', 'test', or NULL for a day in neither window."""
    in_train = day.between(F.lit(windows.train_start), F.lit(windows.train_end))
    in_test = day.between(F.lit(windows.test_start), F.lit(windows.test_end))
    return F.when(in_train, "train").when(in_test, "test")


def time_blocks(df: DataFrame, day: str, blocks: int) -> DataFrame:
    """Per day: rows, rows before it, and its block out of `blocks` of about equal size.

    Fold k of the expanding-window validation trains on the blocks before k and
    validates on block k. A day is never split; where one holds more than a
    block's rows, later blocks start later, so every block has a day as long as
    there are days enough. The running sums cover one row per day.
    """
    per_day = df.groupBy(day).agg(F.count("*").alias("n_rows"))
    ordered = Window.orderBy(day)
    before = F.coalesce(F.sum("n_rows").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = per_day.withColumn("rows_before", before)
    total = per_day.agg(F.sum("n_rows")).scalar()
    position = F.row_number().over(ordered) - 1
    even = F.floor(F.col("rows_before") * F.lit(blocks) / total)
    counted = counted.withColumns({"_at": position, "_ahead": even - position})
    # No step of more than one block from day to day, and no more blocks left than days.
    stepped = F.col("_at") + F.min("_ahead").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    days = per_day.agg(F.count("*")).scalar()
    block = F.greatest(stepped, F.lit(blocks) - (days - F.col("_at")), F.lit(0))
    return counted.withColumn("block", block.cast("int")).drop("_at", "_ahead")


def model_inputs(category_values: Sequence[str]) -> Column:
    """The inputs of one row as an array of doubles, numbers first; NaN is a missing one."""
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in (*NUMERIC_INPUTS, *category_values)])


def training_rows(train: DataFrame, folds: int, digits: int | None = None) -> DataFrame:
    """`target`, `block`, and each row's inputs in two forms: `inputs` to train on and `later_inputs` to validate on.

    A category enters as the mean target of its rows on earlier days, so no row sees its own; to validate, as the mean over
    the blocks before. Rows of earlier blocks have the same inputs in every fold.
    """
    if folds:
        blocked = train.join(cut(time_blocks(train, DAY, folds + 1).select(DAY, "block")), DAY)
    else:
        blocked = train.withColumn("block", F.lit(0))
    labelled = cut(blocked.withColumn(ROW, F.monotonically_increasing_id()))
    means = cut(earlier_means(labelled, CATEGORY_INPUTS, TARGET, DAY, "block", digits))
    values = values_by_row(labelled, ROW, means, CATEGORY_INPUTS, ("code", "block_code"), DAY)
    forms = {"inputs": "code", "later_inputs": "block_code"}
    arrays = [model_inputs([f"{o}_{c}" for c in CATEGORY_INPUTS]).alias(n) for n, o in forms.items()]
    return cut(labelled.join(values, ROW).select(F.col(TARGET).cast("double").alias("target"), "block", *arrays))


def fit_and_validate(train: DataFrame, boosting: Boosting, folds: int) -> tuple[DemandModel, dict[str, float]]:
    """The model of all rows, and mean errors of expanding-window validation by date.

    The folds' models and the final one grow together, each on the blocks before its own end.
    """
    rows = training_rows(train, folds, boosting.mean_digits)
    *partial, final = fit_trees(rows, boosting, range(1, folds + 2))
    totals: dict[str, float] = {}
    for fold, trees in enumerate(partial, 1):
        scored = rows.where(F.col("block") == fold).select("target", trees.column(F.col("later_inputs")).alias("prediction"))
        measured = scored.agg(*[c.alias(n) for n, c in error_columns("target", "prediction", 0.0).items()]).first()
        for name, value in measured.asDict().items():
            totals[f"cv_{name}"] = totals.get(f"cv_{name}", 0.0) + value / folds
    means = cut(target_means(train, CATEGORY_INPUTS, TARGET, boosting.mean_digits))
    return DemandModel(final, means), {name: round(value, 4) for name, value in totals.items()}


def fit(train: DataFrame, boosting: Boosting) -> DemandModel:
    """Category means and trees of one training table."""
    return fit_and_validate(train, boosting, 0)[0]


def check_days(train: DataFrame, folds: int = 2) -> None:
    """Validation needs a day for each block; fails before anything is fitted."""
    days = train.select(DAY).distinct().limit(folds + 1).count()
    if days < folds + 1:
        raise ValueError(f"{folds} folds need at least {folds + 1} training days, there are {days}")


def cross_validate(train: DataFrame, boosting: Boosting, folds: int = FOLDS) -> dict[str, float]:
    """Mean errors of expanding-window validation by date; each fold has category means of its own training rows."""
    check_days(train, folds)
    return fit_and_validate(train, boosting, folds)[1]


def version_number(column: str) -> Column:
    """The number of a name like `V12`, NULL for any other name."""
    return F.regexp_extract(column, r"^V*(\d+)$", 1).try_cast("bigint")


def next_version(names: DataFrame, column: str, by: tuple[str, ...] = ()) -> DataFrame:
    """`V` and one more than the largest number among names like `V12`; `V1` if there are none."""
    latest = F.coalesce(F.max(version_number(column)), F.lit(0))
    return names.groupBy(*by).agg(F.concat(F.lit("V"), (latest + 1).cast("string")).alias("next_version"))


def importance(nodes: DataFrame, feature_names: list[str]) -> DataFrame:
    """Gain and split count per input from a table of split nodes (`feature_index`, `gain`)."""
    spark = nodes.sparkSession
    used = nodes.groupBy("feature_index").agg(F.sum("gain").alias("gain"), F.count("*").alias("splits"))
    names = spark.createDataFrame(list(enumerate(feature_names)), "feature_index int, feature string")
    filled = names.join(used, "feature_index", "left").select(
        "feature",
        F.coalesce("gain", F.lit(0.0)).alias("importance_gain"),
        F.coalesce(F.col("splits").cast("double"), F.lit(0.0)).alias("importance_split"),
    )
    return with_shares(filled, ["importance_gain", "importance_split"])


def with_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds `*_pct`: each column's share of its total in percent."""
    shares = {}
    for column in columns:
        total = df.agg(F.nullif(F.sum(F.col(column).cast("double")), F.lit(0.0))).scalar()
        shares[f"{column}_pct"] = F.round(F.col(column) / total * 100, 2)
    return df.withColumns(shares)


def split_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Split nodes of the fitted trees, read from the stored model under `path`."""
    nodes = spark.read.parquet(f"{path}/trees").where("tree >= 0 and feature >= 0")
    return nodes.select(F.col("feature").alias("feature_index"), "gain")


class ModelStore:
    """Model versions under one folder: files per version, one registry row each.

    A run claims its version by creating a file that must not exist yet, so two runs at once never share a folder; the
    number of a run that broke off is not used again. The registry row is written last, so a version counts only when
    complete, and into a folder of its own, so that runs do not meet there either.
    """

    REGISTRY_COLUMNS = (
        "version string, trained_at timestamp, conformal_q double, alpha double, n_calibration bigint, "
        "coverage_pct double, metrics map<string,double>, comment string"
    )

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @property
    def registry_path(self) -> str:
        return f"{self.root}/registry"

    def registry(self) -> DataFrame:
        if not path_exists(self.spark, self.registry_path):
            return self.spark.createDataFrame([], self.REGISTRY_COLUMNS)
        return self.spark.read.schema(self.REGISTRY_COLUMNS).parquet(self.registry_path)

    def next_version(self) -> str:
        return next_version(self.registry(), "version").first()["next_version"]

    def claim_version(self) -> str:
        """The next version that no other run has claimed, now taken."""
        number = int(self.next_version()[1:])
        while not claim(self.spark, f"{self.root}/claims/V{number}"):
            number += 1
        return f"V{number}"

    def last_version(self) -> str | None:
        number = version_number("version")
        latest = self.registry().where(number.isNotNull()).orderBy(number.desc()).select("version").first()
        return latest and latest["version"]

    def save_files(self, model: DemandModel, version: str, sample: DataFrame | None = None) -> str:
        """Writes the model, and some scored rows if given; returns the folder."""
        path = f"{self.root}/{version}"
        if sample is not None:
            replace_table(sample.limit(SAMPLE_ROWS).coalesce(1), f"{path}/sample")
        replace_table(model.trees.nodes(self.spark), f"{path}/trees")
        replace_table(model.vocabularies, f"{path}/vocabularies")
        return path

    def differing(self, version: str | None = None) -> int:
        """Rows of the stored sample to which the stored model, loaded again, gives another score than it had."""
        model = self.load(version)
        stored = self.spark.read.parquet(f"{self.root}/{model.version}/sample").withColumnRenamed("prediction", "_before")
        again = model.predict(stored)
        return again.where(~F.coalesce(F.abs(F.col("prediction") - F.col("_before")) <= 1e-9, F.lit(False))).count()

    def register(self, model: DemandModel, alpha: float, n_calibration: int, covered: float, comment: str) -> None:
        row = (model.conformal_q, alpha, n_calibration, covered, model.metrics, comment)
        names = "conformal_q double, alpha double, n_calibration bigint, coverage_pct double, " \
            "metrics map<string,double>, comment string"
        entry = self.spark.createDataFrame([row], names).withColumn("trained_at", F.current_timestamp())
        append_rows(entry.coalesce(1), self.registry_path, version=model.version)

    def load(self, version: str | None = None) -> DemandModel:
        """The given version, or the last one."""
        version = version or self.last_version()
        if version is None:
            raise LookupError(f"no model version under {self.root}")
        entry = self.registry().where(F.col("version") == version).first()
        path = f"{self.root}/{version}"
        return DemandModel(
            trees=BoostedTrees.from_nodes(self.spark.read.parquet(f"{path}/trees")),
            vocabularies=self.spark.read.parquet(f"{path}/vocabularies"),
            conformal_q=entry["conformal_q"],
            version=version,
            metrics=dict(entry["metrics"]),
        )


def train(
    features: DataFrame,
    store: ModelStore,
    windows: Windows = Windows(),
    boosting: Boosting = Boosting(),
    alpha: float = ALPHA,
    validate: bool = True,
) -> DataFrame:
    """Fits, measures, calibrates and stores a new version; returns its one-row summary."""
    spark = features.sparkSession
    with temporary(spark):  # the store holds all that is left of a run
        return _train(features, store, windows, boosting, alpha, validate)


def _train(features: DataFrame, store: ModelStore, windows: Windows, boosting: Boosting, alpha: float, validate: bool) -> DataFrame:
    started = time.time()
    spark = features.sparkSession
    data = training_slice(features, windows.train_start, windows.test_end)
    labelled = cut(data.withColumn("split", split_label(F.col(DAY), windows)).where("split is not null"))
    training = labelled.where("split = 'train'").drop("split")
    test = labelled.where("split = 'test'").drop("split")

    if validate:
        check_days(training, FOLDS)
    model, cross_scores = fit_and_validate(training, boosting, FOLDS if validate else 0)
    predicted = cut(model.predict(test))
    scored = predicted.select(TARGET, "prediction")
    if not scored.where("prediction is null or isnan(prediction)").isEmpty():
        raise ValueError("the fitted model gives test rows no number; nothing is stored")
    measured = error_metrics(scored, TARGET, "prediction").drop("n_rows").first().asDict()
    q, n_calibration = conformal_quantile(scored, TARGET, "prediction", alpha)
    if q is None:
        raise ValueError("the test window holds no rows to calibrate on")
    covered = coverage(scored, TARGET, "prediction", q).first()["coverage"] * 100

    model.conformal_q = q
    model.metrics = {**measured, **cross_scores}
    model.version = store.claim_version()
    path = store.save_files(model, model.version, predicted)
    weights = importance(split_nodes(spark, path), [*NUMERIC_INPUTS, *CATEGORY_INPUTS])
    history = weights.withColumn("trained_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"))
    append_rows(history.coalesce(1), f"{store.root}/feature_importance", model_version=model.version)
    comment = (
        f"boosted trees with conformal interval: depth {boosting.depth}, rate {boosting.rate}, "
        f"rounds {boosting.rounds}, train {windows.train_start}..{windows.train_end}, "
        f"test {windows.test_start}..{windows.test_end}"
    )
    store.register(model, alpha, n_calibration, round(covered, 2), comment)
    summary = (
        model.version, measured["rmse"], measured["mae"], measured["wape_pct"], measured["mape_pct"],
        round(q, 4), round(time.time() - started, 1),
    )
    return spark.createDataFrame(
        [summary],
        "version string, rmse double, mae double, wape_pct double, mape_pct double, "
        "conformal_q double, elapsed_s double",
    )
