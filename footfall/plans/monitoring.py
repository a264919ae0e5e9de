"""Daily quality and drift of the predictions, and the published view."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.errors import error_columns
from ..operators.quantiles import exact_quantiles
from ..sources.sinks import VersionedTable, path_exists, replace_table

PSI_BUCKETS = 10
PSI_FLOOR = 1.0e-4


def daily_performance(predictions: DataFrame, at: str = "prediction_timestamp") -> DataFrame:
    """RMSE and MAE of each day."""
    errors = error_columns("actual", "predicted")
    return predictions.groupBy(F.col(at).cast("date").alias("day")).agg(
        F.count("*").alias("n_rows"), errors["rmse"].alias("rmse"), errors["mae"].alias("mae")
    )


def bucket_edges(baseline: DataFrame, column: str, buckets: int = PSI_BUCKETS) -> list[float]:
    """Inner edges that cut the baseline into buckets of equal row counts."""
    levels = [i / buckets for i in range(1, buckets)]
    return sorted({edge for edge in exact_quantiles(baseline, column, levels) if edge is not None})


def _bucket_counts(column: str, edges: Sequence[float]) -> list[Column]:
    """Rows per bucket, `b0`, `b1`, ...; a value equal to an edge belongs to the bucket below it."""
    bounds = [None, *edges, None]
    counts = []
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        inside = F.col(column).isNotNull()
        if low is not None:
            inside = inside & (F.col(column) > F.lit(low))
        if high is not None:
            inside = inside & (F.col(column) <= F.lit(high))
        counts.append(F.count_if(inside).alias(f"b{i}"))
    return counts


@dataclass(frozen=True)
class Baseline:
    """Bucket edges of a baseline period and its rows per bucket."""

    edges: tuple[float, ...]
    counts: tuple[int, ...]

    @classmethod
    def of(cls, rows: DataFrame, column: str, buckets: int = PSI_BUCKETS) -> Baseline:
        edges = tuple(bucket_edges(rows, column, buckets))
        return cls(edges, tuple(rows.agg(*_bucket_counts(column, edges)).first()))

    def names(self) -> list[str]:
        return [f"b{i}" for i in range(len(self.counts))]

    def psi(self, rows: Column) -> Column:
        """Stability index of the bucket counts `b0`, `b1`, ... of `rows` rows. Empty buckets count as `PSI_FLOOR`."""
        total = max(sum(self.counts), 1)
        terms = []
        for name, count in zip(self.names(), self.counts):
            p = F.lit(max(count / total, PSI_FLOOR))
            q = F.greatest(F.col(name) / F.nullif(rows, F.lit(0)), F.lit(PSI_FLOOR))
            terms.append((q - p) * F.ln(q / p))
        return sum(terms[1:], terms[0])


def stability_index(
    baseline: DataFrame, current: DataFrame, column: str, by: Sequence[Column] = (), buckets: int = PSI_BUCKETS
) -> DataFrame:
    """Population stability index of `column` per group of `current` against the baseline.

    The driver sees the bucket edges and one row of baseline counts.
    """
    base = Baseline.of(baseline, column, buckets)
    counted = current.groupBy(*by).agg(F.count(column).alias("n_rows"), *_bucket_counts(column, base.edges))
    return counted.withColumn("psi", base.psi(F.col("n_rows"))).drop(*base.names())


# The monitor's state: one row of counts and sums per day. Sums of several days, or of parts of one, are the state of them
# together, so a day is read once and any period is measured from the state alone.

STATE_MONTH = "month"
SUMS = ("n_rows", "n_errors", "squared", "absolute", "n_values")


def daily_state(predictions: DataFrame, baseline: Baseline, day: Column, *by: str) -> DataFrame:
    """Per day (and `by`): rows, errors, their squares and sizes, and predictions per bucket of the baseline."""
    error = F.col("actual") - F.col("predicted")
    sums = [
        F.count("*").alias("n_rows"),
        F.count(error).alias("n_errors"),
        F.sum(error * error).alias("squared"),
        F.sum(F.abs(error)).alias("absolute"),
        F.count("predicted").alias("n_values"),
    ]
    return predictions.groupBy(day.alias("day"), *by).agg(*sums, *_bucket_counts("predicted", baseline.edges))


def measures(state: DataFrame, baseline: Baseline, period: Column | str = "day") -> DataFrame:
    """Rows, RMSE, MAE and stability index per period of the summed states."""
    period = F.col(period) if isinstance(period, str) else period
    summed = state.groupBy(period.alias("day")).agg(*[F.sum(c).alias(c) for c in (*SUMS, *baseline.names())])
    errors = F.nullif(F.col("n_errors"), F.lit(0))
    return summed.select(
        "day", "n_rows", F.sqrt(F.col("squared") / errors).alias("rmse"), (F.col("absolute") / errors).alias("mae"),
        baseline.psi(F.col("n_values")).alias("psi"),
    )


def monitor(predictions: DataFrame, baseline: DataFrame) -> DataFrame:
    """One row per day: errors, and drift of the predictions against a baseline period."""
    base = Baseline.of(baseline, "predicted")
    return measures(daily_state(predictions, base, F.col("prediction_timestamp").cast("date")), base)


def stored_baseline(spark: SparkSession, path: str, rows: DataFrame | None = None) -> Baseline:
    """The baseline at `path`; the first call fits it to `rows` and stores it."""
    if not path_exists(spark, path):
        if rows is None:
            raise ValueError("the first run needs a baseline period")
        base = Baseline.of(rows, "predicted")
        kinds = "edges array<double>, counts array<bigint>"
        replace_table(spark.createDataFrame([(list(base.edges), list(base.counts))], kinds).coalesce(1), path)
    found = spark.read.parquet(path).first()
    return Baseline(tuple(found["edges"]), tuple(found["counts"]))


def update_monitor(spark: SparkSession, predictions: str, part: str, root: str, baseline: DataFrame | None = None) -> DataFrame:
    """Measures per day of the prediction table at `predictions` (parts by the date `part`), kept up under `root`.

    Each state row names the folder its day was read from, so a run reads the days that are new or were rewritten since,
    and nothing else of the history. The state has a row per day, in parts by month.
    """
    base = stored_baseline(spark, f"{root}/baseline", baseline)
    source, state = VersionedTable(spark, predictions, part), VersionedTable(spark, f"{root}/state", STATE_MONTH)
    known = state.read()
    done = {str(r["day"]): r["source"] for r in known.select("day", "source").collect()} if known is not None else {}
    last = source.commit()
    due = [d for d, generation in (last.parts if last else {}).items() if done.get(d) != generation]
    if due or known is None:
        rows = source.read(due, generation="source")
        if rows is None:
            raise LookupError(f"no predictions at {predictions}")
        fresh = daily_state(rows, base, F.col(part), "source").withColumn(STATE_MONTH, F.date_format("day", "yyyy-MM"))
        state.upsert(fresh, ["day"])
    return measures(state.read(), base)


VIEW_COMMENT = (
    "Demand predictions with the bounds of their 90% interval, "
    "one row per location, service category and day."
)
DIMENSION_COMMENTS = {
    "location_id": "Location of the forecast",
    "service_category": "Service category of the forecast",
    "predicted": "Predicted provider hours",
    "prediction_timestamp": "Day the prediction is for",
}


def publish_view(spark: SparkSession, table: str, view: str) -> DataFrame:
    """Creates or replaces a view with the four dimensions over the prediction table."""
    columns = ", ".join(f"{name} COMMENT '{text}'" for name, text in DIMENSION_COMMENTS.items())
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} ({columns}) COMMENT '{VIEW_COMMENT}' "
        f"AS SELECT {', '.join(DIMENSION_COMMENTS)} FROM {table}"
    )
    return spark.table(view)


def summarise_by(predictions: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Row count and total prediction per combination of dimensions."""
    return predictions.groupBy(*dimensions).agg(
        F.count("*").alias("n_rows"), F.sum("predicted").alias("total_predicted")
    )
