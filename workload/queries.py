"""One query per operator, each over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import calendar_columns, clamped_difference, document_text, local_to_utc_date, share_of_rows
from footfall.operators import errors, nearby, vocabulary
from footfall.operators.checks import duplicate_keys, null_rows
from footfall.operators.trailing import Series
from footfall.plans import demand, dimensions, features, market, monitoring, refresh, scoring, training
from footfall.session import cut, discard, ensure_checkpoint_dir, noting
from footfall.sources.holidays import holiday_table
from footfall.sources.literals import literal_ids
from footfall.sources.sinks import upsert, write_clustered

from .tables import AS_OF, FIRST_DAY, ZONES, holidays, sources, table, zone_of
from .tidy import tidy

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPLIT_DAY = date(1999, 1, 1)
WINDOWS = training.Windows(
    date(1996, 1, 1), date(2000, 6, 30), date(2000, 7, 1), date(2001, 12, 31)
)


def query(build: Query) -> Query:
    """Registers `build` under its name, with tidied output."""
    QUERIES[build.__name__] = lambda spark, sf_dir: tidy(build(spark, sf_dir))
    return build


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand.demand_from_sources(sources(spark, sf_dir))


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing 30-row mean as a stand-in forecast, in the prediction schema and whole minutes."""
    series = Series(demand.SERIES_KEYS, demand.DAY)
    minutes = F.round(F.col("provider_hours_demanded") * 60)
    return daily(spark, sf_dir).withColumn("actual", minutes).select(
        *demand.SERIES_KEYS,
        F.col(demand.DAY).cast("timestamp_ntz").alias("prediction_timestamp"),
        "actual",
        F.round(series.mean("actual", 30)).alias("predicted"),
    )


# Sources, literals, filters -------------------------------------------------


@query
def holiday_calendar(spark, sf_dir):
    days = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("holiday_date"))
    return holidays(spark).join(days.agg(F.count("*").alias("n_orders")), "holiday_date", "left")


@query
def literal_union(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))
    return ids.unionByName(literal_ids(spark)).groupBy("id").agg(F.count("*").alias("n_rows"))


@query
def ref_filter(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("id"), "l_orderkey", "l_partkey")
    return lines.unionByName(literal_ids(spark), allowMissingColumns=True).where("id = 1")


@query
def qualifying_rows(spark, sf_dir):
    tables = sources(spark, sf_dir)
    return demand.qualifying_visits(tables["appointments"], tables["appointment_cancellations"])


@query
def conditional_ratio(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        share_of_rows(F.col("l_returnflag") == "R").alias("returned_ratio"),
        share_of_rows(F.col("l_discount") > 0).alias("discount_ratio"),
    )


@query
def prefix_market(spark, sf_dir):
    prefix = F.left("o_orderpriority", F.lit(1)).alias("prefix")
    return table(spark, sf_dir, "orders").groupBy(prefix).agg(
        F.count("*").alias("n_orders"), F.countDistinct("o_custkey").alias("n_customers")
    )


# Scalar functions -------------------------------------------------------------


@query
def local_to_utc_date_query(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("tz", F.expr(zone_of("user_id")))
    return events.select("event_id", "tz", local_to_utc_date(F.col("ts"), F.col("tz")).alias("utc_date"))


QUERIES["local_to_utc_date"] = QUERIES.pop("local_to_utc_date_query")


@query
def date_features(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select("o_orderkey", *calendar_columns(day))


@query
def json_extract(spark, sf_dir):
    number = document_text(F.try_parse_json("props"), "$.k").cast("bigint")
    return table(spark, sf_dir, "events").select("event_id", number.alias("k"))


@query
def defaults_fill(spark, sf_dir):
    tables = sources(spark, sf_dir)
    return dimensions.account_profile(tables["locations"], tables["crm_account"])


# Joins ------------------------------------------------------------------------


@query
def left_fanout(spark, sf_dir):
    tables = sources(spark, sf_dir)
    lines = demand.booked_lines(tables)
    return lines.groupBy("appointment_id", "service_category").agg(
        F.sum("option_rows").alias("n_rows"),
        F.sum(F.col("option_rows") * F.col("price") + F.col("price_delta")).alias("total_price"),
    )


@query
def left_on_predicate(spark, sf_dir):
    positive = table(spark, sf_dir, "customer").where("c_acctbal > 0")
    held = positive.groupBy(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment").agg(F.count("*").alias("n"))
    rich = held.where("c_mktsegment = 'BUILDING'")
    return table(spark, sf_dir, "nation").join(rich, "n_nationkey", "left").select(
        "n_name", F.coalesce("n", F.lit(0)).alias("n_customers")
    )


@query
def double_role_join(spark, sf_dir):
    rules = dimensions.rules_per_service(dimensions.rules_per_staff(sources(spark, sf_dir)["service_rules"]))
    rows = F.greatest("own_rules", F.lit(1)) * F.greatest("staff_rules", F.lit(1))
    return rules.select("location_id", "service_id", "own_rules", "staff_rules", rows.alias("joined_rows"))


@query
def holiday_proximity(spark, sf_dir):
    keys = daily(spark, sf_dir).select(*demand.PANEL_KEYS)
    return nearby.with_holiday_distance(keys, demand.DAY, holidays(spark))


@query
def default_holidays(spark, sf_dir):
    """Days with events and their distance to the default calendar."""
    days = table(spark, sf_dir, "events").groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n_events"))
    return nearby.with_holiday_distance(days, "day", holiday_table(spark))


def _event_inputs(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    day = F.col("ts").cast("date").alias("day")
    spine = events.where("event_type = 'purchase'").select("user_id", day)
    kinds = ("view", "click", "signup", "error")
    messages = [nearby.daily_counts(events.where(f"event_type = '{c}'"), ["user_id"], "ts", c) for c in kinds]
    spans = {"views_30": ("view", 30), "clicks_7": ("click", 7), "all_30": (None, 30)}
    return spine, reduce(DataFrame.unionByName, messages), "user_id", "day", spans


@query
def trailing_event_counts(spark, sf_dir):
    return nearby.trailing_counts_by_window(*_event_inputs(spark, sf_dir))


@query
def trailing_event_counts_range(spark, sf_dir):
    return nearby.trailing_counts_by_window(*_event_inputs(spark, sf_dir))


@query
def message_window(spark, sf_dir):
    tables = sources(spark, sf_dir)
    messages = dimensions.messages_daily(tables["marketing_email"], tables["marketing_sms"])
    return dimensions.message_window(demand.demand_from_sources(tables), messages)


@query
def channel_union(spark, sf_dir):
    tables = sources(spark, sf_dir)
    return dimensions.messages_daily(tables["marketing_email"], tables["marketing_sms"])


# Aggregates --------------------------------------------------------------------


@query
def demand_daily(spark, sf_dir):
    return daily(spark, sf_dir)


@query
def location_profile(spark, sf_dir):
    tables = sources(spark, sf_dir)
    return dimensions.location_profile(tables["locations"], tables["staff_locations"], tables["staff"], AS_OF)


@query
def service_menu_stats(spark, sf_dir):
    tables = sources(spark, sf_dir)
    return dimensions.menu_stats(
        tables["locations"], tables["services"], tables["service_categories"], tables["service_rules"]
    )


@query
def services_per_location(spark, sf_dir):
    tables = sources(spark, sf_dir)
    return dimensions.services_per_location(tables["locations"], tables["services"])


@query
def scheduled_capacity(spark, sf_dir):
    tables = sources(spark, sf_dir)
    return dimensions.scheduled_capacity(tables["staff_locations"], tables["staff"])


def _market(spark, sf_dir, column):
    tables = sources(spark, sf_dir)
    profile = dimensions.location_profile(tables["locations"], tables["staff_locations"], tables["staff"], AS_OF)
    return market.market_daily(demand.demand_from_sources(tables), profile, column)


@query
def market_daily(spark, sf_dir):
    return _market(spark, sf_dir, "location_zip3")


# Windows -------------------------------------------------------------------------


@query
def rolling_features(spark, sf_dir):
    return demand.rolling_demand(daily(spark, sf_dir))


@query
def rolling_calendar(spark, sf_dir):
    rolled = demand.rolling_demand(daily(spark, sf_dir), calendar=True)
    return rolled.select(*demand.PANEL_KEYS, *CALENDAR_COLUMNS)


CALENDAR_COLUMNS = (
    "count_appts_l7d", "count_appts_l30d", "count_appts_dow_avg", "count_appts_lag_7d",
    "count_appts_lag_364d", "count_appts_trend_4w", "hours_provider_l30d", "hours_provider_per_appt_l30d",
)


def _rolled(spark, sf_dir, *columns):
    return demand.rolling_demand(daily(spark, sf_dir)).select(*demand.PANEL_KEYS, *columns)


@query
def rolling_sums(spark, sf_dir):
    return _rolled(spark, sf_dir, "count_appts_l7d", "count_appts_l30d", "hours_provider_l7d", "hours_provider_l30d")


@query
def weekday_average(spark, sf_dir):
    return _rolled(spark, sf_dir, "count_appts_dow_avg", "hours_provider_dow_avg")


@query
def rolling_trend(spark, sf_dir):
    return _rolled(spark, sf_dir, "count_appts_trend_4w", "hours_provider_trend_4w")


@query
def rolling_ratio(spark, sf_dir):
    return _rolled(spark, sf_dir, "hours_provider_per_appt_l30d")


@query
def behaviour_averages(spark, sf_dir):
    return _rolled(spark, sf_dir, *demand.BEHAVIOUR)


@query
def row_lags(spark, sf_dir):
    series = Series(("location_zip3", "service_category"), demand.DAY)
    lags = [series.lag("demand_count", n).alias(f"lag_{n}") for n in demand.LAGS]
    return _market(spark, sf_dir, "location_zip3").select(
        "location_zip3", "service_category", demand.DAY, "demand_count", *lags
    )


@query
def market_rolling(spark, sf_dir):
    return market.market_rolling(_market(spark, sf_dir, "location_zip"), "location_zip", "zip")


@query
def competitor_residual(spark, sf_dir):
    tables = sources(spark, sf_dir)
    panel = cut(demand.demand_from_sources(tables))
    profile = dimensions.location_profile(tables["locations"], tables["staff_locations"], tables["staff"], AS_OF)
    totals = market.market_rolling(market.market_daily(panel, profile, "location_zip3"), "location_zip3", "zip3")
    own = demand.rolling_demand(panel).join(profile.select("location_id", "location_zip3"), "location_id")
    joined = own.join(totals, ["location_zip3", "service_category", demand.DAY], "left")
    return joined.select(*demand.PANEL_KEYS, *market.competitor_columns("zip3"))


@query
def utilisation_rate(spark, sf_dir):
    tables = sources(spark, sf_dir)
    menu = dimensions.menu_stats(
        tables["locations"], tables["services"], tables["service_categories"], tables["service_rules"]
    )
    capacity = dimensions.scheduled_capacity(tables["staff_locations"], tables["staff"])
    return (
        demand.rolling_demand(demand.demand_from_sources(tables))
        .join(menu, list(demand.SERIES_KEYS), "left")
        .join(capacity, "location_id", "left")
        .select(*demand.PANEL_KEYS, features.utilisation_rate().alias("utilization_rate_recent"))
    )


@query
def clustered_panel(spark, sf_dir):
    """Panel and menu, stored in buckets of the series keys and joined as they lie: windows and join move no row."""
    tables = sources(spark, sf_dir)
    menu = dimensions.menu_stats(
        tables["locations"], tables["services"], tables["service_categories"], tables["service_rules"]
    )
    panel = demand.demand_from_sources(tables).select(*demand.PANEL_KEYS, "demand_count")
    name, keys = f"c{uuid.uuid4().hex}", list(demand.SERIES_KEYS)
    stored = write_clustered(panel, f"{name}_panel", _folder(spark), keys, [demand.DAY], BUCKETS)
    prices = write_clustered(menu, f"{name}_menu", _folder(spark), keys, [], BUCKETS)
    series = Series(demand.SERIES_KEYS, demand.DAY)
    recent = stored.withColumn("recent", series.total("demand_count", 7))
    return recent.join(prices, keys, "left").groupBy(*keys).agg(
        F.count("*").alias("n_days"), F.max("recent").alias("busiest"), F.max("avg_menu_price_cents").alias("avg_menu_price_cents")
    )


BUCKETS = 16


# The feature table and its readers ---------------------------------------------


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_table(sources(spark, sf_dir), holidays(spark), AS_OF, FIRST_DAY)


@query
def feature_table(spark, sf_dir):
    return feature_rows(spark, sf_dir)


@query
def training_slice(spark, sf_dir):
    """Read from the feature table as the daily job stores it: sorted, in month folders that the day bounds prune."""
    stored = refresh.refresh_features(spark, sources(spark, sf_dir), _folder(spark), AS_OF, holidays(spark), FIRST_DAY)
    return training.training_slice(stored, WINDOWS.train_start, WINDOWS.train_end, ("location_id",))


@query
def temporal_split(spark, sf_dir):
    label = training.split_label(F.col(demand.DAY), WINDOWS).alias("split")
    return daily(spark, sf_dir).groupBy(label).agg(
        F.count("*").alias("n_rows"), F.min(demand.DAY).alias("first_day"), F.max(demand.DAY).alias("last_day")
    )


@query
def cv_fold_assignment(spark, sf_dir):
    return training.time_blocks(daily(spark, sf_dir), demand.DAY, 3)


def _categories(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.concat_ws("-", "p_brand", F.nullif("p_size", F.lit(1))).alias("category")
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return lines.join(parts, "l_partkey")


def _fitted_categories(spark, sf_dir):
    seen = _categories(spark, sf_dir).where(F.col("l_shipdate") < F.lit(date(1995, 7, 1)))
    return vocabulary.fit_vocabulary(seen, "category")


@query
def category_vocabulary(spark, sf_dir):
    return _fitted_categories(spark, sf_dir)


@query
def category_encode(spark, sf_dir):
    coded = vocabulary.encode(_categories(spark, sf_dir), "category", _fitted_categories(spark, sf_dir), "code")
    return coded.select("l_orderkey", "l_linenumber", "category", "code")


@query
def category_rank(spark, sf_dir):
    """The model's category input: mean target of the category's lines on earlier days, missing on its first day."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.when(F.col("p_size") != 1, F.concat_ws("-", "p_brand", "p_size")).alias("category")
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity")
    lines = cut(lines.join(parts, "l_partkey").withColumns({"row": F.monotonically_increasing_id(), "block": F.lit(0)}))
    means = vocabulary.earlier_means(lines, ["category"], "l_quantity", "l_shipdate", "block")
    values = vocabulary.values_by_row(lines, "row", means, ["category"], day="l_shipdate")
    return lines.join(values, "row").select("l_orderkey", "l_linenumber", "category", F.round("code_category", 6).alias("value"))


# Predictions ----------------------------------------------------------------------


@query
def error_metrics(spark, sf_dir):
    return errors.error_metrics(forecasts(spark, sf_dir), "actual", "predicted", ("service_category",))


@query
def conformal_quantile(spark, sf_dir):
    scored = cut(forecasts(spark, sf_dir))
    q, n = errors.conformal_quantile(scored, "actual", "predicted")
    return scored.agg(F.count("actual").alias("n_rows")).select("n_rows", F.lit(n).alias("n_calibration"), F.lit(q).alias("q"))


@query
def conformal_coverage(spark, sf_dir):
    scored = cut(forecasts(spark, sf_dir))
    q, _ = errors.conformal_quantile(scored, "actual", "predicted")
    return errors.coverage(scored, "actual", "predicted", q)


@query
def conformal_interval(spark, sf_dir):
    scored = cut(forecasts(spark, sf_dir))
    q, _ = errors.conformal_quantile(scored, "actual", "predicted")
    keys = [c for c in scored.columns if c != "predicted"]
    return scored.select(*keys, *errors.interval_columns(F.col("predicted"), q))


@query
def flatten_prediction(spark, sf_dir):
    records = forecasts(spark, sf_dir).select(
        *scoring.PREDICTION_KEYS, "actual", scoring.prediction_record(F.col("predicted"), 1.5).alias("record")
    )
    return scoring.flatten_prediction(records, "record")


@query
def training_summary(spark, sf_dir):
    scored = cut(forecasts(spark, sf_dir))
    q, _ = errors.conformal_quantile(scored, "actual", "predicted")
    measured = errors.error_metrics(scored, "actual", "predicted").drop("n_rows")
    return measured.withColumns({"version": F.lit("V1"), "conformal_q": F.round(F.lit(q), 4)})


@query
def importance_share(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey"), "l_partkey"
    )
    weights = lines.groupBy(F.col("p_brand").alias("feature")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).cast("double").alias("importance_gain"),
        F.count("*").cast("double").alias("importance_split"),
    )
    ranked = training.with_shares(cut(weights), ["importance_gain", "importance_split"])
    return ranked.orderBy(F.desc("importance_gain"), "feature").limit(10)


@query
def incremental_rows(spark, sf_dir):
    """Days after the last one that a stored, day-partitioned table holds."""
    panel = cut(daily(spark, sf_dir))
    path, day = _folder(spark), F.col(demand.DAY).alias(scoring.PREDICTION_DAY)
    upsert(panel.where(F.col(demand.DAY) < F.lit(SPLIT_DAY)).select(*demand.PANEL_KEYS, "demand_count", day), path, demand.PANEL_KEYS, scoring.PREDICTION_DAY)
    return scoring.rows_after(panel, demand.DAY, scoring.high_water_mark(spark, path))


@query
def upsert_by_key(spark, sf_dir):
    """Two writes of one table: all days, then the later ones with other values."""
    panel = cut(daily(spark, sf_dir).select(*demand.PANEL_KEYS, "demand_count").withColumn("month", F.date_format(demand.DAY, "yyyy-MM")))
    path = _folder(spark)
    upsert(panel.where(F.col(demand.DAY) < F.lit(date(2000, 1, 1))), path, demand.PANEL_KEYS, "month")
    fresh = panel.where(F.col(demand.DAY) >= F.lit(SPLIT_DAY)).withColumn("demand_count", F.col("demand_count") * 10)
    return upsert(fresh, path, demand.PANEL_KEYS, "month").drop("month")


@query
def next_version(spark, sf_dir):
    names = table(spark, sf_dir, "part").selectExpr(
        "p_type", "p_brand", "if(p_size > 5, concat('V', p_size), p_name) version"
    )
    return training.next_version(names, "version", ("p_type", "p_brand"))


@query
def monitor_daily(spark, sf_dir):
    """Two daily runs of the monitor over a prediction table that grew and was corrected between them."""
    scored = cut(forecasts(spark, sf_dir).withColumn(scoring.PREDICTION_DAY, F.col("prediction_timestamp").cast("date")))
    path, root = _folder(spark), _folder(spark)
    early = scored.where(F.col(scoring.PREDICTION_DAY) < F.lit(SPLIT_DAY))
    wrong = early.withColumn("predicted", F.when(F.col(scoring.PREDICTION_DAY) < F.lit(date(1998, 12, 1)), F.col("predicted")).otherwise(F.lit(0.0)))
    upsert(wrong, path, scoring.PREDICTION_KEYS, scoring.PREDICTION_DAY)
    monitoring.update_monitor(spark, path, scoring.PREDICTION_DAY, root, early)
    upsert(scored.where(F.col(scoring.PREDICTION_DAY) >= F.lit(date(1998, 12, 1))), path, scoring.PREDICTION_KEYS, scoring.PREDICTION_DAY)
    return monitoring.update_monitor(spark, path, scoring.PREDICTION_DAY, root).drop("psi")


@query
def monitor_psi(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    middle = F.lit(date(2024, 1, 16))
    current = events.where(F.col("day") >= middle)
    return monitoring.stability_index(events.where(F.col("day") < middle), current, "value", [F.col("day")])


@query
def prediction_view(spark, sf_dir):
    """Totals read through the published view, and a comment it carries."""
    name = f"p{uuid.uuid4().hex}"
    forecasts(spark, sf_dir).write.option("path", _folder(spark)).saveAsTable(f"{name}_table")
    view = monitoring.publish_view(spark, f"{name}_table", f"{name}_view")
    comment = spark.sql(f"DESCRIBE {name}_view").where("col_name = 'predicted'").first()["comment"]
    return monitoring.summarise_by(view, ["location_id", "service_category"]).withColumn("predicted_comment", F.lit(comment))


# Checks -----------------------------------------------------------------------------


@query
def check_unique(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_not_null(spark, sf_dir):
    visits = sources(spark, sf_dir)["appointments"]
    return null_rows(visits, ["source", "client_id"]).select("id", "source", "client_id")


# The model --------------------------------------------------------------------------

# One round of one split: SQL can find the best split and both leaf values.
STUMP = training.Boosting(depth=1, rounds=1, rate=1.0, mean_digits=0)
FIRST_SCORED = date(2000, 12, 31)


def _folder(spark):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"


def _stored_features(spark, sf_dir, replaced):
    """The feature rows in a file of their own; what they were made from goes."""
    with noting() as spent:
        features = feature_rows(spark, sf_dir).withColumns(replaced)
    rows = cut(features)
    discard(spark, spent)
    return rows


def _trained(spark, sf_dir, validate=False):
    """Feature rows, a store with one version trained on them, and the run's summary.

    Numbers are whole and bounded, so every distinct value has a histogram bin of its own.
    """
    whole = {}
    for name in training.NUMERIC_INPUTS:
        number = F.round(F.round(F.col(name).cast("double"), 6))
        whole[name] = F.when(F.col(name).isNotNull(), F.least(F.greatest(number, F.lit(-20.0)), F.lit(200.0)))
    rows = _stored_features(spark, sf_dir, whole)
    store = training.ModelStore(spark, _folder(spark))
    return rows, store, training.train(rows, store, WINDOWS, STUMP, validate=validate)


@query
def train_score(spark, sf_dir):
    rows, store, _ = _trained(spark, sf_dir)
    later = rows.where(F.col(demand.DAY).between(F.lit(WINDOWS.test_start), F.lit(WINDOWS.test_end)))
    return errors.error_metrics(store.load().predict(later), training.TARGET, "prediction", ("service_category",))


@query
def batch_score(spark, sf_dir):
    """The last stored version scores the test window in two incremental runs."""
    rows, store, _ = _trained(spark, sf_dir)
    path = _folder(spark)
    scoring.score_incrementally(rows, store.load(), path, WINDOWS.test_start, FIRST_SCORED)
    return scoring.score_incrementally(rows.where(F.col(demand.DAY) <= F.lit(WINDOWS.test_end)), store.load(), path)


@query
def training_run(spark, sf_dir):
    """The run's summary and its four validation errors from the registry."""
    _, store, summary = _trained(spark, sf_dir, validate=True)
    scores = [F.col("metrics")[name].alias(name) for name in ("cv_rmse", "cv_mae", "cv_wape_pct", "cv_mape_pct")]
    return summary.drop("elapsed_s").join(store.registry().select("version", *scores), "version")


@query
def importance_trees(spark, sf_dir):
    """Importance of all inputs as the training run appended it, from the fitted trees."""
    _, store, _ = _trained(spark, sf_dir)
    history = spark.read.parquet(f"{store.root}/feature_importance")
    return history.select("feature", "importance_split", "importance_gain_pct", "importance_split_pct")


def full_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run at its published setting, on unbounded numbers: 200 rounds of depth 3, two validation folds.

    For the bench; it has no SQL. The result is the run's registry entry.
    """
    store = training.ModelStore(spark, _folder(spark))
    training.train(_stored_features(spark, sf_dir, {}), store, WINDOWS, training.Boosting())
    return store.registry()
