import random
import re
from datetime import date, timedelta
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.operators.vocabulary import earlier_means
from footfall.plans import monitoring, refresh, scoring, training
from footfall.sources.sinks import VersionedTable
from footfall.session import cut, ensure_checkpoint_dir
from footfall.sources.holidays import holiday_table
from workload.queries import WINDOWS
from workload.tables import AS_OF, FIRST_DAY, QUARTER_DAYS, sources

from .conftest import day

SMALL = "/root/testdata/sf0.001"
QUICK = training.Boosting(rounds=3)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("job"))
    holidays = holiday_table(spark, QUARTER_DAYS)
    scratch = Path(urlparse(ensure_checkpoint_dir(spark)).path)
    before = set(scratch.iterdir())
    tables = refresh.refresh(spark, sources(spark, SMALL), root, AS_OF, WINDOWS, QUICK, holidays, FIRST_DAY)
    assert set(scratch.iterdir()) == before  # no scratch folder is left
    return root, tables


def test_summary_and_store(spark, run):
    root, tables = run
    summary = tables["summary"].first()
    assert summary["version"] == "V1" and summary["rmse"] > 0 and summary["conformal_q"] > 0
    store = training.ModelStore(spark, f"{root}/model")
    assert (store.last_version(), store.next_version()) == ("V1", "V2")
    sample = spark.read.parquet(f"{root}/model/V1/sample")
    assert 0 < sample.count() <= training.SAMPLE_ROWS and store.differing() == 0
    entry = store.registry().first()
    assert entry["coverage_pct"] >= 89 and {"rmse", "cv_rmse", "cv_mape_pct"} <= set(entry["metrics"])
    history = spark.read.parquet(f"{root}/model/feature_importance")
    assert history.count() == 34 == len(training.NUMERIC_INPUTS) + len(training.CATEGORY_INPUTS)
    totals = history.agg(F.sum("importance_gain_pct"), F.sum("importance_split_pct")).first()
    assert totals[0] == pytest.approx(100, abs=0.5) and totals[1] == pytest.approx(100, abs=0.5)


def test_predictions(run):
    _, tables = run
    predictions = tables["predictions"]
    assert tuple(predictions.columns) == scoring.PREDICTION_COLUMNS
    in_window = F.col("target_date").between(F.lit(WINDOWS.test_start), F.lit(WINDOWS.test_end))
    assert predictions.count() == tables["features"].where(in_window).count() > 0
    wrong = "pred_lower_05 < 0 or pred_lower_05 > predicted or predicted > pred_upper_95"
    assert predictions.where(wrong).isEmpty()


def test_incremental_scoring(spark, run, tmp_path):
    root, tables = run
    model = training.ModelStore(spark, f"{root}/model").load()
    path = str(tmp_path / "predictions")
    middle = WINDOWS.test_start + timedelta(days=60)
    first = scoring.score_incrementally(tables["features"], model, path, WINDOWS.test_start, middle).count()
    later = scoring.score_incrementally(tables["features"], model, path)
    total = tables["features"].where(F.col("target_date") >= F.lit(WINDOWS.test_start)).count()
    assert 0 < first < later.count() == total
    assert scoring.score_incrementally(tables["features"], model, path).count() == total


def test_unknown_and_missing_inputs_are_scored(spark, run):
    root, tables = run
    model = training.ModelStore(spark, f"{root}/model").load("V1")
    changed = tables["features"].withColumns(
        {
            "location_city": F.lit("never seen"), "sf_segment": F.lit(None).cast("string"),
            "location_age_days": F.lit(None).cast("int"),
        }
    )
    scored = scoring.score(changed, model)
    assert scored.count() == tables["features"].count() and scored.where("predicted is null").isEmpty()


def test_monitor_and_view(spark, run):
    root, tables = run
    quality = tables["monitor"].toPandas()
    assert len(quality) == tables["predictions"].select("prediction_timestamp").distinct().count()
    assert (quality.psi >= 0).all() and (quality.rmse >= quality.mae - 1e-9).all()
    tables["predictions"].write.mode("overwrite").option("path", f"{root}/published").saveAsTable("scores")
    view = monitoring.publish_view(spark, "scores", "demand_predictions")
    assert view.columns == list(monitoring.DIMENSION_COMMENTS)
    comments = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE demand_predictions").collect()}
    assert comments["predicted"] == monitoring.DIMENSION_COMMENTS["predicted"]


def test_stability_index(spark):
    base = spark.createDataFrame([(float(i),) for i in range(1000)], "v double")
    same = monitoring.stability_index(base, base, "v").first()["psi"]
    moved = monitoring.stability_index(base, base.select((F.col("v") + 500).alias("v")), "v").first()["psi"]
    assert same == pytest.approx(0) and moved > 1


def test_time_blocks(spark):
    data = [(day("2026-01-01") + timedelta(i // 3),) for i in range(27)]
    blocks = training.time_blocks(spark.createDataFrame(data, "d date"), "d", 3).orderBy("d").collect()
    assert [r["block"] for r in blocks] == [0, 0, 0, 1, 1, 1, 2, 2, 2]
    assert [r["rows_before"] for r in blocks] == list(range(0, 27, 3))


def test_split_label(spark):
    windows = training.Windows(date(2026, 1, 1), date(2026, 1, 2), date(2026, 1, 4), date(2026, 1, 5))
    df = spark.createDataFrame([(date(2026, 1, d),) for d in range(1, 7)], "d date").orderBy("d")
    labels = [r[0] for r in df.select(training.split_label(F.col("d"), windows)).collect()]
    assert labels == ["train", "train", None, "test", "test", None]


def error_of(scored):
    return scored.agg(F.sqrt(F.avg((F.col("prediction") - F.col(training.TARGET)) ** 2))).first()[0]


def _panel(spark, rows):
    """Training rows (day, city, target); all other inputs are missing."""
    df = spark.createDataFrame(rows, "target_date date, location_city string, provider_hours_demanded double")
    numbers = {c: F.lit(None).cast("double") for c in training.NUMERIC_INPUTS}
    texts = {c: F.lit(None).cast("string") for c in training.CATEGORY_INPUTS if c != "location_city"}
    return df.withColumns(numbers | texts)


@pytest.mark.parametrize("cities", [300, 2000])
def test_category_means_carry_a_target_at_any_size(spark, cities):
    days = [day("2026-01-01") + timedelta(d) for d in range(6)]
    rows = [(d, f"city {i * 7919 % cities}", float(i % 10) * 10) for i in range(cities) for d in days]
    data = _panel(spark, rows)
    model = training.fit(data, training.Boosting(rounds=10, rate=0.5))
    assert error_of(model.predict(data)) < 5.0
    unseen = model.predict(_panel(spark, [(day("2026-01-02"), "nowhere", 0.0), (day("2026-01-02"), None, 0.0)]))
    assert unseen.where("isnan(prediction) or prediction is null").isEmpty()


def test_a_training_run_leaves_no_scratch_and_no_shuffle_files(spark, tmp_path):
    rows = [(day("2026-03-01") + timedelta(i % 50), f"city {i % 9}", float(i % 7)) for i in range(900)]
    data = _panel(spark, rows)
    shared = Path(urlparse(ensure_checkpoint_dir(spark)).path)
    files = spark._jsc.sc().env().blockManager().diskBlockManager()

    def held():
        blocks = files.getAllFiles()
        return {blocks.apply(i).getName() for i in range(blocks.size())}

    folders, blocks = set(shared.iterdir()), {b for b in held() if b.startswith("shuffle_")}
    stored = cut(data.groupBy(training.DAY).agg(F.max(training.TARGET).alias("most")))
    assert not {b for b in held() if b.startswith("shuffle_")} - blocks and stored.count() == 50
    folders |= set(shared.iterdir())
    store = training.ModelStore(spark, str(tmp_path))
    windows = training.Windows(day("2026-03-01"), day("2026-04-09"), day("2026-04-10"), day("2026-04-19"))
    assert training.train(data, store, windows, training.Boosting(rounds=2)).count() == 1
    assert set(shared.iterdir()) == folders and store.load().predict(data).count() == 900


def test_a_category_met_once_tells_nothing_about_itself(spark):
    chance = random.Random(1)
    rows = [(day("2026-01-01") + timedelta(i % 30), f"city {i}", chance.gauss(50, 10)) for i in range(5000)]
    data = _panel(spark, rows)
    spread = error_of(data.withColumn("prediction", F.lit(50.0)))
    inside = training.training_rows(data, 2)
    assert inside.where("inputs[31] is not null and not isnan(inputs[31])").isEmpty()
    model, scores = training.fit_and_validate(data, training.Boosting(rounds=20, rate=0.3), 2)
    assert scores["cv_rmse"] == pytest.approx(spread, rel=0.05)
    assert model.trees.predict(np.full((1, 34), np.nan))[0] == pytest.approx(50, abs=1)


def test_means_see_earlier_days_and_blocks_only(spark):
    rows = [(day(f"2026-01-0{d}"), c, y) for d, c, y in ((1, "a", 1.0), (1, "a", 3.0), (2, "a", 10.0), (2, "b", 5.0), (3, "a", 20.0), (3, None, 7.0), (4, "a", None))]
    df = spark.createDataFrame(rows, "d date, c string, y double").withColumn("block", F.when(F.col("d") < "2026-01-03", 0).otherwise(1))
    found = {(r["category"], r["day"].day): (r["code"], r["block_code"]) for r in earlier_means(df, ["c"], "y", "d", "block").collect()}
    assert found == {
        ("a", 1): (None, None), ("a", 2): (2.0, None), ("a", 3): (14 / 3, 14 / 3), ("a", 4): (34 / 4, 14 / 3),
        ("b", 2): (None, None), ("None", 3): (None, None),
    }


def test_blocks_with_a_heavy_day(spark):
    heavy = [(day("2026-01-03"), "a", 1.0)] * 90 + [(day(f"2026-01-0{i}"), "a", 1.0) for i in (1, 2, 4, 5, 6)]
    blocks = [r["block"] for r in training.time_blocks(_panel(spark, heavy), "target_date", 3).orderBy("target_date").collect()]
    assert blocks == sorted(blocks) and set(blocks) == {0, 1, 2}
    measured = training.cross_validate(_panel(spark, heavy), training.Boosting(rounds=1))
    assert set(measured) >= {"cv_rmse", "cv_mae"}
    two_days = _panel(spark, [(day("2026-01-01"), "a", 1.0), (day("2026-01-02"), "a", 1.0)])
    with pytest.raises(ValueError, match="training days"):
        training.cross_validate(two_days, training.Boosting(rounds=1))


def test_daily_monitor_runs_equal_one_full_run(spark, run, tmp_path):
    _, tables = run
    scored = tables["predictions"].withColumn(scoring.PREDICTION_DAY, F.col("prediction_timestamp").cast("date"))
    baseline = scored.where(F.col(scoring.PREDICTION_DAY) < F.lit(date(2000, 9, 1)))
    path, root = str(tmp_path / "predictions"), str(tmp_path / "monitor")
    table = VersionedTable(spark, path, scoring.PREDICTION_DAY)
    table.upsert(baseline, scoring.PREDICTION_KEYS)
    monitoring.update_monitor(spark, path, scoring.PREDICTION_DAY, root, baseline)
    table.upsert(scored.where(F.col(scoring.PREDICTION_DAY) >= F.lit(date(2000, 9, 1))), scoring.PREDICTION_KEYS)
    days = table.read().select(scoring.PREDICTION_DAY).distinct().count()
    monitoring.update_monitor(spark, path, scoring.PREDICTION_DAY, root)
    corrected = scored.where(F.col(scoring.PREDICTION_DAY) == scored.agg(F.min(scoring.PREDICTION_DAY)).scalar()).withColumn("actual", F.col("actual") + 1)
    table.upsert(corrected, scoring.PREDICTION_KEYS)
    state = VersionedTable(spark, f"{root}/state", monitoring.STATE_MONTH)
    before = state.commit()
    found = monitoring.update_monitor(spark, path, scoring.PREDICTION_DAY, root)
    rewritten = [m for m, g in state.commit().parts.items() if before.parts.get(m) != g]
    assert rewritten == [min(before.parts)]  # only the corrected day was read and stored again
    full = monitoring.monitor(table.read(), baseline).orderBy("day").toPandas()
    got = found.orderBy("day").toPandas()
    assert len(got) == days and list(got.day) == list(full.day)
    for column in ("n_rows", "rmse", "mae", "psi"):
        assert got[column].tolist() == pytest.approx(full[column].tolist())
    months = monitoring.measures(state.read(), monitoring.stored_baseline(spark, f"{root}/baseline"), F.date_format("day", "yyyy-MM"))
    assert months.agg(F.sum("n_rows")).first()[0] == scored.count()


def test_scoring_reads_only_its_months_and_no_history(spark, run):
    root, tables = run
    stored = spark.read.schema(refresh._ddl(tables["features"]) + ", month string").parquet(f"{root}/features")
    after = tables["features"].agg(F.max("target_date")).first()[0] - timedelta(days=40)
    later = scoring.rows_after(stored, "target_date", after)
    plan = later._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and f">= {after:%Y-%m}" in plan
    files = {r[0] for r in later.select(F.input_file_name()).distinct().collect()}
    assert files and all(re.search("month=(.......)", f)[1] >= f"{after:%Y-%m}" for f in files)
    assert scoring.high_water_mark(spark, f"{root}/predictions") == tables["predictions"].agg(F.max("prediction_timestamp")).first()[0].date()
