import pytest
from pyspark.sql import functions as F

from footfall.functions import document_text
from footfall.operators.checks import duplicate_keys, null_rows
from footfall.operators.vocabulary import encode, fit_vocabulary
from footfall.plans.training import next_version
from footfall.sources import sinks
from footfall.sources.literals import literal_ids
from footfall.sources.tables import SOURCE_SCHEMAS, conform, read_sources

from .conftest import day
from .fixtures import make_all


def test_checks_on_the_failing_example(spark):
    ids = literal_ids(spark)
    assert duplicate_keys(ids, ["id"]).isEmpty()
    assert null_rows(ids, ["id"]).count() == 1
    assert ids.where("id = 1").count() == 1
    assert duplicate_keys(ids.union(ids), ["id"]).collect() == [(1, 2)]


def test_documents_in_three_forms(spark):
    text = spark.createDataFrame([("Hair", '{"labels": ["A", "B"]}'), ("Bad", "{oops")], "name string, doc string")
    struct = text.limit(1).select("name", F.struct(F.array(F.lit("A")).alias("labels")).alias("doc"))
    for df, expected in ((text, {"Hair": "A", "Bad": None}), (struct, {"Hair": "A"})):
        table = conform(df, "service_categories_curated", {"service_classification": "doc"})
        label = document_text("service_classification", "$.labels[0]").alias("label")
        assert {r[0]: r[1] for r in table.select("name", label).collect()} == expected


def test_read_sources(spark, tmp_path):
    for name, df in make_all(spark).items():
        df.withColumn("unused", F.lit(1)).write.parquet(f"{tmp_path}/{name}")
    tables = read_sources(spark, str(tmp_path))
    assert set(tables) == set(SOURCE_SCHEMAS)
    assert "unused" not in tables["appointments"].columns and tables["appointments"].count() == 1


KEYS = ["k", "d"]


def panel(spark, *data):
    return spark.createDataFrame([(k, day(d), v) for k, d, v in data], "k string, d date, v int")


def test_upsert(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(panel(spark, ("a", "2026-01-01", 1), ("b", "2026-01-01", 2), ("a", "2026-01-02", 3)), path, KEYS, "d")
    change = panel(spark, ("a", "2026-01-01", 10), ("c", "2026-01-03", 4))
    expected = [("a", "2026-01-01", 10), ("a", "2026-01-02", 3), ("b", "2026-01-01", 2), ("c", "2026-01-03", 4)]
    for _ in range(2):  # a repeated run changes nothing
        sinks.upsert(change, path, KEYS, "d")
        stored = sinks.VersionedTable(spark, path, "d").read()
        assert rows(stored.select("k", F.col("d").cast("string"), "v")) == expected


def contents(table):
    return sorted((r["k"], str(r["d"]), r["v"]) for r in table.read().collect())


def test_a_broken_upsert_changes_nothing_and_a_second_run_finishes_it(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    before = [("a", "2026-01-01", 1), ("a", "2026-01-02", 2)]
    sinks.upsert(panel(spark, *before), path, KEYS, "d")
    table = sinks.VersionedTable(spark, path, "d")
    change = panel(spark, ("a", "2026-01-01", 10), ("a", "2026-01-02", 20), ("b", "2026-01-03", 30))

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(sinks.VersionedTable, "_add", stop)  # both folders are written, the record is not
        with pytest.raises(KeyboardInterrupt):
            sinks.upsert(change, path, KEYS, "d")
    assert contents(table) == before and table.latest() == "2026-01-02"
    sinks.upsert(change, path, KEYS, "d")
    assert contents(table) == [("a", "2026-01-01", 10), ("a", "2026-01-02", 20), ("b", "2026-01-03", 30)]
    assert table.sweep(3600) == 0 and table.sweep(0) == 1
    assert len(contents(table)) == 3


def test_old_parts_go_and_readers_keep_the_version_they_opened(spark, tmp_path):
    path = str(tmp_path / "t")
    table = sinks.VersionedTable(spark, path, "d")
    assert table.read() is None and table.latest() is None
    seen = []
    for value in range(5):
        sinks.upsert(panel(spark, ("a", "2026-01-01", value), ("a", f"2026-01-0{value + 2}", value)), path, KEYS, "d")
        seen.append(table.read())
        if value:
            assert seen[-2].where("d = '2026-01-01'").first()["v"] == value - 1
    folders = list((tmp_path / "t" / "_rows").glob("generation=*/d=2026-01-01"))
    assert len(folders) == 2 and table.read().count() == 6 and table.commit().number == 5
    sinks.upsert(panel(spark), path, KEYS, "d")  # nothing new, no new record
    assert table.commit().number == 5


def test_writers_at_once_do_not_lose_a_write(spark, tmp_path):
    table = sinks.VersionedTable(spark, str(tmp_path / "t"), "d")
    table.upsert(panel(spark, ("a", "2026-01-01", 1)), KEYS)
    first = table.commit()
    table._add(sinks.Commit(2, first.schema, first.parts))
    with pytest.raises(RuntimeError, match="run again"):
        table._add(sinks.Commit(2, first.schema, {}))
    assert contents(table) == [("a", "2026-01-01", 1)]


def test_a_claim_is_given_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from footfall.plans.training import ModelStore

    store = ModelStore(spark, str(tmp_path / "models"))
    with ThreadPoolExecutor(8) as pool:
        versions = list(pool.map(lambda _: store.claim_version(), range(8)))
    assert sorted(versions) == [f"V{i}" for i in range(1, 9)]


def test_day_bounds_reach_the_month_folders(spark, tmp_path):
    from datetime import date

    path = str(tmp_path / "sorted")
    sinks.write_sorted(panel(spark, *[("k", f"2026-{m:02d}-15", m) for m in range(1, 13)]), path, "d", ["k", "d"])
    stored = spark.read.schema("k string, d date, v int, month string").parquet(path)
    found = sinks.between_days(stored, "d", date(2026, 3, 1), date(2026, 4, 30))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "2026-03" in plan
    assert len(set(found.select(F.input_file_name()).toPandas().iloc[:, 0])) == found.count() == 2


def test_clustered_table_is_joined_without_an_exchange(spark, tmp_path):
    df = panel(spark, *[(f"k{i % 7}", f"2026-01-{i % 28 + 1:02d}", i) for i in range(200)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        left = sinks.write_clustered(df, "clustered_left", str(tmp_path / "l"), ["k"], ["d"], 4)
        right = sinks.write_clustered(df.groupBy("k").agg(F.sum("v").alias("total")), "clustered_right", str(tmp_path / "r"), ["k"], [], 4)
        joined = left.join(right, "k").groupBy("k").agg(F.count("*").alias("n"), F.max("total").alias("total"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert {r["k"]: (r["n"], r["total"]) for r in joined.collect()} == {
            f"k{j}": (len(range(j, 200, 7)), sum(range(j, 200, 7))) for j in range(7)
        }
        per_bucket = left.withColumn("f", F.input_file_name()).toPandas().groupby("f")
        assert all(list(zip(part.k, part.d)) == sorted(zip(part.k, part.d)) for _, part in per_bucket)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("drop table if exists clustered_left")
        spark.sql("drop table if exists clustered_right")


@pytest.mark.parametrize("bad", [[("a", "2026-01-01", 1)] * 2, [(None, "2026-01-01", 1)]])
def test_upsert_rejects_bad_keys(spark, tmp_path, bad):
    with pytest.raises(ValueError):
        sinks.upsert(panel(spark, *bad), str(tmp_path / "t"), KEYS, "d")


def test_write_modes(spark, tmp_path):
    df = panel(spark, *[("k", f"2026-0{m}-{d:02d}", d) for m in (1, 2) for d in range(28, 0, -1)])
    path = str(tmp_path / "sorted")
    sinks.write_sorted(df, path, "d", ["k", "d"])
    stored = spark.read.parquet(path)
    assert stored.count() == 56 and stored.select("month").distinct().count() == 2
    for part in stored.where("month = '2026-01'").withColumn("f", F.input_file_name()).toPandas().groupby("f"):
        assert part[1].v.is_monotonic_increasing
    sinks.replace_table(df.limit(1), path)
    assert spark.read.parquet(path).count() == 1
    sinks.append_rows(df.limit(2), path)
    assert spark.read.parquet(path).count() == 3


def test_vocabulary(spark, rows):
    train = spark.createDataFrame([(c,) for c in ("x", "y", "x", None, *map(str, range(300)))], "c string")
    vocabulary = fit_vocabulary(train, "c")
    codes = {r["category"]: r["code"] for r in vocabulary.collect()}
    assert set(codes) == {"x", "y", "None", *map(str, range(300))}
    assert sorted(codes.values()) == list(range(303))
    later = spark.createDataFrame([("y",), (None,), ("new",)], "c string")
    assert rows(encode(later, "c", vocabulary, "n"), "n") == sorted([(codes["y"],), (codes["None"],), (None,)], key=repr)


def test_next_version(spark):
    def after(*names):
        return next_version(spark.createDataFrame([(n,) for n in names], "v string"), "v").first()[0]

    assert after("V1", "V2", "V10", "draft", "Vx") == "V11"
    assert after("draft") == "V1"
    assert after() == "V1"
