"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once untimed on the smallest tables, then once timed. `full_training` is the training run at its published
setting (200 rounds, two validation folds); it has a limit of its own, $BENCH_FULL_LIMIT seconds (0 leaves it out), and is
not part of the total.
"""

from __future__ import annotations

import json
import os
import threading
import time

from footfall.session import build_session
from workload.queries import QUERIES, full_training

HEADLINE = (
    "demand_daily",
    "rolling_features",
    "market_rolling",
    "service_menu_stats",
    "location_profile",
    "message_window",
    "trailing_event_counts",
    "trailing_event_counts_range",
    "conformal_quantile",
    "category_encode",
    "feature_table",
    "train_score",
)


def run(spark, name: str, sf_dir: str) -> None:
    """Plans and runs a query in full; its rows are counted as written, but not stored."""
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def run_full(spark, sf_dir: str, limit: float) -> tuple[float | None, dict]:
    """Seconds and validation errors of the full training run; None if the limit ended it."""
    context = spark.sparkContext
    over = threading.Timer(limit, context.cancelAllJobs)
    over.start()
    started = time.perf_counter()
    try:
        metrics = full_training(spark, sf_dir).first()["metrics"]
    except Exception:
        if time.perf_counter() - started < limit:
            raise
        return None, {}
    finally:
        over.cancel()
    return round(time.perf_counter() - started, 3), {name: metrics[name] for name in sorted(metrics)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # Test partitions are far below a megabyte; keep all cores busy.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    small_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small_dir):
        for name in wanted:  # loads and compiles the engine's code, untimed
            run(spark, name, small_dir)
    seconds = {}
    for name in wanted:
        started = time.perf_counter()
        run(spark, name, sf_dir)
        seconds[name] = round(time.perf_counter() - started, 3)
    total = round(sum(seconds.values()), 3)
    limit = float(os.environ.get("BENCH_FULL_LIMIT", "600"))
    measured = {}
    if limit > 0 and not os.environ.get("BENCH_QUERIES"):
        seconds["full_training"], measured = run_full(spark, sf_dir, limit)
    line = {
        "metric": "total_query_time",
        "value": total,
        "unit": "sec",
        "queries": seconds,
        "full_training_errors": measured,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
