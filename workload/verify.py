"""Compares every query with its SQL: `python -m workload.verify SF_DIR [key ...]`."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from .oracle import ORACLE
from .queries import QUERIES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def normalised(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows sorted; text makes the comparison exact."""
    text = frame[sorted(frame.columns)].astype(object)
    text = text.where(text.notna(), None)
    for name in text.columns:
        text[name] = text[name].map(_text)
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def _text(value) -> str:
    if value is None:
        return "~"
    if isinstance(value, float):
        return repr(value + 0.0).removesuffix(".0")
    if hasattr(value, "isoformat"):
        return value.isoformat().removesuffix("T00:00:00")
    return str(value)


def difference(got: pd.DataFrame, expected: pd.DataFrame) -> str:
    """Empty if both hold the same rows, else a short description."""
    if sorted(got.columns) != sorted(expected.columns):
        return f"columns differ: {sorted(set(got.columns) ^ set(expected.columns))}"
    if len(got) != len(expected):
        return f"rows differ: {len(got)} against {len(expected)}"
    left, right = normalised(got), normalised(expected)
    if left.equals(right):
        return ""
    unequal = [c for c in left.columns if not left[c].equals(right[c])]
    first = unequal[0]
    rows = left.index[left[first] != right[first]]
    return f"values differ in {unequal[:6]}, {len(rows)} rows, e.g. {left[first][rows[0]]} / {right[first][rows[0]]}"


def main(sf_dir: str, keys: list[str]) -> int:
    builder = SparkSession.builder.master("local[8]").appName("verify").config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", "8").config("spark.ui.showConsoleProgress", "false")
    spark = builder.getOrCreate()  # Spark's defaults: no query may depend on this package's settings
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failures = 0
    seconds = 0.0
    for key in keys or QUERIES:
        started = time.time()
        got = QUERIES[key](spark, sf_dir).toPandas()
        spent = time.time() - started
        problem = difference(got, connection.sql(ORACLE[key]).df()) if key in ORACLE else ""
        failures += bool(problem)
        seconds += spent
        print(f"{'FAIL' if problem else 'ok' if key in ORACLE else 'ran':4} {key:28} {len(got):8} {spent:6.1f}s {problem}")
    print(f"{failures} failures, {seconds:.0f} s in Spark")
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
