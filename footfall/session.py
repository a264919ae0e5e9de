"""Session settings and the reliable place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Spark's own adaptive machinery does the sizing, the skew splitting and the
# broadcast decisions; the only forced broadcast is a table with a row per
# calendar day (operators/nearby.py).
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Catalyst broadcasts a side only if its files are within this size.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    # Join key and grouping key differ in the fact joins, so splitting a hot
    # join key costs nothing extra; allow it also where it adds an exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for `DataFrame.checkpoint()`.

    A cluster names its shared folder in `spark.checkpoint.dir`. Only a local
    session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current:
        return current
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="footfall-checkpoint-")
    context.setCheckpointDir(named)
    return named


_HELD: ContextVar[list[str] | None] = ContextVar("held", default=None)


@contextmanager
def noting() -> Iterator[list[str]]:
    """A list that fills with the folders `cut` writes inside the block, for `discard` when their last reader has ended."""
    held: list[str] = []
    token = _HELD.set(held)
    try:
        yield held
    finally:
        _HELD.reset(token)


def discard(spark: SparkSession, folders: list[str]) -> None:
    """Deletes the folders and empties the list."""
    while folders:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(folders.pop())
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Files that `cut` writes inside go when the block ends: for jobs whose results are stored elsewhere by then."""
    with noting() as held:
        try:
            yield
        finally:
            discard(spark, held)


@contextmanager
def _removing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside remove their own shuffle files when they end."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    try:
        spark.conf.set(name, "true")
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def cut(df: DataFrame) -> DataFrame:
    """Write `df` as parquet to the checkpoint folder and go on from the files.

    For a result that several branches read: each scans only its own columns,
    Catalyst knows the real size, and a lost executor never sends the job back
    to the fact tables. The shuffle files behind it go as soon as it is written.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    held = _HELD.get()
    if held is not None:
        held.append(path)
    with _removing_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
