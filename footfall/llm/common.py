"""Reading the tables of a query, and columns whose names cannot clash with a table's own."""

from __future__ import annotations

import uuid
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"


def documents(docs: DataFrame, *extra: str) -> DataFrame:
    """`doc_id` as a long, `text` as a string and the named columns; everything else is left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *extra)


#: Ids that are broadcast at most: some 30 MB for an executor.
FEW_IDS = 1_000_000


def few(ids: DataFrame, most: int = FEW_IDS) -> DataFrame:
    """`ids`, a stored table of one or two numbers a row, to join with: broadcast where counting finds at most `most` rows,
    so that the other side, with its texts, stays where it is; beyond that Spark moves both sides by key."""
    return F.broadcast(ids) if ids.count() <= most else ids


def _deflate(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: zlib.compress(t.encode(), 1) if isinstance(t, str) else None)


def deflated(column: str) -> Column:
    """Texts as bytes that are packed closer than shuffle files pack them."""
    return F.pandas_udf(_deflate, "binary")(column)


def inflated(texts: pd.Series) -> list[str]:
    """The texts again; a null text is empty."""
    return [zlib.decompress(t).decode() if t is not None else "" for t in texts]
