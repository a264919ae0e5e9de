"""Token counts by an exact length histogram.

Documents are encoded whole and aggregated to (group, length, documents), a table as long as there are distinct lengths.
Suffix sums over it answer every context limit: how many documents are at least that long, how many tokens remain if
documents are cut there, and how many sequences they would fill. They run in two levels: inside spans of lengths, and
over span totals, so no task sees more than the lengths of one span or one row per span.

Defined cases: null or empty text has length 0; a null group is a group of its own; repeated rows count each; an empty
table gives an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .tokens import encoder

SPAN = 1024


def _lengths(tokenizer: str | None):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = encoder(tokenizer)
        for frame in frames:
            sizes = [len(known.ids(text if isinstance(text, str) else None)) // 4 for text in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "grp": frame["grp"], "length": sizes})

    return run


def encoded_lengths(docs: DataFrame, group: str, tokenizer: str | None = None) -> DataFrame:
    """doc_id, grp, length of each row."""
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(group).cast("string").alias("grp"), F.col("text").cast("string").alias("text"))
    return picked.mapInPandas(_lengths(tokenizer), "doc_id long, grp string, length long")


def histogram(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("grp", "length").agg(F.count("*").alias("n_docs"))


def with_suffix_sums(counts: DataFrame) -> DataFrame:
    """grp, length, n_docs and, for a context limit of `length` tokens: `docs_at_least`, `tokens_at_least` (all tokens of
    those documents), `docs_below`, `tokens_below` and `tokens_truncated` (tokens left if every document is cut there)."""
    # Read twice below; without the written table every text would be encoded twice.
    spans = cut(counts).withColumn("span", F.floor(F.col("length") / SPAN))
    tokens = F.col("n_docs") * F.col("length")
    totals = spans.groupBy("grp", "span").agg(F.sum("n_docs").alias("docs"), F.sum(tokens).alias("tokens"))
    later = Window.partitionBy("grp").orderBy(F.col("span").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("grp")
    totals = totals.select(
        F.col("grp").alias("t_grp"), F.col("span").alias("t_span"),
        F.coalesce(F.sum("docs").over(later), F.lit(0)).alias("later_docs"), F.coalesce(F.sum("tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("docs").over(whole).alias("all_docs"), F.sum("tokens").over(whole).alias("all_tokens"),
    )
    inside = Window.partitionBy("grp", "span").orderBy(F.col("length").desc())
    joined = spans.join(totals, spans["grp"].eqNullSafe(totals["t_grp"]) & (spans["span"] == totals["t_span"]))
    own = joined.select(
        "grp", "span", "length", "n_docs", "all_docs", "all_tokens",
        (F.sum("n_docs").over(inside) + F.col("later_docs")).alias("docs_at_least"),
        (F.sum(tokens).over(inside) + F.col("later_tokens")).alias("tokens_at_least"),
    )
    return own.select(
        "grp", "length", "n_docs", "docs_at_least", "tokens_at_least",
        (F.col("all_docs") - F.col("docs_at_least")).alias("docs_below"),
        (F.col("all_tokens") - F.col("tokens_at_least")).alias("tokens_below"),
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("docs_at_least") * F.col("length")).alias("tokens_truncated"),
    )


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """grp, context_limit, tokens: tokens left under any limits, also ones no document has as its length.

    The least length at or above a limit holds the answer: its documents and all longer ones give `limit` each.
    """
    each = F.explode(F.array([F.lit(int(x)).cast("long") for x in limits]))
    at = sums.withColumn("context_limit", each)
    longer = at.where("length >= context_limit").groupBy("grp", "context_limit").agg(
        F.min_by(F.col("tokens_below") + F.col("docs_at_least") * F.col("context_limit"), "length").alias("tokens")
    )
    everything = sums.groupBy("grp").agg(F.max(F.col("tokens_below") + F.col("n_docs") * F.col("length")).alias("all_tokens"))
    grid = everything.withColumn("context_limit", each)
    return grid.alias("g").join(
        longer.alias("l"), F.col("g.grp").eqNullSafe(F.col("l.grp")) & (F.col("g.context_limit") == F.col("l.context_limit")), "left"
    ).select("g.grp", "g.context_limit", F.coalesce("l.tokens", "g.all_tokens").alias("tokens"))


def quantiles(sums: DataFrame, levels: list[float]) -> DataFrame:
    """grp, level, length: the least length that at least that share of the group's documents does not exceed."""
    level = F.explode(F.array([F.lit(float(x)) for x in levels])).alias("level")
    total = F.col("docs_below") + F.col("docs_at_least")
    reached = sums.select("grp", "length", (F.col("docs_below") + F.col("n_docs")).alias("upto"), total.alias("total"), level)
    return reached.where("upto >= level * total").groupBy("grp", "level").agg(F.min("length").alias("length"))
