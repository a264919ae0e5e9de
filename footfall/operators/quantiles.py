"""Exact interpolated quantiles of a whole column without a single-task sort.

Spark's exact `percentile` keeps every distinct value of a group in one buffer,
which a residual column at scale does not fit. Here the value range that holds
the wanted ranks is narrowed by counting: each pass is one aggregate with
map-side combine over a fixed number of cells, and only the cell counts reach
the driver. The counts are exact, hence so is the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 4096


def _narrow(values: DataFrame, spans: list[tuple[float, float]]) -> list[list[tuple[float, float, int]]]:
    """Per span: (least value, greatest value, row count) of its cells, in order."""
    v = F.col("v")
    span_id = reduce(
        lambda chain, item: chain.when(v.between(*item[1]), F.lit(item[0])),
        list(enumerate(spans))[1:],
        F.when(v.between(*spans[0]), F.lit(0)),
    )
    low, high = (
        F.element_at(F.array(*[F.lit(span[side]) for span in spans]), F.col("span") + 1) for side in (0, 1)
    )
    # Halves, so that the width of a span never overflows.
    share = F.when(high > low, (v / 2 - low / 2) / (high / 2 - low / 2)).otherwise(F.lit(0.0))
    cell = F.least(F.floor(share * CELLS), F.lit(CELLS - 1))
    cells = (
        values.withColumn("span", span_id)
        .where("span is not null")
        .groupBy("span", cell.alias("cell"))
        .agg(F.min("v").alias("least"), F.max("v").alias("greatest"), F.count("*").alias("n"))
        .collect()
    )
    found: list[list[tuple[float, float, int]]] = [[] for _ in spans]
    for row in sorted(cells, key=lambda r: (r["span"], r["cell"])):
        found[row["span"]].append((row["least"], row["greatest"], row["n"]))
    return found


def _finite() -> Column:
    return F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") != F.lit(math.inf))


def order_statistics(df: DataFrame, column: str, ranks: Sequence[int], bounds: tuple[float, float]) -> dict[int, float]:
    """Value at each zero-based rank of the sorted finite values of `column`."""
    values = df.select(F.col(column).cast("double").alias("v")).where(_finite())
    answers: dict[int, float] = {}
    # span -> the wanted ranks inside it, counted from the span's first row
    open_spans = {bounds: {rank: rank for rank in ranks}}
    while open_spans:
        spans = sorted(open_spans)
        narrower: dict[tuple[float, float], dict[int, int]] = {}
        for span, cells in zip(spans, _narrow(values, spans)):
            wanted = open_spans[span]
            before = 0
            for least, greatest, n in cells:
                for rank, offset in wanted.items():
                    if not before <= offset < before + n:
                        continue
                    if least == greatest or offset == before:
                        answers[rank] = least
                    elif offset == before + n - 1:
                        answers[rank] = greatest
                    elif (least, greatest) == span:
                        raise ArithmeticError(f"the span {span} of {column} cannot be narrowed")
                    else:
                        narrower.setdefault((least, greatest), {})[rank] = offset - before
                before += n
        open_spans = narrower
    return answers


def exact_quantiles(df: DataFrame, column: str, levels: Sequence[float]) -> list[float | None]:
    """Linearly interpolated quantiles; NULL and NaN values are left out."""
    return quantiles_with_count(df, column, lambda n: levels)[0]


def quantiles_with_count(df: DataFrame, column: str, levels_for) -> tuple[list[float | None], int]:
    """As `exact_quantiles`, for levels that depend on the number of values."""
    value = F.col(column).cast("double")
    present = df.select(value.alias("v")).where("v is not null and not isnan(v)")
    summary = present.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("v") == F.lit(-math.inf)).alias("below"),
        F.count_if(F.col("v") == F.lit(math.inf)).alias("above"),
        F.min(F.when(_finite(), F.col("v"))).alias("low"),
        F.max(F.when(_finite(), F.col("v"))).alias("high"),
    ).first()
    n = summary["n"]
    if n == 0:
        return [None for _ in levels_for(0)], 0
    levels = list(levels_for(n))
    positions = [(n - 1) * level for level in levels]
    ranks = {r for p in positions for r in (math.floor(p), min(math.floor(p) + 1, n - 1))}
    # Infinite values take the first and last ranks; only finite ones are narrowed down to.
    below, finite = summary["below"], n - summary["below"] - summary["above"]
    at = {r: -math.inf for r in ranks if r < below} | {r: math.inf for r in ranks if r >= below + finite}
    inner = sorted(r - below for r in ranks - at.keys())
    if inner:
        found = order_statistics(df, column, inner, (summary["low"], summary["high"]))
        at |= {r + below: value for r, value in found.items()}
    result = []
    for position in positions:
        rank = math.floor(position)
        lower, upper, part = at[rank], at[min(rank + 1, n - 1)], position - rank
        if part == 0 or lower == upper:
            result.append(lower)
        elif math.isfinite(upper - lower):
            result.append(lower + (upper - lower) * part)
        else:
            result.append(lower * (1 - part) + upper * part)
    return result, n
