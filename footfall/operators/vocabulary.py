"""Closed category vocabularies: dense integer codes fitted on one table.

Codes are the position in (digest prefix, value) order. The prefix spreads any
set of values evenly over 4096 groups, so numbering needs no global sort: each
group is numbered on its own, and group offsets come from a table of at most
4096 rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PREFIX_DIGITS = 3
MISSING = "None"


def category_text(column: Column | str) -> Column:
    """Category as text; a missing one becomes a category of its own."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(MISSING))


def fit_vocabularies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per distinct category of each column: `feature`, `category`, `code` from 0.

    All columns are read in one pass.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), category_text(c).alias("category")) for c in columns])
    prefix = F.left(F.md5("category"), F.lit(PREFIX_DIGITS))
    found = df.select(F.inline(pairs)).distinct().withColumn("prefix", prefix)
    sizes = found.groupBy("feature", "prefix").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("feature").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("feature", "prefix", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("feature", "prefix").orderBy("category")) - 1
    numbered = found.select("feature", "category", "prefix", within.alias("position"))
    code = (F.col("start") + F.col("position")).cast("int")
    return numbered.join(starts, ["feature", "prefix"]).select("feature", "category", code.alias("code"))


def category_rows(df: DataFrame, columns: Sequence[str], *carry: str) -> DataFrame:
    """One row per row and column of `df`: `feature`, `category` and the carried columns; nothing else moves with it."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), category_text(c).alias("category")) for c in columns])
    return df.select(*carry, F.inline(pairs))


def _mean(total: Column, count: Column, digits: int | None) -> Column:
    """Rounded in two steps, so that float noise decides no tie."""
    mean = total / F.nullif(count, F.lit(0))
    return mean if digits is None else F.round(F.round(mean, 6), digits)


def target_means(df: DataFrame, columns: Sequence[str], target: str, digits: int | None = None) -> DataFrame:
    """One row per distinct category of each column: `feature`, `category`, `code`, the mean of `target` there.

    For rows that are not among those of `df`; its own rows take `earlier_means`.
    """
    rows = category_rows(df.where(F.col(target).isNotNull()), columns, target)
    sums = rows.groupBy("feature", "category").agg(F.sum(F.col(target).cast("double")).alias("total"), F.count("*").alias("n"))
    return sums.select("feature", "category", _mean(F.col("total"), F.col("n"), digits).alias("code"))


def earlier_means(
    df: DataFrame, columns: Sequence[str], target: str, day: str, block: str, digits: int | None = None
) -> DataFrame:
    """One row per category and day: `feature`, `category`, `day`, and the mean of `target` there over rows of earlier days
    (`code`) and of earlier blocks of days (`block_code`), NULL where there are none.

    No row sees its own target or that of its day, so a category met once tells nothing about itself. Windows run over one
    row per category and day, however many rows a category has.
    """
    rows = category_rows(df, columns, target, day, block)
    known = F.col(target).isNotNull()
    daily = rows.groupBy("feature", "category", F.col(day).alias("day"), F.col(block).alias("block")).agg(
        F.sum(F.when(known, F.col(target).cast("double"))).alias("total"), F.count(target).alias("n")
    )
    series = Window.partitionBy("feature", "category")
    days = series.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    blocks = series.orderBy("block").rangeBetween(Window.unboundedPreceding, -1)
    means = [_mean(F.sum("total").over(w), F.sum("n").over(w), digits) for w in (days, blocks)]
    return daily.select("feature", "category", "day", means[0].alias("code"), means[1].alias("block_code"))


def values_by_row(
    df: DataFrame, row: str, means: DataFrame, columns: Sequence[str], outputs: Sequence[str] = ("code",), day: str | None = None
) -> DataFrame:
    """`row` (unique in `df`) and `{output}_{column}` for each column: its category's mean, NULL for an unseen one.

    Only row numbers and categories move to the means; the wide rows stay where they are.
    """
    narrow = category_rows(df, columns, row, *([day] if day else []))
    keys = ["feature", "category"]
    if day:
        narrow, keys = narrow.withColumnRenamed(day, "day"), [*keys, "day"]
    met = narrow.join(means, keys, "left")
    picked = [F.max(F.when(F.col("feature") == c, F.col(o))).alias(f"{o}_{c}") for c in columns for o in outputs]
    return met.groupBy(row).agg(*picked)


def vocabulary_of(vocabularies: DataFrame, column: str) -> DataFrame:
    return vocabularies.where(F.col("feature") == column).select("category", "code")


def fit_vocabulary(df: DataFrame, column: str) -> DataFrame:
    """One row per distinct category of `column`: `category`, `code` from 0."""
    return fit_vocabularies(df, [column]).drop("feature")


def encode(df: DataFrame, column: str, vocabulary: DataFrame, output: str) -> DataFrame:
    """Adds `output`: the code of `column`, NULL for a category not in the vocabulary."""
    lookup = vocabulary.select(F.col("category").alias("_category"), F.col("code").alias(output))
    return df.join(lookup, category_text(column) == F.col("_category"), "left").drop("_category")
