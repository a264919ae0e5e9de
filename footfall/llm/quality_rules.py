"""Quality rules whose cutoffs keep the false rejections of good documents within a proven limit; DataFrame only.

A rule measures a document in parts per thousand (more is worse) and rejects it above its cutoff. Cutoffs are chosen per
stratum (language) and rule on the labelled documents that pass the base rule: from the most lenient cutoff on, each is
tested with the exact binomial tail P(X <= k), X ~ Bin(n, LIMIT), where k of n good documents lie above the cutoff, and
the last cutoff before the first failure is taken (fixed-sequence testing needs no correction along the grid). The level
is divided by the number of strata times rules, so with confidence 1 - LEVEL every rule in every stratum rejects at most
LIMIT of the good documents. A rule without a proven cutoff rejects nothing.

Good: quality 1 and toxic 0 in all label rows of the document.

Defined cases: null text has no words and fails the base rule; repeated rows count each; a null language is a stratum of
its own; labels with null ids or values, and strata or tables without labels, prove no cutoff.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: Words that mark insults; a parameter of the rule, to be replaced for other corpora.
INSULTS = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
#: Cutoffs tried, in parts per thousand, strictest first.
GRID = (0, 1, 2, 3, 5, 7, 10, 15, 20, 30, 50, 70, 100, 150, 200, 300, 400, 500, 700, 1000, 1500, 2000, 3000, 5000)
#: Share of good documents that one rule may reject, and the chance that any of the cutoffs exceeds it.
LIMIT = 0.005
LEVEL = 0.05
RULES = ("symbols", "dup_lines", "repeats", "capitals", "insults")


def measures(docs: DataFrame, carry: list[Column], insults: tuple[str, ...] = INSULTS) -> DataFrame:
    """carry..., n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals, n_insults of `text`."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split("__text", SPACE), lambda w: w != "")
    lines = F.filter(F.split("__text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    pattern = r"\b(?:" + "|".join(insults) + r")\b"
    step = docs.select(*carry, text.alias("__text"))
    names = step.columns[:-1]
    step = step.select(
        *names,
        F.transform(words, lambda w: F.xxhash64(w)).alias("__words"),
        lines.alias("__lines"),
        F.length(F.regexp_replace("__text", SPACE, "")).cast("long").alias("word_chars"),
        F.regexp_count("__text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.regexp_count("__text", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.regexp_count(F.lower("__text"), F.lit(pattern)).cast("long").alias("n_insults"),
    )
    counted = [*names, "word_chars", "n_symbols", "n_capitals", "n_insults"]
    three = F.transform(
        F.sequence(F.lit(0), F.size("__words") - 3),
        lambda i: F.xxhash64(F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)),
    )
    step = step.select(
        *counted,
        F.size("__words").cast("long").alias("n_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("__words") >= 3, three).alias("__runs"),
    )
    counted += ["n_words", "n_lines", "n_dup_lines"]
    # Only texts with a repeated run are sorted: equal runs then stand side by side with their places.
    placed = F.array_sort(F.transform("__runs", lambda run, i: F.struct(run.alias("run"), i.alias("at"))))
    step = step.select(*counted, F.when(F.size(F.array_distinct("__runs")) < F.size("__runs"), placed).alias("__sorted"))

    def repeated(x: Column, i: Column) -> Column:
        same = lambda other: F.coalesce(other["run"] == x["run"], F.lit(False))
        return same(F.get("__sorted", i - 1)) | same(F.get("__sorted", i + 1))

    step = step.select(*counted, F.transform(F.filter("__sorted", repeated), lambda x: x["at"]).alias("__places"))
    start = F.struct(F.lit(0).alias("reached"), F.lit(0).cast("long").alias("total"))

    def cover(state: Column, at: Column) -> Column:
        return F.struct(
            (at + 3).alias("reached"),
            (state["total"] + at + 3 - F.greatest(at, state["reached"])).alias("total"),
        )

    total = F.aggregate(F.sort_array("__places"), start, cover, lambda state: state["total"])
    return step.select(*counted, F.coalesce(total, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rule_values() -> Column:
    """Array in the order of RULES, in whole parts per thousand."""

    def share(part: str, whole: str) -> Column:
        return F.floor(1000 * F.col(part) / F.greatest(F.col(whole), F.lit(1))).cast("long")

    return F.array(
        share("n_symbols", "n_words"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
        share("n_capitals", "word_chars"),
        share("n_insults", "n_words"),
    )


def binomial_tail(k: Column, n: Column, share: float) -> Column:
    """P(X <= k), X ~ Bin(n, share); 1 if k >= n * share, where it is at least a half.

    Terms follow from each other by their ratio; sums are kept as logarithms, so no term is lost to underflow.
    """
    import math

    odds = math.log(share) - math.log1p(-share)

    def add(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        high, low = F.greatest(term, state["sum"]), F.least(term, state["sum"])
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    zero = n * F.lit(math.log1p(-share))
    start = F.struct(zero.alias("term"), zero.alias("sum"))
    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k >= n * share, F.lit(1.0)).otherwise(F.exp(F.aggregate(terms, start, add, lambda state: state["sum"])))


def cutoffs(measured: DataFrame, labels: DataFrame, limit: float = LIMIT, level: float = LEVEL) -> DataFrame:
    """stratum, cuts: the cutoff of each rule in the order of RULES, null where none is proven.

    `measured`: doc_id, stratum, failed (base rule), marks (rule values).
    """
    bad = (F.col("quality") != 1) | (F.col("toxic") != 0) | F.col("quality").isNull() | F.col("toxic").isNull()
    good = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), bad.alias("bad"))
        .groupBy("doc_id").agg(F.max("bad").alias("bad")).where("not bad").select("doc_id")
    )
    held = measured.where("not failed").join(good, "doc_id").select("stratum", F.posexplode("marks").alias("rule", "mark"))
    grid = F.array(*[F.lit(g).cast("long") for g in GRID])
    # Number of cutoffs that the mark exceeds: it lies above exactly those with a lower number.
    above = F.size(F.filter(grid, lambda g: g < F.col("mark")))
    counts = held.groupBy("stratum", "rule", above.alias("above")).agg(F.count("*").alias("n"))
    folded = counts.groupBy("stratum", "rule").agg(
        F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("above", "n"))).alias("by")
    )
    strata = F.count(F.lit(1)).over(Window.partitionBy())
    # A row per stratum and rule: bounded by the number of languages.
    tests = folded.withColumn("tests", strata)
    numbered = tests.select("stratum", "rule", "n", "tests", "by", F.explode(F.sequence(F.lit(0), F.lit(len(GRID) - 1))).alias("at"))
    over = F.aggregate(
        F.sequence(F.col("at") + 1, F.lit(len(GRID))), F.lit(0).cast("long"),
        lambda total, i: total + F.coalesce(F.element_at("by", i), F.lit(0)),
    )
    tried = numbered.select("stratum", "rule", "n", "tests", "at", over.alias("over"))
    passes = binomial_tail(F.col("over"), F.col("n"), limit) <= F.lit(level) / F.col("tests")
    best = tried.select("stratum", "rule", "at", passes.alias("ok")).groupBy("stratum", "rule").agg(
        F.coalesce(F.max(F.when(~F.col("ok"), F.col("at"))), F.lit(-1)).alias("fails")
    )
    chosen = best.select("stratum", "rule", F.get(grid, F.col("fails") + 1).alias("cut"))
    by_rule = chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cut"))).alias("by"))
    return by_rule.select("stratum", F.array(*[F.element_at("by", F.lit(i)) for i in range(len(RULES))]).alias("cuts"))


def verdicts(docs: DataFrame, labels: DataFrame, limit: float = LIMIT, level: float = LEVEL) -> DataFrame:
    """Per row: doc_id, version (hash of the text), the counts, base_failed, kept, failed_rules."""
    stratum = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-")).alias("stratum")
    carry = [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("version"), stratum]
    measured = measures(docs, carry).withColumn("failed", base_failed()).withColumn("marks", rule_values())
    measured = cut(measured)
    chosen = cut(cutoffs(measured, labels, limit, level)).withColumnRenamed("stratum", "c_stratum")
    joined = measured.join(chosen, F.col("stratum") == F.col("c_stratum"), "left")
    names = F.array(*[F.lit(r) for r in RULES])
    wrong = F.filter(
        F.transform(names, lambda r, i: F.when(F.get("marks", i) > F.get("cuts", i), r)), lambda r: r.isNotNull()
    )
    out = joined.withColumn("failed_rules", F.coalesce(wrong, F.array().cast("array<string>")))
    return out.select(
        "doc_id", "version", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.col("failed").alias("base_failed"), (~F.col("failed") & (F.size("failed_rules") == 0)).alias("kept"), "failed_rules",
    )
