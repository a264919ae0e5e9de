"""Quality by perplexity under an interpolated modified Kneser-Ney model of code points, trained on trusted text.

Trusted text is what the labels call good (quality 1, toxic 0). Its runs of ORDER code points are counted per portion of
text and summed in Spark; lower orders use continuation counts, each order has its own three discounts, and all
probabilities come from joins of the count tables, which are sharded by run and grow with the trusted text.

Documents are dealt into batches of bounded size. A batch asks for each run it holds once; the distinct runs of all
batches are joined with the model order by order (a run unseen at one order falls back to the context's weight and the
next order), and the answers go back to their batch, which reads its texts again and sums them up per document. So what
moves is the texts once, compressed, and a few numbers for each distinct run of a batch, never a row per word.

A document is kept if its log perplexity is at most its language's quantile of the log perplexities of trusted documents
that were left out of training (steps of 0.001, exact counts). A language without such documents takes the quantile over
all languages.

Defined cases: a text without code points has no perplexity and is not kept; code points above U+FFFF are one symbol;
repeated rows are judged each; a null language is a language of its own; without trusted text nothing is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, discard, noting
from .common import deflated, few, inflated

ORDER = 4
BATCH_CHARS = 8_000_000
QUANTILE = 0.995
#: Symbols the model shares its last weight among.
SYMBOLS = 1 << 16
STEP = 0.001


def runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(a 64-bit key per code point: it and the three before it, 16 bits each; bounds of the texts)."""
    joined = "\0\0\0".join(["", *texts, ""]) if texts else ""
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    points = np.minimum(points, 0xFFFF).astype(np.uint64)
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    at = np.arange(bounds[-1]) + np.repeat(3 * np.arange(1, len(texts) + 1), lengths)
    key = points[at]
    for back in range(1, ORDER):
        key = key | (points[at - back] << np.uint64(16 * back))
    return key, bounds


def _counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        held, size = [], 0
        for text in [*frame["text"], None]:
            if isinstance(text, str):
                held.append(text)
                size += len(text)
            if held and (text is None or size >= BATCH_CHARS):
                key, n = np.unique(runs(held)[0], return_counts=True)
                yield pd.DataFrame({"run": key.view(np.int64), "n": n})
                held, size = [], 0


def _asked(group: pd.DataFrame) -> pd.DataFrame:
    key = np.unique(runs(inflated(group["deflated"]))[0])
    return pd.DataFrame({"batch": group["batch"].iloc[0], "run": key.view(np.int64)})


def _scores(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    if not len(group):
        return pd.DataFrame({"doc_id": pd.Series(dtype="Int64"), "version": [], "lang": [], "n_chars": [], "log_sum": []})
    key, bounds = runs(inflated(group["deflated"]))
    total = np.zeros(len(key) + 1)
    if len(key):
        known = answers["run"].to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(known)
        value = answers["log_p"].to_numpy()[order]
        total[1:] = np.cumsum(value[np.searchsorted(known[order], key)])
    return pd.DataFrame(
        {"doc_id": group["doc_id"].astype("Int64"), "version": group["version"], "lang": group["lang"],
         "n_chars": np.diff(bounds), "log_sum": total[bounds[1:]] - total[bounds[:-1]]}
    )


def _low(run: Column, symbols: int) -> Column:
    """The last `symbols` symbols."""
    return run.bitwiseAND(F.lit((1 << 16 * symbols) - 1)) if symbols < ORDER else run


def _context(run: Column) -> Column:
    return F.shiftrightunsigned(run, 16)


def _discounted(counts: DataFrame, order: int) -> DataFrame:
    """run, first (discounted share), context weights per context; `counts`: run, n."""
    seen = counts.agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (max(1, seen[f"n{i}"] or 0) for i in (1, 2, 3, 4))
    share = n1 / (n1 + 2 * n2)
    # Small or odd counts of counts can push a discount out of its range.
    d1, d2, d3 = (min(max(d, 0.05), top - 0.05) for d, top in ((1 - 2 * share * n2 / n1, 1), (2 - 3 * share * n3 / n2, 2), (3 - 4 * share * n4 / n3, 3)))
    n = F.col("n")
    off = F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)
    context = _context(F.col("run")) if order > 1 else F.lit(0).cast("long")
    held = counts.select("run", context.alias("context"), "n", off.alias("off"))
    contexts = held.groupBy("context").agg(F.sum("n").alias("total"), F.sum("off").alias("lost"))
    contexts = contexts.select("context", "total", (F.col("lost") / F.col("total")).alias("weight"))
    return held.join(contexts, "context").select("run", ((F.col("n") - F.col("off")) / F.col("total")).alias("first")), contexts.select("context", "weight")


def train(trusted: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Per order from 1: (run, first), (context, weight). `trusted` has `text`."""
    with noting() as held:
        counted = trusted.select("text").mapInPandas(_counts, "run long, n long")
        counts = cut(counted.groupBy("run").agg(F.sum("n").alias("n")))
        tables = [counts]
        for order in range(ORDER - 1, 0, -1):
            # Continuation counts: in how many distinct longer runs a run is the end.
            counts = cut(tables[0].select(_low(F.col("run"), order).alias("run")).groupBy("run").agg(F.count("*").alias("n")))
            tables.insert(0, counts)
    model = [tuple(map(cut, _discounted(table, order))) for order, table in enumerate(tables, 1)]
    discard(trusted.sparkSession, held)
    return model


def log_probabilities(asked: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """run, log_p of each distinct `run`, interpolated from order 1 up."""
    scored = asked.select("run").distinct().withColumn("p", F.lit(1.0 / SYMBOLS))
    for order, (first, weights) in enumerate(model, 1):
        scored = scored.withColumn("part", _low(F.col("run"), order)).withColumn("context", _context(F.col("part")) if order > 1 else F.lit(0).cast("long"))
        scored = scored.join(first.withColumnRenamed("run", "part"), "part", "left").join(weights, "context", "left")
        p = F.coalesce("first", F.lit(0.0)) + F.coalesce("weight", F.lit(1.0)) * F.col("p")
        scored = scored.select("run", p.alias("p"))
    return scored.select("run", F.log("p").alias("log_p"))


def held_out() -> Column:
    """Every fourth trusted document, by hash, is left out of training and sets the quantiles."""
    return F.pmod(F.xxhash64(F.col("doc_id"), F.lit("held out")), F.lit(4)) == 0


def perplexities(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, version, lang, n_chars, log_ppl of each row; doc_id of the trusted documents)."""
    bad = (F.col("quality") != 1) | (F.col("toxic") != 0) | F.col("quality").isNull() | F.col("toxic").isNull()
    good = cut(
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), bad.alias("bad"))
        .groupBy("doc_id").agg(F.max("bad").alias("bad")).where("not bad and doc_id is not null").select("doc_id")
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("version"),
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
    )
    model = train(rows.join(few(good.where(~held_out())), "doc_id", "left_semi"))
    chars = rows.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    batches = max(1, math.ceil(chars / BATCH_CHARS))
    batched = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", "version"), F.lit(batches)).cast("int"))
    # Texts move as bytes that are packed closer than shuffle files pack them.
    packed = deflated("text").alias("deflated")
    by_batch = batched.select("batch", "doc_id", "version", "lang", packed).groupBy("batch")
    asked = by_batch.applyInPandas(_asked, "batch int, run long")
    answers = asked.join(log_probabilities(asked, model), "run").select("batch", "run", "log_p")
    scores = by_batch.cogroup(answers.groupBy("batch")).applyInPandas(
        _scores, "doc_id long, version long, lang string, n_chars long, log_sum double"
    )
    log_ppl = F.when(F.col("n_chars") > 0, -F.col("log_sum") / F.col("n_chars"))
    return cut(scores.select("doc_id", "version", "lang", "n_chars", log_ppl.alias("log_ppl"))), good


def quantile_cuts(values: DataFrame, group: str, value: str, level: float) -> DataFrame:
    """group, cut: the least step of STEP that at least a share `level` of the group's values does not exceed."""
    steps = values.where(F.col(value).isNotNull()).groupBy(group, F.ceil(F.col(value) / STEP).alias("step")).agg(F.count("*").alias("n"))
    # A row per step of a language: log perplexities span a few thousand steps.
    upto = F.sum("n").over(Window.partitionBy(group).orderBy("step"))
    total = F.sum("n").over(Window.partitionBy(group))
    reached = steps.select(group, "step", (upto >= level * total).alias("ok")).where("ok")
    return reached.groupBy(group).agg((F.min("step") * STEP).alias("cut"))


def classify(docs: DataFrame, labels: DataFrame, level: float = QUANTILE) -> DataFrame:
    """doc_id, version, lang, n_chars, perplexity, cut (as perplexity), kept."""
    scores, good = perplexities(docs, labels)
    trusted = scores.join(good.where(held_out()), "doc_id", "left_semi")
    by_lang = quantile_cuts(trusted, "lang", "log_ppl", level).withColumnRenamed("lang", "c_lang")
    overall = quantile_cuts(trusted.withColumn("all", F.lit(0)), "all", "log_ppl", level).first()
    common = overall["cut"] if overall else None
    joined = scores.join(cut(by_lang), F.col("lang").eqNullSafe(F.col("c_lang")), "left")
    limit = F.coalesce("cut", F.lit(common).cast("double"))
    return joined.select(
        "doc_id", "version", "lang", "n_chars", F.exp("log_ppl").alias("perplexity"), F.exp(limit).alias("cut"),
        F.coalesce(F.col("log_ppl") <= limit, F.lit(False)).alias("kept"),
    )
