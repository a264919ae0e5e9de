"""Benchmark decontamination by winnowing, in DataFrame functions only.

The hash of every run of K words is taken, and of each window of WINDOW - K + 1 neighbouring hashes the least is kept.
Two texts that share WINDOW consecutive words share such a window, hence a kept hash, so no shared span of that length
is missed. Kept hashes of documents and items are joined; a meeting gives an alignment, and along it the words
themselves are compared and every run of WINDOW equal words is extended to its ends.

An item with fewer words is one window: its single hash over all its words is looked for at every place. The lengths
that occur are read first (at most WINDOW - 1 numbers).

Spark broadcasts the items' hashes if their written files are within `autoBroadcastJoinThreshold`; otherwise both
sides are moved by hash and hot hashes are split at run time.

Defined cases: null or wordless text has no words and no hits; rows with the same `doc_id` are judged row by row; a
wordless item never matches; an item without id counts for `n_hit`, not for `n_items`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .common import documents

WINDOW = 13
K = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words once A-Z are in lower case, and in the text as it is.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words(text: Column) -> Column:
    return F.filter(F.split(lowered(F.coalesce(text, F.lit(""))), BETWEEN), lambda w: w != "")


def _run_hashes(hashes: Column, k: int) -> Column:
    """Hash of the k word hashes from each place on; none if there are fewer words."""
    places = F.sequence(F.lit(1), F.size(hashes) - k + 1)
    run = F.transform(places, lambda i: F.xxhash64(*[F.get(hashes, i - 1 + j) for j in range(k)]))
    return F.when(F.size(hashes) >= k, run).otherwise(F.array().cast("array<bigint>"))


def _window_lows(runs: Column, width: int) -> Column:
    lows = F.transform(F.sequence(F.lit(1), F.size(runs) - width + 1), lambda i: F.array_min(F.slice(runs, i, width)))
    return F.when(F.size(runs) >= width, lows).otherwise(F.array().cast("array<bigint>"))


def _kept(runs: Column, lows: Column, width: int) -> Column:
    """(hash, place from 0) of each run hash that is the least of a window of `width`; ties are all kept.

    A hash is the least of a window around it exactly if it equals the greatest of those windows' least ones.
    """

    def mark(g: Column, p: Column) -> Column:
        around = F.slice(lows, F.greatest(p - width + 2, F.lit(1)), F.least(F.lit(width), p + 1))
        return F.when(g == F.array_max(around), F.struct(g.alias("hash"), p.alias("place")))

    kept = F.filter(F.transform(runs, mark), lambda x: x.isNotNull())
    # `lows` is named twice so that the optimizer leaves it a column and does not compute it anew for each place.
    return F.when(F.size(lows) > 0, kept)


def fingerprints(texts: DataFrame, carry: list[str], k: int = K, width: int = WINDOW - K + 1) -> DataFrame:
    """Rows (carry..., hash, place) from `words` (array of strings); texts with fewer than k + width - 1 words have none."""
    hashed = texts.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    runs = hashed.select(*carry, _run_hashes(F.col("hashes"), k).alias("runs"))
    lows = runs.withColumn("lows", _window_lows(F.col("runs"), width))
    kept = lows.select(*carry, _kept(F.col("runs"), F.col("lows"), width).alias("kept"))
    # An inner explode would be preceded by a filter on its size, with all the above inlined and computed per place.
    exploded = kept.select(*carry, F.explode_outer("kept").alias("one"))
    return exploded.where("one is not null").select(*carry, F.lit(k).alias("k"), F.col("one.hash").alias("hash"), F.col("one.place").alias("place"))


def _spans(doc_words: Column, item_words: Column, shift: Column, window: Column) -> Column:
    """Spans (first, last) of document words that equal item words along one alignment, at least `window` long."""
    empty = F.array().cast("array<struct<first:int,last:int>>")
    size = F.size(item_words)

    def step(state: Column, i: Column) -> Column:
        at = i + shift
        same = (i < size) & (at >= 0) & F.coalesce(F.get(doc_words, at) == F.get(item_words, i), F.lit(False))
        closed = F.when(
            state["run"] >= window,
            F.concat(state["spans"], F.array(F.struct((at - state["run"]).alias("first"), (at - 1).alias("last")))),
        ).otherwise(state["spans"])
        return F.struct(
            F.when(same, state["run"] + 1).otherwise(0).alias("run"),
            F.when(same, state["spans"]).otherwise(closed).alias("spans"),
        )

    start = F.struct(F.lit(0).alias("run"), empty.alias("spans"))
    return F.aggregate(F.sequence(F.lit(0), size), start, step, lambda state: state["spans"])


def overlaps(docs: DataFrame, items: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """Rows (doc_id, version, item_id, first, last): words of a document that lie in one occurrence of item windows."""
    docs = documents(docs).withColumn("version", F.xxhash64("text"))
    bench = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text").cast("string")).alias("words"))
    bench = cut(bench.where(F.size("words") > 0).withColumn("item", F.xxhash64("item_id", "words")))
    lengths = sorted(r[0] for r in bench.where(F.size("words") < window).select(F.size("words")).distinct().collect())
    worded = docs.select("doc_id", "version", words(F.col("text")).alias("words"))
    long_items = bench.where(F.size("words") >= window)
    item_marks = [fingerprints(long_items, ["item"], k, window - k + 1)]
    doc_marks = [fingerprints(worded, ["doc_id", "version"], k, window - k + 1)]
    for n in lengths:
        # k = 0 marks whole short items, so that a hash of five words is not met by a window's hash of five.
        item_marks.append(fingerprints(bench.where(F.size("words") == n), ["item"], n, 1).withColumn("k", F.lit(-n)))
        doc_marks.append(fingerprints(worded, ["doc_id", "version"], n, 1).withColumn("k", F.lit(-n)))
    marks = cut(_union(item_marks).withColumnRenamed("place", "item_place"))
    met = _union(doc_marks).join(marks, ["k", "hash"])
    alignments = cut(met.select("doc_id", "version", "item", (F.col("place") - F.col("item_place")).alias("shift")).distinct())
    pairs = alignments.select(F.col("doc_id").alias("a_doc"), F.col("version").alias("a_version"), "item", "shift")
    same_row = docs["doc_id"].eqNullSafe(pairs["a_doc"]) & (docs["version"] == pairs["a_version"])
    compared = (
        docs.join(pairs, same_row)
        .select("doc_id", "version", words(F.col("text")).alias("words"), "item", "shift")
        .join(bench.select("item", "item_id", F.col("words").alias("item_words")), "item")
    )
    spans = compared.select(
        "doc_id",
        "version",
        "item_id",
        F.explode_outer(_spans(F.col("words"), F.col("item_words"), F.col("shift"), F.least(F.lit(window), F.size("item_words")))).alias("span"),
    )
    return spans.where("span is not null").select("doc_id", "version", "item_id", "span.first", "span.last").distinct()


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _hits(found: DataFrame) -> DataFrame:
    """h_doc, h_version, hit (words in any span), items (sorted ids): overlapping spans are merged by the greatest end so far."""
    before = Window.partitionBy("doc_id", "version").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("last").over(before), F.lit(-1))
    fresh = F.greatest(F.col("last") - F.greatest(F.col("first"), reached + 1) + 1, F.lit(0))
    return (
        found.withColumn("fresh", fresh)
        .groupBy("doc_id", "version")
        .agg(F.sum("fresh").cast("long").alias("hit"), F.array_sort(F.collect_set("item_id")).alias("items"))
        .select(F.col("doc_id").alias("h_doc"), F.col("version").alias("h_version"), "hit", "items")
    )


def _counted(docs: DataFrame) -> DataFrame:
    n_words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return documents(docs).select("doc_id", F.xxhash64("text").alias("version"), n_words.alias("n_words"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, k: int = K, one_in: int = 20) -> DataFrame:
    """Per row of `docs`: doc_id, version (hash of the text), n_words, n_hit, n_items, items_sha256, contaminated.

    Contaminated: at least one hit word, and at least one word in `one_in` is hit.
    """
    hits = _hits(overlaps(docs, items, window, k))
    rows = _counted(docs)
    joined = rows.join(hits, rows["doc_id"].eqNullSafe(hits["h_doc"]) & (rows["version"] == hits["h_version"]), "left")
    n_hit = F.coalesce("hit", F.lit(0)).cast("long")
    return joined.select(
        "doc_id",
        "version",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * one_in >= F.col("n_words"))).alias("contaminated"),
    )


def contaminated_versions(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, version of the contaminated rows."""
    return contamination(docs, items).where("contaminated").select("doc_id", "version").distinct()
