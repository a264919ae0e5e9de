"""Token ids in grammar-compressed shards (Re-Pair), written and read by Spark.

Documents are spread by range over `doc_id` and sorted, so shards follow each other in that order. A shard is one row of
a Parquet table: the documents' ids and token counts, the rules, how many tokens each rule expands to, and the
compressed symbols with the place where each document begins. Pairs never cross the end of a document, so one document,
or a span of one, is read from its own symbols and the rules alone.

Re-Pair replaces frequent pairs of neighbouring symbols by new ones, round by round. A round takes all pairs that occur
at least LEAST times at once, the most frequent first where occurrences overlap. Symbols stay below 2**16 where the
vocabulary leaves room, so they take two bytes.

`index` beside the shards has a row per writing task: its tokens and the tokens before it.

Defined cases: null or empty text is a document that holds the end id alone; a null `doc_id` comes first; rows with the
same `doc_id` are ordered by text; an empty table gives empty folders that read back as no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents
from .tokens import encoder

SHARD_TOKENS = 1 << 20
ROUNDS = 5
LEAST = 16
SLOTS = 20

SCHEMA = (
    "part int, shard int, before long, tokens long, doc_ids array<long>, sizes binary, begins binary,"
    " first_rule int, rules binary, expansions binary, symbol_bytes int, symbols binary"
)


def compress(ids: np.ndarray, last: np.ndarray, first_rule: int, rounds: int = ROUNDS, least: int = LEAST):
    """(symbols, `last` of the symbols, rules as pairs). `last` marks the last token of each document."""
    narrow = first_rule + 256 <= 1 << 16
    most = (1 << 16 if narrow else 1 << 31) - first_rule
    kind, bits = (np.uint32, 16) if narrow else (np.uint64, 32)
    symbols = ids.astype(kind)
    rules: list[np.ndarray] = []
    made = 0
    factor, away = kind(0x9E3779B1), kind((32 if narrow else 64) - SLOTS)
    if not narrow:
        factor = np.uint64(0x9E3779B97F4A7C15)
    for step in range(rounds):
        room = (most - made) // (rounds - step)
        if len(symbols) < 2 or room < 1:
            break
        code = (symbols[:-1] << kind(bits)) | symbols[1:]
        inside = ~last[:-1]
        ordered = np.sort(code[inside])
        heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, dtype=np.int64)
        counts = np.diff(np.concatenate((heads, [len(ordered)])))
        often = np.flatnonzero(counts >= least)
        if not len(often):
            break
        often = often[np.lexsort((ordered[heads[often]], -counts[often]))][:room]
        pairs = ordered[heads[often]]
        # A table of slots finds a pair's rank, from 1; of pairs in one slot the most frequent stays.
        ranks = np.int16 if len(pairs) < 1 << 15 else np.int32
        table = np.zeros(1 << SLOTS, dtype=ranks)
        slots = (pairs * factor) >> away
        table[slots[::-1]] = np.arange(len(pairs), 0, -1, dtype=ranks)
        rank = table[(code * factor) >> away]
        found = (rank > 0) & inside & (np.concatenate((pairs[:1], pairs))[rank] == code)
        rank[~found] = np.iinfo(ranks).max
        found[1:] &= rank[1:] < rank[:-1]
        found[:-1] &= rank[:-1] <= rank[1:]
        at = np.flatnonzero(found)
        if not len(at):
            break
        is_used = np.zeros(len(pairs) + 1, dtype=bool)
        is_used[rank[at]] = True
        used = np.flatnonzero(is_used) - 1
        number = np.cumsum(is_used)[rank[at]] - 1
        symbols[at] = (first_rule + made + number).astype(kind)
        stay = np.ones(len(symbols), dtype=bool)
        stay[at + 1] = False
        last[at] = last[at + 1]
        symbols, last = symbols[stay], last[stay]
        chosen = pairs[used]
        rules.append(np.stack((chosen >> kind(bits), chosen & kind((1 << bits) - 1)), axis=1).astype(np.uint32))
        made += len(used)
    return symbols, last, np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.uint32)


def expansion_lengths(rules: np.ndarray, first_rule: int) -> np.ndarray:
    """Tokens of each rule; a rule refers to earlier rules only."""
    sizes = np.ones(len(rules), dtype=np.uint32)
    size_of = np.ones(first_rule + len(rules), dtype=np.uint32)
    done = 0
    while done < len(rules):
        # All rules up to the first that refers to one at or after `done` are known now.
        later = np.flatnonzero((rules[done:] >= first_rule + done).any(axis=1))
        upto = done + int(later[0]) if len(later) else len(rules)
        sizes[done:upto] = size_of[rules[done:upto]].sum(axis=1)
        size_of[first_rule + done : first_rule + upto] = sizes[done:upto]
        done = upto
    return sizes


def expand(symbols: np.ndarray, rules: np.ndarray, first_rule: int) -> np.ndarray:
    symbols = symbols.astype(np.uint32)
    while len(symbols) and symbols.max() >= first_rule:
        high = symbols >= first_rule
        places = np.cumsum(high + 1) - (high + 1)
        wider = np.empty(len(symbols) + int(high.sum()), dtype=np.uint32)
        wider[places[~high]] = symbols[~high]
        pair = rules[symbols[high] - first_rule]
        wider[places[high]], wider[places[high] + 1] = pair[:, 0], pair[:, 1]
        symbols = wider
    return symbols


class Shard:
    """One row of the table, for random access."""

    def __init__(self, row):
        self.first_rule = int(row["first_rule"])
        self.doc_ids = list(row["doc_ids"])
        self.sizes = np.frombuffer(row["sizes"], dtype="<u8").astype(np.int64)
        self.begins = np.frombuffer(row["begins"], dtype="<u8").astype(np.int64)
        self.rules = np.frombuffer(row["rules"], dtype="<u4").reshape(-1, 2)
        self.expansions = np.frombuffer(row["expansions"], dtype="<u4")
        self.symbols = np.frombuffer(row["symbols"], dtype=f"<u{int(row['symbol_bytes'])}")

    def document(self, i: int) -> np.ndarray:
        return expand(self.symbols[self.begins[i] : self.begins[i + 1]], self.rules, self.first_rule)

    def span(self, i: int, start: int, stop: int) -> np.ndarray:
        """Tokens start..stop of document i; only the symbols that cover them are expanded."""
        own = self.symbols[self.begins[i] : self.begins[i + 1]].astype(np.int64)
        size = np.ones(len(own), dtype=np.int64)
        size[own >= self.first_rule] = self.expansions[own[own >= self.first_rule] - self.first_rule]
        ends = np.cumsum(size)
        a = int(np.searchsorted(ends, start, side="right"))
        b = int(np.searchsorted(ends, stop, side="left")) + 1
        skipped = int(ends[a - 1]) if a else 0
        return expand(own[a:b], self.rules, self.first_rule)[start - skipped : stop - skipped]

    def all(self) -> Iterator[np.ndarray]:
        # Every symbol's tokens in a row, then one look at them for each symbol.
        rules = np.arange(self.first_rule, self.first_rule + len(self.rules), dtype=np.uint32)
        tokens = np.concatenate((np.arange(self.first_rule, dtype=np.uint32), expand(rules, self.rules, self.first_rule)))
        sizes = np.concatenate((np.ones(self.first_rule, dtype=np.int32), self.expansions.astype(np.int32)))
        starts = np.cumsum(sizes, dtype=np.int32) - sizes
        n = sizes[self.symbols]
        places = np.cumsum(n, dtype=np.int64) - n
        whole = tokens[np.repeat(starts[self.symbols] - places, n) + np.arange(n.sum())]
        ends = np.cumsum(self.sizes)
        for start, end in zip(ends - self.sizes, ends):
            yield whole[start:end]


def _shard(part: int, number: int, before: int, doc_ids: list, texts: list[bytes], first_rule: int) -> dict:
    ids = np.frombuffer(b"".join(texts), dtype="<u4")
    sizes = np.array([len(t) // 4 for t in texts], dtype="<u8")
    last = np.zeros(len(ids), dtype=bool)
    last[np.cumsum(sizes).astype(np.int64) - 1] = True
    symbols, ends, rules = compress(ids, last, first_rule)
    width = 2 if first_rule + len(rules) <= 1 << 16 else 4
    return {
        "part": part, "shard": number, "before": before, "tokens": int(sizes.sum()), "doc_ids": doc_ids, "sizes": sizes.tobytes(),
        "begins": np.concatenate(([0], np.flatnonzero(ends) + 1)).astype("<u8").tobytes(), "first_rule": first_rule,
        "rules": rules.astype("<u4").tobytes(), "expansions": expansion_lengths(rules, first_rule).astype("<u4").tobytes(),
        "symbol_bytes": width, "symbols": symbols.astype(f"<u{width}").tobytes(),
    }


def _write(tokenizer: str | None, end_id: int, shard_tokens: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = encoder(tokenizer)
        first_rule = max(known.tokenizer.get_vocab_size(), end_id + 1)
        part, number, before, held, doc_ids, texts = 0, 0, 0, 0, [], []
        for frame in frames:
            for part_id, doc_id, text in zip(frame["part"], frame["doc_id"], frame["text"]):
                part = int(part_id)
                texts.append(known.ids(text if isinstance(text, str) else None) + end)
                doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
                held += len(texts[-1]) // 4
                if held >= shard_tokens:
                    yield pd.DataFrame([_shard(part, number, before, doc_ids, texts, first_rule)])
                    number, before, held, doc_ids, texts = number + 1, before + held, 0, [], []
        if texts:
            yield pd.DataFrame([_shard(part, number, before, doc_ids, texts, first_rule)])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, shard_tokens: int = SHARD_TOKENS) -> None:
    """Writes `path`/shards and `path`/index."""
    ordered = documents(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    # The id is read as nullable text-free columns; Arrow turns a long column with nulls into floats otherwise.
    named = ordered.select(F.spark_partition_id().alias("part"), F.col("doc_id").cast("string").alias("doc_id"), "text")
    named.mapInPandas(_write(tokenizer, end_id, shard_tokens), SCHEMA).write.parquet(f"{path}/shards")
    shards = docs.sparkSession.read.schema(SCHEMA).parquet(f"{path}/shards")
    totals = shards.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    # A row per writing task, so one ordered window holds them.
    base = F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals.select("part", "tokens", base.alias("base")).write.parquet(f"{path}/index")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shards with `start`, the tokens of all documents before them."""
    index = spark.read.schema("part int, tokens long, base long").parquet(f"{path}/index")
    shards = spark.read.schema(SCHEMA).parquet(f"{path}/shards")
    return shards.join(index.select("part", "base"), "part").withColumn("start", F.col("base") + F.col("before"))


def _read(with_ids: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, row in frame.iterrows():
                shard, start, rows = Shard(row), int(row["start"]), []
                for doc_id, ids in zip(shard.doc_ids, shard.all()):
                    raw = ids.astype("<u4").tobytes()
                    found = (None if pd.isna(doc_id) else int(doc_id), start, len(ids), zlib.crc32(raw))
                    rows.append((*found, ids.astype("int32")) if with_ids else found)
                    start += len(ids)
                names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
                yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    return run


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if wanted, ids of each document in the files."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return read_shards(spark, path).mapInPandas(_read(with_ids), schema)
