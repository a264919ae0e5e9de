"""Near-duplicate documents by HyperMinHash registers, bands and exact verification.

Each document's set of distinct word shingles becomes 128 registers: a shingle's hash picks a bucket, and the register
keeps the bucket's least value as leading-zero count (6 bits) and mantissa (10 bits). Equal sets are one class from the
start, so copies cost one row. Bands of four registers give bucket keys; two sets with similarity 0.85 share none of the
32 keys with a chance of about 5e-11, if they fill the registers.

Small sets leave registers empty, and one shingle can spoil a run of borrowed ones. Sets of at most FEW shingles therefore
have exact keys besides: the first n - ceil(threshold * n) + 1 of their n shingles in one order of all shingles. Two sets
that reach the threshold always have one of these in common. The order is by count, rare ones first, so a common line
makes no large bucket; counts come from a part of the texts and are kept per slot, as any one order gives the same links.
Sizes are cut into ranges so that linked sets lie in the same or the next one, and a key is told apart by range.

Classes that share a key are compared without emitting pairs of a bucket. Every class takes the neighbour with most
shared keys as its hub. A class is a *core* member of its hub's group and a guest in the groups of all classes it shares
a key with, so each pair that shares a key meets in the group where one of the two is core. Groups are cut into blocks;
a block pair is compared in one task: registers first (collision-corrected estimate, six standard errors of slack), then
the full shingle sets. A task returns a spanning forest of its links, never all pairs, so nothing grows with the square
of a group. Components follow by minimum labels with pointer jumping, cut to files each round.

Defined cases: no words or null text: empty set, linked with nothing. Rows that share a `doc_id` are versions of one
document, their links are joined. A null `doc_id` has `component_id` null, takes part in no link and is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import documents, few
from .words import Words, distinct, mixed, passes, shingles

BUCKETS = 128
BANDS = 32
MANTISSA = 10
#: Members of a block; two blocks of full sets are what one comparison holds.
BLOCK = 256
#: Largest set with exact keys. Of two linked sets, one of which is larger, neither leaves runs of registers empty.
FEW = 256
SLOTS = 1 << 16
_EMPTY = 0


def registers(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """uint16 registers (texts x buckets) of sorted distinct shingle hashes; 0 is an empty bucket."""
    n = len(bounds) - 1
    h = mixed(values ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    owner = np.repeat(np.arange(n), np.diff(bounds))
    slot = owner * BUCKETS + (h >> np.uint64(57)).astype(np.int64)
    rest = (h << np.uint64(7)) | np.uint64(64)
    least = np.full(n * BUCKETS, np.iinfo(np.uint64).max, dtype=np.uint64)
    order = np.argsort(slot, kind="stable")
    if len(order):
        s = slot[order]
        heads = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        least[s[heads]] = np.minimum.reduceat(rest[order], heads)
    filled = np.zeros(n * BUCKETS, dtype=bool)
    filled[slot] = True
    # A float's exponent would round; shift by the leading zeros instead.
    zeros = np.zeros(len(least), dtype=np.uint64)
    x = least.copy()
    for step in (32, 16, 8, 4, 2, 1):
        low = x < np.uint64(1 << (64 - step))
        zeros[low] += np.uint64(step)
        x[low] <<= np.uint64(step)
    mantissa = (x << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    # Leading zeros are at most 57 because of the marker bit, so 1 + zeros fits 6 bits.
    packed = ((zeros + np.uint64(1)) << np.uint64(MANTISSA)) | mantissa
    return np.where(filled, packed, _EMPTY).astype(np.uint16).reshape(n, BUCKETS)


def collision_rate(size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Chance that two independent registers agree, for sets of these sizes.

    The least of k uniform values in a bucket has about the density k exp(-k x); cells of the register's grid at
    leading-zero count i are 2**-(i+1+MANTISSA) wide, so the chance is the sum over i of width times the integral of
    both densities.
    """
    a, b = np.maximum(size_a, 1) / BUCKETS, np.maximum(size_b, 1) / BUCKETS
    total = np.zeros(np.broadcast(a, b).shape)
    for i in range(48):
        high, low = 2.0**-i, 2.0 ** -(i + 1)
        total += low / (1 << MANTISSA) * (a * b / (a + b)) * (np.exp(-(a + b) * low) - np.exp(-(a + b) * high))
    return total


def estimates(left: np.ndarray, right: np.ndarray, size_left: np.ndarray, size_right: np.ndarray):
    """(collision-corrected similarity, registers it rests on) of all pairs between two register blocks."""
    both = (left[:, None, :] == right[None, :, :]) & (left[:, None, :] != _EMPTY)
    used = ((left[:, None, :] != _EMPTY) | (right[None, :, :] != _EMPTY)).sum(axis=2)
    chance = collision_rate(size_left[:, None], size_right[None, :])
    share = both.sum(axis=2) / np.maximum(used, 1)
    return np.clip((share - chance) / (1 - chance), 0, 1), used


def band_keys(regs: np.ndarray) -> np.ndarray:
    """int64 keys (texts x bands). An empty register borrows the next filled one; band k holds k, k+32, k+64, k+96."""
    filled = np.concatenate((regs, regs), axis=1)
    at = np.where(filled != _EMPTY, np.arange(2 * BUCKETS), 2 * BUCKETS)
    nearest = np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1][:, :BUCKETS]
    nearest = np.minimum(nearest, 2 * BUCKETS - 1)
    # The distance is part of the value, so a borrowed register differs from an own one.
    value = np.take_along_axis(filled, nearest, axis=1).astype(np.uint64)
    value |= (nearest - np.arange(BUCKETS)).astype(np.uint64) << np.uint64(16)
    groups = value.reshape(len(regs), BUCKETS // BANDS, BANDS)
    key = np.zeros((len(regs), BANDS), dtype=np.uint64)
    for row in range(BUCKETS // BANDS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + groups[:, row, :] + np.uint64(1))
    return mixed(key + np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0xD1342543DE82EF95)).view(np.int64)


def _slot(values: np.ndarray) -> np.ndarray:
    return (mixed(values ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(48)).astype(np.int64)


def size_range(n: np.ndarray, threshold: tuple[int, int]) -> np.ndarray:
    """Number of the range that a set's size lies in; sizes of linked sets are in the same range or in neighbours."""
    above, below = threshold
    edges = [1]
    while edges[-1] <= FEW:
        edges.append(edges[-1] * below // above + 1)
    return np.searchsorted(edges, n, side="right")


def prefix_keys(values: np.ndarray, bounds: np.ndarray, counts: np.ndarray, threshold: tuple[int, int]) -> list[np.ndarray]:
    """int64 keys of each text from sorted distinct shingle hashes; none for more than FEW shingles. counts: by slot."""
    above, below = threshold
    n = np.diff(bounds)
    small = (n > 0) & (n <= FEW)
    take = np.where(small, n + above * n // -below + 1, 0)
    v, own = values[np.repeat(small, n)], np.where(small, n, 0)
    owner = np.repeat(np.arange(len(n)), own)
    place = np.arange(len(v)) - np.repeat(np.cumsum(own) - own, own)
    order = np.lexsort((mixed(v), counts[_slot(v)], owner))
    first = place < take[owner]
    span = size_range(n, threshold)[owner[first]].astype(np.uint64)
    salts = np.stack((span, span + np.uint64(1)), axis=1) * np.uint64(0x2545F4914F6CDD1D)
    keys = mixed(mixed(v[order][first])[:, None] ^ salts).view(np.int64).ravel()
    return np.split(keys, np.cumsum(2 * take)[:-1])


def _sets(frame: pd.DataFrame, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for first, texts in passes(frame["text"]):
        values, bounds = distinct(*shingles(Words(texts), size))
        yield first, values, bounds


def _counted(size: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SLOTS, dtype=np.int64)
        for frame in frames:
            for _, values, _ in _sets(frame, size):
                total += np.bincount(_slot(values), minlength=SLOTS)
        slots = np.flatnonzero(total)
        yield pd.DataFrame({"slot": slots, "n": total[slots]})

    return run


def slot_counts(docs: DataFrame, size: int) -> np.ndarray:
    """Occurrences by slot of the shingles in one in 16 of the short texts."""
    part = docs.where((F.length("text") <= 16 * FEW) & (F.pmod(F.xxhash64("text"), F.lit(16)) == 0)).select("text")
    counts = np.zeros(SLOTS, dtype=np.int64)
    for slot, n in part.mapInPandas(_counted(size), "slot long, n long").groupBy("slot").agg(F.sum("n")).collect():
        counts[slot] = n
    return counts


def _sketch(size: int, counts, threshold: tuple[int, int]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first, values, bounds in _sets(frame, size):
                n = np.diff(bounds)
                regs = registers(values, bounds)
                sums = []
                for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
                    total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mixed(values ^ np.uint64(salt)), dtype=np.uint64)))
                    sums.append(mixed(total[bounds[1:]] - total[bounds[:-1]] + n.astype(np.uint64)))
                ident = np.stack(sums, axis=1).astype("<u8")
                yield pd.DataFrame(
                    {
                        "doc_id": frame["doc_id"].iloc[first : first + len(n)].to_numpy(),
                        "n_shingles": n,
                        "ident": [x.tobytes() for x in ident],
                        "regs": [x.tobytes() for x in regs],
                        "few": prefix_keys(values, bounds, counts.value, threshold),
                    }
                ).astype({"doc_id": "Int64"})

    return run


def _keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        if len(frame):
            regs = np.frombuffer(b"".join(frame["regs"]), dtype="<u2").reshape(-1, BUCKETS)
            yield pd.DataFrame({"node": frame["node"], "keys": [np.concatenate(x) for x in zip(band_keys(regs), frame["few"])]})


def _full_sets(size: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first, values, bounds in _sets(frame, size):
                regs = registers(values, bounds)
                rows = range(len(bounds) - 1)
                yield pd.DataFrame(
                    {
                        "node": frame["doc_id"].iloc[first : first + len(bounds) - 1].to_numpy(),
                        "full": [values[bounds[i] : bounds[i + 1]].tobytes() for i in rows],
                        "regs": [regs[i].tobytes() for i in rows],
                    }
                )

    return run


def _links(ids, cores, first, fulls, regs, threshold: tuple[int, int], split: int) -> list[tuple[int, int]]:
    """A spanning forest of the links of one block pair; members from `split` on are the second block (0: one block)."""
    above, below = threshold
    level = above / below
    sets = [np.frombuffer(x, dtype=np.uint64) for x in fulls]
    sizes = np.array([len(x) for x in sets])
    marks = np.frombuffer(b"".join(regs), dtype="<u2").reshape(-1, BUCKETS)
    n = len(ids)
    rows, columns, scores = [], [], []
    for start in range(0, n, 32):
        part = slice(start, min(n, start + 32))
        score, used = estimates(marks[part], marks, sizes[part], sizes)
        slack = 6 * np.sqrt(level * (1 - level) / np.maximum(used, 1))
        near = score >= level - slack
        i, j = np.nonzero(near)
        i = i + start
        fit = (i < j) & (cores[i] | cores[j]) & (np.minimum(sizes[i], sizes[j]) * below >= above * np.maximum(sizes[i], sizes[j]))
        if split:
            fit &= first[i] != first[j]
        rows.append(i[fit])
        columns.append(j[fit])
        scores.append(score[i[fit] - start, j[fit]])
    i, j, s = np.concatenate(rows), np.concatenate(columns), np.concatenate(scores)
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = []
    for k in np.argsort(-s, kind="stable"):
        a, b = int(i[k]), int(j[k])
        ra, rb = root(a), root(b)
        if ra == rb or ids[a] == ids[b]:
            continue
        x, y = sets[a], sets[b]
        at = np.searchsorted(x, y)
        common = int((x[np.minimum(at, len(x) - 1)] == y).sum())
        if below * common >= above * (len(x) + len(y) - common):
            parent[ra] = rb
            found.append((int(ids[a]), int(ids[b])))
    return found


def _compare(threshold: tuple[int, int]):
    columns = ["hub", "one", "two", "mine", "node", "core", "full", "regs"]

    def of(group: pd.DataFrame) -> list[tuple[int, int]]:
        return _links(
            group["node"].to_numpy(), group["core"].to_numpy(), group["mine"].to_numpy(), list(group["full"]), list(group["regs"]),
            threshold, int(group["one"].iloc[0] != group["two"].iloc[0]),
        )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by block pair; a pair that reaches the end of a batch waits for the next one."""
        held = None
        for frame in frames:
            frame = frame[columns] if held is None else pd.concat([held, frame[columns]], ignore_index=True)
            if not len(frame):
                continue
            keys = frame[["hub", "one", "two"]].to_numpy()
            heads = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
            held = frame.iloc[heads[-1] :]
            found = [link for a, b in zip(heads[:-1], heads[1:]) for link in (of(frame.iloc[a:b]) if b - a > 1 else [])]
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])
        if held is not None and len(held) > 1 and (found := of(held)):
            yield pd.DataFrame(found, columns=["a", "b"])

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of `links` (a, b) reaches.

    Labels only fall. A round takes the least label among the neighbours, then the label's own label, which at least
    halves the way to go; it ends when a round changes none.
    """
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("least"))
        lower = labels.join(near, "node").select("node", "component", F.least("component", "least").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("further"))
        moved = cut(
            lower.join(jump, "next", "left").select("node", F.col("component").alias("was"), F.least("next", "further").alias("component"))
        )
        labels = moved.select("node", "component")
        if moved.where("was <> component").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, size: int = 5, threshold: tuple[int, int] = (85, 100)) -> DataFrame:
    """Per row of `docs` (`doc_id`, `text`): doc_id, n_shingles, component_id, kept.

    Documents are linked if threshold[1] * |common shingles| >= threshold[0] * |all shingles of both|.
    """
    docs = documents(docs)
    counts = docs.sparkSession.sparkContext.broadcast(slot_counts(docs, size))
    sketches = cut(docs.mapInPandas(_sketch(size, counts, threshold), "doc_id long, n_shingles long, ident binary, regs binary, few array<long>"))
    classes = cut(
        sketches.where("n_shingles > 0 and doc_id is not null")
        .groupBy("ident")
        .agg(F.min("doc_id").alias("node"), F.first("regs").alias("regs"), F.first("few").alias("few"))
    )
    keys = classes.select("node", "regs", "few").mapInPandas(_keys, "node long, keys array<long>")
    keys = keys.select("node", F.explode("keys").alias("key"))
    taken = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = cut(keys.join(taken, "key"))
    weights = shared.groupBy("node").agg(F.sum(F.col("n") - 1).alias("weight"))
    tops = shared.join(weights, "node").groupBy("key").agg(F.max(F.struct("weight", "node")).alias("top"))
    hubs = cut(shared.join(tops, "key").groupBy("node").agg(F.max("top")["node"].alias("hub")))
    hosts = shared.join(hubs, "node").select("key", "hub").distinct()
    guests = shared.select("key", "node").join(hosts, "key").select("hub", "node").distinct()
    members = guests.join(hubs.select("node", F.col("hub").alias("own")), "node").select("hub", "node", (F.col("own") == F.col("hub")).alias("core"))
    # A hub that is itself a guest elsewhere still belongs to its own group.
    members = cut(members)
    counts = members.groupBy("hub").agg(F.count("*").alias("m"), F.count_if("core").alias("cores")).where("m > 1 and cores > 0")
    wanted = few(cut(members.select(F.col("node").alias("doc_id")).distinct()))
    sets = (
        docs.join(wanted, "doc_id", "left_semi")
        .mapInPandas(_full_sets(size), "node long, full binary, regs binary")
    )
    placed = (
        members.join(counts, "hub")
        .withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
        .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("hub", "node", "core", "mine", F.least("mine", "other").alias("one"), F.greatest("mine", "other").alias("two"))
    )
    compared = (
        placed.join(sets, "node")
        .select("hub", "one", "two", "mine", "node", "core", "full", "regs")
        .repartition("hub", "one", "two")
        .sortWithinPartitions("hub", "one", "two")
    )
    links = cut(compared.mapInPandas(_compare(threshold), "a long, b long"))
    # Rows of one document with different texts are one node.
    labels = components(links)
    versions = sketches.where("doc_id is not null and n_shingles > 0").select("doc_id", "ident").distinct()
    named = classes.select("ident", "node").join(labels, "node", "left").select("ident", F.coalesce("component", "node").alias("component"))
    placed_docs = versions.join(named, "ident").groupBy("doc_id").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    split = placed_docs.where("least < most").select(F.col("least").alias("a"), F.col("most").alias("b"))
    placed_docs = cut(placed_docs.select("doc_id", F.col("least").alias("component"), F.col("most")))
    if not split.isEmpty():
        apart = versions.join(named, "ident").join(placed_docs.where("component < most").select("doc_id", F.col("component").alias("least")), "doc_id")
        merged = components(apart.select(F.col("component").alias("a"), F.col("least").alias("b")))
        placed_docs = placed_docs.join(merged.select(F.col("node").alias("component"), F.col("component").alias("merged")), "component", "left").select(
            "doc_id", F.coalesce("merged", "component").alias("component")
        )
    out = sketches.select("doc_id", "n_shingles").join(placed_docs.select("doc_id", "component"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
