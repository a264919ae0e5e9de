"""Repair of the turn structure of conversations at least cost.

A conversation is right if its role initials read `(s?(ua)+)?`. Edits: Keep a row (0), Rerole it to user or assistant (1),
Delete it (2; required for blank and repeated rows), Insert an empty user or assistant row (5); a truncated row that is
not deleted costs 5 more. Of all cheapest edit lists the one whose initials are least in ASCII is taken.

Cost DP: nodes are (rows done, last initial), with four last initials: none, s, u, a. The least cost to go is found from
the end. Prefix-doubling path ranking: on arcs that keep that cost, nodes are ranked by their least audits of 1, 2, 4, ...
letters; the rank of 2m letters is that of the pair (rank of m letters, rank of m letters of the node m letters on). At
each node the arc with the least letter and target rank is taken, and doubled pointers along these arcs give the node at
every place of the audit at once. A letter leads from a node to one node, so a list of initials fixes the repair.

Rows are sorted by range over (conversation, turn, row), so no conversation has to fit a task. They are cut into chunks
of at most `CHUNK` rows; a chunk is a 4x4 matrix of least costs between its ends, and chunks of one conversation are
joined by doubling, as are their end nodes. Only the digest of a whole conversation is made by one task, which streams it.

Equal rows of one turn are counted, not repeated: all but the first are deleted. Defined cases: a null role or text is
one space, so a null text is blank; an empty role, or one with another initial, cannot be kept; null turns come first,
rows of one turn follow in the order of `role:text`; a null `conv_id` is a conversation of its own; a conversation without
rows has an empty audit. An empty table gives an empty result. Extra columns are left out. A very long text moves with its
row only; the steps above see one letter of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

CHUNK = 1024
SPACE = " \t\n\x0b\x0c\r"
#: Role initials by class; all others are class 0.
INITIALS = "sua"
#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NEVER = 1 << 60
#: The node after an inserted or reroled row, by last initial (none, s, u, a).
TURN = np.array([2, 2, 3, 2])
#: The node after a kept row, by class and last initial; -1 where it cannot stand.
KEEP = np.array([[-1, -1, -1, -1], [1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1]])
#: Cost of the inserts still needed after the last row.
FINAL = (0, 2 * INSERT, INSERT, 0)
#: Edits in ASCII order; 0 is the end.
LETTERS = np.frombuffer(b"\0DIKR", dtype=np.uint8)
ROLE_OF = np.frombuffer(b"-sua", dtype=np.uint8)
#: Faults of a row: a row's first one counts.
BLANK, DUPLICATE, CUT_OFF = 1, 2, 3


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with reproducible faults: by crc32 of `conv_id:turn` modulo 20 a row is dropped (0),
    emptied (1), robbed of its `[.!?]` (2), repeated (3) or given to the user (4). Nulls are one space."""

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    given = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind")
    )
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    hurt = given.where("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
    return hurt.drop("copy")


def placed(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies and `place`, which follows conversation, turn and `role:text`."""

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)

    given = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), spaced("role"), spaced("text"))
    counted = cut(given.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")))
    said = F.concat("role", F.lit(":"), "text")
    # Range bounds are sampled, so they see a short prefix, which sorts as the whole does.
    spread = counted.repartitionByRange("conv_id", "turn", F.left(said, F.lit(64))).sortWithinPartitions("conv_id", "turn", said)
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    return cut(spread.select(key.alias("key"), "conv_id", "turn", "role", "text", "copies", F.monotonically_increasing_id().alias("place")))


def _codes(ordered: DataFrame) -> DataFrame:
    """key, place, code (class of the initial + 4 * fault), copies."""
    initial = F.left("role", F.lit(1))
    kind = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    tail = F.right(F.rtrim(F.col("text"), F.lit(SPACE)), F.lit(1))
    narrow = ordered.select(
        "key", "place", "copies", "role", kind.alias("kind"), F.sha2("text", 256).alias("digest"),
        (tail == "").alias("blank"), (~tail.isin(".", "!", "?")).alias("cut_off"),
    )
    firsts = narrow.where("not blank").groupBy("key", "role", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("is_first"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("is_first").isNull(), DUPLICATE).when(F.col("cut_off"), CUT_OFF).otherwise(0)
    return narrow.join(firsts, "place", "left").select("key", "place", (F.col("kind") + 4 * fault).cast("int").alias("code"), "copies")


def _chunks(codes: DataFrame, chunk: int) -> DataFrame:
    """key, no (from 0), chunks of the conversation, items: array of (place, code, copies) in order, at most `chunk`."""
    if chunk < 1 or chunk & (chunk - 1):
        raise ValueError("a chunk is a power of two, so that none spans two partitions")
    block = F.shiftright("place", chunk.bit_length() - 1)
    item = F.struct("place", "code", "copies")
    held = cut(codes.groupBy("key", block.alias("block")).agg(F.array_sort(F.collect_list(item)).alias("items")))
    # Blocks of one partition follow each other; a conversation has at most one run of them in each partition.
    part = F.shiftright(F.col("items")[0]["place"], 33)
    runs = held.select("key", "block", part.alias("part")).groupBy("key", "part").agg(F.min("block").alias("least"), F.count("*").alias("n"))
    sized = runs.groupBy("key").agg(F.sum("n").alias("chunks"), F.array_sort(F.collect_list(F.struct("part", "least", "n"))).alias("runs"))

    def start(state: Column, run: Column) -> Column:
        return F.when(run["part"] < part, state + run["n"]).when(run["part"] == part, state + F.col("block") - run["least"]).otherwise(state)

    no = F.aggregate("runs", F.lit(0).cast("long"), start)
    return held.join(sized, "key").select("key", no.alias("no"), "chunks", "items")


class _Batch:
    """Items of the chunks of one Arrow batch as flat arrays."""

    def __init__(self, batch: pa.RecordBatch):
        items = batch.column("items")
        self.n = len(items)
        offsets = items.offsets.to_numpy()
        self.lengths = np.diff(offsets)
        values = items.values.slice(offsets[0], offsets[-1] - offsets[0])
        self.place, code, self.copies = (values.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        self.kind, self.fault = code & 3, code >> 2
        self.must = (self.fault == BLANK) | (self.fault == DUPLICATE)
        self.extra = np.where(self.fault == CUT_OFF, TRUNCATED, 0)
        self.first = offsets[:-1] - offsets[0]
        #: Number of the layer before each chunk's first row; a chunk has one layer more than rows.
        self.base = self.first + np.arange(self.n)

    def costs(self, ends: np.ndarray) -> np.ndarray:
        """Least cost to go, layers x 4 x cases, from `ends` (chunks x 4 x cases) after the last row of each chunk."""
        out = np.empty((len(self.place) + self.n, 4, ends.shape[2]), dtype=np.int64)
        out[self.base + self.lengths] = ends
        order = np.argsort(-self.lengths, kind="stable")
        ranked = self.lengths[order]
        for back in range(1, int(self.lengths.max(initial=0)) + 1):
            own = order[: np.searchsorted(-ranked, -back, side="right")]
            at, layer = self.first[own] + self.lengths[own] - back, self.base[own] + self.lengths[own] - back
            after = out[layer + 1]
            extra = self.extra[at][:, None, None]
            to = KEEP[self.kind[at]]
            kept = np.where((to < 0)[:, :, None], NEVER, np.take_along_axis(after, np.maximum(to, 0)[:, :, None], axis=1))
            stays = extra + np.minimum(kept, REROLE + after[:, TURN])
            row = np.minimum(DELETE + after, np.where(self.must[at][:, None, None], NEVER, stays))
            for _ in range(2):  # two inserts at one place at most
                row = np.minimum(row, INSERT + row[:, TURN])
            out[layer] = np.minimum(row, NEVER)
        return out

    def arcs(self, costs: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Target node of each edit that keeps the least cost, nodes x 5 (column 0 unused), -1 where it does not."""
        layers = len(costs)
        node = np.arange(layers * 4).reshape(layers, 4)
        targets = np.full((layers, 4, 5), -1, dtype=np.int64)
        at = np.delete(np.arange(layers), self.base + self.lengths)  # the layer before each row
        now, after = costs[at], costs[at + 1]
        free, extra = ~self.must[:, None], self.extra[:, None]
        to = KEEP[self.kind]
        kept = np.where(to < 0, NEVER, np.take_along_axis(after, np.maximum(to, 0), axis=1))
        targets[at, :, 1] = np.where(now == DELETE + after, node[at + 1], -1)
        targets[at, :, 2] = np.where(now == INSERT + now[:, TURN], node[at][:, TURN], -1)
        targets[at, :, 3] = np.where(free & (now == extra + kept), (at[:, None] + 1) * 4 + np.maximum(to, 0), -1)
        targets[at, :, 4] = np.where(free & (now == extra + REROLE + after[:, TURN]), node[at + 1][:, TURN], -1)
        ends = (self.base + self.lengths)[last]
        targets[ends, 1:3, 2] = node[ends][:, TURN[1:3]]
        return targets.reshape(layers * 4, 5)


def _doubled(pointer: np.ndarray, letter: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Pointers 1, 2, 4, ... letters on until all have ended, and each node's number of letters to the end."""
    pointers, length = [pointer], (letter > 0).astype(np.int64)
    while True:
        further = length[pointers[-1]]
        if not further.any():
            return pointers, length
        length = length + further
        pointers.append(pointers[-1][pointers[-1]])


def least_paths(targets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(letter, doubled pointers, letters to the end) of each node along its least audit.

    Nodes are ranked by the least audits of 1, 2, 4, ... letters, an ended audit before a longer one.
    """
    n = np.arange(len(targets))
    letter = np.where((targets >= 0).any(axis=1), np.argmax(targets >= 0, axis=1), 0)
    pointer = np.where(letter > 0, targets[n, letter], n)
    rank = letter
    for onward in _doubled(pointer, letter)[0]:
        rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + rank[onward], return_inverse=True)[1]
    # The arc with the least (letter, rank of the rest).
    key = np.where(targets >= 0, np.arange(5) * (len(n) + 1) + rank[targets], np.iinfo(np.int64).max)
    chosen = np.where(letter > 0, np.argmin(key, axis=1), 0)
    pointers, length = _doubled(np.where(chosen > 0, targets[n, chosen], n), chosen)
    return chosen, pointers, length


def _at(pointers: list[np.ndarray], node: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The node so many letters on."""
    for k, pointer in enumerate(pointers):
        node = np.where((steps >> k) & 1 > 0, pointer[node], node)
    return node


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least cost from each node before a chunk to each after it, row by row, as `costs`."""
    ends = np.where(np.eye(4, dtype=bool), 0, NEVER)[None].astype(np.int64)
    for batch in batches:
        if batch.num_rows:
            chunks = _Batch(batch)
            costs = chunks.costs(np.repeat(ends, chunks.n, axis=0))[chunks.base].reshape(-1)
            offsets = pa.array(np.arange(chunks.n + 1) * 16, pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(costs))], names=[*batch.schema.names, "costs"])


def _ends(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(batch.column("ends").to_pylist(), dtype=np.int64)[:, :, None]


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last initial after a chunk for each one before it, along least audits, as `exits`."""
    for batch in batches:
        if batch.num_rows:
            chunks, last = _Batch(batch), batch.column("last").to_numpy(zero_copy_only=False)
            _, pointers, length = least_paths(chunks.arcs(chunks.costs(_ends(batch))[:, :, 0], last))
            start = (chunks.base[:, None] * 4 + np.arange(4)).ravel()
            exits = _at(pointers, start, length[start]) % 4
            offsets = pa.array(np.arange(chunks.n + 1) * 4, pa.int32())
            columns = [batch.column("key"), batch.column("no"), pa.ListArray.from_arrays(offsets, pa.array(exits, pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "no", "exits"])


PLAN = (
    "key string, no long, cost long, audit string, blank long, duplicate long, truncated long, illegal long, "
    "letters string, roles string, places array<long>"
)


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk: cost to go from its entry (copies apart), audit, faults, illegal pairs, and its edits one by one."""
    for batch in batches:
        if not batch.num_rows:
            continue
        chunks, last = _Batch(batch), batch.column("last").to_numpy(zero_copy_only=False)
        entry = batch.column("entry").to_numpy()
        follower = batch.column("follower").to_numpy()
        costs = chunks.costs(_ends(batch))[:, :, 0]
        letter, pointers, length = least_paths(chunks.arcs(costs, last))
        start = chunks.base * 4 + entry
        letters = length[start]
        bounds = np.concatenate(([0], np.cumsum(letters)))
        steps = np.arange(bounds[-1]) - np.repeat(bounds[:-1], letters)
        node = _at(pointers, np.repeat(start, letters), steps)
        edit = letter[node]
        inserted = edit == 2
        # The item of an edit: as many rows as its layer has behind it.
        item = node // 4 - np.repeat(np.arange(chunks.n), letters)
        times = np.where(inserted, 1, chunks.copies[np.minimum(item, len(chunks.copies) - 1)])
        places = np.where(inserted, -1, chunks.place[np.minimum(item, len(chunks.place) - 1)])
        roles = np.where(edit == 1, ROLE_OF[0], ROLE_OF[pointers[0][node] % 4])
        written = LETTERS[edit].tobytes(), roles.astype(np.uint8).tobytes()
        spots = np.concatenate(([0], np.cumsum(times)))
        whole = np.full(spots[-1], ord("D"), dtype=np.uint8)
        whole[spots[:-1]] = LETTERS[edit]
        spelt = whole.tobytes()

        def per_chunk(values: np.ndarray) -> np.ndarray:
            sums = np.concatenate(([0], np.cumsum(values)))
            return sums[chunks.first + chunks.lengths] - sums[chunks.first]

        kind, fault, copies = chunks.kind, chunks.fault, chunks.copies
        blank = per_chunk(np.where(fault == BLANK, copies, 0))
        duplicate = per_chunk(np.where(fault == DUPLICATE, copies, np.where(fault == BLANK, 0, copies - 1)))
        truncated = per_chunk((fault == CUT_OFF).astype(np.int64))
        onward = np.append(kind[1:], 0)
        onward[chunks.first + chunks.lengths - 1] = follower
        legal = ((kind == 1) & (onward == 2)) | ((kind == 2) & (onward == 3)) | ((kind == 3) & (onward == 2)) | (onward < 0)
        illegal = per_chunk(copies - 1 + ~legal)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key"), batch.column("no"), pa.array(costs.reshape(-1)[start], pa.int64()),
                pa.array([spelt[spots[a] : spots[b]].decode() for a, b in zip(bounds, bounds[1:])], pa.string()),
                pa.array(blank), pa.array(duplicate), pa.array(truncated), pa.array(illegal),
                *[pa.array([w[a:b].decode() for a, b in zip(bounds, bounds[1:])], pa.string()) for w in written],
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(places, pa.int64())),
            ],
            names=["key", "no", "cost", "audit", "blank", "duplicate", "truncated", "illegal", "letters", "roles", "places"],
        )


def _with_ends(chunks: DataFrame) -> DataFrame:
    """Adds per chunk: `ends` (cost to go after it), `entry` (last initial before it), `follower` (class of the row after
    it, -1 for none), `last`."""
    fixed = {"ends": F.array(*[F.lit(c).cast("long") for c in FINAL]), "entry": F.lit(0).cast("long"), "follower": F.lit(-1).cast("long"), "last": F.lit(True)}
    alone = chunks.where("chunks = 1").select("key", "no", "items", *[c.alias(n) for n, c in fixed.items()])
    several = chunks.where("chunks > 1")
    longest = several.agg(F.max("chunks")).first()[0]
    if longest is None:
        return alone
    kinds = "key string, no long, chunks long, items array<struct<place:long,code:int,copies:long>>, costs array<long>"
    matrices = cut(several.mapInArrow(_matrices, kinds))
    step, product = 1, matrices.select("key", "no", "costs")
    while step < longest:  # the matrix of a chunk and all after it
        onward = product.select("key", (F.col("no") - step).alias("no"), F.col("costs").alias("rest"))

        def through(e: Column) -> Column:
            mids = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda m: F.get("costs", F.floor(e / 4).cast("int") * 4 + m) + F.get("rest", m * 4 + e % 4))
            return F.least(F.array_min(mids), F.lit(NEVER))

        both = F.when(F.col("rest").isNull(), F.col("costs")).otherwise(F.transform(F.sequence(F.lit(0), F.lit(15)), through))
        product = cut(product.join(onward, ["key", "no"], "left").select("key", "no", both.alias("costs")))
        step *= 2
    closing = F.array(*[F.lit(c).cast("long") for c in FINAL])

    def left_to_go(s: Column) -> Column:
        return F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda m: F.get("costs", s * 4 + m) + F.get(closing, m)))

    rest = product.select("key", (F.col("no") - 1).alias("no"), F.transform(F.sequence(F.lit(0), F.lit(3)), left_to_go).alias("ends"))
    heads = several.select("key", (F.col("no") - 1).alias("no"), F.col("items")[0]["code"].bitwiseAND(F.lit(3)).cast("long").alias("follower"))
    joined = several.join(rest, ["key", "no"], "left").join(heads, ["key", "no"], "left")
    known = cut(
        joined.select(
            "key", "no", "items", F.coalesce("ends", closing).alias("ends"),
            F.coalesce("follower", F.lit(-1)).cast("long").alias("follower"), F.col("ends").isNull().alias("last"),
        )
    )
    step, exits = 1, cut(known.mapInArrow(_exits, "key string, no long, exits array<long>"))
    while step < longest:  # the last initial after a chunk for each one before the first of 2 * step chunks
        before = exits.select("key", (F.col("no") + step).alias("no"), F.col("exits").alias("into"))
        through = F.when(F.col("into").isNull(), F.col("exits")).otherwise(F.transform("into", lambda s: F.get("exits", s.cast("int"))))
        exits = cut(exits.join(before, ["key", "no"], "left").select("key", "no", through.alias("exits")))
        step *= 2
    entries = exits.select("key", (F.col("no") + 1).alias("no"), F.col("exits")[0].alias("entry"))
    met = known.join(entries, ["key", "no"], "left")
    return alone.unionByName(met.select("key", "no", "items", "ends", F.coalesce("entry", F.lit(0)).cast("long").alias("entry"), "follower", "last"))


def repair(rows: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Two tables. Per conversation with rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. Per row of
    the repaired conversations: conv_id, no and at (its order), edit (K, R or I), turn, role, text."""
    ordered = placed(rows)
    plans = cut(_with_ends(_chunks(_codes(ordered), chunk)).select("key", "no", "items", "ends", "entry", "follower", "last").mapInArrow(_plans, PLAN))
    turns = ordered.groupBy("key", "conv_id", "turn").agg(F.sum(F.col("copies") - 1).alias("spare"))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    spans = turns.groupBy("key", "conv_id").agg(gaps.alias("gaps"), F.sum("spare").alias("spare"))
    faults = ("blank", "duplicate", "truncated", "illegal")
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", "audit"))), lambda part: part["audit"]), "")
    totals = plans.groupBy("key").agg(*[F.sum(c).alias(c) for c in faults], F.sum(F.when(F.col("no") == 0, F.col("cost"))).alias("path"), audit.alias("audit"))
    summary = spans.join(totals, "key").select("conv_id", "gaps", *faults, (F.col("path") + DELETE * F.col("spare")).alias("cost"), "audit")
    edits = plans.select("key", "no", "roles", "letters", F.posexplode("places").alias("at", "place"))
    here = [F.substring(c, F.col("at") + 1, F.lit(1)).alias(c) for c in ("letters", "roles")]
    kept = edits.select("key", "no", "at", "place", *here).where("letters <> 'D'")
    renamed = F.when(F.col("roles") == "u", "user").otherwise("assistant")
    stays = kept.where("place >= 0").join(ordered.drop("key", "copies"), "place").select(
        "key", "conv_id", "no", "at", F.col("letters").alias("edit"), "turn", F.when(F.col("letters") == "K", F.col("role")).otherwise(renamed).alias("role"), "text"
    )
    number = F.when(F.col("key") != "null", F.col("key").cast("long"))
    added = kept.where("place < 0").select(
        "key", number.alias("conv_id"), "no", "at", F.col("letters").alias("edit"), F.lit(None).cast("long").alias("turn"), renamed.alias("role"), F.lit("").alias("text")
    )
    return summary, stays.unionByName(added)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each run of rows of a conversation; state goes on from batch to batch."""
    current, running = None, None

    def closed(key: str, digest) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"key": pa.array([key], pa.string()), "repaired_sha256": pa.array([digest.hexdigest()], pa.string())})

    for batch in batches:
        done = []
        for key, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "role", "text"))):
            if key != current:
                if running is not None:
                    done.append((current, running))
                current, running = key, hashlib.sha256()
            else:
                running.update(b"\n")
            running.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        if done:
            keys, digests = zip(*done)
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.string()), "repaired_sha256": pa.array([d.hexdigest() for d in digests], pa.string())})
    if running is not None:
        yield closed(current, running)


def report(rows: DataFrame, everyone: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """For each `conv_id` of `everyone` the summary of `repair(rows)` and the digest of its repaired rows."""
    summary, repaired = repair(rows, chunk)
    streamed = repaired.select("key", "no", "at", "role", "text").repartition("key").sortWithinPartitions("key", "no", "at")
    digests = streamed.select("key", "role", "text").mapInArrow(_digests, "key string, repaired_sha256 string")
    keyed = F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("key")
    ids = everyone.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select("conv_id", keyed)
    known = summary.select(keyed, *[c for c in summary.columns if c != "conv_id"])
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    return ids.join(known, "key", "left").join(digests, "key", "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")
    )
