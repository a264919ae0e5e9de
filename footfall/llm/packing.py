"""Best-fit packing of token sequences into fixed-length training sequences.

Documents longer than a sequence are cut into full pieces and a rest. Pieces are dealt out by hash and each task packs
its share as they come: a piece goes into the open bin with the least free space that still holds it, else into a new
one. At most `open_bins` bins are open; beyond that the fullest closes first. Open bins are found through a bitset keyed
by free space (one integer of capacity + 1 bits), so a placement is a shift and a lowest-set-bit, and a task's memory
does not grow with its share.

The order inside a task is longest first among the pieces of a bounded buffer, so a task's memory stays bounded too.
A sequence's number is the task's number and a running number; both follow from the data alone, so a repeated task
gives the same sequences.

Defined cases: null or empty text is one piece that holds the end id alone; repeated rows are packed each; a null
`doc_id` is packed like any other; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents
from .tokens import encoder

CAPACITY = 4096
OPEN_BINS = 2048
#: Ids that a task holds before it hands its pieces on; a longer document goes on by itself.
HELD_IDS = 1 << 19


def _cut(tokenizer: str | None, capacity: int, end_id: int, with_ids: bool):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = encoder(tokenizer)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

        def made(rows: list) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64", "piece": "int32"})

        for frame in frames:
            rows, held = [], 0
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                ids = known.ids(text if isinstance(text, str) else None) + end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start : start + 4 * capacity]
                    row = (doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, dtype="<u4").astype("int32")) if with_ids else row)
                held += len(ids) // 4
                if held >= HELD_IDS:
                    yield made(rows)
                    rows, held = [], 0
            if rows:
                yield made(rows)

    return run


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if wanted, ids of each piece of each document."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return documents(docs).mapInPandas(_cut(tokenizer, capacity, end_id, with_ids), schema)


class Bins:
    """Open bins by free space. `place(length)` gives (bin, offset)."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.free = 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            stack = self.by_free[space]
            at = stack.pop()
            if not stack:
                self.free &= ~(1 << space)
            self.open -= 1
        else:
            space, at = self.capacity, self.made
            self.made += 1
        left = space - length
        if left:
            if self.open == self.most:
                self._close()
            self.by_free[left].append(at)
            self.free |= 1 << left
            self.open += 1
        return at, self.capacity - space

    def _close(self) -> None:
        space = (self.free & -self.free).bit_length() - 1
        stack = self.by_free[space]
        stack.pop()
        if not stack:
            self.free &= ~(1 << space)
        self.open -= 1


def _pack(capacity: int, most: int, part_column: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins, part = Bins(capacity, most), None
        for frame in frames:
            if not len(frame):
                continue
            if part is None:
                part = int(frame[part_column].iloc[0])
            lengths = frame["length"].to_numpy()
            numbers, offsets = np.empty(len(frame), dtype=np.int64), np.empty(len(frame), dtype=np.int64)
            for i in np.argsort(-lengths, kind="stable"):
                numbers[i], offsets[i] = bins.place(int(lengths[i]))
            frame = frame.drop(columns=part_column)
            yield frame.assign(sequence_id=(part << 40) + numbers, offset=offsets)

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`; lengths must be within 1 and `capacity`."""
    keys = [F.col(c) for c in ("doc_id", "piece", "ids_crc32")]
    dealt = pieces.withColumn("__order", F.xxhash64(*keys)).repartition("__order").sortWithinPartitions("__order", *keys)
    numbered = dealt.withColumn("__order", F.spark_partition_id().cast("long"))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return numbered.mapInPandas(_pack(capacity, open_bins, "__order"), schema)
