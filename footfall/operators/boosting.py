"""Boosted regression trees on histograms, with missing numbers and second-order gains.

Inputs are arrays of doubles, NaN for a missing number. Each input is cut into at most 255 bins; missing numbers have a bin
of their own, and a split sends them to the side where the gain is greater. For squared error with leaf penalty L the gain
of a split is half of GL^2/(nL+L) + GR^2/(nR+L) - G^2/(n+L), with G the sum of errors and n the rows of a side.

One pass over the binned table per tree level sums errors and rows by (fit, node, input, bin) inside the tasks. What
leaves them has a fixed size: nodes x inputs x 256 bins, whatever the rows. Several fits on growing parts of the table
(validation folds and the final model) go on together, so that they share every pass. Predictions so far are written
beside the bins every `REFRESH` rounds; a pass carries only the trees since, so neither lineage nor the work of a pass
grows with the rounds, and a lost executor costs one pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut

MISSING_BIN = 255
BINS = 256
#: Rank error of a cut point, as a share of one over this.
ACCURACY = 10_000
REFRESH = 10
#: Gains that differ by less than this share are equal; the first input, then the least cut, wins.
SAME_GAIN = 1e-9
#: Up to so many tasks the driver adds their histograms itself; more are added by tasks first, up to `FAN_IN` in each.
DIRECT, FAN_IN, ADDERS = 32, 64, 8
NODES = (
    "tree int, node int, feature int, threshold double, missing_left boolean, value double, gain double, n_rows double"
)


@dataclass(frozen=True)
class Growth:
    depth: int = 3
    min_rows_per_leaf: int = 5
    rate: float = 0.07
    rounds: int = 200
    leaf_penalty: float = 1.0


class Tree:
    """A binary tree in heap order: node 1 is the root, 2n and 2n+1 are the children of n; feature -1 is a leaf."""

    def __init__(self, depth: int):
        size = 2 << depth
        self.depth = depth
        self.feature = np.full(size, -1, dtype=np.int32)
        self.bin = np.full(size, -1, dtype=np.int32)
        self.threshold = np.full(size, np.nan)
        self.missing_left = np.zeros(size, dtype=bool)
        self.value = np.zeros(size)
        self.gain = np.zeros(size)
        self.n_rows = np.zeros(size)

    def _reach(self, x: np.ndarray, missing: np.ndarray, bound: np.ndarray, levels: int | None) -> np.ndarray:
        rows, node = np.arange(len(x)), np.ones(len(x), dtype=np.int64)
        for _ in range(self.depth if levels is None else levels):
            feature = self.feature[node]
            at = np.maximum(feature, 0)
            left = np.where(missing[rows, at], self.missing_left[node], x[rows, at] <= bound[node])
            node = np.where(feature >= 0, 2 * node + ~left, node)
        return node

    def reach_bins(self, bins: np.ndarray, levels: int | None = None) -> np.ndarray:
        """The node each row of bins arrives at after so many levels, or at the end."""
        return self._reach(bins, bins == MISSING_BIN, self.bin, levels)

    def reach(self, x: np.ndarray) -> np.ndarray:
        return self._reach(x, np.isnan(x), self.threshold, None)


@dataclass
class BoostedTrees:
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += tree.value[tree.reach(x)]
        return out

    def column(self, inputs: Column) -> Column:
        """The prediction for a column of input arrays."""
        model = self

        @F.pandas_udf("double")
        def predicted(arrays: pd.Series) -> pd.Series:
            return pd.Series(model.predict(np.vstack(arrays.to_numpy()).astype(np.float64)) if len(arrays) else [], dtype="float64")

        return predicted(inputs)

    def nodes(self, spark: SparkSession) -> DataFrame:
        """All nodes as a table; tree -1 carries the base value."""
        rows = [(-1, 1, -1, None, False, self.base, 0.0, 0.0)]
        for number, tree in enumerate(self.trees):
            for node in range(1, len(tree.feature)):
                if node == 1 or tree.feature[node // 2] >= 0:
                    threshold = float(tree.threshold[node]) if tree.feature[node] >= 0 else None
                    rows.append(
                        (
                            number, node, int(tree.feature[node]), threshold, bool(tree.missing_left[node]),
                            float(tree.value[node]), float(tree.gain[node]), float(tree.n_rows[node]),
                        )
                    )
        return spark.createDataFrame(rows, NODES).coalesce(1)

    @classmethod
    def from_nodes(cls, nodes: DataFrame) -> BoostedTrees:
        """The trees of a table of `nodes`: at most rounds x 2**(depth+1) rows."""
        rows = sorted(nodes.collect(), key=lambda r: (r["tree"], r["node"]))
        out = cls()
        depth = max((int(r["node"]).bit_length() - 1 for r in rows), default=0)
        for row in rows:
            if row["tree"] < 0:
                out.base = row["value"]
                continue
            while len(out.trees) <= row["tree"]:
                out.trees.append(Tree(depth))
            tree, node = out.trees[row["tree"]], row["node"]
            tree.feature[node], tree.missing_left[node] = row["feature"], row["missing_left"]
            tree.threshold[node] = np.nan if row["threshold"] is None else row["threshold"]
            tree.value[node], tree.gain[node], tree.n_rows[node] = row["value"], row["gain"], row["n_rows"]
        return out


# Bins -----------------------------------------------------------------------------


def _arrays(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _few_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (feature, value) of a task's distinct values; a null value where there are more than fit the bins."""
    seen: list[np.ndarray | None] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _arrays(batch.column("inputs"))
        seen = seen or [np.empty(0)] * x.shape[1]
        for i, known in enumerate(seen):
            if known is not None:
                values = x[:, i]
                merged = np.union1d(known, values[~np.isnan(values)])
                seen[i] = merged if len(merged) <= MISSING_BIN else None
    for i, values in enumerate(seen):
        own = pa.array([None], pa.float64()) if values is None else pa.array(values, pa.float64())
        yield pa.RecordBatch.from_pydict({"feature": pa.array([i] * len(own), pa.int32()), "value": own})


def cut_points(inputs: DataFrame, n_inputs: int) -> list[np.ndarray]:
    """Upper bounds of the bins of each input: all its values if they are few, else quantiles with the greatest value."""
    found = inputs.select("inputs").mapInArrow(_few_values, "feature int, value double").distinct()
    # At most 256 values for each input are kept; more only show that there are too many.
    kept = F.slice(F.array_sort(F.collect_set("value")), 1, MISSING_BIN + 1)
    few = found.groupBy("feature").agg(F.max(F.col("value").isNull()).alias("many"), F.count("value").alias("n"), kept.alias("values"))
    points = [np.empty(0)] * n_inputs
    wide = set()
    for row in few.collect():
        if row["many"] or row["n"] > MISSING_BIN:
            wide.add(row["feature"])
        else:
            points[row["feature"]] = np.array(row["values"], dtype=np.float64)
    if wide:
        levels = [i / MISSING_BIN for i in range(1, MISSING_BIN + 1)]
        numbers = {i: F.get("inputs", F.lit(i)) for i in sorted(wide)}
        asked = [F.percentile_approx(F.when(~F.isnan(c), c), levels, ACCURACY).alias(f"q{i}") for i, c in numbers.items()]
        tops = [F.max(F.when(~F.isnan(c), c)).alias(f"m{i}") for i, c in numbers.items()]
        row = inputs.agg(*asked, *tops).first()
        for i in numbers:
            points[i] = np.unique([*row[f"q{i}"][:-1], row[f"m{i}"]])
    return points


def to_bins(x: np.ndarray, points: Sequence[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, dtype=np.uint8)
    for i, bounds in enumerate(points):
        missing = np.isnan(x[:, i])
        out[:, i] = np.minimum(np.searchsorted(bounds, np.where(missing, 0.0, x[:, i])), MISSING_BIN - 1)
        out[missing, i] = MISSING_BIN
    return out


def _blobs(values: np.ndarray) -> pa.Array:
    """One binary per row of a two-dimensional array."""
    values = np.ascontiguousarray(values)
    width = values.shape[1] * values.itemsize
    bounds = pa.py_buffer((np.arange(len(values) + 1) * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(values), [None, bounds, pa.py_buffer(values)])


def _unblob(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), width)


BINNED = "bins binary, target double, block int, margins binary"


def binned(rows: DataFrame, points: Sequence[np.ndarray], bases: Sequence[float]) -> DataFrame:
    """`rows` (inputs, target, block) as bins, with the starting prediction of each fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bins = to_bins(_arrays(batch.column("inputs")), points)
                margins = np.tile(np.array(bases), (batch.num_rows, 1))
                yield pa.RecordBatch.from_arrays(
                    [_blobs(bins), batch.column("target"), batch.column("block"), _blobs(margins)], names=["bins", "target", "block", "margins"]
                )

    return rows.select("inputs", F.col("target").cast("double"), F.col("block").cast("int")).mapInArrow(run, BINNED)


# Passes ----------------------------------------------------------------------------


def _rows_of(batch: pa.RecordBatch, n_inputs: int, n_fits: int):
    bins = _unblob(batch.column("bins"), np.uint8, n_inputs)
    margins = _unblob(batch.column("margins"), np.float64, n_fits)
    return bins, batch.column("target").to_numpy(), batch.column("block").to_numpy(), margins


def _refreshed(recent: list[list[Tree]], n_inputs: int):
    """Adds the recent trees of each fit to its margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, _, _, margins = _rows_of(batch, n_inputs, len(recent))
            margins = margins.copy()
            for f, trees in enumerate(recent):
                for tree in trees:
                    margins[:, f] += tree.value[tree.reach_bins(bins)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _blobs(margins)], names=["bins", "target", "block", "margins"])

    return run


def _histograms(recent: list[list[Tree]], growing: list[Tree], level: int, limits: Sequence[int], n_inputs: int):
    """Of a task: per fit and node of the level, sums of errors and rows by input and bin."""
    width = 1 << level
    cells = width * n_inputs * BINS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(growing), 2, cells))
        for batch in batches:
            if not batch.num_rows:
                continue
            all_bins, target, block, margins = _rows_of(batch, n_inputs, len(growing))
            for f, tree in enumerate(growing):
                own = block < limits[f]
                bins, error = all_bins[own], margins[own, f] - target[own]
                for done in recent[f]:
                    error += done.value[done.reach_bins(bins)]
                node = tree.reach_bins(bins, level) - width
                inside = node >= 0  # rows in leaves of earlier levels are done
                bins, error, node = bins[inside], error[inside], node[inside]
                cell = ((node[:, None] * n_inputs + np.arange(n_inputs)) * BINS + bins).ravel()
                sums[f, 0] += np.bincount(cell, np.repeat(error, n_inputs), cells)
                sums[f, 1] += np.bincount(cell, minlength=cells)
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        fits = len(growing)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(fits), pa.int32()), pa.array([part] * fits, pa.int32()), _blobs(sums.reshape(fits, -1))], names=["fit", "part", "sums"]
        )

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The histograms of a group of tasks, added for each fit."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for fit, blob in zip(batch.column("fit").to_pylist(), batch.column("sums")):
            values = np.frombuffer(blob.as_buffer(), dtype=np.float64)
            totals[fit] = totals[fit] + values if fit in totals else values.copy()
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    for fit, values in totals.items():
        yield pa.RecordBatch.from_arrays([pa.array([fit], pa.int32()), pa.array([part], pa.int32()), _blobs(values[None])], names=["fit", "part", "sums"])


def _total(parts: DataFrame, tasks: int, shape: tuple[int, ...]) -> np.ndarray:
    """Sum over tasks, (fit, errors and rows, node, input, bin)."""
    while tasks > DIRECT:
        tasks = min(tasks - 1, max(ADDERS, tasks // FAN_IN))
        parts = parts.repartition(tasks, F.col("part") % tasks).mapInArrow(_added, parts.schema)
    out = np.zeros(shape)
    for row in sorted(parts.collect(), key=lambda r: (r["fit"], r["part"])):
        out[row["fit"]] += np.frombuffer(row["sums"], dtype=np.float64).reshape(shape[1:])
    return out


def best_split(errors: np.ndarray, rows: np.ndarray, n_cuts: Sequence[int], growth: Growth) -> tuple[float, int, int, bool] | None:
    """(gain, input, bin, missing left) of one node from its sums by (input, bin); None if no split gains.

    Rows up to a bin go left. Missing rows are tried on both sides; without any they go right.
    """
    known_g, known_n = errors[:, :MISSING_BIN].cumsum(axis=1), rows[:, :MISSING_BIN].cumsum(axis=1)
    lost_g, lost_n = errors[:, MISSING_BIN, None], rows[:, MISSING_BIN, None]
    all_g, all_n = known_g[:, -1:] + lost_g, known_n[:, -1:] + lost_n
    penalty = growth.leaf_penalty
    possible = np.arange(MISSING_BIN) < np.asarray(n_cuts)[:, None]
    gains = np.full((len(errors), MISSING_BIN, 2), -np.inf)
    for side, (g, n) in enumerate(((known_g, known_n), (known_g + lost_g, known_n + lost_n))):
        other_g, other_n = all_g - g, all_n - n
        allowed = possible & (n >= growth.min_rows_per_leaf) & (other_n >= growth.min_rows_per_leaf)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (g * g / (n + penalty) + other_g * other_g / (other_n + penalty) - all_g * all_g / (all_n + penalty)) / 2
        gains[:, :, side] = np.where(allowed, gain, -np.inf)
    top = gains.max(initial=-np.inf)
    if not top > 0:
        return None
    feature, cut_at, side = np.unravel_index(np.argmax(gains >= top * (1 - SAME_GAIN)), gains.shape)
    return float(gains[feature, cut_at, side]), int(feature), int(cut_at), bool(side)


def _grow_level(tree: Tree, level: int, sums: np.ndarray, points: Sequence[np.ndarray], growth: Growth) -> None:
    """Splits the nodes of a level by their histograms (errors and rows, node, input, bin) and values both children."""
    n_cuts = [len(p) for p in points]
    for at in range(1 << level):
        node = (1 << level) + at
        if level and tree.feature[node // 2] < 0:
            continue
        errors, rows = sums[0, at], sums[1, at]
        if level == 0:
            tree.n_rows[node] = rows[0].sum()
            tree.value[node] = -growth.rate * errors[0].sum() / (rows[0].sum() + growth.leaf_penalty)
        found = best_split(errors, rows, n_cuts, growth)
        if found is None:
            continue
        tree.gain[node], feature, cut_at, tree.missing_left[node] = found
        tree.feature[node], tree.bin[node], tree.threshold[node] = feature, cut_at, points[feature][cut_at]
        lost = [s[feature, MISSING_BIN] if tree.missing_left[node] else 0.0 for s in (errors, rows)]
        left_g, left_n = errors[feature, : cut_at + 1].sum() + lost[0], rows[feature, : cut_at + 1].sum() + lost[1]
        sides = ((2 * node, left_g, left_n), (2 * node + 1, errors[feature].sum() - left_g, rows[feature].sum() - left_n))
        for child, g, n in sides:
            tree.n_rows[child] = n
            tree.value[child] = -growth.rate * g / (n + growth.leaf_penalty)


def fit_trees(rows: DataFrame, growth: Growth, limits: Sequence[int]) -> list[BoostedTrees]:
    """One model for each limit, trained on the rows whose block is below it.

    `rows` holds `inputs` (array of doubles), `target` and `block` (a small number); it is read a few times before it is
    binned, so it should be stored. Rows without a target are left out. A limit without rows gives the value 0 everywhere.
    """
    rows = rows.where("target is not null and not isnan(target)").select("inputs", F.col("target").cast("double").alias("target"), F.col("block").cast("int").alias("block"))
    means = rows.agg(*[F.avg(F.when(F.col("block") < limit, F.col("target"))).alias(f"m{i}") for i, limit in enumerate(limits)], F.max(F.size("inputs")).alias("n")).first()
    models = [BoostedTrees(means[f"m{i}"] or 0.0) for i in range(len(limits))]
    if means["n"] is None:
        return models
    n_inputs = means["n"]
    points = cut_points(rows, n_inputs)
    table = cut(binned(rows, points, [m.base for m in models])).persist(StorageLevel.MEMORY_AND_DISK)
    recent: list[list[Tree]] = [[] for _ in limits]
    for number in range(growth.rounds):
        if number and number % REFRESH == 0:
            older = table
            table = cut(older.mapInArrow(_refreshed(recent, n_inputs), BINNED)).persist(StorageLevel.MEMORY_AND_DISK)
            older.unpersist()
            recent = [[] for _ in limits]
        growing = [Tree(growth.depth) for _ in limits]
        tasks = table.rdd.getNumPartitions() if number % REFRESH == 0 else tasks
        for level in range(growth.depth):
            parts = table.mapInArrow(_histograms(recent, growing, level, limits, n_inputs), "fit int, part int, sums binary")
            sums = _total(parts, tasks, (len(limits), 2, 1 << level, n_inputs, BINS))
            for f, tree in enumerate(growing):
                _grow_level(tree, level, sums[f], points, growth)
        for f, tree in enumerate(growing):
            recent[f].append(tree)
            models[f].trees.append(tree)
    table.unpersist()
    return models
