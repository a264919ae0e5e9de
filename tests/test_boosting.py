"""Boosted trees against plain computations, missing numbers, shared fits and the stored form."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.operators import boosting
from footfall.operators.boosting import Growth, fit_trees

KINDS = "inputs array<double>, target double, block int"


def table(spark, x, y, block=None):
    block = np.zeros(len(y), dtype=int) if block is None else block
    return spark.createDataFrame([(list(map(float, r)), float(v), int(b)) for r, v, b in zip(x, y, block)], KINDS).repartition(3)


def by_hand(x, y, growth):
    """Boosting by trying every value of every input as a cut, missing rows on either side."""
    prediction = np.full(len(y), y.mean())
    trees = []
    for _ in range(growth.rounds):
        error = prediction - y

        def grow(rows, level):
            g, n = error[rows].sum(), len(rows)
            best = None
            if level < growth.depth:
                for feature in range(x.shape[1]):
                    values = x[rows, feature]
                    for bound in np.unique(values[~np.isnan(values)]):
                        for missing_left in (False, True):
                            left = np.where(np.isnan(values), missing_left, values <= bound)
                            gl, nl = error[rows[left]].sum(), left.sum()
                            if min(nl, n - nl) < growth.min_rows_per_leaf:
                                continue
                            gain = (gl**2 / (nl + 1) + (g - gl) ** 2 / (n - nl + 1) - g**2 / (n + 1)) / 2
                            if gain > 1e-12 and (best is None or gain > best[0] * (1 + 1e-9)):
                                best = gain, feature, bound, missing_left, left
            if best is None:
                return -growth.rate * g / (n + 1)
            gain, feature, bound, missing_left, left = best
            return feature, bound, missing_left, grow(rows[left], level + 1), grow(rows[~left], level + 1)

        def value(node, row):
            while isinstance(node, tuple):
                feature, bound, missing_left, low, high = node
                node = low if (missing_left if np.isnan(row[feature]) else row[feature] <= bound) else high
            return node

        tree = grow(np.arange(len(y)), 0)
        trees.append(tree)
        prediction = prediction + np.array([value(tree, row) for row in x])
    return prediction


@pytest.mark.parametrize("depth,rounds", [(1, 1), (3, 1), (2, 13)])
def test_equal_to_trying_every_cut(spark, depth, rounds):
    chance = np.random.default_rng(depth)
    x = chance.integers(0, 9, size=(220, 4)).astype(float)
    x[chance.random(x.shape) < 0.2] = np.nan
    y = np.where(np.isnan(x[:, 0]), 4, x[:, 0]) * 2 + np.where(x[:, 1] > 4, 7, 0) + chance.normal(size=220)
    growth = Growth(depth=depth, rounds=rounds, rate=0.3)
    (model,) = fit_trees(table(spark, x, y), growth, [1])
    assert model.predict(x) == pytest.approx(by_hand(x, y, growth))


@pytest.mark.parametrize("side", ["large", "small"])
def test_missing_rows_go_where_they_gain(spark, side):
    """Missing rows behave like large (or small) values; one split finds both."""
    chance = np.random.default_rng(2)
    x = chance.uniform(0, 100, size=(600, 2))
    high = x[:, 0] > 60
    missing = chance.random(600) < 0.3
    x[missing, 0] = np.nan
    y = np.where(high | missing, 10.0, 0.0) if side == "large" else np.where(high & ~missing, 10.0, 0.0)
    (model,) = fit_trees(table(spark, x, y), Growth(depth=1, rounds=1, rate=1.0), [1])
    (tree,) = model.trees
    assert tree.feature[1] == 0 and tree.missing_left[1] == (side == "small") and 55 < tree.threshold[1] <= 60
    at = model.predict(np.array([[np.nan, 5.0], [99.0, 5.0], [1.0, 5.0]]))
    assert at == pytest.approx([10, 10, 0] if side == "large" else [0, 10, 0], abs=0.3)


def test_a_split_of_missing_against_known_rows(spark):
    x = np.array([[1.0], [np.nan]] * 20)
    y = np.array([0.0, 8.0] * 20)
    (model,) = fit_trees(table(spark, x, y), Growth(depth=1, rounds=1, rate=1.0), [1])
    assert model.predict(np.array([[np.nan], [5.0], [1.0]])).tolist() == pytest.approx([4 + 80 / 21, 4 + 80 / 21, 4 - 80 / 21])


def test_fits_that_grow_together_equal_fits_alone(spark):
    chance = np.random.default_rng(5)
    x = chance.integers(0, 50, size=(400, 3)).astype(float)
    y = x[:, 0] - x[:, 1] / 3 + chance.normal(size=400)
    block = np.arange(400) // 134
    growth = Growth(depth=2, rounds=boosting.REFRESH + 2)
    together = fit_trees(table(spark, x, y, block), growth, [1, 2, 3])
    for limit, model in enumerate(together, 1):
        own = block < limit
        (alone,) = fit_trees(table(spark, x[own], y[own]), growth, [1])
        assert model.predict(x) == pytest.approx(alone.predict(x))


def test_cut_points(spark):
    chance = np.random.default_rng(6)
    wide = chance.normal(size=5000)
    x = np.column_stack([wide, chance.integers(0, 255, size=5000), np.full(5000, np.nan)])
    points = boosting.cut_points(table(spark, x, wide), 3)
    assert len(points[1]) == 255 and len(points[2]) == 0
    assert 200 < len(points[0]) <= 255 and points[0][-1] == wide.max()
    shares = np.searchsorted(np.sort(wide), points[0], side="right") / 5000
    assert np.abs(np.diff(shares)).max() < 0.01
    bins = boosting.to_bins(x, points)
    assert set(bins[:, 2]) == {boosting.MISSING_BIN} and bins[:, 0].max() < boosting.MISSING_BIN


def test_many_tasks_add_before_the_driver(spark, monkeypatch):
    chance = np.random.default_rng(7)
    x = chance.integers(0, 9, size=(300, 2)).astype(float)
    y = x[:, 0] + chance.normal(size=300)
    rows = table(spark, x, y)
    (plain,) = fit_trees(rows, Growth(rounds=2), [1])
    monkeypatch.setattr(boosting, "DIRECT", 1)
    monkeypatch.setattr(boosting, "ADDERS", 1)
    monkeypatch.setattr(boosting, "FAN_IN", 2)
    (added,) = fit_trees(rows, Growth(rounds=2), [1])
    assert added.predict(x) == pytest.approx(plain.predict(x))


def test_stored_trees_predict_the_same(spark, tmp_path):
    chance = np.random.default_rng(8)
    x = chance.normal(size=(300, 3))
    x[chance.random(x.shape) < 0.1] = np.nan
    y = np.nan_to_num(x[:, 0]) * 3
    rows = table(spark, x, y)
    (model,) = fit_trees(rows, Growth(rounds=5), [1])
    model.nodes(spark).write.parquet(str(tmp_path / "trees"))
    again = boosting.BoostedTrees.from_nodes(spark.read.parquet(str(tmp_path / "trees")))
    assert (again.predict(x) == model.predict(x)).all()
    scored = rows.select("target", again.column(F.col("inputs")).alias("p")).toPandas()
    assert sorted(scored.p) == pytest.approx(sorted(model.predict(x)))


def test_empty_and_constant_tables(spark):
    (none,) = fit_trees(spark.createDataFrame([], KINDS), Growth(rounds=2), [1])
    assert none.predict(np.zeros((2, 3))).tolist() == [0, 0]
    (same,) = fit_trees(table(spark, np.ones((30, 2)), np.full(30, 4.0)), Growth(rounds=3), [1])
    assert same.predict(np.array([[9.0, np.nan]])).tolist() == [4.0]
    early, late = fit_trees(table(spark, np.ones((30, 2)), np.full(30, 4.0), np.ones(30)), Growth(rounds=2), [1, 2])
    assert early.predict(np.ones((1, 2))).tolist() == [0.0] and late.predict(np.ones((1, 2))).tolist() == [4.0]
