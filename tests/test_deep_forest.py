from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerloom.operators import deep_forest, model


def split_by_hand(bins, label, weight):
    """Best cut of one feature by brute force: weighted gini after the split."""
    best = None
    for cut in sorted(set(bins))[:-1]:
        cost = 0.0
        for side in (bins <= cut, bins > cut):
            w, one = weight[side].sum(), (weight * label)[side].sum()
            cost += w - (one**2 + (w - one) ** 2) / w
        best = min(best or (cost, cut), (cost, cut))
    return best


def test_the_first_cut_is_the_best_one():
    rng = np.random.default_rng(3)
    for _ in range(50):
        bins = rng.integers(0, 9, (40, 1)).astype(np.uint8)
        label, weight = rng.integers(0, 2, 40).astype(float), rng.integers(1, 4, 40).astype(float)
        feature, cut, left, share = deep_forest.grow(bins, label, weight, 1, rng)
        assert feature[0] == 0 and left[0] == 1
        w = [(bins[:, 0] <= cut[0]), (bins[:, 0] > cut[0])]
        cost = sum(weight[s].sum() - ((weight * label)[s].sum() ** 2 + (weight * (1 - label))[s].sum() ** 2) / weight[s].sum() for s in w)
        assert cost == pytest.approx(split_by_hand(bins[:, 0], label, weight)[0])
        assert share[0] == pytest.approx((weight * label).sum() / weight.sum(), rel=1e-6)


def test_trees_grow_until_rows_are_told_apart():
    rng = np.random.default_rng(4)
    bins = rng.permutation(np.arange(200)).astype(np.uint8)[:, None]
    label = (np.arange(200) % 2).astype(float)[np.argsort(rng.random(200))]
    tree = deep_forest.grow(bins, label, np.ones(200), 1, rng)
    assert ((deep_forest.shares(tree, bins) > 0.5) == label).all()  # far deeper than log2
    same = np.zeros((10, 3), np.uint8)
    feature, _, _, share = deep_forest.grow(same, np.array([1.0] * 4 + [0.0] * 6), np.ones(10), 2, rng)
    assert feature.tolist() == [-1] and share[0] == pytest.approx(0.4)
    # A node whose drawn feature is constant looks at the others.
    wide = np.zeros((20, 5), np.uint8)
    wide[:, 4] = np.arange(20)
    assert ((deep_forest.shares(deep_forest.grow(wide, label[:20], np.ones(20), 1, rng), wide) > 0.5) == label[:20]).all()


def test_sums_from_a_table_and_by_sorting_agree():
    rng = np.random.default_rng(6)
    node, value = rng.integers(0, 2, 600), rng.integers(0, 200, 600).astype(np.uint8)
    weight = rng.integers(1, 5, 600).astype(float)
    ones = weight * rng.integers(0, 2, 600)
    table, by_sort = (deep_forest._sums(node, value, weight, ones, nodes) for nodes in (2, 3))
    assert all((a == b).all() for a, b in zip(table, by_sort, strict=True))
    assert table[2].sum() == weight.sum() and table[3].sum() == ones.sum()


def test_trees_are_grown_by_several_tasks(spark, rows):
    forest = deep_forest.train_deep_forest(rows.limit(50), ["open", "close"], "target", 12, 42)
    assert forest.subtrees.count() == 12
    assert len(forest.subtrees.inputFiles()) > 1


@pytest.fixture(scope="module")
def rows(spark):
    x, y = F.rand(1), F.rand(2)
    data = spark.range(1500).select("id", x.alias("open"), y.alias("close"))
    label = ((F.col("open") * 8).cast("int") + (F.col("close") * 8).cast("int")) % 2  # a chess board
    return data.withColumn("target", label)


@pytest.mark.parametrize("leaf_rows", [200_000, 300])
def test_deep_trees_learn_a_chess_board(spark, rows, tmp_path, leaf_rows, monkeypatch):
    monkeypatch.setattr(deep_forest, "LEAF_ROWS", leaf_rows)
    forest = deep_forest.train_deep_forest(rows, ["open", "close"], "target", 15, 42, leaf_rows)
    model.save_model(forest, str(tmp_path / "model"))
    model.save_model(forest, str(tmp_path / "model"))
    loaded = model.load_model(str(tmp_path / "model"))
    found = model.predict(loaded, rows).collect()
    assert len(found) == 1500 and found[0].asDict().keys() == {"id", "open", "close", "target", "prediction"}
    assert sum(row["prediction"] == row["target"] for row in found) >= 1450
    joined = deep_forest.predict_deep(loaded, rows, broadcast_bytes=0)
    assert {(row["id"], row["prediction"]) for row in joined.collect()} == {(row["id"], row["prediction"]) for row in found}
    leaves = loaded.subtrees.count()
    assert leaves == 15 if leaf_rows > 1500 else leaves > 15
    assert model.predict(loaded, rows.limit(0)).collect() == []


def test_rows_are_drawn_by_the_hash_of_row_tree_and_seed(spark):
    rows = [0, 1, 77, (1 << 33) + 5, -3]
    for tree, seed in ((0, 42), (7, 42), (99, -1)):
        ids = spark.createDataFrame([(row, tree, seed) for row in rows], "row bigint, tree int, seed int")
        hashes = {row["row"]: row["h"] for row in ids.select("row", F.xxhash64("row", "tree", "seed").alias("h")).collect()}
        found = deep_forest._hashed(deep_forest._hashed(deep_forest._row_hash(np.array(rows)), tree), seed)
        assert found.view(np.int64).tolist() == [hashes[row] for row in rows]
    weight = deep_forest.draws(deep_forest._row_hash(np.arange(200_000)), 3, 42)
    assert abs(weight.mean() - 1) < 0.01 and abs((weight == 0).mean() - np.exp(-1)) < 0.01


def test_the_cut_from_sums_is_the_first_cut_of_a_tree():
    rng = np.random.default_rng(8)
    for _ in range(30):
        bins, label = rng.integers(0, 9, (60, 3)).astype(np.uint8), rng.integers(0, 2, 60)
        weight = rng.integers(1, 4, 60)
        sums = np.zeros((3, 256, 2))
        for n in range(3):
            np.add.at(sums[n], (bins[:, n], label), weight)
        place, cut, sides = deep_forest.best_cut(sums)
        best = min((split_by_hand(bins[:, n], label, weight)[0], n) for n in range(3))
        assert split_by_hand(bins[:, place], label, weight) == (pytest.approx(best[0]), cut)
        here = bins[:, place] <= cut
        assert sides == [weight[here].sum(), (weight * label)[here].sum(), weight[~here].sum(), (weight * label)[~here].sum()]
    assert deep_forest.best_cut(np.zeros((3, 256, 2)))[0] == -1


def test_tops_are_split_until_no_leaf_holds_too_many_rows(spark, rows, monkeypatch):
    monkeypatch.setattr(deep_forest, "NODES_A_PASS", 2)  # others wait for a later pass
    constant = rows.select(F.lit(1.0).alias("a"), F.lit(2.0).alias("b"), F.lit(3.0).alias("c"), "open", "target")
    forest = deep_forest.train_deep_forest(constant, ["a", "b", "c", "open"], "target", 3, 42, 200)
    assert all(len(top[0]) > 1 for top in forest.tops)  # also where the first features drawn are constant
    assert {feature for top in forest.tops for feature in top[0].tolist()} == {-1, 3}
    leaves = {(row["tree"], row["leaf"]) for row in forest.subtrees.collect()}
    assert leaves == {(tree, int(leaf)) for tree, top in enumerate(forest.tops) for leaf in np.flatnonzero(top[0] < 0)}
    bins = np.zeros((1500, 4), np.uint8)
    bins[:, 3] = np.searchsorted(np.array(forest.cuts[3]), np.array([row["open"] for row in rows.collect()]))
    for top in forest.tops:
        assert np.bincount(deep_forest._leaf(top, bins)).max() < 2 * 200 * 1.3  # draws vary about the rows
