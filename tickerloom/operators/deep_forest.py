"""A random forest whose trees grow until their leaves are pure.

The tops of the trees are split by sums over all rows, a level of all trees in a pass, until no leaf of
a top holds more rows than a task may; few rows need no such level. Then the rows of each leaf of each
tree, drawn with replacement, go to one task, which grows the rest of that tree there, level by level.
What is stored is the tops and one row for each leaf with the subtree below it.

Rows are moved as blocks of bytes, a block for the rows of a batch that fall into a leaf: a byte a feature
and one for weight and label.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise

LEAF_ROWS = 200_000  # rows of a tree that a task takes
MOST_LEVELS = 30  # of the tops
NODES_A_PASS = 20_000  # of all tops, whose sums a task holds (12 kB a node for 3 features)
BINS = 255  # different values of a feature that are told apart, by quantiles
BROADCAST_BYTES = 64 << 20  # of subtrees sent to every task; larger forests are joined

# Chances of a row being drawn at most 0, 1, ... times, with one draw a row on average.
_DRAWS = np.cumsum([math.exp(-1) / math.factorial(n) for n in range(8)]).tolist()
_SUBTREE = "feature binary, cut binary, left binary, share binary"
_KINDS = (np.int8, np.uint8, np.int32, np.float32)

Top = tuple[np.ndarray, np.ndarray, np.ndarray]  # feature, cut and left of its nodes, as in :func:`grow`


@dataclass(frozen=True)
class DeepForest:
    tops: list[Top]
    names: list[str]
    cuts: list[list[float]]  # of each feature, ascending
    subtrees: DataFrame  # tree, leaf (a node of the tree's top) and ``_SUBTREE``

    @property
    def trees(self) -> int:
        return len(self.tops)


def _binned(rows: DataFrame, names: list[str], cuts: list[list[float]], keep: list[str]) -> DataFrame:
    """``keep`` and the features as one byte each."""
    edges = [np.array(one) for one in cuts]

    @F.arrow_udf("binary")
    def bins(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), len(edges))
            columns = [np.searchsorted(edge, values[:, n], "left") for n, edge in enumerate(edges)]
            packed = np.stack(columns, 1).astype(np.uint8)
            yield pa.array([row.tobytes() for row in packed], pa.binary())

    return rows.select(*keep, F.array(*names).alias("_x")).withColumn("_bins", bins("_x")).drop("_x")


_PRIMES = tuple(
    np.uint64(n)
    for n in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _PRIMES[1]
    x = (x ^ (x >> np.uint64(29))) * _PRIMES[2]
    return x ^ (x >> np.uint64(32))


def _row_hash(rows: np.ndarray) -> np.ndarray:
    """``xxhash64`` of whole numbers (bigint)."""
    x = _rotated(rows.astype(np.int64).view(np.uint64) * _PRIMES[1], 31) * _PRIMES[0]
    x = x ^ (np.uint64(42) + _PRIMES[4] + np.uint64(8))
    return _mixed(_rotated(x, 27) * _PRIMES[0] + _PRIMES[3])


def _hashed(before: np.ndarray, number: int) -> np.ndarray:
    """``xxhash64`` of what ``before`` is the hash of and one more number (int)."""
    with np.errstate(over="ignore"):
        x = (before + _PRIMES[4] + np.uint64(4)) ^ (np.uint64(number & 0xFFFFFFFF) * _PRIMES[0])
        return _mixed(_rotated(x, 23) * _PRIMES[1] + _PRIMES[2])


def draws(row_hash: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree, from ``xxhash64`` of row, tree and seed."""
    chance = (_hashed(_hashed(row_hash, tree), seed) & np.uint64((1 << 30) - 1)) / float(1 << 30)
    weight = np.zeros(len(chance), np.uint8)
    for edge in _DRAWS:
        weight += chance >= edge
    return weight


def _leaf(top: Top, bins: np.ndarray) -> np.ndarray:
    """The leaf of a tree each row falls into."""
    feature, cut, left = top
    node = np.zeros(len(bins), np.int64)
    moving = np.arange(len(bins))
    while len(moving):
        moving = moving[feature[node[moving]] >= 0]
        at = node[moving]
        node[moving] = left[at] + (bins[moving, feature[at]] > cut[at])
    return node


def _sums(node: np.ndarray, value: np.ndarray, weight: np.ndarray, ones: np.ndarray, nodes: int):
    """The different (node, value), ascending, with the sums of both amounts: from a table of all of
    them where it is no larger than the rows, else by sorting. Weights are whole numbers above 0, so
    the order of adding does not matter."""
    key = node * 256 + value
    if nodes * 256 <= len(key):
        table = np.bincount(key, weight, nodes * 256)
        found = np.flatnonzero(table)
        return found >> 8, found & 255, table[found], np.bincount(key, ones, nodes * 256)[found]
    # Sorted as one number with both amounts: an order of the rows would be slower to find and to follow.
    bits = int(weight.max()).bit_length()
    packed = ((key << bits | weight.astype(np.int64)) << bits) | ones.astype(np.int64)
    packed.sort()
    key, mask = packed >> 2 * bits, (1 << bits) - 1
    first = np.flatnonzero(np.diff(key, prepend=-1))
    found = key[first]
    weight = np.add.reduceat(packed >> bits & mask, first).astype(float)
    return found >> 8, found & 255, weight, np.add.reduceat(packed & mask, first).astype(float)


def _gini(w: np.ndarray, one: np.ndarray, rest: np.ndarray, rest_ones: np.ndarray) -> np.ndarray:
    """Score of a cut, from weight and weight of label 1 on both sides; the larger the better."""
    return (one**2 + (w - one) ** 2) / w + (rest_ones**2 + (rest - rest_ones) ** 2) / rest


def grow(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, tries: int, rng: np.random.Generator):
    """Arrays ``feature, cut, left, share`` of the nodes of a tree over rows of bins, labels (0 or 1)
    and weights, grown until leaves are of one label or of equal rows.

    A node sends rows with a bin up to ``cut`` to the node ``left``, others to the one after it; a leaf
    has feature -1. ``share`` is the weight of label 1. Each node looks at ``tries`` features drawn for
    it, and at further ones only if those cannot split it. All nodes of a level are split at once.
    """
    size, features = bins.shape
    cells = np.ascontiguousarray(bins).ravel()
    feature, cut, left, share = [], [], [], []
    rows, node = np.arange(size), np.zeros(size, np.int64)
    weighted_label = weight * label
    nodes, first = 1, 0  # of this level; number of its first node
    while nodes:
        total = np.bincount(node, weight[rows], nodes)
        ones = np.bincount(node, weighted_label[rows], nodes)
        level_feature = np.full(nodes, -1, np.int8)
        level_cut = np.zeros(nodes, np.uint8)
        open_nodes = (ones > 0) & (ones < total)
        drawn = np.argsort(rng.random((nodes, features)), axis=1)
        best = np.full(nodes, -np.inf)
        for turn in range(features):
            if turn >= tries:  # the features drawn are constant in these nodes
                open_nodes &= level_feature < 0
            if turn == 0 or turn >= tries:
                inside = np.flatnonzero(open_nodes[node])
                part, part_node = rows[inside], node[inside]
                part_weight, part_ones = weight[part], weighted_label[part]
                place = part * features
            if not len(part):
                break
            at, value, amount, amount_ones = _sums(
                part_node, cells[place + drawn[:, turn][part_node]], part_weight, part_ones, nodes
            )
            before, before_ones = np.cumsum(amount), np.cumsum(amount_ones)
            start = np.flatnonzero(np.diff(at, prepend=-1))
            group = np.cumsum(np.diff(at, prepend=-1) != 0) - 1
            w = before - (before[start] - amount[start])[group]
            one = before_ones - (before_ones[start] - amount_ones[start])[group]
            edge = np.flatnonzero(at[1:] == at[:-1])
            if not len(edge):
                continue
            w, one, here = w[edge], one[edge], at[edge]
            rest, rest_ones = total[here] - w, ones[here] - one
            score = _gini(w, one, rest, rest_ones)
            start = np.flatnonzero(np.diff(here, prepend=-1))
            found = np.full(nodes, -np.inf)
            found[here[start]] = np.maximum.reduceat(score, start)
            hit = np.flatnonzero((score == found[here]) & (score > best[here]))
            level_feature[here[hit]] = drawn[here[hit], turn]
            level_cut[here[hit]] = value[edge[hit]]
            best = np.maximum(best, found)
        split = level_feature >= 0
        child = np.cumsum(split) - 1
        level_left = np.where(split, first + nodes + 2 * child, -1).astype(np.int32)
        feature.append(level_feature)
        cut.append(level_cut)
        left.append(level_left)
        share.append((ones / np.maximum(total, 1e-12)).astype(np.float32))
        inside = np.flatnonzero(split[node])
        rows, node = rows[inside], node[inside]
        right = cells[rows * features + level_feature[node]] > level_cut[node]
        node = 2 * child[node] + right
        first += nodes
        nodes = 2 * int(split.sum())
    return tuple(np.concatenate(column) for column in (feature, cut, left, share))


def shares(subtree: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    """The share of label 1 in the leaf each row falls into."""
    return subtree[3][_leaf(subtree[:3], bins)]


def _unpacked(blobs: tuple[bytes, ...]) -> tuple[np.ndarray, ...]:
    return tuple(np.frombuffer(blob, kind) for blob, kind in zip(blobs, _KINDS, strict=True))


def _matrix(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), -1)


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, label and bins of the rows of a batch of ``_row, _label, _bins``."""
    row, label = (batch.column(n).to_numpy() for n in (0, 1))
    return _row_hash(row), label.astype(np.uint8), _matrix(batch.column(2).to_pylist())


def _dealt(tops: list[Top], seed: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``tree, leaf, rows``: the rows of a batch drawn for a tree, a block for each leaf."""
        for batch in batches:
            if not len(batch):
                continue
            row_hash, label, bins = _read(batch)
            for tree, top in enumerate(tops):
                weight = draws(row_hash, tree, seed)
                drawn = np.flatnonzero(weight)
                leaf = _leaf(top, bins[drawn])
                order = np.argsort(leaf, kind="stable")
                drawn, leaf = drawn[order], leaf[order]
                block = np.column_stack([bins[drawn], weight[drawn] << 1 | label[drawn]])
                edges = [*np.flatnonzero(np.diff(leaf, prepend=-1)).tolist(), len(leaf)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(edges) - 1, tree), pa.int32()),
                        pa.array(leaf[edges[:-1]], pa.int32()),
                        pa.array([block[low:high].tobytes() for low, high in zip(edges, edges[1:])], pa.binary()),
                    ],
                    ["tree", "leaf", "rows"],
                )

    return deal


def _grown(features: int, tries: int, seed: int):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Subtrees of the leaves whose blocks come one after the other."""
        current, blocks = None, []

        def close() -> pa.RecordBatch:
            tree, leaf = current
            table = np.frombuffer(b"".join(blocks), np.uint8).reshape(-1, features + 1)
            label, weight = (table[:, -1] & 1).astype(float), (table[:, -1] >> 1).astype(float)
            found = grow(table[:, :-1], label, weight, tries, np.random.default_rng([seed, tree, leaf]))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([tree], pa.int32()),
                    pa.array([leaf], pa.int32()),
                    *[pa.array([column.astype(kind).tobytes()]) for column, kind in zip(found, _KINDS, strict=True)],
                ],
                ["tree", "leaf", "feature", "cut", "left", "share"],
            )

        for batch in batches:
            for tree, leaf, block in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if (tree, leaf) != current:
                    if blocks:
                        yield close()
                    current, blocks = (tree, leaf), []
                blocks.append(block)
        if blocks:
            yield close()

    return finish


def _tried(tree: int, node: int, turn: int, features: int, tries: int, seed: int) -> np.ndarray:
    """The features a node of a top looks at: ``tries`` drawn for it, in a further turn the next ones."""
    return np.random.default_rng([seed, tree, node]).permutation(features)[turn * tries : (turn + 1) * tries]


def _summed(tops: list[Top], asked: dict[int, dict[int, int]], features: int, tries: int, seed: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``tree, node, sums`` of the nodes asked for (by tree, with their turn): the weight of a task's
        rows by feature tried, bin and label."""
        sums, tried, place = {}, {}, {}
        for tree, nodes in asked.items():
            sums[tree] = np.zeros((tries, len(nodes), 256, 2))
            place[tree] = np.full(len(tops[tree][0]), -1)
            place[tree][list(nodes)] = np.arange(len(nodes))
            tried[tree] = np.zeros((len(nodes), tries), np.int64)
            for n, (node, turn) in enumerate(nodes.items()):
                found = _tried(tree, node, turn, features, tries, seed)
                # In its last turn a node may have fewer features left; the last one is summed again.
                tried[tree][n] = np.resize(found, tries) if len(found) == tries else [*found, *[found[-1]] * (tries - len(found))]
        for batch in batches:
            if not len(batch):
                continue
            row_hash, label, bins = _read(batch)
            for tree in asked:
                weight = draws(row_hash, tree, seed)
                drawn = np.flatnonzero(weight)
                at = place[tree][_leaf(tops[tree], bins[drawn])]
                drawn, at = drawn[at >= 0], at[at >= 0]
                total = sums[tree].reshape(tries, -1)
                for n in range(tries):
                    key = (at * 256 + bins[drawn, tried[tree][at, n]]) * 2 + label[drawn]
                    total[n] += np.bincount(key, weight[drawn], total.shape[1])
        for tree, nodes in asked.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(nodes), tree), pa.int32()),
                    pa.array(list(nodes), pa.int32()),
                    pa.array([sums[tree][:, n].tobytes() for n in range(len(nodes))], pa.binary()),
                ],
                ["tree", "node", "sums"],
            )

    return add


def best_cut(sums: np.ndarray) -> tuple[int, int, list[int]]:
    """Place of the feature, cut, and weight and weight of label 1 left and right of it, from weights by
    feature, bin and label; place -1 if no feature can split the rows."""
    best, found = -np.inf, (-1, 0, [0, 0, 0, 0])
    for n, table in enumerate(sums):
        value = np.flatnonzero(table.sum(1))
        one, w = np.cumsum(table[value, 1]), np.cumsum(table[value].sum(1))
        if len(value) < 2 or not 0 < one[-1] < w[-1]:
            continue
        rest, rest_ones = w[-1] - w[:-1], one[-1] - one[:-1]
        score = _gini(w[:-1], one[:-1], rest, rest_ones)
        if score.max() > best:
            best, edge = score.max(), int(np.flatnonzero(score == score.max())[-1])
            sides = [w[edge], one[edge], rest[edge], rest_ones[edge]]
            found = n, int(value[edge]), [int(side) for side in sides]
    return found


def _cut(tries: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best cut of each node from the sums of all tasks."""
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for tree, node, sums in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                table = np.frombuffer(sums).reshape(tries, 256, 2)
                total[tree, node] = total[tree, node] + table if (tree, node) in total else table
        found = [(*key, *best_cut(sums)) for key, sums in total.items()]
        columns = list(zip(*found, strict=True)) if found else [[]] * 5
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
            ["tree", "node", "place", "cut", "sides"],
        )

    return cut


def _tops(binned: DataFrame, features: int, trees: int, tries: int, seed: int, leaf_rows: int, size: int, tasks: int) -> list[Top]:
    """The tops of the trees: nodes with more than twice ``leaf_rows`` rows are split, each pass over the
    rows splitting those of one level (at most ``NODES_A_PASS`` of them; the others wait). The driver holds
    the nodes, not their sums."""
    grown = [([-1], [0], [-1]) for _ in range(trees)]  # feature, cut, left
    waiting = [(tree, 0, 0, 0) for tree in range(trees)] if size > 2 * leaf_rows else []  # node, turn, level
    arrays = lambda: [tuple(np.array(c, kind) for c, kind in zip(top, _KINDS)) for top in grown]
    while waiting:
        chosen, waiting = waiting[:NODES_A_PASS], waiting[NODES_A_PASS:]
        levels = {(tree, node): (turn, level) for tree, node, turn, level in chosen}
        asked: dict[int, dict[int, int]] = {}
        for tree, node, turn, _ in chosen:
            asked.setdefault(tree, {})[node] = turn
        cuts = (
            binned.select("_row", "_label", "_bins")
            .mapInArrow(_summed(arrays(), asked, features, tries, seed), "tree int, node int, sums binary")
            .repartition(tasks, "tree", "node")
            .mapInArrow(_cut(tries), "tree int, node int, place int, cut int, sides array<long>")
        )
        for tree, node, place, cut, sides in sorted(cuts.collect()):
            turn, level = levels[tree, node]
            feature, cuts_of, left = grown[tree]
            if place < 0:
                if (turn + 1) * tries < features:
                    waiting.append((tree, node, turn + 1, level))
                continue
            feature[node] = int(_tried(tree, node, turn, features, tries, seed)[place])
            cuts_of[node], left[node] = cut, len(feature)
            for weight, ones in (sides[:2], sides[2:]):
                if weight > 2 * leaf_rows and 0 < ones < weight and level + 1 < MOST_LEVELS:
                    waiting.append((tree, len(feature), 0, level + 1))
                feature.append(-1)
                cuts_of.append(0)
                left.append(-1)
    return arrays()


def train_deep_forest(
    train: DataFrame, names: list[str], target: str, trees: int, seed: int, leaf_rows: int = LEAF_ROWS
) -> DeepForest:
    """Fit on the columns ``names`` (no missing values) and labels 0 and 1.

    How often a row is drawn for a tree follows from a hash of the row, its copies and the tree, so a
    task that is run again draws the same. The cut points, at most ``BINS`` a feature, are the only data
    on the driver besides the tops.
    """
    rows = materialise(train.select(*names, F.col(target).cast("int").alias("_label")), "train")
    size = rows.count()
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1].tolist()
    cuts = [sorted(set(found)) for found in rows.approxQuantile(names, quantiles, 0.0005)]
    binned = materialise(
        _binned(rows, names, cuts, ["_label"]).withColumn("_row", F.monotonically_increasing_id()), "binned"
    )
    # Given, not left to the size of the rows: the cost lies in growing, not in their bytes.
    tasks = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tries = max(1, round(math.sqrt(len(names))))
    tops = _tops(binned, len(names), trees, tries, seed, leaf_rows, size, tasks)
    subtrees = (
        binned.select("_row", "_label", "_bins")
        .mapInArrow(_dealt(tops, seed), "tree int, leaf int, rows binary")
        .repartition(tasks, "tree", "leaf")
        .sortWithinPartitions("tree", "leaf")
        .mapInArrow(_grown(len(names), tries, seed), f"tree int, leaf int, {_SUBTREE}")
    )
    return DeepForest(tops, names, cuts, materialise(subtrees, "subtrees"))


def _voted(trees: dict[tuple[int, int], tuple[np.ndarray, ...]], tops: list[Top], bins: np.ndarray) -> np.ndarray:
    """Mean share of label 1 over all trees; a leaf no row was drawn for has no vote."""
    total, votes = np.zeros(len(bins)), np.zeros(len(bins))
    for tree, top in enumerate(tops):
        leaves = _leaf(top, bins)
        for leaf in np.unique(leaves).tolist():
            subtree = trees.get((tree, leaf))
            if subtree is not None:
                here = np.flatnonzero(leaves == leaf)
                total[here] += shares(subtree, bins[here])
                votes[here] += 1
    return total / np.maximum(votes, 1)


def _shares_of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_row, share`` of rows that come after the subtree of their leaf."""
    subtree = key = None
    for batch in batches:
        trees, leaves = (batch.column(n).to_numpy() for n in (0, 1))
        heads = np.flatnonzero(batch.column(2).is_null().to_numpy(zero_copy_only=False)).tolist()
        places, found = [np.zeros(0, np.int64)], [np.zeros(0)]
        for low, high in zip([-1, *heads], [*heads, len(trees)], strict=True):
            if low >= 0:
                key = (trees[low], leaves[low])
                subtree = _unpacked(tuple(batch.column(n)[low].as_py() for n in range(4, 8)))
            low += 1
            if key is None or low == high:
                continue
            own = (trees[low:high] == key[0]) & (leaves[low:high] == key[1])
            if own.any():
                bins = _matrix(batch.column(3).slice(low, high - low).to_pylist())
                places.append(batch.column(2).slice(low, high - low).to_numpy()[own])
                found.append(shares(subtree, bins[own]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(places), pa.int64()), pa.array(np.concatenate(found), pa.float64())],
            ["_row", "share"],
        )


def predict_deep(forest: DeepForest, df: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add the class with the larger mean share over all trees as ``prediction`` (int).

    A forest of few bytes goes to every task. A larger one is joined: rows meet the subtree of their
    leaf, tree by tree, and the shares are averaged by row.
    """
    kept = df.drop("prediction")
    order = [f"`{name}`" for name in kept.columns]
    rows = _binned(kept, forest.names, forest.cuts, order)
    tops = forest.tops
    size = sum((F.length(name) for name in ("feature", "cut", "left", "share")), F.lit(0))
    if (forest.subtrees.agg(F.sum(size)).first()[0] or 0) <= broadcast_bytes:
        found = {
            (row["tree"], row["leaf"]): _unpacked((row["feature"], row["cut"], row["left"], row["share"]))
            for row in forest.subtrees.collect()
        }
        sent = df.sparkSession.sparkContext.broadcast(found)

        @F.arrow_udf("double")
        def mean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for bins in batches:
                yield pa.array(_voted(sent.value, tops, _matrix(bins.to_pylist())))

        scored = rows.withColumn("_share", mean("_bins"))
    else:

        @F.arrow_udf("array<int>")
        def leaves(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for bins in batches:
                table = _matrix(bins.to_pylist())
                found = np.stack([_leaf(top, table) for top in tops], 1)
                yield pa.array(list(found.astype(np.int32)), pa.list_(pa.int32()))

        found = rows.withColumn("_leaves", leaves("_bins")).withColumn("_row", F.monotonically_increasing_id())
        numbered = materialise(found, "numbered")
        empty = [F.lit(None).cast("binary").alias(name) for name in ("feature", "cut", "left", "share")]
        asked = numbered.select("_row", "_bins", F.posexplode("_leaves").alias("tree", "leaf")).select(
            "tree", "leaf", "_row", "_bins", *empty
        )
        trees = forest.subtrees.select(
            "tree", "leaf", F.lit(None).cast("long").alias("_row"), F.lit(None).cast("binary").alias("_bins"),
            "feature", "cut", "left", "share",
        )
        votes = (
            trees.unionByName(asked)
            .repartition("tree", "leaf")
            .sortWithinPartitions("tree", "leaf", F.asc_nulls_first("_row"))
            .mapInArrow(_shares_of_rows, "_row long, share double")
            .groupBy("_row")
            .agg(F.avg("share").alias("_share"))
        )
        scored = numbered.join(votes, "_row", "left")
    return scored.select(*order, F.when(F.col("_share") > 0.5, 1).otherwise(0).alias("prediction"))


def save_deep(forest: DeepForest, path: str) -> None:
    spark = forest.subtrees.sparkSession
    tops = [(tree, *[bytearray(column.tobytes()) for column in top]) for tree, top in enumerate(forest.tops)]
    stored = spark.createDataFrame(tops, "tree int, feature binary, cut binary, left binary")
    stored.write.mode("overwrite").parquet(f"{path}/tops")
    forest.subtrees.write.mode("overwrite").parquet(f"{path}/subtrees")
    meta = spark.createDataFrame([(forest.names, forest.cuts)], "names array<string>, cuts array<array<double>>")
    meta.write.mode("overwrite").parquet(f"{path}/meta")


def load_deep(spark: SparkSession, path: str) -> DeepForest:
    meta = spark.read.parquet(f"{path}/meta").first()
    cuts = [list(one) for one in meta["cuts"]]
    tops = [
        tuple(np.frombuffer(blob, kind) for blob, kind in zip(row[1:], _KINDS))
        for row in sorted(spark.read.parquet(f"{path}/tops").collect(), key=lambda row: row["tree"])
    ]
    return DeepForest(tops, list(meta["names"]), cuts, spark.read.parquet(f"{path}/subtrees"))
