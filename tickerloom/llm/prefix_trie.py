"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a sequence of first turns that some conversation starts with. Nodes are named by a hash of
their sequence that can be composed, so a conversation may span any number of sorted ranges. What a
node has below it is summed over the forest of parent edges below the root: a component is split at
its centroid, whose total is that of the component's nodes below it; the total is added to the nodes
on the path from the centroid to the component's top, and the parts, of half the weight at most, are
split in turn. Components that fit a task are finished there; larger ones are split by joins, as the
path of a node to the top is a range of the turns of one conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.session import materialise

COMPONENT_NODES = 100_000  # of a component that one task splits
BLOCK_IDS = 10_000  # ids hashed in one piece
ROOT = bytes(16)

_PRIME = (1 << 61) - 1
_BASES = (1_152_921_504_606_846_577 % _PRIME, 776_531_419_905_623_411)


def digested(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv, turn, digest, words`` of each turn: a 16-byte digest of role and text (null counts as
    empty), and the number of words ``[^\\x20\\x09-\\x0D]+`` of the text. Rows without a conversation
    are left out."""
    said = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    by = F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(""))
    return conversations.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(by).cast("string"), F.lit(":"), by, said))).alias("digest"),
        F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )


def _extended(state: tuple[int, ...], more: tuple[int, ...]) -> tuple[int, ...]:
    """``count, hash, hash`` of a sequence followed by another."""
    size = more[0]
    return (
        state[0] + size,
        *((h * pow(base, size, _PRIME) + g) % _PRIME for h, g, base in zip(state[1:], more[1:], _BASES, strict=True)),
    )


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add to sorted rows their place in the partition, and depth and hash of the turns of their
    conversation so far in this partition, and the hash before and of the first of them."""
    current, depth, row = None, 0, 0
    state = [0, 0]
    for batch in batches:
        found = np.zeros((8, batch.num_rows), np.int64)
        convs, digests = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for at, (conv, digest) in enumerate(zip(convs, digests, strict=True)):
            if depth == 0 or conv != current:
                current, depth, state = conv, 0, [0, 0]
            before = state
            parts = int.from_bytes(digest[:8], "big"), int.from_bytes(digest[8:], "big")
            state = [(h * base + x + 1) % _PRIME for h, x, base in zip(before, parts, _BASES, strict=True)]
            depth += 1
            if depth == 1:
                first = state
            found[:, at] = (row, depth, *state, *before, *first)
            row += 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *[pa.array(column) for column in found]],
            [*batch.schema.names, "row", "depth", "h1", "h2", "b1", "b2", "t1", "t2"],
        )


def _names(one: np.ndarray, other: np.ndarray) -> pa.Array:
    both = np.stack([one, other], 1)
    return pa.array([row.tobytes() for row in both], pa.binary())


def _completed(starts: dict[int, tuple]):
    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Depth and names with the turns of earlier partitions in front."""
        for batch in batches:
            table = np.stack([column.to_numpy() for column in batch.columns[5:]], 0)  # depth ... t2
            parts, convs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, (part, conv) in enumerate(zip(parts, convs, strict=True)):
                start = starts.get(part)
                if start is not None and start[0] == conv:
                    depth, h1, h2, b1, b2 = table[:5, at].tolist()
                    whole = _extended(start[1], (depth, h1, h2))
                    before = _extended(start[1], (depth - 1, b1, b2))
                    table[:, at] = (whole[0], *whole[1:], *before[1:], *start[2])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    pa.array(table[0]),
                    _names(table[1], table[2]),
                    _names(table[3], table[4]),
                    _names(table[5], table[6]),
                    batch.column(2),
                    batch.column(3),
                ],
                ["conv", "depth", "node", "parent", "top", "digest", "words"],
            )

    return complete


def numbered(turns: DataFrame) -> DataFrame:
    """``conv, depth, node, parent, top, digest, words``: the turns of each conversation numbered
    from 1 (null turns first; turns of one number by digest), the name of the sequence up to each,
    of the one before it and of the first turn.

    Rows are sorted over ranges of conversation, turn and a random last key, so that neither a long
    conversation nor copies of a row stay in one range. Each range numbers its own rows; of each,
    one row with its first and last conversation goes to the driver, which puts the ranges together.
    """
    kind = turns.schema["conv"].dataType.simpleString()
    order = [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("digest"), F.asc("spread")]
    schema = f"part int, conv {kind}, digest binary, words long, row long, depth long, " + ", ".join(
        f"{name} long" for name in ("h1", "h2", "b1", "b2", "t1", "t2")
    )
    local = materialise(
        turns.withColumn("spread", F.rand(23))
        .orderBy(*order)
        .select(F.spark_partition_id().alias("part"), "conv", "digest", "words")
        .mapInArrow(_local, schema),
        "ranges",
    )
    state = F.struct("conv", "depth", "h1", "h2", "t1", "t2")
    ends = local.groupBy("part").agg(F.min_by("conv", "row").alias("first"), F.max_by(state, "row").alias("last"))
    starts: dict[int, tuple] = {}
    carried = None
    for range_ in sorted(ends.collect(), key=lambda found: found["part"]):  # one a range
        last = range_["last"]
        mine, first = (last["depth"], last["h1"], last["h2"]), (last["t1"], last["t2"])
        if carried is not None and carried[0] == range_["first"]:
            starts[range_["part"]] = carried
            if last["conv"] == carried[0]:
                mine, first = _extended(carried[1], mine), carried[2]
        carried = (last["conv"], mine, first)
    schema = f"conv {kind}, depth long, node binary, parent binary, top binary, digest binary, words long"
    return materialise(local.mapInArrow(_completed(starts), schema), "turns")


def rollup(parents: list[int], values: np.ndarray, added: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over what each node of a tree has below it, itself included, plus ``added``.

    ``parents`` come before their children; the parent of the top is -1.
    """
    result = added.copy()
    part = [0] * len(parents)  # component of a node
    size = [0] * len(parents)
    parts = 1
    todo = [list(range(len(parents)))] if parents else []
    while todo:
        nodes = todo.pop()
        name = part[nodes[0]]
        for node in nodes:
            size[node] = 1
        for node in reversed(nodes):
            above = parents[node]
            if above >= 0 and part[above] == name:
                size[above] += size[node]
        centre = next(node for node in reversed(nodes) if 2 * size[node] > len(nodes))
        upper, below = [], {}
        mine = [centre]
        for node in nodes:
            if node == centre:
                continue
            above = parents[node]
            if above == centre and part[above] == name:
                part[node] = parts
                below[parts] = [node]
                parts += 1
            elif above >= 0 and part[above] in below:
                part[node] = part[above]
                below[part[node]].append(node)
            else:
                upper.append(node)
                continue
            mine.append(node)
        total = values[mine].sum(0)
        result[centre] += total
        node = parents[centre]
        while node >= 0 and part[node] == name:
            result[node] += total
            node = parents[node]
        part[centre] = -1
        todo += [*([upper] if upper else []), *below.values()]
    return result


def _rolled_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, leaves, saved`` of components that come one after the other, tops first."""
    current, rows = None, []

    def close() -> pa.RecordBatch:
        place = {row[0]: at for at, row in enumerate(rows)}
        parents = [place.get(row[1], -1) for row in rows]
        numbers = np.array([row[2:] for row in rows], np.int64)
        found = rollup(parents, numbers[:, :2], numbers[:, 2:])
        return pa.RecordBatch.from_arrays(
            [pa.array([row[0] for row in rows], pa.binary()), pa.array(found[:, 0]), pa.array(found[:, 1])],
            ["node", "leaves", "saved"],
        )

    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if row[0] != current:
                if rows:
                    yield close()
                current, rows = row[0], []
            rows.append(row[1:])
    if rows:
        yield close()


def _split(forest: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split each component at its centroid: ``node, leaves, saved`` of the centroids, and the
    rest with new components.

    The weight of a node is the number of turns at it and below it in its component. The deepest
    node with more than half of the weight is the centroid.
    """
    totals = forest.groupBy("comp").agg(F.max("weight").alias("total"), F.min("depth").alias("top_depth"))
    place = F.struct(F.col("depth").alias("at"), F.col("node").alias("centre"), "conv", "weight")
    centres = materialise(
        forest.join(totals, "comp")
        .where(2 * F.col("weight") > F.col("total"))
        .groupBy("comp")
        .agg(F.max(place).alias("z"), F.any_value("top_depth").alias("top_depth"))
        .select("comp", "top_depth", "z.at", "z.centre", F.col("z.conv").alias("by"), F.col("z.weight").alias("lost")),
        "centres",
    )
    # What is below the centroid passes through one of its children.
    child = turns.select(
        F.col("conv"), (F.col("depth") - 1).alias("at"), F.col("node").alias("child"), F.col("parent").alias("through")
    )
    split = (
        forest.join(centres.select("comp", "at", "centre"), "comp")
        .join(child, ["conv", "at"], "left")
        .withColumn("is_centre", F.col("node") == F.col("centre"))
        .withColumn(
            "below", F.coalesce((F.col("depth") > F.col("at")) & (F.col("through") == F.col("centre")), F.lit(False))
        )
    )
    split = materialise(split, "split")
    sums = materialise(
        split.where("below or is_centre")
        .groupBy("comp")
        .agg(F.sum("leaf").alias("more_leaves"), F.sum("own").alias("more_saved")),
        "sums",
    )
    done = (
        split.where("is_centre")
        .join(sums, "comp")
        .select("node", (F.col("leaves") + F.col("more_leaves")).alias("leaves"), (F.col("saved") + F.col("more_saved")).alias("saved"))
    )
    path = (
        turns.select(F.col("conv").alias("by"), F.col("depth").alias("step"), "node")
        .join(centres.join(sums, "comp").select("comp", "by", "top_depth", "at", "lost", "more_leaves", "more_saved"), "by")
        .where("step >= top_depth and step < at")
        .select("comp", "node", "lost", "more_leaves", "more_saved")
    )
    zero = F.lit(0).cast("long")
    upper = (
        split.where("not below and not is_centre")
        .join(path, ["comp", "node"], "left")
        .withColumn("weight", F.col("weight") - F.coalesce("lost", zero))
        .withColumn("leaves", F.col("leaves") + F.coalesce("more_leaves", zero))
        .withColumn("saved", F.col("saved") + F.coalesce("more_saved", zero))
    )
    under = split.where("below").withColumn("comp", F.col("child"))
    rest = upper.select(*forest.columns).unionByName(under.select(*forest.columns))
    return materialise(done, "done"), materialise(rest, "forest")


def _sums_below(nodes: DataFrame, turns: DataFrame, limit: int) -> DataFrame:
    """``node, leaves, saved`` summed over what each node but the root has below it."""
    zero = F.lit(0).cast("long")
    forest = nodes.select(
        F.col("top").alias("comp"),
        "node",
        "parent",
        "depth",
        F.col("conv_id").alias("conv"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaf"),
        "own",
        zero.alias("leaves"),
        zero.alias("saved"),
        F.lit(None).cast("long").alias("weight"),
    )
    results = None
    weighed = False

    def finished(small: DataFrame) -> DataFrame:
        return (
            small.select("comp", "depth", "node", "parent", "leaf", "own", "leaves", "saved")
            .repartition("comp")
            .sortWithinPartitions("comp", "depth")
            .drop("depth")
            .mapInArrow(_rolled_up, "node binary, leaves long, saved long")
        )

    while True:
        large = forest.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
        large = materialise(large.select("comp"), "large")
        some = not large.isEmpty()
        small = finished(forest.join(large, "comp", "left_anti") if some else forest)
        results = small if results is None else results.unionByName(small)
        if not some:
            return materialise(results, "rolled")
        forest = forest.join(large, "comp", "left_semi")
        if not weighed:  # by the turns from a node on
            weighed = True
            lengths = turns.groupBy("conv").agg(F.max("depth").alias("n"))
            weights = (
                turns.join(large, F.col("top") == F.col("comp"), "left_semi")
                .join(lengths, "conv")
                .groupBy("node")
                .agg(F.sum(F.col("n") - F.col("depth") + 1).alias("weight"))
            )
            forest = forest.drop("weight").join(weights, "node").select(*forest.columns)
        done, forest = _split(forest, turns)
        results = results.unionByName(done)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, first, ids``: the ids of sorted rows, joined by commas, in blocks."""
    current, first, ids = None, None, []
    for batch in batches:
        found = []
        nodes, keys, texts = (column.to_pylist() for column in batch.columns)
        for node, key, text in zip(nodes, keys, texts, strict=True):
            if ids and (node != current or len(ids) >= BLOCK_IDS):
                found.append((current, first, ",".join(ids)))
                ids = []
            if not ids:
                current, first = node, key
            ids.append(text)
        yield _rows(found, batch.schema)
    if ids:
        yield _rows([(current, first, ",".join(ids))], batch.schema)


def _rows(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [(), (), ()]
    kinds = [field.type for field in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], ["node", "first", "ids"]
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, ends_sha256`` of blocks that come one after the other."""
    current, digest = None, None
    for batch in batches:
        found = []
        for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if digest is not None and node == current:
                digest.update(b",")
            else:
                if digest is not None:
                    found.append((current, digest.hexdigest()))
                current, digest = node, hashlib.sha256()
            digest.update(ids.encode())
        yield _hash_rows(found)
    if digest is not None:
        yield _hash_rows([(current, digest.hexdigest())])


def _hash_rows(found: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([row[0] for row in found], pa.binary()), pa.array([row[1] for row in found], pa.string())],
        ["node", "ends_sha256"],
    )


def _ends(members: DataFrame) -> DataFrame:
    """``node, ends_sha256`` over the ids (ascending, joined by commas) that end at each node.

    Ids are joined over ranges of node and id first, so what meets in one task is a row a block; it is
    hashed as it comes and never held.
    """
    kind = members.schema["conv"].dataType.simpleString()
    return (
        members.orderBy("node", "conv")
        .select("node", "conv", F.col("conv").cast("string").alias("id"))
        .mapInArrow(_blocks, f"node binary, first {kind}, ids string")
        .repartition("node")
        .sortWithinPartitions("node", "first")
        .select("node", "ids")
        .mapInArrow(_hashed, "node binary, ends_sha256 string")
    )


def prefix_trie(turns: DataFrame, convs: DataFrame | None = None, component_nodes: int = COMPONENT_NODES) -> DataFrame:
    """One row per node of the trie of :func:`digested` turns: ``node``, ``parent`` (names; the
    root's parent is null), ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Members of a node are the conversations that begin with its sequence of turns; all belong to the
    root. ``n_leaves`` counts childless nodes at it and below; ``saved_tokens`` sums there the words
    of the last turn times the members but one, what a cache of prefixes saves. ``ends_sha256`` is
    over the ids of the conversations that end there. ``convs`` (one column) names conversations
    that may have no turn, which belong to the root; ids are of any orderable type. Null ids are left
    out, repeated rows are further turns, and turns of one number follow by digest. Without any
    conversation there are no rows.
    """
    names = turns.select("conv") if convs is None else convs.select(F.col(f"`{convs.columns[0]}`").alias("conv"))
    all_convs = materialise(names.where("conv is not null").distinct(), "conversations")
    rows = numbered(turns)
    root = F.lit(ROOT)
    counted = (
        rows.select("conv", "depth", "node", "parent", "top", "words")
        .unionByName(
            all_convs.select(
                "conv",
                F.lit(0).cast("long").alias("depth"),
                root.alias("node"),
                F.lit(None).cast("binary").alias("parent"),
                F.lit(None).cast("binary").alias("top"),
                F.lit(0).cast("long").alias("words"),
            )
        )
        .groupBy("node")
        .agg(
            F.count(F.lit(1)).alias("n_convs"),
            F.min("conv").alias("conv_id"),
            F.min("depth").alias("depth"),
            F.min("parent").alias("parent"),
            F.min("top").alias("top"),
            F.min("words").alias("words"),
        )
    )
    counted = materialise(counted.withColumn("own", (F.col("n_convs") - 1) * F.col("words")), "counted")
    children = counted.where("depth > 0").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    zero = F.lit(0).cast("long")
    nodes = materialise(
        counted.join(children.withColumnRenamed("parent", "node"), "node", "left").withColumn(
            "n_children", F.coalesce("n_children", zero)
        ),
        "nodes",
    )
    below = _sums_below(nodes.where("depth > 0"), rows, component_nodes)
    tops = nodes.where("depth = 1").select("node").join(below, "node")
    whole = tops.groupBy(root.alias("node")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    # The last node of each conversation; those without turns end at the root.
    last = rows.groupBy("conv").agg(F.max_by("node", "depth").alias("node"))
    members = all_convs.join(last, "conv", "left").select(F.coalesce("node", root).alias("node"), "conv")
    above = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(below.unionByName(whole), "node", "left")
        .join(_ends(members), "node", "left")
        .join(above, "parent", "left")
        .select(
            "node",
            "parent",
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.coalesce("leaves", F.lit(1).cast("long")).alias("n_leaves"),
            F.coalesce("saved", zero).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def with_shared_starts(turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt to share their first turns, as digested turns, and all their ids (longs).

    Conversation c begins with the first h turns of the conversation ``c - c % group`` (fewer or
    none, if that has no more or does not exist) and goes on with its own turns after its first h,
    h being the CRC-32 of c in decimal modulo ``most``.
    """
    own = numbered(turns)
    shared = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(most))
    convs = materialise(own.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), "conversations")
    wanted = convs.select("conv", (F.col("conv") - F.col("conv") % group).alias("base"), shared.alias("h"))
    first = own.where(F.col("depth") < most).select(F.col("conv").alias("base"), "depth", "digest", "words")
    begun = wanted.join(first, "base").where("depth <= h")
    rest = own.where(F.col("depth") > shared)
    columns = ["conv", F.col("depth").alias("turn"), "digest", "words"]
    return begun.select(*columns).unionByName(rest.select(*columns)), convs.select("conv")
