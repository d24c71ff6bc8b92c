"""Connected components of a graph of any size, and a filter of fixed size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.session import materialise

BITMAP_BITS = 1 << 26  # 8 MB, whatever the number of keys
_BUCKET_BITS = 32_768  # of Spark's bitmap functions


def unused_name(taken: Iterable[str], name: str) -> str:
    """A column name like ``name`` that none of ``taken`` is, whatever its case."""
    used = {other.lower() for other in taken}
    while name.lower() in used:
        name += "_"
    return name


class UnionFind:
    """Sets of nodes; the least node of a set stands for it."""

    def __init__(self):
        self._parent: dict = {}

    def find(self, node):
        parent = self._parent
        root = node
        while (above := parent.setdefault(root, root)) != root:
            root = above
        while (above := parent[node]) != root:
            parent[node] = root
            node = above
        return root

    def union(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self._parent[max(a, b)] = min(a, b)

    def members(self) -> Iterator[tuple]:
        """(node, root) of every node that is not its own root."""
        for node in list(self._parent):
            root = self.find(node)
            if root != node:
                yield node, root


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of one partition: at most one edge a node is left."""
    sets = UnionFind()
    schema = None
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sets.union(a, b)
    if schema is not None:
        found = list(sets.members())
        yield pa.RecordBatch.from_arrays(
            [pa.array([pair[side] for pair in found], schema.field(side).type) for side in (0, 1)],
            ["u", "v"],
        )


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (two columns of one orderable type) but the
    roots; the root is the least node of the component. Loops and repeated edges do no harm, edges
    with a null end are left out, and no edges give no rows.

    Union-find inside each partition first, then rounds in which every node points its neighbours
    to the least of them (larger neighbours, then smaller ones) until nothing changes. The least
    neighbour comes from an aggregate that combines before it shuffles, so a hub, or a component
    of a third of all nodes, is spread. Each round is stored, so a lost executor costs one round.
    """
    a, b = (F.col(f"`{name}`") for name in edges.columns)
    kind = edges.dtypes[0][1]
    pairs = edges.select(a.alias("u"), b.alias("v")).where((a != b) & a.isNotNull() & b.isNotNull())
    current = materialise(pairs.mapInArrow(_contract, f"u {kind}, v {kind}").distinct(), "edges")
    before = None
    while True:
        state = current.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")
        ).first()
        if state["n"] == 0 or state == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        # Larger neighbours are pointed to the least of a node and its neighbours.
        both = current.union(current.select("v", "u"))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Smaller neighbours, and the node itself, are pointed to the least of those.
        down = materialise(large.where("u <> v").distinct(), "edges")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", "m"))
        current = materialise(small.where("u <> v").distinct(), "edges")


def spread_bit(key: Column) -> Column:
    """A bit number for a key: the place of its hash among ``BITMAP_BITS``."""
    return F.pmod(F.xxhash64(key), F.lit(BITMAP_BITS))


def bitmap_of(bits: DataFrame) -> bytes:
    """A bitmap of ``BITMAP_BITS`` with the given bits set (one column of bit numbers): a filter
    whose size does not depend on the number of keys. Different keys may share a bit, so an exact
    join must follow."""
    bit = F.col(bits.columns[0]) + 1  # Spark's bitmap functions count from 1
    found = (
        bits.select(bit.alias("bit"))
        .groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits"))
        .collect()
    )
    size = _BUCKET_BITS // 8
    bitmap = bytearray(BITMAP_BITS // 8 + size)
    for row in found:
        start = (row["bucket"] - 1) * size
        bitmap[start : start + size] = row["bits"]
    return bytes(bitmap)


def is_set(bitmap: bytes, place: int) -> bool:
    return bool(bitmap[place >> 3] >> (place & 7) & 1)
