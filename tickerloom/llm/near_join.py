"""Self-join of texts by the Jaccard similarity of their word n-grams, along chosen paths.

Each text is a set of shingles of five words, embedded as the least values of a number of hash
functions: a token is a function with its value, and two sets share as large a part of their tokens
as their similarity. From the root, a node of the search tree samples tokens and sends each set down
the sampled tokens it has; sets that meet in a small node are compared exactly. One run finds a
similar pair with a probability that is known, so runs are repeated until the target recall.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.session import materialise

from .components import UnionFind, bitmap_of, connected_components, is_set, spread_bit, unused_name
from .decontamination import words
from .line_dedup import mixed

SIMILARITY = 0.8
WORDS = 5  # of a shingle
TOKENS = 32  # hash functions
TARGET_RECALL = 0.999  # of pairs that have just the similarity asked for
SMALL = 256  # sets of a node that is not split further
LEVELS = 3  # splits at most; a node that is still larger is compared in blocks
BLOCK = 512  # sets of a block
_CHUNK = 1 << 18  # bytes hashed at once

_BASE = np.uint64(0x100000001B3)
_INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))
_LETTERS = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = mixed((np.arange(1, 65, dtype=np.uint64)) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    size = 1 << max(_CHUNK.bit_length(), int(size).bit_length())
    if size not in _powers:
        with np.errstate(over="ignore"):
            up = np.cumprod(np.full(size, _BASE, np.uint64))
            down = np.cumprod(np.full(size, _INVERSE, np.uint64))
        _powers.clear()
        _powers[size] = (up, down)
    return _powers[size]


def shingle_hashes(
    texts: list[str | None], size: int = WORDS, split: Callable[[str | None], list[bytes]] = words
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts in order, and the number of shingles of each text. A
    text of fewer words than a shingle has, but not none, is one shingle."""
    parts, amounts = [np.zeros(0, np.uint64)], []
    chunk: list[bytes] = []
    counts: list[int] = []
    length = 0

    def close() -> None:
        nonlocal chunk, counts, length
        if counts:
            hashes, amount = _shingles(chunk, np.array(counts, np.int64), size)
            parts.append(hashes)
            amounts.append(amount)
        chunk, counts, length = [], [], 0

    for text in texts:
        found = split(text)
        chunk += found
        counts.append(len(found))
        length += len(text or "")
        if length > _CHUNK:
            close()
    close()
    return np.concatenate(parts), np.concatenate(amounts) if amounts else np.zeros(0, np.int64)


def _shingles(found: list[bytes], counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(found), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    up, down = _power_tables(len(data) + 1)
    # A word's hash is a polynomial in its letters: a difference of prefix sums, shifted back.
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTERS[data] * up[: len(data)])])
    hashes = mixed((prefix[ends] - prefix[starts]) * down[starts] if len(found) else prefix[:0])
    amount = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.cumsum(counts) - counts
    place = np.arange(int(amount.sum())) + np.repeat(first - (np.cumsum(amount) - amount), amount)
    last = np.repeat(first + counts, amount)
    total = np.zeros(len(place), np.uint64)
    for step in range(size):
        at = place + step
        inside = at < last
        total[inside] += hashes[at[inside]] * _FACTORS[step]
    return mixed(total), amount


def signatures(hashes: np.ndarray, amounts: np.ndarray, tokens: int = TOKENS) -> np.ndarray:
    """Least value of each hash function over each non-empty set, as 32-bit numbers."""
    starts = (np.cumsum(amounts) - amounts)[amounts > 0]
    found = np.zeros((len(starts), tokens), np.int32)
    if len(starts):
        for token in range(tokens):
            factor = _FACTORS[token % 64]
            least = np.minimum.reduceat(hashes * factor, starts)
            found[:, token] = (mixed(least) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return found


def contents(hashes: np.ndarray, amounts: np.ndarray) -> np.ndarray:
    """16 bytes for each non-empty set, two sums over its shingles: copies have the same."""
    some = amounts > 0
    starts = (np.cumsum(amounts) - amounts)[some]
    content = np.zeros((len(starts), 2), np.uint64)
    if len(starts):
        content[:, 0] = np.add.reduceat(hashes, starts)
        content[:, 1] = np.add.reduceat(mixed(hashes ^ _FACTORS[40]), starts)
        content[:, 1] += mixed(amounts[some].astype(np.uint64))
    return content


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, content, signature`` of each text; texts without words have neither."""
    for batch in batches:
        hashes, amounts = shingle_hashes(batch.column(1).to_pylist())
        some = amounts > 0
        content = contents(hashes, amounts)
        place = np.cumsum(some) - 1
        keys = [content[p].tobytes() if s else None for p, s in zip(place, some, strict=True)]
        signature = signatures(hashes, amounts)
        offsets = np.concatenate([[0], np.cumsum(np.where(some, TOKENS, 0))])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(keys, pa.binary()),
                pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(signature.ravel(), pa.int32())
                ),
            ],
            ["doc_id", "content", "signature"],
        )


def runs_for(recall: float, levels: int) -> int:
    """Runs after which a pair of just the similarity asked for has met with this probability.

    A node samples each token with probability 1 / (similarity * TOKENS), so such a pair shares one
    sampled token on average. It goes on from a split with probability 1 - exp(-1), and from
    further splits with the usual recursion of a branching process.
    """
    met = 1.0
    for _ in range(levels):
        met = 1.0 - math.exp(-met)
    return math.ceil(math.log(1.0 - recall) / math.log(1.0 - met))


def _children(signature: Column, path: Column, similarity: float) -> Column:
    """The nodes below ``path`` a set goes to: one for each sampled token it has."""
    limit = int((1 << 31) / (similarity * TOKENS))

    def child(value: Column, token: Column) -> Column:
        sampled = F.pmod(F.xxhash64(path, token), F.lit(1 << 31)) < limit
        return F.when(sampled, F.xxhash64(path, token, value))

    return F.array_compact(F.transform(signature, child))


def _leaves(sets: DataFrame, similarity: float, recall: float) -> DataFrame:
    """``path, content, size``: the nodes in which sets are compared, of two sets at least."""
    runs = F.sequence(F.lit(1), F.lit(runs_for(recall, LEVELS)))
    paths = F.flatten(
        F.transform(runs, lambda run: _children(F.col("signature"), F.xxhash64(F.lit("run"), run), similarity))
    )
    nodes = sets.select("content", F.explode(paths).alias("path"))
    leaves = None
    for level in range(1, LEVELS + 1):
        nodes = materialise(nodes, "nodes")
        sizes = (
            nodes.groupBy("path")
            .agg(
                F.count(F.lit(1)).alias("size"),
                F.sum(F.xxhash64("content").cast("decimal(38,0)")).alias("sum"),
                F.bit_xor(F.xxhash64("content", F.lit(7))).alias("xor"),
            )
            .where("size > 1")
            # Nodes of the same sets are compared once.
            .groupBy("size", "sum", "xor")
            .agg(F.min("path").alias("path"))
        )
        members = materialise(nodes.join(sizes.select("path", "size"), "path"), "members")
        last = level == LEVELS
        ready = members if last else members.where(F.col("size") <= SMALL)
        leaves = ready if leaves is None else leaves.unionByName(ready)
        if not last:
            nodes = (
                members.where(F.col("size") > SMALL)
                .join(sets.select("content", "signature"), "content")
                .select("content", F.explode(_children(F.col("signature"), F.col("path"), similarity)).alias("path"))
            )
    return leaves


def _texts(rows: DataFrame, bitmap: bytes) -> DataFrame:
    """``content, text`` of rows whose id may be wanted."""
    sent = rows.sparkSession.sparkContext.broadcast(bitmap)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = [is_set(sent.value, place) for place in batch.column(1).to_pylist()]
            texts = batch.column(0).filter(pa.array(mask, pa.bool_()))
            hashes, amounts = shingle_hashes(texts.to_pylist())
            keys = [key.tobytes() for key in contents(hashes, amounts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), texts.filter(pa.array(amounts > 0))], ["content", "text"]
            )

    return rows.select("text", spread_bit(F.col("doc_id")).alias("bit")).mapInArrow(
        pick, "content binary, text string"
    )


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Number of common elements of every two sets."""
    if len(sets) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]], np.float64)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, amount = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = amount[column] > 1
    owner, column = owner[shared], column[shared]
    column = np.unique(column, return_inverse=True)[1]
    total = np.zeros((len(sets), len(sets)), np.float64)
    width = int(column.max()) + 1 if len(column) else 0
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for first in range(0, width, 8192):
        part = slice(*np.searchsorted(column, [first, first + 8192]))
        table = np.zeros((len(sets), 8192), np.float32)
        table[owner[part], column[part] - first] = 1.0
        total += table @ table.T
    return total


def _compare(similarity: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links and edges of groups that come one after the other."""
        current, members = None, []
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            for row in zip(*columns, strict=True):
                if row[:3] != current:
                    if members:
                        yield _linked(current, members, similarity)
                    current, members = row[:3], []
                members.append(row[3:])
        if members:
            yield _linked(current, members, similarity)

    return compare


def _linked(key: tuple, members: list[tuple], similarity: float) -> pa.RecordBatch:
    """``content, links, root``: of each set with a similar one, the rows it is linked to by pairs
    that count here, and the least member of its component here."""
    path, low, high = key
    members = sorted({row[0]: row for row in members}.values())
    ids = [row[0] for row in members]
    hashes, amounts = shingle_hashes([row[3] for row in members])
    cuts = np.cumsum(amounts)[:-1]
    sets = [np.unique(part) for part in np.split(hashes, cuts)]
    links = dict.fromkeys(ids, 0)
    found = UnionFind()
    if len(members) > 1:
        size = np.array([len(x) for x in sets], np.float64)
        both = _overlaps(sets)
        near = both * (1.0 + similarity) >= similarity * (size[:, None] + size[None, :]) - 1e-6
        if low != high:  # pairs within one block are compared where it meets itself
            block = np.array([row[1] for row in members])
            near &= block[:, None] != block[None, :]
        paths = [frozenset(row[4]) for row in members]
        for one, other in zip(*(side.tolist() for side in np.nonzero(np.triu(near, 1))), strict=True):
            found.union(ids[one], ids[other])
            if min(paths[one] & paths[other]) == path:
                links[ids[one]] += members[other][2]
                links[ids[other]] += members[one][2]
    linked = [ident for ident in ids if links[ident] or found.find(ident) != ident]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(linked, pa.binary()),
            pa.array([links[ident] for ident in linked], pa.int64()),
            pa.array([found.find(ident) for ident in linked], pa.binary()),
        ],
        ["content", "links", "root"],
    )


def near_join(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    recall: float = TARGET_RECALL,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id, n_links``.

    Rows are linked if the sets of five-word shingles of their texts (words as in
    ``decontamination.words``) have a Jaccard similarity of ``similarity`` or more; ``n_links`` is
    the number of other rows a row is linked to, copies counted, and ``class_id`` the least id of
    its connected component; ids are of any orderable type. A text of fewer than five words is one shingle. Null and empty texts,
    and texts without words, have no set: each is a class of its own without links. Rows that
    repeat, or have one id and different texts, are copies or texts like others; null ids too, but
    they are never the least id, so a class of null ids only has a null class id. Other columns
    are ignored, and an empty table gives no rows.

    Copies collapse into one set before the search. Sets whose node stays large, such as near
    copies by the thousand, are compared in blocks: a pair of blocks is one group, so no task holds
    more than two, and no pair is written, only counts and at most one edge a set and group. A pair
    that meets in several leaves counts in the least of them.
    """
    rows = docs.select(F.col(f"`{ident}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    slim = materialise(
        rows.mapInArrow(_sets, f"doc_id {kind}, content binary, signature array<int>"), "sets"
    )
    copies = materialise(
        slim.where(F.col("content").isNotNull())
        .groupBy("content")
        .agg(
            F.min("doc_id").alias("first"),
            F.count(F.lit(1)).alias("copies"),
            F.any_value("signature").alias("signature"),
        ),
        "copies",
    )
    leaves = materialise(_leaves(copies, similarity, recall), "leaves")
    compared = leaves.groupBy("content").agg(F.collect_list("path").alias("paths"))
    compared = materialise(compared.join(copies.drop("signature"), "content"), "compared")
    bits = compared.select(spread_bit(F.col("first")).alias("bit"))
    texts = _texts(rows, bitmap_of(bits)).dropDuplicates(["content"])
    full = materialise(compared.drop("first").join(texts, "content"), "texts")
    blocks = F.ceil(F.col("size") / BLOCK)
    dealt = (
        leaves.withColumn("block", F.pmod(F.xxhash64("content", F.lit(3)), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .select(
            "path",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "content",
            "block",
        )
        .join(full, "content")
        .select("path", "low", "high", "content", "block", "copies", "text", "paths")
    )
    key = ["path", "low", "high"]
    linked = materialise(
        dealt.repartition(*[F.col(name) for name in key])
        .sortWithinPartitions(*key)
        .mapInArrow(_compare(similarity), "content binary, links long, root binary"),
        "links",
    )
    roots = connected_components(linked.select("content", "root"))
    links = linked.groupBy("content").agg(F.sum("links").alias("links"))
    classes = (
        copies.drop("signature")
        .join(links, "content", "left")
        .join(roots.withColumnRenamed("node", "content"), "content", "left")
        .withColumn("root", F.coalesce("root", "content"))
    )
    classes = materialise(classes, "classes")
    least = classes.groupBy("root").agg(F.min("first").alias("class_id"))
    answers = classes.join(least, "root").select(
        "content",
        "class_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    found = slim.where(F.col("content").isNotNull()).join(answers, "content")
    without = slim.where(F.col("content").isNull()).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")
    )
    return found.select("doc_id", "class_id", "n_links").unionByName(without)


def keep_one_of_each(docs: DataFrame, ident: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` whose id is the class id of :func:`near_join`, in whole; of rows with the
    same id and text one stays. Rows with a null id stay, as nothing tells them apart."""
    found = near_join(docs, ident, text, **options)
    name = unused_name(docs.columns, "_kept")
    kept = found.where("doc_id = class_id").select(F.col("doc_id").alias(name)).distinct()
    others = docs.where(F.col(f"`{ident}`").isNull())
    chosen = docs.join(kept, F.col(f"`{ident}`") == F.col(name), "left_semi")
    return chosen.dropDuplicates([ident, text]).unionByName(others)
