"""Near copies of documents by fast similarity sketching, banding and exact verification.

A sketch has a fixed number of bins. In a round, every element of a set is thrown into one bin and
leaves its hash there if that is the least of the first round to reach the bin. Rounds go on until
all bins are full; from a fixed round on, each round fills one bin for certain. A large set is done
after one or two rounds, so a sketch costs little more than one hash an element, yet two sketches
agree in as many bins as the sets are similar, with strong concentration. Sets whose sketches agree
in a band of bins are candidates; all links are verified on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.session import materialise

from .components import UnionFind, connected_components
from .line_dedup import mixed
from .near_join import shingle_hashes

WORDS = 4  # of a shingle
PERCENT = 80  # similarity asked for
BINS = 64  # of a sketch: 16 bands of 4 find a pair of just 0.8 with 0.9998
BAND = 4  # bins of a band
HUB_ROUNDS = 2  # in which documents meet one document of their bucket
CHUNK = 1_000  # documents that meet one hub in one group
BLOCK_SHINGLES = 1 << 21  # of a block of a bucket: 16 MB of hashes
_CHUNK_BYTES = 1 << 20  # of text made into sketches at once
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = 0x9E3779B97F4A7C15


def words(text: str | None) -> list[bytes]:
    """What stands between blanks and the signs 9 to 13, A-Z in lower case; null has none."""
    return text.encode().lower().split() if text else []


def distinct_shingles(texts: list[str | None], size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different shingles of all texts, ascending for each, and their numbers."""
    hashes, amounts = shingle_hashes(texts, size, words)
    ends = np.cumsum(amounts)
    for start, end in zip((ends - amounts).tolist(), ends.tolist(), strict=True):
        hashes[start:end].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[(ends - amounts)[amounts > 0]] = True
    counted = np.concatenate([[0], np.cumsum(new)])
    return hashes[new], counted[ends] - counted[ends - amounts]


def sketches(hashes: np.ndarray, amounts: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The sketch of each set, none of them empty: per bin the round that filled it and the hash."""
    found = np.full(len(amounts) * bins, _EMPTY)
    first = np.arange(len(amounts)) * bins  # of each set
    owner = np.repeat(first, amounts)
    for turn in range(2 * bins):
        thrown = mixed(hashes + np.uint64((turn + 1) * _STEP % (1 << 64)))
        place = (thrown >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)
        if turn >= bins:
            place[:] = turn - bins
        value = np.uint64(turn << 32) | (thrown & np.uint64(0xFFFFFFFF))
        np.minimum.at(found, owner + place.astype(np.int64), value)
        open_sets = (found.reshape(-1, bins) == _EMPTY).any(1)
        left = open_sets[owner // bins]
        if not left.any():
            break
        if not left.all():
            owner, hashes = owner[left], hashes[left]
    return found.reshape(-1, bins)


def band_keys(sketch: np.ndarray, band: int = BAND) -> np.ndarray:
    """A key for each band of each sketch; bands of different places have different keys."""
    bands = sketch.shape[1] // band
    keys = np.zeros((len(sketch), bands), np.uint64)
    place = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for part in range(band):
        keys = mixed(keys + place + sketch[:, part::band][:, :bands])
    return keys.view(np.int64)


def contents(hashes: np.ndarray, amounts: np.ndarray) -> list[bytes]:
    """16 bytes for each set, none of them empty: equal for equal sets."""
    starts = np.cumsum(amounts) - amounts
    both = np.zeros((len(amounts), 2), np.uint64)
    if len(amounts):
        both[:, 0] = np.add.reduceat(mixed(hashes), starts)
        both[:, 1] = np.add.reduceat(mixed(hashes ^ np.uint64(_STEP)), starts) + mixed(amounts.astype(np.uint64))
    return [row.tobytes() for row in both]


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, digest, content, size, bands`` of each text; texts without words have size 0."""
    for batch in batches:
        texts = batch.column(2).to_pylist()
        low = 0
        while low < len(texts):
            high, length = low, 0
            while high < len(texts) and length < _CHUNK_BYTES:
                length += len(texts[high] or "")
                high += 1
            hashes, amounts = distinct_shingles(texts[low:high])
            some = amounts > 0
            keys = band_keys(sketches(hashes, amounts[some]))
            found = iter(contents(hashes, amounts[some]))
            offsets = np.concatenate([[0], np.cumsum(np.where(some, keys.shape[1], 0))])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, high - low),
                    batch.column(1).slice(low, high - low),
                    pa.array([next(found) if one else None for one in some], pa.binary()),
                    pa.array(amounts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.ravel(), pa.int64())),
                ],
                ["doc_id", "digest", "content", "size", "bands"],
            )
            low = high


def similar(size: int, other, both, percent: int = PERCENT):
    """Whether ``both`` common shingles are enough for sets of these sizes; other and both may be arrays."""
    return 100 * both >= percent * (size + other - both)


def _against_hub(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of documents to the hub that comes before them in the sorted rows."""
        hub = np.zeros(0, np.uint64)
        for batch in batches:
            names, roles, members, texts = (column.to_pylist() for column in batch.columns)
            hashes, amounts = distinct_shingles(texts)
            linked = []
            for row, part in enumerate(np.split(hashes, np.cumsum(amounts)[:-1])):
                if roles[row] == 0:
                    hub = part
                else:
                    both = len(np.intersect1d(hub, part, assume_unique=True))
                    if similar(len(hub), len(part), both, percent):
                        linked.append((members[row], names[row]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([pair[side] for pair in linked], pa.binary()) for side in (0, 1)], ["u", "v"]
            )

    return verify


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Of ``content, hub`` the similar pairs as ``u, v``. A hub's documents come in groups of about
    ``CHUNK``, each with the hub's text, so a hub of very many is spread."""
    counts = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("n"))
    dealt = materialise(
        pairs.join(counts, "hub").withColumn(
            "part", F.pmod(F.xxhash64("content", F.lit(5)), F.ceil(F.col("n") / CHUNK))
        ),
        "pairs",
    )
    members = dealt.select("hub", "part", F.lit(1).alias("role"), "content").join(texts, "content")
    hubs = dealt.select("hub", "part").distinct().withColumn("content", F.col("hub")).join(texts, "content")
    both = members.unionByName(hubs.withColumn("role", F.lit(0)))
    return (
        both.repartition("hub", "part")
        .sortWithinPartitions("hub", "part", "role")
        .select("hub", "role", "content", "text")
        .mapInArrow(_against_hub(percent), "u binary, v binary")
    )


def _linked(members: list[tuple], percent: int) -> list[tuple[bytes, bytes]]:
    """Links that join all classes of ``content, root, text`` between which there is any link."""
    hashes, amounts = distinct_shingles([row[2] for row in members])
    roots = UnionFind()
    known = [roots.find(row[1]) for row in members]
    names, label = np.unique(np.array(known, object), return_inverse=True)
    label = label.copy()
    # A pair of two classes has a document outside the largest class.
    often = np.bincount(label).argmax()
    order = np.flatnonzero(label != often)
    _, column, amount = np.unique(hashes, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(members)), amounts)
    shared = amount[column] > 1
    owner, column = owner[shared], column[shared]
    starts = np.searchsorted(owner, np.arange(len(members) + 1))
    marked = np.zeros(len(amount), bool)
    links = []
    for one in order.tolist():
        if (label == label[one]).all():
            break
        mine = column[starts[one] : starts[one + 1]]
        marked[mine] = True
        both = np.bincount(owner[marked[column]], minlength=len(members))
        marked[mine] = False
        near = similar(int(amounts[one]), amounts, both, percent) & (label != label[one])
        for other in np.flatnonzero(near).tolist():
            if label[other] != label[one]:
                links.append((members[one][0], members[other][0]))
                label[label == label[other]] = label[one]
    return links


def _compared(percent: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of groups that come one after the other."""
        current, members = None, []

        def close() -> pa.RecordBatch:
            links = _linked(members, percent)
            return pa.RecordBatch.from_arrays(
                [pa.array([pair[side] for pair in links], pa.binary()) for side in (0, 1)], ["u", "v"]
            )

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if row[:3] != current:
                    if members:
                        yield close()
                    current, members = row[:3], []
                members.append(row[3:])
        if members:
            yield close()

    return compare


def _remaining(groups: DataFrame, roots: DataFrame) -> DataFrame:
    """``bucket, content, size, root`` of the buckets that hold several classes."""
    labelled = groups.join(roots.select(F.col("node").alias("content"), "root"), "content", "left").withColumn(
        "root", F.coalesce("root", "content")
    )
    labelled = materialise(labelled, "labelled")
    several = labelled.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b")
    return materialise(labelled.join(several.select("bucket"), "bucket"), "remaining")


def _hub_pairs(groups: DataFrame, tested: DataFrame | None) -> DataFrame:
    """``content, hub``: for each document the hub of one of its buckets that it was not compared
    with. A bucket's hub is of its most frequent class, so the few others come to it."""
    classes = groups.groupBy("bucket", "root").agg(
        F.count(F.lit(1)).alias("n"), F.min("content").alias("hub")
    )
    hubs = classes.groupBy("bucket").agg(F.max(F.struct("n", "hub", "root")).alias("best")).select(
        "bucket", F.col("best.hub").alias("hub"), F.col("best.root").alias("hub_root")
    )
    pairs = groups.join(hubs, "bucket").where("content <> hub and root <> hub_root").select("content", "hub")
    if tested is not None:
        pairs = pairs.join(tested, ["content", "hub"], "left_anti")
    return pairs.groupBy("content").agg(F.min("hub").alias("hub"))


def _classes(groups: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``node, root`` of the documents that are linked: the components of all links inside buckets.

    First documents meet a hub of a bucket of theirs, so that most buckets hold one class and need
    no more. What is left is compared in full, in pairs of blocks of bounded size.
    """
    edges = tested = None
    labelled = groups.withColumn("root", F.col("content"))
    for _ in range(HUB_ROUNDS):
        pairs = materialise(_hub_pairs(labelled, tested), "hubs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = materialise(_verified(pairs, texts, percent), "links")
        edges = found if edges is None else edges.unionByName(found)
        roots = connected_components(edges)
        labelled = _remaining(groups, roots)
        if labelled.isEmpty():
            return roots
    # A bucket of two documents that were compared is done.
    done = (
        labelled.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("a"), F.max("content").alias("b"))
        .where("n = 2")
        .join(
            tested.select(F.least("content", "hub").alias("a"), F.greatest("content", "hub").alias("b")),
            ["a", "b"],
            "left_semi",
        )
    )
    left = labelled.join(done.select("bucket"), "bucket", "left_anti")
    sums = left.groupBy("bucket").agg(F.ceil(F.sum("size") / BLOCK_SHINGLES).alias("blocks"))
    dealt = (
        left.join(sums, "bucket")
        .withColumn("block", F.pmod(F.xxhash64("content", F.lit(3)), "blocks"))
        .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .select(
            "bucket",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "content",
            "root",
        )
        .join(texts, "content")
        .select("bucket", "low", "high", "content", "root", "text")
    )
    key = ["bucket", "low", "high"]
    rest = (
        dealt.repartition(*[F.col(name) for name in key])
        .sortWithinPartitions(*key)
        .mapInArrow(_compared(percent), "u binary, v binary")
    )
    rest = materialise(rest, "rest")
    return roots if rest.isEmpty() else connected_components(edges.unionByName(rest))


def near_copies(
    docs: DataFrame, ident: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked if their sets of four-word shingles (words as in :func:`words`) have
    ``percent`` hundredths of their union in common; ``component_id`` is the least id of a connected
    component, and ``kept`` tells whether it is the row's own. A text of fewer words is one shingle;
    null and empty texts and texts without words have no shingle, are linked with nothing and kept.
    Ids may be of any orderable type. Rows that repeat are copies: all have the same answer, so
    rows of one id are all kept or none. A null id is never the least; a component of null ids only
    has a null ``component_id``, and rows with a null id are kept only then. Other columns are
    ignored, an empty table gives no rows.

    Equal sets collapse before the search, so copies, however many, cost one candidate. Texts of
    candidates only are read again. No task holds more than two blocks of a bucket.
    """
    rows = docs.select(F.col(f"`{ident}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.withColumn("digest", F.xxhash64("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, digest long, content binary, size long, bands array<long>"
    slim = materialise(rows.select("doc_id", "digest", "text").mapInArrow(_sets, schema), "sketches")
    copies = materialise(
        slim.where("size > 0")
        .groupBy("content")
        .agg(
            F.min("doc_id").alias("first"),
            F.min(F.struct("doc_id", "digest")).alias("source"),
            F.any_value("size").alias("size"),
            F.any_value("bands").alias("bands"),
        ),
        "copies",
    )
    members = materialise(copies.select("content", "size", F.explode("bands").alias("bucket")), "members")
    alone = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("content").cast("decimal(38,0)")).alias("sum"),
        F.bit_xor(F.xxhash64("content", F.lit(7))).alias("xor"),
    )
    # Buckets of the same documents are looked at once.
    chosen = alone.where("n > 1").groupBy("n", "sum", "xor").agg(F.min("bucket").alias("bucket"))
    groups = materialise(members.join(chosen.select("bucket"), "bucket"), "groups")
    wanted = copies.join(groups.select("content").distinct(), "content").select(
        "content", F.col("source.doc_id").alias("source_id"), F.col("source.digest").alias("source_digest")
    )
    found = rows.join(
        wanted, (F.col("digest") == F.col("source_digest")) & F.col("doc_id").eqNullSafe(F.col("source_id"))
    )
    texts = materialise(found.select("content", "text").dropDuplicates(["content"]), "texts")
    roots = _classes(groups, texts, percent)
    classes = materialise(
        copies.select("content", "first")
        .join(roots.select(F.col("node").alias("content"), "root"), "content", "left")
        .withColumn("root", F.coalesce("root", "content")),
        "classes",
    )
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    answers = classes.join(least, "root").select("content", "component_id")
    linked = slim.where("size > 0").select("doc_id", "size", "content").join(answers, "content")
    without = slim.where("size = 0").select("doc_id", "size", F.col("doc_id").alias("component_id"))
    both = linked.select("doc_id", "size", "component_id").unionByName(without)
    return both.select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def recall(similarity: float, bins: int = BINS, band: int = BAND) -> float:
    """Chance that a pair of this similarity shares a band, bins taken as independent."""
    return 1.0 - math.pow(1.0 - math.pow(similarity, band), bins // band)
