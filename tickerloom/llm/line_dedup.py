"""Fuzzy deduplication of lines by MinHash.

Lines are compared as sets of shingles of 8 UTF-8 bytes. A signature of the least hashes in each of
a number of bins is cut into bands; lines that share a band are candidates; their exact Jaccard
similarity decides; one line of each connected component stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.session import materialise

from .components import BITMAP_BITS, bitmap_of, connected_components

SIMILARITY = 0.8
SHINGLE = 8  # bytes
BANDS, ROWS = 10, 4  # finds a pair of similarity 0.8 with probability 0.995
BLOCK_LINES, BLOCK_BYTES = 512, 1 << 20  # of a block of a bucket; two blocks are held at once
_BINS = BANDS * ROWS
_CHUNK = 1 << 18  # bytes hashed at once
_SLICE = 256  # texts held as lines at once
_TOGETHER = 1 << 15  # bytes of small groups of lines compared at once
_CANDIDATES = 1 << 18  # pairs of a line and a shingle's other line, expanded at once
_KNOWN = 200_000  # digests a task remembers, for speed only: a line met again has its bands again

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def normalised(line: str) -> bytes:
    """Lower case, white space as single blanks; what lines are compared by."""
    return " ".join(line.lower().split()).encode()


def normalised_lines(text: str | None) -> list[bytes]:
    """:func:`normalised` of each line. In most texts a blank is all white space there is, and single
    inside lines, so only the case changes; such a text is cut as a whole."""
    if not text:
        return []
    text = text.lower()
    # Of all white space only the blank is printable.
    single = text.replace("\n", "").isprintable() and not any(x in text for x in ("  ", " \n", "\n "))
    if single and text[0] != " " and text[-1] != " ":
        return text.encode().split(b"\n")
    return [" ".join(line.split()).encode() for line in text.split("\n")]


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(30))
    values *= _MIX
    values ^= values >> np.uint64(27)
    values *= _MIX2
    values ^= values >> np.uint64(31)
    return values


def shingles(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of all lines, 8 bytes as a number, and the line of each. A shorter line is one
    shingle, filled up with zeros."""
    padded = [line if len(line) >= SHINGLE else line.ljust(SHINGLE, b"\0") for line in lines]
    amount = np.array([len(line) - SHINGLE + 1 for line in padded], np.int64)
    data = b"".join(padded)
    # Every 8 neighbouring bytes as one number.
    windows = np.ndarray((len(data) - SHINGLE + 1,), "<u8", data, 0, (1,))
    starts = np.cumsum([0] + [len(line) for line in padded[:-1]])
    owner = np.repeat(np.arange(len(lines)), amount)
    place = np.arange(int(amount.sum())) + np.repeat(starts - (np.cumsum(amount) - amount), amount)
    return windows[place], owner


def band_hashes(lines: list[bytes]) -> np.ndarray:
    """``BANDS`` hashes a line. Each shingle's hash falls into one bin and competes for its least
    value there; an empty bin takes the value of the next full one, moved by the distance."""
    padded = [line if len(line) >= SHINGLE else line.ljust(SHINGLE, b"\0") for line in lines]
    length = np.fromiter(map(len, padded), np.int64, len(padded))
    data = b"".join(padded)
    hashes = mixed(np.ndarray((len(data) - SHINGLE + 1,), "<u8", data, 0, (1,)) * _GOLDEN)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    # Eight bytes that reach into the next line are no shingle.
    hashes[(np.cumsum(length)[:-1, None] - np.arange(1, SHINGLE)).ravel()] = empty
    bins = hashes >> np.uint64(40)
    bins *= np.uint64(_BINS)
    bins >>= np.uint64(24)
    place = bins.view(np.int64)
    place += np.repeat(np.arange(len(lines)) * _BINS, length)[: len(hashes)]
    least = np.full(len(lines) * _BINS, empty)
    np.minimum.at(least, place, hashes)
    signature = least.reshape(len(lines), _BINS)
    holes = signature == empty
    if holes.any():
        rounds = np.concatenate([signature, signature], axis=1)
        full = np.where(rounds == empty, 2 * _BINS, np.arange(2 * _BINS))
        source = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1][:, :_BINS]
        distance = (source - np.arange(_BINS)).astype(np.uint64)
        signature = np.take_along_axis(rounds, source, axis=1) + distance * _GOLDEN
    band = np.zeros((len(lines), BANDS), np.uint64)
    for row in range(ROWS):
        band = mixed(band * _GOLDEN + signature[:, row::ROWS] + np.uint64(1))
    return mixed(band + np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX).view(np.int64)


def shingle_set(line: bytes) -> np.ndarray:
    """The different shingles of one line, ascending."""
    padded = line.ljust(SHINGLE, b"\0")
    values = np.ndarray((len(padded) - SHINGLE + 1,), "<u8", padded, 0, (1,)).copy()
    values.sort()
    return values[np.append(True, values[1:] != values[:-1])]


def overlap(one: np.ndarray, other: np.ndarray) -> float:
    """Jaccard similarity of two sets, each without repeats."""
    merged = np.concatenate((one, other))
    merged.sort()
    both = np.count_nonzero(merged[1:] == merged[:-1])
    return both / (len(one) + len(other) - both)


def jaccard(a: bytes, b: bytes) -> float:
    """Exact similarity of two normalised lines."""
    return overlap(shingle_set(a), shingle_set(b))


def _digest(line: bytes) -> bytes:
    return xxhash.xxh3_128_digest(line)


def _columns(digests: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """The first 8 bytes of each digest as a number, and the digests."""
    joined = b"".join(digests)
    ends = np.arange(0, len(joined) + 1, 16, dtype=np.int32)
    column = pa.Array.from_buffers(pa.binary(), len(digests), [None, pa.py_buffer(ends), pa.py_buffer(joined)])
    return np.frombuffer(joined, "<i8")[::2], column


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _SLICE):
            yield batch.slice(start, _SLICE)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, line, digest, short, bands`` of each line. Copies of a line have the same bands, so
    a line of which the task remembers an earlier copy has none."""
    known: set[bytes] = set()
    for batch in _sliced(batches):
        if len(known) > _KNOWN:
            known.clear()
        rows, numbers, digests, fresh, values = [], [], [], [], []
        seen: dict[bytes, bytes] = {}
        for row, text in enumerate(batch.column(1).to_pylist()):
            for number, line in enumerate(normalised_lines(text)):
                if not line:
                    continue
                digest = seen.get(line)
                if digest is None:
                    digest = seen[line] = _digest(line)
                    new = digest not in known
                    if new:
                        known.add(digest)
                        values.append(line)
                else:
                    new = False
                fresh.append(new)
                rows.append(row)
                numbers.append(number)
                digests.append(digest)
        bands = _in_chunks(values)
        offsets = np.concatenate([[0], np.cumsum(np.where(fresh, BANDS, 0))]) if fresh else np.zeros(1)
        short, column = _columns(digests)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(rows, pa.int32())),
                pa.array(numbers, pa.int32()),
                column,
                pa.array(short, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(bands.ravel(), pa.int64())),
            ],
            ["doc_id", "line", "digest", "short", "bands"],
        )


def _in_chunks(lines: list[bytes]) -> np.ndarray:
    parts, chunk, size = [np.zeros((0, BANDS), np.int64)], [], 0
    for line in lines:
        chunk.append(line)
        size += len(line)
        if size > _CHUNK:
            parts.append(band_hashes(chunk))
            chunk, size = [], 0
    if chunk:
        parts.append(band_hashes(chunk))
    return np.concatenate(parts)


def _similar(similarity: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Pairs come in order of b, so its shingles often serve the next pair too.
            last, other = None, np.zeros(0, "<u8")
            found = []
            for x, y, s, t in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if x == y:
                    continue
                if y != last:
                    last, other = y, shingle_set(t)
                one = shingle_set(s)
                # No similarity is above the ratio of the sizes.
                if min(len(one), len(other)) < similarity * max(len(one), len(other)):
                    continue
                if overlap(one, other) >= similarity:
                    found.append((x, y))
            yield pa.RecordBatch.from_arrays(
                [pa.array([pair[side] for pair in found], pa.binary()) for side in (0, 1)], ["a", "b"]
            )

    return verify


def _values(rows: DataFrame, bitmap: bytes) -> DataFrame:
    """``short, digest, value`` of the lines that may be candidates, each once."""
    sent = rows.sparkSession.sparkContext.broadcast(bitmap)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sent.value, np.uint8)
        for batch in _sliced(batches):
            different: set[bytes] = set()
            for text in batch.column(0).to_pylist():
                different.update(normalised_lines(text))
            different.discard(b"")
            lines = list(different)
            short, digests = _columns(list(map(_digest, lines)))
            place = short % BITMAP_BITS
            chosen = np.flatnonzero(bits[place >> 3] >> (place & 7).astype(np.uint8) & 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(short[chosen], pa.int64()),
                    digests.take(pa.array(chosen, pa.int64())),
                    pa.array([lines[n] for n in chosen.tolist()], pa.binary()),
                ],
                ["short", "digest", "value"],
            )

    return (
        rows.select("text")
        .mapInArrow(wanted, "short long, digest binary, value binary")
        .dropDuplicates(["digest"])
    )


def _buckets(occurrences: DataFrame) -> DataFrame:
    """``band, short, low, high, size``: the lines of each band bucket of two lines or more, with the
    bucket's least and its greatest line, by the first 8 bytes of the digests."""
    keyed = occurrences.where(F.size("bands") > 0).select(
        F.col("short"), F.explode("bands").alias("band")
    )
    # One shuffle serves the aggregate and the join.
    keyed = keyed.repartition(F.col("band"))
    hubs = (
        keyed.groupBy("band")
        .agg(F.min("short").alias("low"), F.max("short").alias("high"), F.count(F.lit(1)).alias("size"))
        .where("low < high")
    )
    return keyed.join(hubs, "band")


def _candidates(buckets: DataFrame) -> DataFrame:
    """``a, b``: each line of a bucket with the two hubs. A bucket of n lines gives 2 n pairs at most;
    :func:`_rest` compares the others."""
    hub: Column = F.explode(F.array("low", "high")).alias("hub")
    return (
        buckets.select("short", hub)
        .where("short <> hub")
        .select(F.least("short", "hub").alias("a"), F.greatest("short", "hub").alias("b"))
        .distinct()
    )


def _joined(groups: list[list[tuple]], similarity: float) -> list[tuple[bytes, bytes]]:
    """Pairs of roots that similar lines of one group join; a group's members are (block, root, line)
    of two blocks, of which pairs across are compared, or of one.

    Shingles are ordered by how often they occur, rarest first. Of two similar lines the longer one's
    first shingles and the shorter one's hold a common one, so only those are looked up. Groups are
    mostly small, so the lines of all groups are prepared together.
    """
    members = [member for group in groups for member in group]
    if not members:
        return []
    amounts = np.array([len(group) for group in groups])
    group = np.repeat(np.arange(len(groups)), amounts)
    opening = np.cumsum(amounts) - amounts  # the first line of each group
    block = np.array([member[0] for member in members])
    across = (np.minimum.reduceat(block, opening) != np.maximum.reduceat(block, opening))[group]
    values, owner = shingles([member[2] for member in members])
    column, amount = np.unique(values, return_inverse=True, return_counts=True)[1:]
    rank = np.empty(len(amount), np.int64)
    rank[np.argsort(amount, kind="stable")] = np.arange(len(amount))
    single = int(np.count_nonzero(amount == 1))  # lines share no shingle of a rank below
    ranked = np.sort(owner * len(rank) + rank[column])
    ranked = ranked[np.append(True, ranked[1:] != ranked[:-1])]
    owner = ranked // len(rank)
    ranked -= owner * len(rank)
    size = np.bincount(owner, minlength=len(members))
    # Within a group the shorter lines come first.
    order = np.lexsort((size, group))
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    ranked = np.sort(number[owner] * len(rank) + ranked)
    size, block = size[order], block[order]
    owner = np.repeat(np.arange(len(size)), size)
    ranked -= owner * len(rank)
    roots = [(g, members[n][1]) for g, n in zip(group.tolist(), order.tolist(), strict=True)]
    names = sorted(set(roots))
    named = {name: n for n, name in enumerate(names)}
    component = np.array([named[root] for root in roots])
    ends = np.cumsum(size)
    place = np.arange(len(ranked)) - (ends - size)[owner]
    # A line shares this much at least with a line as long or longer, or with a shorter one.
    longer = np.ceil(2 * similarity / (1 + similarity) * size - 1e-6).astype(np.int64)
    shorter = np.ceil(similarity * size - 1e-6).astype(np.int64)
    listed = (place <= (size - longer)[owner]) & (ranked >= single)
    index = np.sort(ranked[listed] * len(size) + owner[listed])  # lines ascend within a shingle
    wanted = (place <= (size - shorter)[owner]) & (ranked >= single)
    line, sought = owner[wanted], ranked[wanted] * len(size)
    lows = np.searchsorted(index, sought + opening[group[line]])
    many = np.searchsorted(index, sought + line) - lows
    marked = np.zeros(len(rank), bool)
    found: list[tuple[bytes, bytes]] = []
    if not len(line):
        return found
    # Slices of whole lines, of so many candidates or of one line.
    total = np.cumsum(many)
    stops = np.flatnonzero(np.append(line[1:] != line[:-1], True)) + 1
    start = 0
    while start < len(line):
        before = total[start - 1] if start else 0
        stop = stops[min(np.searchsorted(total[stops - 1], before + _CANDIDATES, "right"), len(stops) - 1)]
        if stop <= start:
            stop = stops[np.searchsorted(stops, start, "right")]
        some = many[start:stop]
        at = np.arange(int(some.sum())) + np.repeat(lows[start:stop] - (np.cumsum(some) - some), some)
        near = index[at] % len(size)
        pairs = np.unique(np.repeat(line[start:stop], some) * len(size) + near)
        one, near = pairs // len(size), pairs % len(size)
        alike = (size[near] >= similarity * size[one] - 1e-6) & (component[near] != component[one])
        alike &= ~across[one] | (block[near] != block[one])
        last = -1
        for this, other in zip(one[alike].tolist(), near[alike].tolist(), strict=True):
            if component[other] == component[this]:
                continue
            if this != last:
                if last >= 0:
                    marked[own] = False
                last, own = this, ranked[ends[this] - size[this] : ends[this]]
                marked[own] = True
            both = int(np.count_nonzero(marked[ranked[ends[other] - size[other] : ends[other]]]))
            if both / (size[other] + size[this] - both) >= similarity:
                found.append((names[component[other]][1], names[component[this]][1]))
                component[component == component[other]] = component[this]
        if last >= 0:
            marked[own] = False
        start = stop
    return found


def _joining(similarity: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Edges of groups that come one after the other."""
        current, members, groups, size = None, [], [], 0

        def edges() -> pa.RecordBatch:
            pairs = _joined(groups, similarity)
            return pa.RecordBatch.from_arrays(
                [pa.array([pair[side] for pair in pairs], pa.binary()) for side in (0, 1)], ["a", "b"]
            )

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if row[:3] != current:
                    if len(members) > 1:
                        groups.append(members)
                        size += sum(SHINGLE + len(member[2]) for member in members)
                    if size >= _TOGETHER:
                        yield edges()
                        groups, size = [], 0
                    current, members = row[:3], []
                members.append(row[3:])
        if len(members) > 1:
            groups.append(members)
        if groups:
            yield edges()

    return compare


def _rest(buckets: DataFrame, values: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: pairs of roots joined by similar lines of one bucket that are not hubs.

    Lines of one component need no comparison, so only buckets of several components are left; of
    three lines all pairs are done. All pairs of such a bucket are compared, by pairs of blocks: no
    task holds more than two blocks, and at most one edge a line and group is written. Buckets of the
    same lines are compared once.
    """
    lines = values.select("short", "digest", F.length("value").alias("bytes")).join(
        roots.withColumnRenamed("node", "digest"), "digest", "left"
    )
    lines = lines.withColumn("root", F.coalesce("root", "digest"))
    members = materialise(
        buckets.where("size > 3").select("band", "short").distinct().join(lines, "short").drop("short"), "members"
    )
    open_ = (
        members.groupBy("band")
        .agg(
            F.min("root").alias("low"),
            F.max("root").alias("high"),
            F.count(F.lit(1)).alias("size"),
            F.sum("bytes").alias("bytes"),
            F.sum(F.xxhash64("digest").cast("decimal(38,0)")).alias("sum"),
            F.bit_xor(F.xxhash64("digest", F.lit(7))).alias("xor"),
        )
        .where("low < high and size > 3")
        .groupBy("size", "bytes", "sum", "xor")
        .agg(F.min("band").alias("band"))
    )
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK_LINES, F.col("bytes") / BLOCK_BYTES))
    dealt = (
        members.drop("bytes")
        .join(open_.select("band", blocks.alias("blocks")), "band")
        .withColumn("block", F.pmod(F.xxhash64("digest", F.lit(3)), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "band",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "block",
            "root",
            "digest",
        )
        .join(values.select("digest", "value"), "digest")
        .select("band", "low", "high", "block", "root", "value")
    )
    key = ["band", "low", "high"]
    return (
        dealt.repartition(*[F.col(name) for name in key])
        .sortWithinPartitions(*key)
        .mapInArrow(_joining(similarity), "a binary, b binary")
    )


def duplicate_lines(docs: DataFrame, ident: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, removed``: the numbers, from 0 and ascending, of the lines of a document that are
    near copies of an earlier line; documents that keep all their lines are left out.

    Lines are parts of a text between line breaks; they are compared after lower-casing and with
    white space as single blanks. Lines of a Jaccard similarity of ``similarity`` or more are linked,
    and of each connected component the line of the least (id, number) stays. Blank lines are never
    duplicates; null and empty texts have none. Lines shorter than a shingle match only equal ones.
    Ids are of any orderable type; a null id is the least id. Rows that repeat an id share one answer: a number that is a
    duplicate in one of them is listed for the id.

    Exact copies are joined by a digest of 16 bytes and travel once. Texts are read a second time
    for the candidates only, which a bitmap of fixed size picks out beforehand.
    """
    rows = docs.select(F.col(f"`{ident}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    occurrences = materialise(
        rows.mapInArrow(_occurrences, f"doc_id {kind}, line int, digest binary, short long, bands array<long>"),
        "lines",
    )
    buckets = materialise(_buckets(occurrences), "buckets")
    pairs = materialise(_candidates(buckets), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("short"))
    bits = ends.select(F.pmod("short", F.lit(BITMAP_BITS)).alias("bit"))
    values = materialise(
        _values(rows, bitmap_of(bits)).join(ends.distinct(), "short", "left_semi"), "values"
    )
    one = values.select(F.col("short").alias("a"), F.col("digest").alias("digest_a"), F.col("value").alias("text_a"))
    two = values.select(F.col("short").alias("b"), F.col("digest").alias("digest_b"), F.col("value").alias("text_b"))
    verified = (
        pairs.join(one, "a")
        .join(two, "b")
        .select("digest_a", "digest_b", "text_a", "text_b")
        .mapInArrow(_similar(similarity), "a binary, b binary")
    )
    roots = connected_components(verified)
    # Components joined by the pairs of a bucket without a hub.
    further = connected_components(_rest(buckets, values, roots, similarity))
    further = further.select(F.col("node").alias("root"), F.col("root").alias("further"))
    place = F.struct("doc_id", "line")
    firsts = occurrences.groupBy("digest").agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("copies")
    )
    classes = firsts.join(roots.withColumnRenamed("node", "digest"), "digest", "left").withColumn(
        "root", F.coalesce("root", "digest")
    )
    classes = classes.join(further, "root", "left").withColumn("root", F.coalesce("further", "root"))
    classes = materialise(classes.drop("further"), "classes")
    kept = classes.groupBy("root").agg(
        F.min("first").alias("kept"), (F.sum("copies") > 1).alias("repeated")
    )
    repeated = classes.join(kept.where("repeated").drop("repeated"), "root").select("digest", "kept")
    return (
        occurrences.select("doc_id", "line", "digest")
        .join(repeated, "digest")
        .where(~((F.col("doc_id").eqNullSafe(F.col("kept.doc_id"))) & (F.col("line") == F.col("kept.line"))))
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_set("line")).alias("removed"))
    )


def _with_removed(docs: DataFrame, removed: DataFrame, ident: str) -> DataFrame:
    found = removed.select(F.col("doc_id").alias("_id"), F.col("removed").alias("_removed"))
    none = F.array().cast("array<int>")
    joined = docs.join(found, F.col(f"`{ident}`").eqNullSafe(F.col("_id")), "left").drop("_id")
    return joined.withColumn("_removed", F.coalesce("_removed", none))


def line_counts(docs: DataFrame, ident: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_lines, n_kept, removed``; see
    :func:`duplicate_lines`. Blank lines count; a null text has none, an empty one a blank line."""
    removed = duplicate_lines(docs, ident, text, **options)
    slim = docs.select(
        F.col(f"`{ident}`").alias("doc_id"),
        F.coalesce(F.size(F.split(F.col(f"`{text}`"), "\n", -1)), F.lit(0)).alias("n_lines"),
    )
    counted = _with_removed(slim, removed, "doc_id").withColumn(
        "_removed", F.filter("_removed", lambda line: line < F.col("n_lines"))
    )
    return counted.select(
        "doc_id", "n_lines", (F.col("n_lines") - F.size("_removed")).alias("n_kept"), F.col("_removed").alias("removed")
    )


def dedup_lines(docs: DataFrame, ident: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the duplicate lines of :func:`duplicate_lines`. Rows of which no line but
    blank ones would be left go; rows without duplicates stay as they are."""
    removed = duplicate_lines(docs, ident, text, **options)
    places = {name: f"c{place}" for place, name in enumerate(docs.columns)}  # no name clashes with ours
    joined = _with_removed(docs.toDF(*places.values()), removed, places[ident])
    lines = F.split(places[text], "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_removed"))
    shorter = F.array_join(F.transform(left, lambda number: F.get(lines, number)), "\n")
    cut = (F.size("_removed") > 0) & F.col(places[text]).isNotNull()
    changed = joined.withColumn("_text", F.when(cut, shorter).otherwise(F.col(places[text])))
    return changed.where(~cut | F.col("_text").rlike("\\S")).select(
        *[F.col("_text" if name == text else place).alias(name) for name, place in places.items()]
    )
