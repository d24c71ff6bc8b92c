"""Removal of benchmark passages from training text with an FM-index per shard.

The texts of a shard, as sequences of word numbers, are indexed: suffix array, Burrows-Wheeler
transform, a wavelet tree for ranks, and sampled suffix positions. Each window of a benchmark item
is searched backward; its occurrences are located by stepping to a sampled position, and the spans
found are merged. The corpus may be of any size, as a shard is one batch of rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
SAMPLE_EVERY = 8  # suffix positions kept
BLOCK_ITEMS = 20_000  # benchmark items searched in one pass over the texts
SHARD_WORDS = 4_000_000  # words indexed together

# Lower case for A-Z; every byte that is no word byte becomes a blank.
_FOLD = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if 48 <= byte <= 57 or 97 <= byte <= 122 or byte >= 128 else 32
    for byte in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case; null has none."""
    return text.encode().translate(_FOLD).split() if text else []


class WaveletTree:
    """Ranks over a sequence of symbols: one bit vector a bit of the symbol, ones after zeros."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self._levels = []
        for bit in range(int(largest).bit_length() - 1, -1, -1):
            ones = ((symbols >> bit) & 1).astype(np.int64)
            before = np.concatenate([[0], np.cumsum(ones)])  # ones before each place
            zeros = len(symbols) - int(before[-1])
            self._levels.append((bit, before, zeros))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each ``symbol`` stands before the ``place`` beside it."""
        start = np.zeros_like(place)
        for bit, before, zeros in self._levels:
            one = ((symbol >> bit) & 1).astype(bool)
            start_ones, place_ones = before[start], before[place]
            start = np.where(one, zeros + start_ones, start - start_ones)
            place = np.where(one, zeros + place_ones, place - place_ones)
        return place - start

    def symbol(self, place: np.ndarray) -> np.ndarray:
        found = np.zeros_like(place)
        for _, before, zeros in self._levels:
            one = before[place + 1] - before[place]
            found = 2 * found + one
            place = np.where(one == 1, zeros + before[place], place - before[place])
        return found


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling the compared length until all differ."""
    size = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    length = 1
    while True:
        second = np.zeros(size, np.int64)
        second[: size - length] = rank[length:] + 1
        key = rank * (size + 1) + second
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(size, np.int64)
        rank[order] = new
        length *= 2
        if new[-1] == size - 1 or length >= size:
            return order


class FmIndex:
    """Counts and places of word sequences in a text whose last symbol is the only 0."""

    def __init__(self, symbols: np.ndarray):
        order = suffix_array(symbols)
        transform = symbols[order - 1]
        largest = int(symbols.max())
        self.size = len(symbols)
        self._tree = WaveletTree(transform, max(largest, 1))
        counts = np.bincount(symbols, minlength=largest + 2)
        self._first = np.concatenate([[0], np.cumsum(counts)])
        self._largest = largest
        sampled = order % SAMPLE_EVERY == 0
        self._sampled = sampled
        self._sample_rank = np.concatenate([[0], np.cumsum(sampled)])
        self._samples = order[sampled]

    def ranges(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffix array that begin with each pattern; patterns of one length, a row
        each. All are extended to the left at once."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.size, np.int64)
        alive = np.arange(len(patterns))
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, column]
            known = symbol <= self._largest
            alive, symbol = alive[known], symbol[known]
            first = self._first[symbol]
            new_low = first + self._tree.rank(symbol, low[alive])
            new_high = first + self._tree.rank(symbol, high[alive])
            low[:], keep = 0, new_low < new_high
            high[:] = 0
            alive = alive[keep]
            low[alive], high[alive] = new_low[keep], new_high[keep]
            if not len(alive):
                break
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix array: steps to the left until a kept position."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        todo = np.flatnonzero(~self._sampled[rows])
        while len(todo):
            place = rows[todo]
            symbol = self._tree.symbol(place)
            rows[todo] = self._first[symbol] + self._tree.rank(symbol, place)
            steps[todo] += 1
            todo = todo[~self._sampled[rows[todo]]]
        return self._samples[self._sample_rank[rows]] + steps


class Windows:
    """The windows of a block of benchmark items, by length."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set[int]]] = {}
        self.shortest = window
        for item, text in items:
            found = words(text)
            if not found:
                continue
            numbers = [self.vocabulary.setdefault(word, len(self.vocabulary) + 2) for word in found]
            length = min(window, len(numbers))
            self.shortest = min(self.shortest, length)
            table = by_length.setdefault(length, {})
            for start in range(len(numbers) - length + 1):
                table.setdefault(tuple(numbers[start : start + length]), set()).add(item)
        self.by_length = {
            length: (np.array(list(table), np.int64), [sorted(x) for x in table.values()])
            for length, table in by_length.items()
        }

    def search(self, texts: list[list[bytes]]) -> dict[int, list[tuple[int, int, list[int]]]]:
        """(first word, end, items) of every occurrence, by number of the text.

        A window holds benchmark words only. So only runs of such words that are long enough for
        the shortest window are indexed, each closed by symbol 1, which no window holds; symbol 0
        ends the whole.
        """
        number = self.vocabulary.get
        pieces, owners, starts = [], [], []
        for owner, text in enumerate(texts):
            if len(text) < self.shortest:
                continue
            known = np.array([number(word, 0) for word in text], np.int64)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], known != 0, [0]])))
            for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if end - start >= self.shortest:
                    pieces.append(known[start:end])
                    pieces.append(_CLOSE)
                    owners.append(owner)
                    starts.append(start)
        if not pieces:
            return {}
        offsets = np.cumsum([0] + [len(piece) + 1 for piece in pieces[::2]])
        index = FmIndex(np.concatenate([*pieces, _END]))
        hits: dict[int, list[tuple[int, int, list[int]]]] = {}
        for length, (patterns, items) in self.by_length.items():
            low, high = index.ranges(patterns)
            amount = high - low
            which = np.repeat(np.arange(len(patterns)), amount)
            if not len(which):
                continue
            rows = np.arange(len(which)) - np.repeat(np.cumsum(amount) - amount, amount) + low[which]
            places = index.locate(rows)
            runs = np.searchsorted(offsets, places, side="right") - 1
            for pattern, place, run in zip(which.tolist(), places.tolist(), runs.tolist(), strict=True):
                start = starts[run] + place - int(offsets[run])
                hits.setdefault(owners[run], []).append((start, start + length, items[pattern]))
        return hits


_CLOSE = np.ones(1, np.int64)
_END = np.zeros(1, np.int64)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that touch or overlap, joined."""
    joined: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return joined


_HITS = pa.struct(
    [
        ("n_words", pa.int64()),
        ("starts", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())),
        ("items", pa.list_(pa.int64())),
    ]
)


def _scan(windows: Windows, values: list[str | None], before: list[dict]) -> list[dict]:
    """Hits of one batch, added to those of earlier blocks; cut into shards by words."""
    found = []
    shard: list[list[bytes]] = []
    size = 0

    def close() -> None:
        hits = windows.search(shard)
        for place, text in enumerate(shard):
            earlier = before[len(found)]
            spans = [(start, end) for start, end, _ in hits.get(place, ())]
            items = {item for _, _, of in hits.get(place, ()) for item in of}
            if earlier is not None:
                spans += zip(earlier["starts"], earlier["ends"], strict=True)
                items |= set(earlier["items"])
            joined = merged(spans)
            found.append(
                {
                    "n_words": len(text),
                    "starts": [start for start, _ in joined],
                    "ends": [end for _, end in joined],
                    "items": sorted(items),
                }
            )

    for value in values:
        shard.append(words(value))
        size += len(shard[-1])
        if size >= SHARD_WORDS:
            close()
            shard, size = [], 0
    close()
    return found


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    ident: str = "item_id",
    window: int = WINDOW,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """Add ``passages`` to each row: ``n_words``, ``starts`` and ``ends`` (merged spans of words
    that lie in an occurrence of a benchmark window) and ``items`` (their ids, ascending).

    A window is ``window`` consecutive words of an item, or all of an item that has fewer. Null and
    empty texts have no words, nor do such items, and match nothing. Repeated rows and repeated
    items stay as they are; items of one text are all reported. A null item id is ignored. No rows
    move between tasks: every task indexes the batches it reads. The benchmark is taken in blocks
    of ``block_items`` items, one pass each, so what a task holds does not grow with it.
    """
    others = [F.col(f"`{name}`") for name in docs.columns if name != "passages"]
    rows = docs.select(*others, F.lit(None).cast(_PASSAGES).alias("passages"))
    items = benchmark.select(F.col(ident).cast("long").alias("item"), F.col("text"))
    items = items.where(F.col("item").isNotNull() & F.col("text").isNotNull())
    blocks = max(1, -(-items.count() // block_items))
    numbered = items.withColumn("_block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    for block in range(blocks):
        part = [(row["item"], row["text"]) for row in numbered.where(F.col("_block") == block).collect()]
        rows = rows.select(
            *others, _searcher(docs, Windows(part, window))(F.col(text), F.col("passages")).alias("passages")
        )
    return rows


_PASSAGES = "struct<n_words:bigint,starts:array<bigint>,ends:array<bigint>,items:array<bigint>>"


def _searcher(docs: DataFrame, windows: Windows):
    sent = docs.sparkSession.sparkContext.broadcast(windows)

    @F.arrow_udf(_PASSAGES)
    def search(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for values, before in batches:
            found = _scan(sent.value, values.to_pylist(), before.to_pylist())
            yield pa.array(found, _HITS)

    return search


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Add ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated`` to each row;
    see :func:`find_passages`."""
    added = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "passages")
    plain = docs.select(*[F.col(f"`{name}`") for name in docs.columns if name not in added])
    found = find_passages(plain, benchmark, **options)
    hit: Column = F.aggregate(
        F.arrays_zip("passages.starts", "passages.ends"),
        F.lit(0).cast("long"),
        lambda total, span: total + span["ends"] - span["starts"],
    )
    names = F.array_sort(F.transform("passages.items", lambda item: item.cast("string")))
    return found.select(
        *[F.col(f"`{name}`") for name in plain.columns],
        F.col("passages.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("passages.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        (F.size("passages.items") > 0).alias("contaminated"),
    )


def remove_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """Rows with the benchmark passages cut out of ``text``; other columns stay, and so do all
    rows, their text unchanged where nothing is found. A line break takes the place of a span."""
    places = {name: f"c{place}" for place, name in enumerate(docs.columns)}  # no name clashes with ours
    where = places[text]
    found = find_passages(docs.toDF(*places.values()), benchmark, text=where, **options)

    @F.arrow_udf("string")
    def cut(values: pa.Array, passages: pa.Array) -> pa.Array:
        return pa.array(
            [
                without_spans(value, list(zip(hit["starts"], hit["ends"], strict=True)))
                for value, hit in zip(values.to_pylist(), passages.to_pylist(), strict=True)
            ],
            pa.string(),
        )

    changed = F.when(F.size("passages.items") > 0, cut(F.col(where), F.col("passages"))).otherwise(F.col(where))
    return found.select(
        *[(changed if name == text else F.col(place)).alias(name) for name, place in places.items()]
    )


def without_spans(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the words of the spans and what stands between them."""
    if not text or not spans:
        return text
    data = text.encode()
    edges = [(found.start(), found.end()) for found in _WORD.finditer(data)]
    kept, end = [], 0
    for first, after in spans:
        kept.append(data[end : edges[first][0]])
        end = edges[after - 1][1]
    kept.append(data[end:])
    return b"\n".join(kept).decode()
