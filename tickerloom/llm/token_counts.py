"""Token counts of byte-level BPE without emitting identifiers.

The number of tokens of a pretoken is its number of bytes minus the merges BPE makes in it. Merges
are found with a heap of adjacent pairs by rank over a doubly linked list of symbols, so that a
pretoken of n bytes takes n log n steps however long it is.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import unused_name

TOKEN_LIMIT = 1024

# The pretoken pattern and byte alphabet of the byte-level vocabularies, with white
# space written out as Unicode's White_Space.
_SPACE = r"\t-\r \x85\xa0  -     　"
_PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

# White space and the text up to the next white space: no pretoken crosses from one chunk to the
# next, so the count of a chunk can be kept.
_CHUNK = re.compile(rf"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")

# Counts kept by a worker, for speed only: a full table is emptied and fills again.
KEPT_CHUNKS = 300_000
KEPT_PRETOKENS = 500_000


def _alphabet() -> dict[str, int]:
    """Letter of the vocabulary file -> byte: visible bytes stand for themselves, the others are
    shifted behind the first 256 code points in order."""
    hidden = [byte for byte in range(256) if byte not in _VISIBLE]
    return {chr(byte): byte for byte in _VISIBLE} | {
        chr(256 + place): byte for place, byte in enumerate(hidden)
    }


def read_vocabulary(path: str) -> dict:
    """Merge table and special strings of a byte-level BPE file in the tokenizers' JSON format."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model = content["model"]
    identifier = model["vocab"]
    letters = _alphabet()
    start = [0] * 256
    for letter, byte in letters.items():
        start[byte] = identifier[letter]
    ranks, made = {}, []
    for rank, merge in enumerate(model["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        ranks.setdefault((identifier[left], identifier[right]), rank)
        made.append(identifier[left + right])
    return {
        "start": start,
        "ranks": ranks,
        "made": made,
        "special": [item["content"] for item in content["added_tokens"]],
    }


class BpeCounter:
    """Counts tokens; keeps the counts of chunks and pretokens it has seen."""

    def __init__(self, vocabulary: dict):
        self._start = vocabulary["start"]
        self._ranks = vocabulary["ranks"]
        self._made = vocabulary["made"]
        self._pretokens = regex.compile(_PRETOKEN)
        special = sorted(vocabulary["special"], key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, special))) if special else None
        self._seen: dict[str, int] = {}
        self._chunks: dict[str, int] = {}

    def merged_length(self, data: bytes) -> int:
        """Symbols left of ``data`` when no adjacent pair has a rank."""
        symbols = list(map(self._start.__getitem__, data))
        size = len(symbols)
        rank_of = self._ranks.get
        made = self._made
        # A heap entry is rank * size + place: lowest rank first, leftmost of equal ranks first.
        heap = [
            rank * size + place
            for place, rank in enumerate(map(rank_of, zip(symbols, symbols[1:], strict=False)))
            if rank is not None
        ]
        if not heap:
            return size
        heapify(heap)
        following = list(range(1, size + 1))
        previous = list(range(-1, size - 1))
        left = size
        while heap:
            rank, place = divmod(heappop(heap), size)
            after = following[place]
            if after >= size or rank_of((symbols[place], symbols[after])) != rank:
                continue  # one of the two has been merged since
            merged = symbols[place] = made[rank]
            symbols[after] = -1
            beyond = following[place] = following[after]
            left -= 1
            if beyond < size:
                previous[beyond] = place
                rank = rank_of((merged, symbols[beyond]))
                if rank is not None:
                    heappush(heap, rank * size + place)
            before = previous[place]
            if before >= 0:
                rank = rank_of((symbols[before], merged))
                if rank is not None:
                    heappush(heap, rank * size + before)
        return left

    def _chunk(self, chunk: str) -> int:
        total = 0
        seen = self._seen
        for pretoken in self._pretokens.findall(chunk):
            count = seen.get(pretoken)
            if count is None:
                count = self.merged_length(pretoken.encode())
                if len(pretoken) <= 64:
                    if len(seen) >= KEPT_PRETOKENS:
                        seen.clear()
                    seen[pretoken] = count
            total += count
        return total

    def _plain(self, text: str) -> int:
        total = 0
        kept = self._chunks
        for chunk in _CHUNK.findall(text):
            count = kept.get(chunk)
            if count is None:
                count = self._chunk(chunk)
                if len(chunk) <= 64:
                    if len(kept) >= KEPT_CHUNKS:
                        kept.clear()
                    kept[chunk] = count
            total += count
        return total

    def count(self, text: str) -> int:
        if self._special is None:
            return self._plain(text)
        total = end = 0
        for found in self._special.finditer(text):
            total += self._plain(text[end : found.start()]) + 1
            end = found.end()
        return total + self._plain(text[end:] if end else text)


_RESULT = pa.struct([("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
_counters: dict[str, BpeCounter] = {}  # of this worker process, by vocabulary file


def token_counts(
    docs: DataFrame, vocabulary: str, text: str = "text", limit: int = TOKEN_LIMIT
) -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (``n_tokens > limit``) to each row.

    ``vocabulary`` is the path of the vocabulary file on the driver; its merge table, of a fixed
    size, is broadcast. A null text counts as empty: 0 bytes, 0 tokens. Each row is counted by
    itself, so repeated rows stay. Columns named as the three results are replaced by them.
    No rows move between tasks.
    """
    table = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    @F.arrow_udf("n_bytes long, n_tokens long")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counters.get(vocabulary)
        if counter is None:
            counter = _counters[vocabulary] = BpeCounter(table.value)
        for texts in batches:
            values = [value or "" for value in texts.to_pylist()]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([len(value.encode()) for value in values], pa.int64()),
                    pa.array([counter.count(value) for value in values], pa.int64()),
                ],
                fields=list(_RESULT),
            )

    others = [F.col(f"`{name}`") for name in docs.columns if name not in _ADDED]
    found = unused_name(docs.columns, "_counts")
    counted = docs.select(*others, counts(F.col(f"`{text}`")).alias(found))
    return counted.select(
        *others,
        F.col(found)["n_bytes"].alias("n_bytes"),
        F.col(found)["n_tokens"].alias("n_tokens"),
        (F.col(found)["n_tokens"] > limit).alias("over_limit"),
    )


_ADDED = ("n_bytes", "n_tokens", "over_limit")
