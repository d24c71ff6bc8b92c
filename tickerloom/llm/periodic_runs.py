"""Runs of repeated words in texts, found by recompression.

A text becomes a sequence of word numbers. A run-length grammar is built over it level by level:
block compression replaces stretches of one symbol, pair compression replaces pairs of a left and a
right symbol, in turns, until no question is open. How far two places agree (their longest common
extension) is read from the grammar: equal symbols lead up to wider ones, the first difference leads
down again. Every run of period p covers a point of a grid of step p or wider together with the
place p words on, so the extensions at the points of all these grids (a harmonic sum) find all runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 12  # of a run
CANDIDATES = 1_000_000  # grid points looked at together
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class _Level:
    """One sequence of the grammar: symbols, the text of each, and where each went above."""

    def __init__(self, symbols: np.ndarray, owner: np.ndarray):
        self.symbols = symbols  # words from 0; two negative ones of its own enclose each text
        self.owner = owner  # number of the text
        self.blocks = False  # made into the next level by block or by pair compression
        self.up = self.head = self.tail = symbols[:0]  # parent; first and last child of a parent

    def close(self, kept: np.ndarray, first: np.ndarray) -> None:
        """Group the elements ``kept``, of which those marked ``first`` begin a parent."""
        heads = np.flatnonzero(first)
        self.up = np.full(len(self.symbols), -1, np.int64)
        self.up[kept] = np.cumsum(first) - 1
        self.head = kept[heads]
        self.tail = kept[np.append(heads[1:], len(kept)) - 1]


def _compressed(level: _Level, texts: np.ndarray, number: int, names: int) -> tuple[_Level, int]:
    """The next level over the texts that still have open questions; ``names`` counts symbols."""
    kept = np.flatnonzero(texts[level.owner])
    symbols = level.symbols[kept]
    same = np.zeros(len(symbols), bool)
    same[1:] = symbols[1:] == symbols[:-1]
    level.blocks = bool(same.any())
    if level.blocks:
        level.close(kept, ~same)
        above = level.symbols[level.head]
        length = level.tail - level.head + 1
        wide = length > 1
        keys, found = np.unique(above[wide] * np.int64(len(symbols) + 1) + length[wide], return_inverse=True)
    else:
        # Each symbol is a left or a right one; ends are neither, so texts stay apart.
        mixed = (symbols.astype(np.uint64) + np.uint64(number * 0xD6E8FEB8665 + 1)) * _SPREAD
        side = (mixed >> np.uint64(40)) & np.uint64(1)
        left, right = (symbols >= 0) & (side == 0), (symbols >= 0) & (side == 1)
        pairs, turned = left[:-1] & right[1:], right[:-1] & left[1:]
        if turned.sum() > pairs.sum():
            pairs = turned
        second = np.append(False, pairs)
        level.close(kept, ~second)
        wide = np.append(pairs, False)[~second]
        above = level.symbols[level.head]
        keys, found = np.unique(
            above[wide] * np.int64(names) + level.symbols[level.tail[wide]], return_inverse=True
        )
    above = above.copy()
    above[wide] = names + found
    return _Level(above, level.owner[level.head]), names + len(keys)


class _Extension:
    """Common extensions of pairs of places, all forwards (``step`` 1) or all backwards (-1)."""

    def __init__(self, x: np.ndarray, y: np.ndarray, step: int):
        self.start, self.step = x, step
        self.x, self.y = x.copy(), y.copy()
        self.stop = np.full(len(x), -1)  # level at which the symbols differ
        self.open = np.arange(len(x))

    def compare(self, level: _Level, number: int) -> None:
        """Those with unlike symbols stop here."""
        unlike = level.symbols[self.x[self.open]] != level.symbols[self.y[self.open]]
        self.stop[self.open[unlike]] = number
        self.open = self.open[~unlike]

    def rest(self, level: _Level, place: np.ndarray) -> np.ndarray:
        """Elements from a place to the end of its parent, in the direction."""
        parent = level.up[place]
        return level.tail[parent] - place + 1 if self.step > 0 else place - level.head[parent] + 1

    def climb(self, level: _Level, number: int) -> None:
        """From equal symbols to the parents; places inside a parent first move to its end."""
        x, y = self.x[self.open], self.y[self.open]
        edge = level.head if self.step > 0 else level.tail
        inside = (edge[level.up[x]] != x) | (edge[level.up[y]] != y)
        one, other = self.rest(level, x), self.rest(level, y)
        # In a pair only its second symbol can be inside, here as there.
        move = np.where(inside, np.minimum(one, other) if level.blocks else 1, 0)
        x, y = x + self.step * move, y + self.step * move
        halted = inside & (one != other) if level.blocks else np.zeros(len(x), bool)
        self.x[self.open], self.y[self.open] = x, y
        self.stop[self.open[halted]] = number
        self.open = self.open[~halted]
        self.x[self.open], self.y[self.open] = level.up[x[~halted]], level.up[y[~halted]]

    def descend(self, level: _Level, number: int) -> None:
        """From unlike parents to the first unlike symbols below them."""
        at = np.flatnonzero(self.stop > number)
        edge = level.head if self.step > 0 else level.tail
        x, y = edge[self.x[at]], edge[self.y[at]]
        move = (level.symbols[x] == level.symbols[y]).astype(np.int64)
        if level.blocks:
            move *= np.minimum(self.rest(level, x), self.rest(level, y))
        self.x[at], self.y[at] = x + self.step * move, y + self.step * move

    def length(self) -> np.ndarray:
        return (self.x - self.start) * self.step


def extensions(
    symbols: np.ndarray, owner: np.ndarray, x: np.ndarray, y: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """How many symbols agree from ``x`` and ``y`` on, and before them.

    ``symbols`` are word numbers from 0, each text enclosed by two negative numbers of its own;
    ``owner`` is the number of the text of each symbol, and ``x < y`` are places of words in one text.
    """
    names = int(symbols.max(initial=0)) + 1
    level, levels = _Level(symbols, owner), []
    both = (_Extension(x, y, 1), _Extension(x - 1, y - 1, -1))
    while True:
        number = len(levels)
        for side in both:
            side.compare(level, number)
        texts = np.zeros(int(owner.max(initial=0)) + 1, bool)
        for side in both:
            texts[level.owner[side.x[side.open]]] = True
        if not texts.any():
            break
        above, names = _compressed(level, texts, number, names)
        levels.append(level)
        for side in both:
            side.climb(level, number)
        level = above
    for number in range(len(levels) - 1, -1, -1):
        for side in both:
            side.descend(levels[number], number)
    return both[0].length(), both[1].length()


def _grid(lengths: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``text, place, period`` of the grid points of all texts, some at a time."""
    longest = np.where(lengths >= least, lengths // 2, 0)
    text = np.repeat(np.arange(len(lengths)), longest)
    period = np.arange(len(text)) - np.repeat(np.cumsum(longest) - longest, longest) + 1
    step = np.maximum(period, least - period)  # no run agrees with itself over fewer words
    points = (lengths[text] - period + step - 1) // step
    total = np.cumsum(points)
    low = 0
    while low < len(text):
        done = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, done + CANDIDATES, "right")))
        part = slice(low, high)
        row = np.repeat(np.arange(low, high), points[part])
        turn = np.arange(len(row)) - np.repeat(total[part] - points[part] - done, points[part])
        yield text[row], turn * step[row], period[row]
        low = high


def find_runs(texts: list[np.ndarray], least: int = LEAST_WORDS) -> list[np.ndarray]:
    """Rows ``start, length, period`` of all runs of each text, by start and period.

    A text is an array of word numbers from 0; equal words have equal numbers.
    """
    lengths = np.array([len(words) for words in texts], np.int64)
    pieces = [part for n, words in enumerate(texts) for part in ([-2 * n - 1], words, [-2 * n - 2])]
    symbols = np.concatenate([np.asarray(part, np.int64) for part in pieces] or [np.zeros(0, np.int64)])
    owner = np.repeat(np.arange(len(texts)), lengths + 2)
    first = np.cumsum(lengths + 2) - lengths - 1
    found = [np.zeros((0, 4), np.int64)]
    for text, place, period in _grid(lengths, least):
        x = first[text] + place
        agree = symbols[x] == symbols[x + period]
        if not agree.any():
            continue
        text, place, period, x = text[agree], place[agree], period[agree], x[agree]
        wanted = np.zeros(len(texts), bool)
        wanted[text] = True
        part = np.flatnonzero(wanted[owner])
        moved = np.zeros(len(symbols), np.int64)
        moved[part] = np.arange(len(part))
        after, before = extensions(symbols[part], owner[part], moved[x], moved[x + period])
        run = after + before >= np.maximum(period, least - period)
        rows = np.stack([text, place - before, after + before + period, period], 1)[run]
        found.append(_shortest_periods(rows))
    rows = _shortest_periods(np.concatenate(found))
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    cuts = np.searchsorted(rows[:, 0], np.arange(1, len(texts)))
    return [part[:, 1:] for part in np.split(rows, cuts)] if texts else []


def _shortest_periods(rows: np.ndarray) -> np.ndarray:
    """Of the periods of one stretch the smallest: others found are its multiples."""
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)
    return rows[new]


def _described(texts: list[bytes], least: int) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """Number of words, runs, and the text without repetitions, of each text."""
    split = [text.split() for text in texts]  # of bytes: at blanks and \t \n \v \f \r only
    numbers: dict[bytes, int] = {}
    coded = [np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64) for words in split]
    for words, runs in zip(split, find_runs(coded, least), strict=True):
        if len(runs):
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, runs[:, 0] + runs[:, 2], 1)
            np.add.at(change, runs[:, 0] + runs[:, 1], -1)
            kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
            yield len(words), runs, b" ".join([words[place] for place in kept.tolist()])
        else:
            yield len(words), runs, b" ".join(words)


def _chunks(texts: list[bytes], least_bytes: int = 1 << 20) -> Iterator[list[bytes]]:
    chunk, size = [], 0
    for text in texts:
        chunk.append(text)
        size += len(text)
        if size >= least_bytes:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


_RESULT = "struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, collapsed: string>"


def periodic_runs(docs: DataFrame, text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """Add ``n_words``, ``runs`` and ``collapsed`` to each row.

    Words are what stands between blanks and the signs 9 to 13. A run is a longest possible stretch
    of words that repeats with its smallest period, of ``least_words`` words and two periods at
    least: ``start`` (number of its first word, from 0), ``length`` and ``period`` in words, by start
    and period. ``collapsed`` is the text without the words that some run holds after its first
    period, the others joined by one blank. Null and empty texts have no words, no runs and an
    empty ``collapsed``. Rows are read by themselves and whole, however long, so repeated rows and
    null ids do no harm; columns named as the results are replaced. No rows move between tasks. A
    task holds an Arrow batch of texts and about a megabyte of them, or one longer text, as numbers.
    """

    @F.arrow_udf(_RESULT)
    def described(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _answers(batch, least_words)

    names = ("n_words", "runs", "collapsed")
    others = [F.col(f"`{name}`") for name in docs.columns if name not in names]
    found = described(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    answer = next(f"_found{n}" for n in range(len(docs.columns) + 1) if f"_found{n}" not in docs.columns)
    return docs.select(*others, found.alias(answer)).select(
        *others, *[F.col(answer)[name].alias(name) for name in names]
    )


def _answers(batch: pa.Array, least: int) -> pa.StructArray:
    counts: list[int] = []
    ends = [0]
    runs = [np.zeros((0, 3), np.int64)]
    collapsed: list[bytes] = []
    for chunk in _chunks(batch.cast(pa.binary()).to_pylist()):
        for count, found, kept in _described(chunk, least):
            counts.append(count)
            runs.append(found)
            ends.append(ends[-1] + len(found))
            collapsed.append(kept)
    table = np.concatenate(runs)
    fields = ("start", "length", "period")
    rows = pa.StructArray.from_arrays([pa.array(table[:, n]) for n in range(3)], fields)
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)
    texts = pa.array(collapsed, pa.binary()).cast(pa.string())
    return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), lists, texts], ["n_words", "runs", "collapsed"])
