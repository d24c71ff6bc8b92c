"""Marginal probability of texts over all their segmentations into subword pieces.

The pieces and their first scores are those of an existing vocabulary. The different words of the
training texts re-weight them by expected counts. A word's marginal is the sum over all its
segmentations, by a forward recursion in log space over the lattice of pieces, done for many words
of one length at once. A word of the training texts is one more way through its lattice, weighted
by its discounted count; what the discount frees goes to the ways along pieces, so all words
together have probability 1.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.session import materialise

ROUNDS = 3  # re-estimations of the piece weights
PRIOR_WEIGHT = 100.0  # pieces the existing scores count for
FREQUENT_WORDS = 100_000  # words at most that every task holds; the others are joined
HELD_OUT = (7, 2)  # crc32 of the id modulo the first is the second

_LOWER = bytes(byte + 32 if 65 <= byte <= 90 else byte for byte in range(256))
_CELLS = 1 << 20  # words scored together: words times their length
_LONG = 2_000  # bytes of a word scored by itself
_GATHERED = 1 << 15, 1 << 22  # rows or bytes of words a task gathers, to score many of one length at once


def words(text: str | None) -> list[bytes]:
    """Words between blanks, tabs and line ends, A-Z in lower case; null has none."""
    return text.encode().translate(_LOWER).split() if text else []


def read_pieces(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a sentencepiece model as bytes, a leading blank for the mark of a word's start,
    and their probabilities after the model's scores.

    The scores of this kind of model are minus the rank, so a piece weighs 1 / rank. Control
    pieces are left out; every single byte is a piece, so that each word has a segmentation.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    rank = {bytes([byte]): float(size) for byte in range(256)}
    for number in range(size):
        if model.is_control(number) or model.is_unknown(number):
            continue
        if model.is_byte(number):
            continue
        piece = model.id_to_piece(number).replace("▁", " ").encode()
        if b" " in piece[1:] or not piece:
            continue  # a piece of several blanks occurs in no word
        score = model.get_score(number)
        rank[piece] = min(rank.get(piece, np.inf), max(1.0, -score) if score > -1e8 else float(size))
    pieces = sorted(rank)
    weight = np.array([1.0 / rank[piece] for piece in pieces])
    return pieces, weight / weight.sum()


# For a start: (end, places of the words that have a piece there, numbers of these pieces).
_Edges = list[list[tuple[int, np.ndarray, np.ndarray]]]
_PREFIX, _NOTHING = -1, -2  # of a longer piece only; of no piece


class Lattice:
    """Pieces by their bytes, and the recursions over words."""

    def __init__(self, pieces: list[bytes], probability: np.ndarray):
        self.pieces = pieces
        self.number = {piece[:end]: _PREFIX for piece in pieces for end in range(1, len(piece))}
        self.number.update((piece, place) for place, piece in enumerate(pieces))
        self.longest = max(map(len, pieces))
        with np.errstate(divide="ignore"):
            self.log_p = np.log(probability)

    def _edges(self, block: list[bytes], length: int) -> _Edges:
        """Pieces in words of one length, by their start. A word is looked up at a start until what
        follows begins no piece."""
        everyone = np.arange(len(block))
        edges = []
        for start in range(length):
            places, left, found = everyone, block, []
            for end in range(start + 1, min(length, start + self.longest) + 1):
                parts = [word[start:end] for word in left]
                number = np.fromiter(
                    map(self.number.get, parts, repeat(_NOTHING)), np.int32, len(parts)
                )
                has = number >= 0
                if has.any():
                    found.append((end, places[has], number[has]))
                goes_on = number > _NOTHING
                places = places[goes_on]
                if not len(places):
                    break
                left = list(compress(left, goes_on.tolist()))
            edges.append(found)
        return edges

    def _forward(self, edges: _Edges, size: int, length: int) -> np.ndarray:
        alpha = np.full((length + 1, size), -np.inf)
        alpha[0] = 0.0
        for start, found in enumerate(edges):
            for end, places, piece in found:
                way = alpha[start, places] + self.log_p[piece]
                alpha[end, places] = np.logaddexp(alpha[end, places], way)
        return alpha

    def _blocks(self, found: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes], int]]:
        lengths = np.array([len(word) for word in found], np.int64)
        order = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.diff(lengths[order])) + 1
        for group in np.split(order, edges):
            if not len(group):
                continue
            length = int(lengths[group[0]])
            many = max(1, _CELLS // (length + 1) ** 2)
            for first in range(0, len(group), many):
                part = group[first : first + many]
                yield part, [found[place] for place in part], length

    def log_marginal(self, found: list[bytes]) -> np.ndarray:
        """Natural log of the probability of each word, a blank put before it."""
        result = np.zeros(len(found))
        for part, block, length in self._blocks([b" " + word for word in found]):
            if length > _LONG:
                result[part] = [self._long(word) for word in block]
            else:
                result[part] = self._forward(self._edges(block, length), len(block), length)[length]
        return result

    def _pieces_at(self, word: bytes, start: int) -> Iterator[tuple[int, int]]:
        """End and number of each piece that begins at ``start``."""
        for end in range(start + 1, min(len(word), start + self.longest) + 1):
            number = self.number.get(word[start:end], _NOTHING)
            if number >= 0:
                yield end, number
            elif number == _NOTHING:
                return

    def _forward_long(self, word: bytes) -> list[float]:
        """As ``_forward`` for one word of any length: a number a byte, no lists of edges."""
        alpha = [-np.inf] * (len(word) + 1)
        alpha[0] = 0.0
        for start in range(len(word)):
            for end, piece in self._pieces_at(word, start):
                alpha[end] = np.logaddexp(alpha[end], alpha[start] + self.log_p[piece])
        return alpha

    def _long(self, word: bytes) -> float:
        return float(self._forward_long(word)[-1])

    def _expected_long(self, word: bytes, total: np.ndarray) -> None:
        """Add the expected number of each piece in one word of any length."""
        alpha = self._forward_long(word)
        beta = [-np.inf] * len(word) + [0.0]
        for start in range(len(word) - 1, -1, -1):
            for end, piece in self._pieces_at(word, start):
                way = self.log_p[piece] + beta[end]
                beta[start] = np.logaddexp(beta[start], way)
                total[piece] += np.exp(alpha[start] + way - alpha[-1])

    def expected(self, found: list[bytes]) -> np.ndarray:
        """Expected number of each piece in the words. Words of more than ``_LONG`` bytes are taken
        one by one, which bounds the memory and gives the same numbers."""
        total = np.zeros(len(self.pieces))
        for _, block, length in self._blocks([b" " + word for word in found]):
            if length > _LONG:
                for word in block:
                    self._expected_long(word, total)
                continue
            edges = self._edges(block, length)
            alpha = self._forward(edges, len(block), length)
            beta = np.full((length + 1, len(block)), -np.inf)
            beta[length] = 0.0
            pieces, shares = [], []
            for start in range(length - 1, -1, -1):
                for end, places, piece in edges[start]:
                    way = self.log_p[piece] + beta[end, places]
                    beta[start, places] = np.logaddexp(beta[start, places], way)
                    pieces.append(piece)
                    shares.append(alpha[start, places] + way - alpha[length, places])
            total += np.bincount(
                np.concatenate(pieces), np.exp(np.concatenate(shares)), minlength=len(total)
            )
        return total


def _held_out(ident: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(ident.cast("string")), F.lit(HELD_OUT[0])) == HELD_OUT[1], F.lit(False))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a partition with how often training texts have them, some of them several times."""
    counts: Counter[bytes] = Counter()
    for batch in batches:
        for held_out, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if held_out:
                counts.update(dict.fromkeys(words(text), 0))
            else:
                counts.update(words(text))
        if len(counts) > 1_000_000:
            yield _counted(counts)
            counts = Counter()
    yield _counted(counts)


def _counted(counts: Counter[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "c"]
    )


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Larger batches than Spark sends, still of bounded size."""
    rows, size = _GATHERED
    parts: list[pa.RecordBatch] = []
    for batch in batches:
        parts.append(batch)
        if sum(part.num_rows for part in parts) >= rows or sum(part.nbytes for part in parts) >= size:
            yield pa.concat_batches(parts)
            parts = []
    if parts:
        yield pa.concat_batches(parts)


def fit_pieces(vocabulary: DataFrame, path: str, rounds: int = ROUNDS) -> Lattice:
    """Piece weights from all training words, each once, as they stand for words not seen yet: each
    round adds up the expected number of each piece under the weights so far. ``vocabulary`` is
    ``(word, c)``. Only one number a piece reaches the driver."""
    pieces, prior = read_pieces(path)
    context = vocabulary.sparkSession.sparkContext
    probability = prior
    for _ in range(rounds):
        sent = context.broadcast(Lattice(pieces, probability))

        def expected(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(sent.value.pieces))
            for batch in _gathered(batches):
                total += sent.value.expected(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total))), pa.array(total)], ["piece", "amount"]
            )

        rows = (
            vocabulary.where("c > 0").select("word").mapInArrow(expected, "piece long, amount double")
            .where("amount > 0").groupBy("piece").agg(F.sum("amount").alias("amount")).collect()
        )
        amount = PRIOR_WEIGHT * prior
        for row in rows:
            amount[row["piece"]] += row["amount"]
        probability = amount / amount.sum()
    return Lattice(pieces, probability)


def lm_scores(
    docs: DataFrame,
    pieces: str,
    ident: str = "doc_id",
    text: str = "text",
    rounds: int = ROUNDS,
    frequent: int = FREQUENT_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score``.

    Tokens are the words between white space, then one end. Training texts are those not held out.
    ``base_score`` is the add-one unigram log10 probability of the tokens; ``score`` is the log10
    probability under the model: each word's marginal over all ways through its lattice, and the
    end as a token of its own. Null and empty texts are one end. Rows
    without an id are training rows; rows that repeat are scored, and counted, each by itself. An
    empty table gives no row. ``pieces`` is the path of a sentencepiece model on the driver.

    The most frequent words, at most ``frequent``, are looked up in a table every task holds, so no hot
    word is shuffled; all others are joined. Both ways use the same counts.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn(
        "held_out", _held_out(F.col("doc_id"))
    )
    counted = materialise(
        rows.select("held_out", "text")
        .mapInArrow(_count_words, "word binary, c long")
        .groupBy("word")
        .agg(F.sum("c").alias("c")),
        "words",
    )
    ends = rows.where(~F.col("held_out")).count()
    sizes = counted.agg(
        F.sum("c").alias("n"),
        F.count_if(F.col("c") > 0).alias("v"),
        F.count_if(F.col("c") == 1).alias("once"),
        F.count_if(F.col("c") == 2).alias("twice"),
    ).first()
    train_tokens = (sizes["n"] or 0) + ends
    types = sizes["v"] + (1 if ends else 0)
    lattice = fit_pieces(counted, pieces, rounds)
    # Absolute discount of each count; what it frees is shared by the ways along pieces.
    discount = sizes["once"] / (sizes["once"] + 2.0 * sizes["twice"]) if sizes["once"] else 0.5
    with np.errstate(divide="ignore"):
        whole = np.log(max(train_tokens, 1))
        freed = np.log(discount * max(sizes["v"], 1)) - whole
    # Without training texts the end, like every word, rests on the lattice's scale.
    end_score = float(np.log10(ends / train_tokens)) if ends else float(np.log10(0.5))
    below = np.log10(float(train_tokens + types + 1))
    sent = spark.sparkContext.broadcast(lattice)

    def marginals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            counts = np.array(batch.column(1).to_pylist(), np.float64)
            with np.errstate(divide="ignore"):
                own = np.log(np.maximum(counts - discount, 0.0)) - whole
            along = sent.value.log_marginal(batch.column(0).to_pylist()) + freed
            score = np.logaddexp(own, along) / np.log(10.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score)], ["word", "c", "score"]
            )

    scored = materialise(counted.mapInArrow(marginals, "word binary, c long, score double"), "scored")
    # Counts by size class, some hundred rows, show from which class on the words are few enough.
    step = F.floor(F.log2(F.col("c") + 1.0) * 8).alias("step")
    least, amount_held = None, 0
    for row in scored.groupBy(step).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect():
        amount_held += row["n"]
        if amount_held > frequent:
            break
        least = row["step"]
    table = {}
    if least is not None:
        top = scored.where(F.floor(F.log2(F.col("c") + 1.0) * 8) >= least).collect()
        table = {
            bytes(row["word"]): (int(row["c"] > 0), float(np.log10(row["c"] + 1.0) - below), row["score"])
            for row in top
        }
    held = spark.sparkContext.broadcast(table)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text with the sums over frequent words, and one for each of its other
        words: ``row, word, n, known, base, score``."""
        get = held.value.get
        for batch in batches:
            firsts: list[tuple] = []
            rows_, words_, numbers = [], [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = Counter(words(text))
                known = 0
                base = score = 0.0
                others = []
                for word, n in counts.items():
                    entry = get(word)
                    if entry is None:
                        others.append(word)
                    else:
                        known += n * entry[0]
                        base += n * entry[1]
                        score += n * entry[2]
                firsts.append((row, counts.total(), known, base, score))
                rows_.extend([row] * len(others))
                words_.extend(others)
                numbers.extend(map(counts.__getitem__, others))
            row, n, known, base, score = zip(*firsts, strict=True) if firsts else ((),) * 5
            more = len(words_)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*row, *rows_], pa.int64()),
                    pa.array([*[None] * len(row), *words_], pa.binary()),
                    pa.array([*n, *numbers], pa.int64()),
                    pa.array([*known, *[0] * more], pa.int64()),
                    pa.array([*base, *[0.0] * more], pa.float64()),
                    pa.array([*score, *[0.0] * more], pa.float64()),
                ],
                ["row", "word", "n", "known", "base", "score"],
            )

    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    found = materialise(
        numbered.select("row", "text").mapInArrow(
            look_up, "row long, word binary, n long, known long, base double, score double"
        ),
        "found",
    )
    other = found.where(F.col("word").isNotNull()).select("row", "word", "n")
    joined = (
        other.join(scored, "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("o_known"),
            F.sum(F.col("n") * (F.log10(F.col("c") + 1.0) - below)).alias("o_base"),
            F.sum(F.col("n") * F.col("score")).alias("o_score"),
        )
    )
    none = F.lit(0.0)
    return (
        numbered.select("row", "doc_id", "held_out")
        .join(found.where(F.col("word").isNull()).drop("word"), "row")
        .join(joined, "row", "left")
        .select(
            "doc_id",
            "held_out",
            (F.col("n") + 1).alias("n_tokens"),
            (F.col("known") + F.coalesce("o_known", F.lit(0)) + int(ends > 0)).alias("n_known"),
            F.lit(train_tokens).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("o_base", none) + float(np.log10(ends + 1.0) - below)).alias("base_score"),
            (F.col("score") + F.coalesce("o_score", none) + end_score).alias("score"),
        )
    )
