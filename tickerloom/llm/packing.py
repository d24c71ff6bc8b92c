"""Packing of sequences into batches of a token budget with little padding.

A dynamic programme over the global histogram of lengths chooses the bucket boundaries: every
sequence is padded to the boundary of its bucket, and the boundaries are those of the least
padding. Batches are then formed inside each bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.session import materialise

MAX_LENGTH = 2048  # tokens of a sequence; longer texts become several sequences
BUCKETS = 16
TOKEN_BUDGET = 16_384  # tokens of a batch, padding included
SHARD_ROWS = 10_000  # sequences numbered together

# Words between white space stand for tokens.
WORD = "[^ \\t-\\r]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def best_boundaries(lengths: Sequence[int], counts: Sequence[int], buckets: int) -> list[int]:
    """At most ``buckets`` boundaries, ascending, the last being the largest length, for which
    ``sum(count * boundary)`` is least; of equally good choices the one with fewer buckets.

    ``cost[j]`` is the least padded size of the first ``j`` lengths with the buckets so far; adding
    one bucket is a minimum over its start. Lengths are a bounded set, so this is small work.
    """
    size = len(lengths)
    if size == 0:
        return []
    length = np.asarray(lengths, dtype=np.float64)
    upto = np.concatenate([[0.0], np.cumsum(np.asarray(counts, dtype=np.float64))])
    cost = np.concatenate([[0.0], np.full(size, np.inf)])
    starts: list[np.ndarray] = []
    totals: list[float] = []
    for _ in range(min(buckets, size)):
        # Of a bucket that starts after i lengths and ends with the jth: (count of both) * length.
        table = cost[:size, None] + (upto[None, 1:] - upto[:size, None]) * length[None, :]
        table[np.tril_indices(size, -1)] = np.inf
        starts.append(table.argmin(axis=0))
        cost = np.concatenate([[np.inf], table.min(axis=0)])
        totals.append(float(cost[size]))
    end = size
    chosen = []
    for level in range(int(np.argmin(totals)), -1, -1):
        chosen.append(int(lengths[end - 1]))
        end = int(starts[level][end - 1])
    return chosen[::-1]


def length_buckets(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    max_length: int = MAX_LENGTH,
    buckets: int = BUCKETS,
    budget: int = TOKEN_BUDGET,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per sequence: ``doc_id, piece, n_tokens, bucket, batch, slot``.

    Tokens are the words of the text between white space. A text of more than ``max_length`` tokens
    becomes several sequences, ``piece`` 0, 1, ..., all but the last full, so no token is lost; a
    text without any, or null, becomes none. ``bucket`` is the length all sequences of the bucket
    are padded to; ``batch`` (``bucket-shard-number``) holds at most ``budget // bucket`` sequences,
    at least one, in the places ``slot`` 0, 1, .... Rows that repeat are sequences of their own.
    An empty table gives none. Columns but the two named are ignored.

    The histogram has at most ``max_length`` rows whatever the input, and only it reaches the driver.
    A bucket, or one id or none, may hold most rows: sequences are dealt by a hash of the number of
    their stored row into shards of about ``shard_rows`` which are numbered apart, each leaving at most one batch that is not full.
    """
    if not 0 < max_length <= budget:
        raise ValueError("max_length must be between 1 and the token budget")
    total = F.col("_total")
    rows = materialise(
        docs.select(
            F.col(ident).alias("doc_id"),
            word_count(F.col(text)).alias("_total"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "lengths",
    ).where(total > 0)
    pieces = F.expr(f"(_total + {max_length - 1}) div {max_length}")
    # Of a text of several sequences all but the last are full: counted without expanding them.
    last = total - (pieces - 1) * max_length
    histogram = (
        rows.select(F.inline(F.array(
            F.struct(last.alias("length"), F.lit(1).cast("long").alias("n")),
            F.struct(F.lit(max_length).cast("long").alias("length"), (pieces - 1).alias("n")),
        )))
        .groupBy("length")
        .agg(F.sum("n").alias("n"))
        .where("n > 0")
        .orderBy("length")
        .collect()
    )
    if not histogram:
        kind = rows.dtypes[0][1]
        return docs.sparkSession.createDataFrame(
            [], f"doc_id {kind}, piece int, n_tokens bigint, bucket bigint, batch string, slot bigint"
        )
    boundaries = best_boundaries([r["length"] for r in histogram], [r["n"] for r in histogram], buckets)
    sizes = {b: 0 for b in boundaries}
    for row in histogram:
        sizes[next(b for b in boundaries if row["length"] <= b)] += row["n"]

    def by_bucket(values: dict[int, int]) -> Column:
        """Value of the first boundary not below the length; at most ``buckets`` cases."""
        chosen = F.when(F.col("n_tokens") <= boundaries[0], F.lit(values[boundaries[0]]))
        for boundary in boundaries[1:]:
            chosen = chosen.when(F.col("n_tokens") <= boundary, F.lit(values[boundary]))
        return chosen.cast("long")

    shards = {b: -(-n // shard_rows) for b, n in sizes.items()}
    places = {b: max(1, budget // b) for b in boundaries}
    number = F.row_number().over(
        Window.partitionBy("bucket", "_shard").orderBy("doc_id", "piece", "n_tokens", "_row")
    ) - F.lit(1)
    return (
        rows.withColumn("_pieces", pieces)
        .select("doc_id", "_row", "_total", "_pieces", F.explode(F.sequence(F.lit(0), F.col("_pieces").cast("int") - 1)).alias("piece"))
        .withColumn(
            "n_tokens",
            F.when(F.col("piece") < F.col("_pieces") - 1, F.lit(max_length).cast("long")).otherwise(
                F.col("_total") - (F.col("_pieces") - 1) * max_length
            ),
        )
        .withColumn("bucket", by_bucket({b: b for b in boundaries}))
        .withColumn("_places", by_bucket(places))
        .withColumn("_shard", F.pmod(F.xxhash64("_row", "piece"), by_bucket(shards)))
        .withColumn("_number", number)
        .select(
            "doc_id",
            "piece",
            "n_tokens",
            "bucket",
            F.concat_ws("-", "bucket", "_shard", F.expr("_number div _places")).alias("batch"),
            F.expr("_number % _places").alias("slot"),
        )
    )
