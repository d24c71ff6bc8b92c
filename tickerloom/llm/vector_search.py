"""Exact top-k search by inner product over a vector-approximation file.

Every different vector is stored once in full and once as an approximation: a byte a component, the
cell it lies in, and its distance from the middles of those cells. Queries scan the approximations
only, which gives a lower and an upper bound of each inner product. Candidates whose upper bound lies
below the kth lower bound are done with; of the others, full vectors are read in the order of their
bound, first a few for each query, then those that the kth score found so far does not rule out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.session import materialise

CELLS = 128  # cells a component; at most 128, so that a cell is a byte
SLAB_ROWS = 16384  # approximations a task holds
BLOCK_ROWS = 1024  # queries a task holds
FIRST_READS = 4  # full vectors read first, as a multiple of k
_AT_ONCE = 64  # queries a task scans its approximations for at once


def integer_vectors(vectors: DataFrame, ident: str, vector: str, scale: int) -> DataFrame:
    """``(id, v)`` with ``floor(scale * x)`` of each component. Vectors that are null, empty or
    hold a null or non-finite component are left out, as are rows without an id."""
    value = F.col(vector).cast("array<double>")
    infinite = F.lit(float("inf"))

    def unusable(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == infinite)

    return (
        vectors.select(F.col(ident).cast("long").alias("id"), value.alias("v"))
        .where(F.col("id").isNotNull() & (F.size("v") > 0) & ~F.exists("v", unusable))
        .select("id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))).alias("v"))
    )


def _members(points: DataFrame, k: int) -> DataFrame:
    """``(digest, id, n)``: ids of the rows that share a vector. They share a score too, so beyond
    the ``k + 1`` smallest ids (one may be the query's own) none can be among the best ``k``."""
    smallest = Window.partitionBy("digest").orderBy("id")
    return (
        points.groupBy("digest", "id")
        .agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("n"))
        .withColumn("_place", F.row_number().over(smallest))
        .where(F.col("_place") <= k + 1)
        .drop("_place")
    )


def _approximations(classes: DataFrame, sizes: DataFrame) -> DataFrame:
    """The approximation file: ``dim, low, width, slab, row, only_id, single, cells, off``."""
    low, width = F.col("low"), F.col("width")

    def cell(x: Column) -> Column:
        return F.least(F.floor((x.cast("double") - low) / width), F.col("_cells") - 1).cast("tinyint")

    def squared(x: Column, c: Column) -> Column:
        off = x.cast("double") - (low + c * width + (width - 1) / 2)
        return off * off

    total = F.aggregate(F.zip_with("v", "cells", squared), F.lit(0.0), lambda a, b: a + b)
    return (
        classes.join(sizes, "dim")
        .withColumn("cells", F.transform("v", cell))
        .select(
            "dim",
            "low",
            "width",
            F.pmod(F.xxhash64("row"), F.col("_slabs")).alias("slab"),
            "_blocks",
            "row",
            "only_id",
            "single",
            "cells",
            F.sqrt(total).alias("off"),
        )
    )


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _scan(queries: pd.DataFrame, slab: pd.DataFrame, k: int) -> pd.DataFrame:
    """Bounds of the inner products of a block of queries with a slab of approximations, without
    those whose upper bound lies below the kth lower bound."""
    low, width = float(slab["low"].iloc[0]), float(slab["width"].iloc[0])
    middle = low + _matrix(slab["cells"]) * width + (width - 1) / 2
    off, reach = slab["off"].to_numpy(), np.sqrt((middle * middle).sum(axis=1))
    rows, single = slab["row"].to_numpy(), slab["single"].to_numpy(bool)
    only = slab["only_id"].to_numpy(np.int64)
    parts = []
    for start in range(0, len(queries), _AT_ONCE):
        block = queries.iloc[start : start + _AT_ONCE]
        wanted = _matrix(block["v"])
        length = np.sqrt((wanted * wanted).sum(axis=1))[:, None]
        about = wanted @ middle.T
        # By Cauchy and Schwarz; the second part is more than what the sums are rounded by.
        slack = length * off + 1e-12 * length * (reach + off + 1)
        own = single & (only == block["id"].to_numpy(np.int64)[:, None])
        lower = np.where(own, -np.inf, about - slack)
        if len(rows) > k:
            floor = np.partition(lower, len(rows) - k, axis=1)[:, len(rows) - k, None]
        else:
            floor = -np.inf
        asked, found = np.nonzero((about + slack >= floor) & ~own)
        parts.append(
            pd.DataFrame(
                {
                    "query": block["query"].to_numpy()[asked],
                    "row": rows[found],
                    "lower": lower[asked, found],
                    "upper": (about + slack)[asked, found],
                }
            )
        )
    return pd.concat(parts, ignore_index=True)


def _scores(pairs: DataFrame, asked: DataFrame, classes: DataFrame) -> DataFrame:
    """Exact inner products of ``(query, row)`` pairs: ``query, id, digest, score``."""
    products = F.zip_with("v", "w", F.try_multiply)
    return (
        pairs.select("query", "row")
        .join(classes.select("row", "digest", "v"), "row")
        .join(asked.select("query", "id", F.col("v").alias("w")), "query")
        .select(
            "query",
            "id",
            "digest",
            F.aggregate(products, F.lit(0).cast("long"), F.try_add).alias("score"),
        )
    )


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    ident: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    cells: int = CELLS,
) -> DataFrame:
    """The ``k`` best of ``vectors`` for each row of ``queries`` by the inner product of the
    integer vectors ``floor(scale * x)``: ``query_id, rank, vec_id, score``, ties to the smaller id.

    Rows with the query's own id are no candidates. Fewer candidates than ``k`` give all of them; a
    query without any gives no row. Rows that are null, or hold a null or non-finite component, take
    no part. Vectors are compared with those of their own length only. A vector id that repeats is
    a candidate each time; a query id that repeats is searched once for each different vector and
    the best ``k`` of all are returned. Scores beyond 64 bits sort last and are null. Other columns
    are ignored. Rows with equal vectors are scanned once. Approximations are dealt into slabs and
    queries into blocks of bounded size, and each pair of a slab and a block is one group, so no task
    holds more than one of each; full vectors are never sent to the blocks.

    The number of cells bounds only how many full vectors are read, not the result.
    """
    if not 1 <= cells <= 128:
        raise ValueError("cells must be between 1 and 128")
    points = integer_vectors(vectors, ident, vector, scale)
    points = materialise(
        points.withColumn("digest", F.md5(F.concat_ws(",", F.col("v").cast("array<string>")))), "vectors"
    )
    members = materialise(_members(points, k), "members")
    # ``single``: all rows with this vector have one id, ``only_id``.
    classes = materialise(
        points.groupBy("digest")
        .agg(
            F.min("id").alias("only_id"),
            (F.min("id") == F.max("id")).alias("single"),
            F.any_value("v").alias("v"),
        )
        .select("digest", "only_id", "single", "v", F.size("v").alias("dim"))
        .withColumn("row", F.monotonically_increasing_id()),
        "classes",
    )
    asked = materialise(
        integer_vectors(queries, ident, vector, scale)
        .distinct()
        .withColumn("dim", F.size("v"))
        .withColumn("query", F.monotonically_increasing_id()),
        "queries",
    )
    # One row per vector length, a handful: sizes of the blocks and the range of the components.
    low, high = F.min(F.array_min("v")).cast("double"), F.max(F.array_max("v")).cast("double")
    sizes = classes.groupBy("dim").agg(
        low.alias("low"),
        F.greatest(F.ceil((high - low + 1) / cells), F.lit(1)).cast("double").alias("width"),
        F.ceil(F.count(F.lit(1)) / SLAB_ROWS).alias("_slabs"),
        F.lit(cells).alias("_cells"),
    )
    blocks = asked.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("_blocks"))
    sizes = materialise(sizes.join(blocks, "dim"), "sizes")
    approximations = materialise(_approximations(classes, sizes), "approximations")

    def others(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    slabs = approximations.withColumn("block", others("_blocks")).drop("_blocks")
    wanted = (
        asked.join(sizes.select("dim", "_slabs", "_blocks"), "dim")
        .withColumn("block", F.pmod(F.xxhash64("query"), F.col("_blocks")))
        .withColumn("slab", others("_slabs"))
        .select("dim", "block", "slab", "query", "id", "v")
    )
    key = ["dim", "slab", "block"]
    none = pd.DataFrame({"query": [], "row": [], "lower": [], "upper": []})

    def scan(own: pd.DataFrame, slab: pd.DataFrame) -> pd.DataFrame:
        if own.empty or slab.empty:
            return none.astype({"query": "int64", "row": "int64"})
        return _scan(own, slab, k)

    bounds = materialise(
        wanted.groupBy(*key)
        .cogroup(slabs.groupBy(*key))
        .applyInPandas(scan, "query long, row long, lower double, upper double"),
        "bounds",
    )

    def place(column: str) -> Column:
        return F.row_number().over(Window.partitionBy("query").orderBy(F.desc(column), "row"))

    def kth(best: DataFrame, column: str) -> DataFrame:
        """The kth best of each query's ``column``, null if there are fewer."""
        least = F.when(F.count(column) >= k, F.min(column)).alias("floor")
        return best.groupBy("query").agg(least)

    lowest = kth(bounds.withColumn("_place", place("lower")).where(F.col("_place") <= k), "lower")
    possible = F.col("floor").isNull() | (F.col("upper") >= F.col("floor"))
    left = materialise(
        bounds.join(lowest, "query").where(possible).drop("floor", "lower").withColumn("place", place("upper")),
        "left",
    )
    read = F.col("place") <= FIRST_READS * k
    first = materialise(_scores(left.where(read), asked, classes), "first")
    best = first.withColumn(
        "_place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "digest"))
    )
    floors = kth(best.where(F.col("_place") <= k), "score")
    # A candidate whose bound equals the kth score can still win by its smaller id.
    rest = left.where(~read).join(floors, "query").where(possible)
    found = first.unionByName(_scores(rest, asked, classes)).select(
        F.col("id").alias("query_id"), "digest", "score"
    )
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.join(members, "digest")
        .where(F.col("id") != F.col("query_id"))
        .select("query_id", F.col("id").alias("vec_id"), "score", F.explode(F.sequence(F.lit(1), F.col("n"))))
        .withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
