"""Union, lookup and anti joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import DATE, SYMBOL
from ..sources.companies import companies


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts; columns meet by name, absent ones are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def attach_dimension(df: DataFrame, dimension: DataFrame, key: str = SYMBOL) -> DataFrame:
    """Left join of a dimension with one row per key. No hint: Spark broadcasts the dimension
    when its own size estimate is below the threshold and shuffles (with the skew split of AQE)
    when it is not."""
    return df.join(dimension, key, "left")


def attach_company(df: DataFrame) -> DataFrame:
    """Company id and sector by symbol; unknown symbols get none. The dimension is fixed at 128
    rows, which bounds the broadcast."""
    return df.join(F.broadcast(companies(df.sparkSession)), SYMBOL, "left")


def pending_companies(wanted: DataFrame, loaded: DataFrame) -> DataFrame:
    """Companies of which nothing is loaded yet."""
    return wanted.join(loaded.select(SYMBOL).distinct(), SYMBOL, "left_anti")


def one_per_day(df: DataFrame) -> DataFrame:
    """One row per (symbol, day): the smallest by its other columns, so that it repeats."""
    others = [name for name in df.columns if name not in (SYMBOL, DATE)]
    return (
        df.groupBy(SYMBOL, DATE)
        .agg(F.min(F.struct(*others)).alias("_row"))
        .select(*[
            F.col(name) if name in (SYMBOL, DATE) else F.col("_row")[name].alias(name)
            for name in df.columns
        ])
    )


def rows_not_in(known: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new`` that ``known`` lacks, compared whole, with NULL equal to NULL."""
    a, b = new.alias("a"), known.alias("b")
    same = reduce(and_, [F.col(f"a.`{n}`").eqNullSafe(F.col(f"b.`{n}`")) for n in new.columns])
    return a.join(b, same, "left_anti")


def undated_rows(new: DataFrame) -> DataFrame:
    """Rows without a symbol or a day, which cannot be told new from old, as quarantine:
    ``path, line, reason``."""
    lacking = F.col(SYMBOL).isNull() | F.col(DATE).isNull()
    return new.where(lacking).select(
        F.lit(None).cast("string").alias("path"),
        F.to_json(F.struct(*new.columns)).alias("line"),
        F.lit("no symbol or day").alias("reason"),
    )


def unseen_rows(history: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new`` whose (symbol, day) the history lacks, one per (symbol, day). Rows without
    symbol or day take no part; see :func:`undated_rows`.

    Of the history only the two key columns are read, and only between the first and the last day
    of ``new``: the bounds are scalar subqueries, which the scan turns into pushed filters.
    """
    new = new.dropna(subset=[SYMBOL, DATE])
    fresh = one_per_day(new)
    days = new.agg(F.min(DATE).alias("first"), F.max(DATE).alias("last"))
    known = (
        history.where(
            F.col(DATE).between(days.select("first").scalar(), days.select("last").scalar())
        )
        .select(SYMBOL, DATE)
        .distinct()
    )
    return fresh.join(known, [SYMBOL, DATE], "left_anti")


def append_new_rows(history: DataFrame, new: DataFrame) -> DataFrame:
    """The history and the rows it lacked."""
    return history.unionByName(unseen_rows(history, new))
