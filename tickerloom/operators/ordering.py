"""Order, positions, first rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DATE, SYMBOL
from ..session import materialise


def panel_order(df: DataFrame) -> list[Column]:
    """Symbol, then date with missing dates last, then every other column, so that ties repeat.
    Without a date column, symbol only comes first."""
    others = [name for name in df.columns if name not in (SYMBOL, DATE)]
    dates = [F.asc_nulls_last(DATE)] if DATE in df.columns else []
    return [F.asc(SYMBOL), *dates, *[F.asc(name) for name in others]]


def _spread_order(df: DataFrame, order: list[Column]) -> DataFrame:
    """Global sort whose ranges are over ``order`` and a random last key, so a large symbol, and
    even the copies of one row, spread over several partitions."""
    return df.withColumn("_spread", F.rand(29)).orderBy(*order, "_spread").drop("_spread")


def sorted_panel(df: DataFrame) -> DataFrame:
    """Globally ordered panel, for the final sink; equal rows are interchangeable."""
    return _spread_order(df, panel_order(df))


def range_pieces(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The sorted rows, stored once, with the number of their range (``_range``, ascending, empty
    ranges left out) and their place in it (``_row``, from 0). Stored, so that every reader sees
    one partitioning."""
    row_bits = 33  # monotonically_increasing_id: partition number above, row number below
    return materialise(
        _spread_order(df, order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_id", row_bits))
        .withColumn("_row", F.col("_id").bitwiseAND(F.lit((1 << row_bits) - 1)))
        .drop("_id"),
        name,
    )


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """Number the rows of the sorted panel from 0.

    A window over all rows would be one task. Here each range partition numbers its own rows, and
    the sizes of the partitions before it, one row per partition, are added.
    """
    pieces = range_pieces(df, panel_order(df), "sorted")
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        pieces.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    # One row per partition of the sort: bounded by spark.sql.shuffle.partitions.
    return (
        pieces.join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_start") + F.col("_row"))
        .select(*df.columns, name)
    )


ONE_TASK = 100_000  # rows a task may gather


def first_n(df: DataFrame, n: int = 10_000, one_task: int = ONE_TASK) -> DataFrame:
    """The first ``n`` rows of the sorted panel.

    Few rows come from a top-k plan, whose last step is one task. More are cut from the sorted ranges:
    the sizes of the ranges, one number a partition, tell which lie before the cut, which one holds it
    and how many of its rows count. No task sees more than its range.
    """
    order = panel_order(df)
    if n <= one_task:
        return df.orderBy(*order).limit(n)
    pieces = range_pieces(df, order, "sorted")
    sizes = pieces.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()
    before = 0
    for size in sorted(sizes, key=lambda row: row["_range"]):
        if before + size["n"] >= n:
            here = (F.col("_range") == size["_range"]) & (F.col("_row") < n - before)
            pieces = pieces.where((F.col("_range") < size["_range"]) | here)
            break
        before += size["n"]
    return pieces.select(*df.columns)


def first_per_symbol(df: DataFrame) -> DataFrame:
    """Earliest row of each symbol. An aggregate, not a window: each task sends one row per
    symbol, whatever the symbol's size."""
    others = [name for name in df.columns if name not in (SYMBOL, DATE)]
    key = F.struct(F.col(DATE).isNull(), F.col(DATE), *others)
    return (
        df.where(F.col(SYMBOL).isNotNull())
        .groupBy(SYMBOL)
        .agg(F.min_by(F.struct(*df.columns), key).alias("_first"))
        .select(*[F.col("_first")[name].alias(name) for name in df.columns])
    )
