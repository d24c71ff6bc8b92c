"""Features and the next-day label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions import movement
from ..schema import DATE, FEATURES, SYMBOL, TARGET
from .ordering import range_pieces

def price_features(df: DataFrame) -> DataFrame:
    """``price_range`` and ``daily_return``; needs ``open`` above 0."""
    return df.withColumns(
        {
            "price_range": F.col("high") - F.col("low"),
            "daily_return": (F.col("close") - F.col("open")) / F.col("open"),
        }
    )


def movement_label(df: DataFrame) -> DataFrame:
    return df.withColumn("movement", movement(F.col("open"), F.col("close")))


def next_close(df: DataFrame) -> DataFrame:
    """Add ``next_close``: the close of the symbol's next row by date, NULL on its last row.

    Rows without a date follow all others. Rows of one day are ordered by a hash of their other
    columns, then by those columns, so the result repeats; equal rows follow one another.

    One path whatever the size of a symbol: the rows are cut into ranges of about one size in
    this order and stored, so a large symbol, a day or a set of copies spans several ranges. The
    next row is sought inside the range; the last row of a range takes the first row of the next
    one. A successor counts only if it is of the same symbol.
    """
    ties = [name for name in df.columns if name not in (SYMBOL, DATE)]
    order = [F.asc(SYMBOL), F.asc_nulls_last(DATE), F.xxhash64(*ties), *ties]
    pieces = range_pieces(df, order, "label")
    # A struct tells "no successor" (NULL) from "the successor has no close".
    row = F.struct(SYMBOL, "close")
    inside = F.lead(row).over(Window.partitionBy("_range").orderBy("_row"))
    # One row per range: bounded by spark.sql.shuffle.partitions.
    heads = pieces.where("_row = 0").select("_range", row.alias("_head"))
    after = F.lead("_head").over(Window.partitionBy(F.lit(0)).orderBy("_range"))
    heads = heads.select("_range", after.alias("_after"))
    same = F.col("_next")[SYMBOL].eqNullSafe(F.col(SYMBOL))
    return (
        pieces.withColumn("_inside", inside)
        .join(F.broadcast(heads), "_range")
        .withColumn("_next", F.coalesce("_inside", "_after"))
        .withColumn("next_close", F.when(same, F.col("_next")["close"]))
        .select(*df.columns, "next_close")
    )


def next_up(close: Column, following: Column) -> Column:
    """1 when the following close is above this one, else 0."""
    return F.when(following > close, 1).otherwise(0)


def label_next_up(df: DataFrame) -> DataFrame:
    """Add ``next_close`` and ``target``; drop rows without a next close."""
    return (
        next_close(df)
        .where(F.col("next_close").isNotNull() & ~F.isnan("next_close"))
        .withColumn(TARGET, next_up(F.col("close"), F.col("next_close")))
    )


def feature_matrix(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Those of the nine features that exist, in fixed order, and the target; rows with a gap go.
    ``keep`` names key columns to carry along."""
    wanted = [name for name in FEATURES if name in df.columns] + [TARGET]
    return df.select(*keep, *wanted).dropna(subset=wanted)
