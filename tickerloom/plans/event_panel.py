"""A price panel derived from an ``events`` table, for tables without prices.

One bar per user and day, with the kinds of dirt price files have: unreadable dates, missing, zero,
negative, NaN and infinite values, and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import clean


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars: ``uid, symbol, d, open, high, low, close, traded_quantity, traded_amount``.

    The aggregate combines on the map side, so a busy user is one row per task and day.
    """
    value, at = F.col("value"), F.col("ts")
    return (
        events(spark, folder)
        .groupBy(F.col("user_id").alias("uid"), at.cast("date").alias("d"))
        .agg(
            F.min_by(value, at).alias("open"),
            F.max(value).alias("high"),
            F.min(value).alias("low"),
            F.max_by(value, at).alias("close"),
            F.count(F.lit(1)).cast("double").alias("traded_quantity"),
            F.sum(value.cast("decimal(18,2)")).cast("double").alias("traded_amount"),
        )
        .withColumn("symbol", F.concat(F.lit("U"), F.col("uid").cast("string")))
    )


def panel(spark: SparkSession, folder: str) -> DataFrame:
    """Bars with the change against the symbol's previous bar. The window holds one row per day
    of a symbol, so the calendar bounds it."""
    previous = F.lag("close").over(Window.partitionBy("uid").orderBy("d"))
    return bars(spark, folder).withColumn(
        "per_change", F.try_divide(F.col("close") - previous, previous) * 100
    )


def raw(spark: SparkSession, folder: str) -> DataFrame:
    """The dirty panel, dates as text."""
    uid, day = F.col("uid"), F.dayofmonth("d")
    kind = F.when(day == uid % 20 + 10, uid % 20).otherwise(0)  # kind of dirt in this row
    unreadable = (day == 9) & (uid % 50 == 11)
    times = F.when(uid % 50 == 0, 2).otherwise(1)
    dirty = panel(spark, folder).select(
        "symbol",
        F.when(unreadable, "not-a-date").otherwise(F.col("d").cast("string")).alias(
            "published_date"
        ),
        F.when(kind == 3, None).when(kind == 4, 0.0).otherwise(F.col("open")).alias("open"),
        "high",
        "low",
        F.when(kind == 5, float("nan")).when(kind == 6, -1.0).otherwise(F.col("close")).alias(
            "close"
        ),
        F.when(kind == 7, float("inf")).otherwise(F.col("per_change")).alias("per_change"),
        "traded_quantity",
        "traded_amount",
        F.explode(F.array_repeat(F.lit(1), times)).alias("_time"),
    )
    return dirty.drop("_time")


def unique(spark: SparkSession, folder: str) -> DataFrame:
    return raw(spark, folder).transform(clean.dedupe_rows)


def finite(spark: SparkSession, folder: str) -> DataFrame:
    """Unique rows with dates parsed and non-finite values removed."""
    return unique(spark, folder).transform(clean.nonfinite_to_null).transform(clean.parse_dates)


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return unique(spark, folder).transform(clean.clean_panel)
