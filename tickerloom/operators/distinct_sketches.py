"""Distinct counts that can be added up: a HyperLogLog sketch for each day.

The number of companies of a week is not the sum of those of its days. Sketches of days can be united
for any span, and new rows only add sketches, so nothing is counted twice and no old row is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DATE, SYMBOL
from ..session import read_or_empty

LOG_REGISTERS = 12  # 4,096 registers: a standard error of 1.6 %
SKETCH_SCHEMA = f"{DATE} date, sketch binary"


def daily_sketches(df: DataFrame, counted: str = SYMBOL, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """A sketch of the different values of ``counted`` for each day, rows without a day left out.
    Tasks send sketches, a few kilobytes each, whatever the number of rows."""
    return (
        df.where(F.col(DATE).isNotNull())
        .groupBy(DATE)
        .agg(F.hll_sketch_agg(counted, log_registers).alias("sketch"))
    )


def add_sketches(df: DataFrame, path: str, counted: str = SYMBOL) -> None:
    """Append the sketches of new rows. A day may have several; rows that come again do no harm."""
    daily_sketches(df, counted).write.mode("append").parquet(path)


def stored_sketches(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, SKETCH_SCHEMA)


def distinct_counts(sketches: DataFrame, span: Column) -> DataFrame:
    """``span, estimate``: about how many different values each span of days has."""
    return sketches.groupBy(span.alias("span")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate")
    )
