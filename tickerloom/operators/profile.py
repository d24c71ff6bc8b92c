"""Counts about a table. Each result is one aggregate over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_missing
from ..schema import SYMBOL



def profile(df: DataFrame) -> DataFrame:
    """One row per column: missing values, with the row and column count of the table."""
    fields = df.schema.fields
    gaps = [
        F.count_if(is_missing(F.col(field.name), field.dataType)).alias(f"_{i}")
        for i, field in enumerate(fields)
    ]
    totals = df.agg(F.count(F.lit(1)).alias("row_count"), *gaps)
    per_column = F.array(
        *[
            F.struct(F.lit(field.name).alias("column_name"), F.col(f"_{i}").alias("missing"))
            for i, field in enumerate(fields)
        ]
    )
    return totals.select("row_count", F.inline(per_column)).select(
        "column_name", "missing", "row_count", F.lit(len(fields)).cast("long").alias("column_count")
    )


def column_summary(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, values present."""
    fields = df.schema.fields
    present = [
        F.count_if(~is_missing(F.col(field.name), field.dataType)).alias(f"_{i}")
        for i, field in enumerate(fields)
    ]
    per_column = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col(f"_{i}").alias("non_null"),
            )
            for i, field in enumerate(fields)
        ]
    )
    return df.agg(*present).select(F.inline(per_column))


def rows_per_symbol(df: DataFrame) -> DataFrame:
    """Rows and distinct rows of each symbol (of each company file).

    Equal rows collapse first, on the map side, so one shuffle of the distinct rows serves both.
    """
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return distinct.groupBy(SYMBOL).agg(
        F.sum("_copies").alias("row_count"), F.count(F.lit(1)).alias("distinct_rows")
    )


def merge_audit(df: DataFrame) -> DataFrame:
    """One row: rows before the dedupe, rows removed, rows after, companies."""
    return rows_per_symbol(df).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.col("row_count") - F.col("distinct_rows")), F.lit(0)).alias("removed"),
        F.coalesce(F.sum("distinct_rows"), F.lit(0)).alias("final_rows"),
        F.count(SYMBOL).alias("companies"),
    )
