"""Dates whose spelling differs from source to source and is not declared.

All cells of a source (a company's file) vote: the format under which most of them read wins. Day and
month are told apart by the cells with a day above 12; where there is none, by the days being close
together, as daily rows are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import DATE, SYMBOL

ISO = "yyyy-MM-dd"
# Spellings that are tried, earlier ones first when nothing else decides.
FORMATS = (ISO, "yyyy/MM/dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd.MM.yyyy", "dd-MM-yyyy", "d MMM yyyy", "MMM d, yyyy")


def _read(text: Column, spelling: str) -> Column:
    return text.try_cast("date") if spelling == ISO else F.try_to_date(F.trim(text), spelling)


def vote(df: DataFrame, formats: Sequence[str] = FORMATS, source: str = SYMBOL) -> DataFrame:
    """One row per source: ``date_format``, the cells it reads (``read``), the other cells that are
    no NULL (``unread``), and whether another format reads as many of them as other days
    (``ambiguous``). A source of which no format reads a cell has no format.

    One aggregate that combines on the map side, so a source of a third of all rows is spread.
    """
    text = F.col(DATE).cast("string")
    days = [_read(text, spelling) for spelling in formats]
    counts = [F.count(day).alias(f"_n{i}") for i, day in enumerate(days)]
    spans = [F.datediff(F.max(day), F.min(day)).alias(f"_s{i}") for i, day in enumerate(days)]
    sums = [F.sum(F.unix_date(day)).alias(f"_d{i}") for i, day in enumerate(days)]
    votes = F.array(
        *[
            F.struct(
                (-F.col(f"_n{i}")).alias("missed"),
                F.col(f"_s{i}").alias("span"),
                F.lit(i).alias("place"),
                F.lit(spelling).alias("date_format"),
                F.col(f"_d{i}").alias("days"),
            )
            for i, spelling in enumerate(formats)
        ]
    )
    won = F.col("_votes")[0]
    rivals = F.exists(
        "_votes", lambda other: (other["missed"] == won["missed"]) & (other["days"] != won["days"])
    )
    return (
        df.groupBy(source)
        .agg(F.count(text).alias("_cells"), *counts, *spans, *sums)
        .withColumn("_votes", F.array_sort(votes))
        .select(
            source,
            F.when(won["missed"] < 0, won["date_format"]).alias("date_format"),
            (-won["missed"]).alias("read"),
            (F.col("_cells") + won["missed"]).alias("unread"),
            F.coalesce((won["missed"] < 0) & rivals, F.lit(False)).alias("ambiguous"),
        )
    )


def parse_by_vote(
    df: DataFrame, formats: Sequence[str] = FORMATS, source: str = SYMBOL, winners: DataFrame | None = None
) -> DataFrame:
    """Text dates to ``date`` by the format that won in their source; what it cannot read becomes
    NULL. The table of winners, one row per source, is joined without a hint."""
    won = (vote(df, formats, source) if winners is None else winners).select(
        F.col(source).alias("_source"), F.col("date_format").alias("_format")
    )
    text = F.col(DATE).cast("string")
    parsed = F.coalesce(*[F.when(F.col("_format") == spelling, _read(text, spelling)) for spelling in formats])
    joined = df.join(won, F.col(source).eqNullSafe(F.col("_source")), "left")
    return joined.withColumn(DATE, parsed).drop("_source", "_format")
