"""Cleaning steps. Each is ``DataFrame -> DataFrame``; none runs a job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean_name, date_from_text, finite_or_null
from ..schema import DATE, OHLC, REQUIRED


def normalize_columns(df: DataFrame, drop_dots: bool = True) -> DataFrame:
    """Rename every column to its normal form."""
    names = [clean_name(name, drop_dots) for name in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"column names collide after cleaning: {names}")
    return df.toDF(*names)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows (NULL equals NULL, NaN equals NaN).

    Copies collapse on the map side, so a row repeated many times costs one row per task.
    """
    return df.dropDuplicates()


def nonfinite_to_null(df: DataFrame) -> DataFrame:
    """NaN and infinities of all floating-point columns become NULL."""
    return df.select(
        *[
            finite_or_null(F.col(field.name)).alias(field.name)
            if isinstance(field.dataType, (T.DoubleType, T.FloatType))
            else F.col(field.name)
            for field in df.schema.fields
        ]
    )


def parse_dates(df: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
    """Text date to ``date``; what cannot be read becomes NULL."""
    if DATE not in df.columns:
        return df
    return df.withColumn(DATE, date_from_text(F.col(DATE), formats))


def fill_change(df: DataFrame) -> DataFrame:
    """A missing daily change counts as 0."""
    return df.fillna(0.0, subset=["per_change"])


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows that miss the date, a price, the quantity, the amount or the symbol."""
    return df.dropna(subset=REQUIRED)


def positive_prices(df: DataFrame) -> DataFrame:
    """Keep rows whose four prices are all above 0. NaN is not above 0."""
    keep = F.lit(True)
    for name in OHLC:
        keep = keep & (F.col(name) > 0) & ~F.isnan(name)
    return df.where(keep)


def clean_panel(df: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
    """Raw, deduplicated rows to valid rows: unreadable and non-finite values are missing, a
    missing change is 0, and rows that miss another value or have a price not above 0 go.

    Prices are tested first, on the stored columns, so that the test reaches the scan; removing
    infinite prices afterwards gives the same rows as testing last.
    """
    return (
        df.transform(positive_prices)
        .transform(nonfinite_to_null)
        .transform(parse_dates, formats)
        .transform(fill_change)
        .transform(drop_incomplete)
    )
