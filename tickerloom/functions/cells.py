"""Expressions on single cells. All are built-in Spark functions, so they stay in codegen."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts a CSV reader takes as "missing".
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_INFINITY = float("inf")


def clean_name(name: str, drop_dots: bool = True) -> str:
    """Normal form of a column name: trimmed, lower case, ``_`` for blanks, no dots."""
    tidy = name.lstrip("﻿").strip().lower().replace(" ", "_")
    return tidy.replace(".", "") if drop_dots else tidy


def clean_name_column(name: Column, drop_dots: bool = True) -> Column:
    """``clean_name`` for names held in a column."""
    trimmed = F.regexp_replace(name, r"(?U)^[﻿\s]+|\s+$", "")
    tidy = F.replace(F.lower(trimmed), F.lit(" "), F.lit("_"))
    return F.replace(tidy, F.lit("."), F.lit("")) if drop_dots else tidy


def split_csv_line(line: Column) -> Column:
    """Fields of one CSV line. Only lines with a quote pay for the quote-aware split."""
    quoted = F.transform(
        F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1),
        lambda field: F.replace(
            F.regexp_replace(field, r'^\s*"(.*)"\s*$', "$1"), F.lit('""'), F.lit('"')
        ),
    )
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ",", -1))


def is_missing_text(text: Column) -> Column:
    return text.isNull() | F.trim(text).isin(MISSING_TEXTS)


# What the double cast accepts beyond decimal numbers: type letters and hexadecimal digits.
_NOT_DECIMAL = r"[0-9.][dDfF]\s*$|[xX]"


def number_from_text(
    text: Column, kind: T.DataType | None = None, thousands: str | None = None
) -> Column:
    """Number in a text, NULL when missing or unreadable; every spelling of infinity is accepted.
    Whole numbers may be written with a fraction (``1.0``), and with a separator between groups of
    three digits when ``thousands`` names one."""
    if thousands is not None:
        mark = re.escape(thousands)
        grouped = text.rlike(rf"^\s*[+-]?\d{{1,3}}({mark}\d{{3}})+(\.\d*)?\s*$")
        text = F.when(grouped, F.replace(text, F.lit(thousands), F.lit(""))).otherwise(text)
    value = F.when(~text.rlike(_NOT_DECIMAL), F.trim(text).try_cast(T.DoubleType()))
    if kind is None or isinstance(kind, T.DoubleType):
        return F.nullif(value, F.lit(float("nan")))
    return value.try_cast(kind)


def date_from_text(text: Column, formats: Sequence[str] = ()) -> Column:
    """ISO date in a text, else the first of ``formats`` that reads it, else NULL."""
    return F.coalesce(
        text.try_cast(T.DateType()),
        *[F.try_to_date(text, fmt) for fmt in formats],
    )


def finite_or_null(value: Column) -> Column:
    """NULL for NaN and both infinities. Spark sorts NaN above infinity, so one test is enough."""
    return F.when(F.abs(value) < _INFINITY, value)


def is_missing(value: Column, kind: T.DataType) -> Column:
    """NULL, or NaN where the type has one."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def movement(opened: Column, closed: Column) -> Column:
    """``up``, ``down`` or ``same``; a missing price (NULL or NaN) gives ``same``."""
    comparable = ~(F.isnan(opened) | F.isnan(closed))
    return (
        F.when(comparable & (closed > opened), "up")
        .when(comparable & (closed < opened), "down")
        .otherwise("same")
    )


def flatten_once(lists: Column) -> Column:
    """One list of the items of a list of lists, in order."""
    return F.flatten(lists)
