"""Landed source pages: JSON answers, one per line.

An answer is ``{"symbol", "recordsTotal", "data": [row]}``. Without ``symbol`` the file name
(``<symbol>.json`` or ``<symbol>.<anything>.json``) gives it.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean_name_column, is_missing_text, number_from_text
from ..schema import DATE, NUMERIC_FIELDS, PAGE_FIELDS, PAGE_ROW_NUMBER, RAW_SCHEMA, SYMBOL
from ..session import few_listing_tasks
from .company_files import symbol_from_path

JSON_STEM = r"([^/.]+)[^/]*\.json$"
_CORRUPT = "_corrupt_record"

# Names and types of the source's values are not known, so a row is read as names and texts.
PAGE_SCHEMA = T.StructType(
    [
        T.StructField(SYMBOL, T.StringType()),
        T.StructField("recordsTotal", T.StringType()),
        T.StructField("data", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
        T.StructField(_CORRUPT, T.StringType()),
    ]
)

PARSED_SCHEMA = T.StructType(
    [
        *RAW_SCHEMA.fields,
        *[T.StructField(name, T.StringType()) for name in ("_path", "_line", "_reason")],
    ]
)


def _with_symbol(pages: DataFrame, symbol_pattern: str = JSON_STEM) -> DataFrame:
    stem = symbol_from_path(F.col("_metadata.file_path"), symbol_pattern)
    named = F.coalesce(F.col(SYMBOL), F.when(stem != "", stem))
    return pages.select(
        named.alias(SYMBOL),
        "recordsTotal",
        F.transform("data", lambda row: F.map_entries(row)).alias("data"),
        F.col("_metadata.file_path").alias("_path"),
        _CORRUPT,
    )


def read_pages(
    spark: SparkSession, landing: str | list[str], symbol_pattern: str = JSON_STEM
) -> DataFrame:
    """Answers with their rows as lists of (key, value). A symbol that the answers lack is taken from
    the path."""
    with few_listing_tasks(spark):
        answers = spark.read.schema(PAGE_SCHEMA).json(landing)
    return _with_symbol(answers, symbol_pattern)


def stream_pages(spark: SparkSession, landing: str, files_per_batch: int = 1000) -> DataFrame:
    reader = spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
    return _with_symbol(reader.json(landing))


def _tidy(key: Column) -> Column:
    """Cleaned name, dots kept; names that are clean already skip the work."""
    return F.when(key.isin([*PAGE_FIELDS, SYMBOL]), key).otherwise(
        clean_name_column(key, drop_dots=False)
    )


def parse_pages(pages: DataFrame, thousands: str | None = None) -> DataFrame:
    """Every row of all pages with its values, its file and, when it cannot be used, a reason; see
    ``PARSED_SCHEMA``. A page without ``data`` has no row, a page that is no JSON answer is one
    unusable row. Columns are matched by cleaned name, so the page row number and unknown columns
    go. Of two columns of one name the first counts.

    ``thousands`` is the separator numbers may be grouped by; without it such numbers are
    unreadable.
    """
    unreadable = F.col(_CORRUPT).isNotNull()
    rows = (
        pages.withColumn("_cells", F.explode_outer(F.when(~unreadable, F.col("data"))))
        .where(unreadable | F.col("_cells").isNotNull())
        .withColumn("_names", F.transform("_cells", lambda cell: _tidy(cell["key"])))
    )
    types = {field.name: field.dataType for field in RAW_SCHEMA.fields}
    place = {name: (F.array_position("_names", name) - 1).cast("int") for name in PAGE_FIELDS}
    texts = {name: F.get("_cells", place[name])["value"] for name in PAGE_FIELDS}
    kept = (SYMBOL, "_path", _CORRUPT, "_cells")
    found = rows.select(*kept, *[texts[name].alias(f"_text_{name}") for name in PAGE_FIELDS])
    values = [
        number_from_text(F.col(f"_text_{name}"), types[name], thousands).alias(name) for name in NUMERIC_FIELDS
    ]
    # As in the scan of company files: a generator of one row per row, so that every number is parsed once.
    read = found.select(F.inline(F.array(F.struct(*found.columns, *values))))
    not_number = reduce(
        or_, [F.col(name).isNull() & ~is_missing_text(F.col(f"_text_{name}")) for name in NUMERIC_FIELDS]
    )
    reason = F.when(unreadable, "not a page").when(not_number, "not a number")
    date = F.col(f"_text_{DATE}")
    return read.select(
        F.when(~is_missing_text(date), date).alias(DATE),
        *NUMERIC_FIELDS,
        SYMBOL,
        "_path",
        F.when(reason.isNotNull(), F.coalesce(_CORRUPT, F.to_json("_cells"))).alias("_line"),
        reason.alias("_reason"),
    )


def usable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("_reason").isNull()).drop("_path", "_line", "_reason")


def quarantine(parsed: DataFrame) -> DataFrame:
    """The other rows: ``path, line, reason``, as for company files."""
    return parsed.where(F.col("_reason").isNotNull()).select(
        F.col("_path").alias("path"), F.col("_line").alias("line"), F.col("_reason").alias("reason")
    )


def explode_pages(pages: DataFrame, thousands: str | None = None) -> DataFrame:
    """The usable rows of :func:`parse_pages`."""
    return usable(parse_pages(pages, thousands))


def page_completeness(pages: DataFrame) -> DataFrame:
    """Per symbol: rows the source announced (0 if it never did), different rows landed, missing.

    Pages overlap when the source grows between two requests, so rows are told apart by a digest
    of their cells without the page row number, which shifts then. Copies collapse before they are
    shuffled.
    """
    number = PAGE_ROW_NUMBER.lower()
    cells = F.filter("_cells", lambda cell: _tidy(cell["key"]) != number)
    digest = F.md5(F.to_json(F.array_sort(cells)))
    rows = (
        pages.select(SYMBOL, "recordsTotal", F.explode_outer("data").alias("_cells"))
        .groupBy(SYMBOL, digest.alias("_digest"))
        .agg(F.max(F.col("recordsTotal").try_cast("bigint")).alias("_announced"))
    )
    counts = rows.groupBy(SYMBOL).agg(
        F.coalesce(F.max("_announced"), F.lit(0)).alias("announced"),
        F.count("_digest").alias("landed"),
    )
    return counts.withColumn(
        "missing", F.greatest(F.col("announced") - F.col("landed"), F.lit(0))
    )
