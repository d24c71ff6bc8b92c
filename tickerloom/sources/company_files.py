"""A folder of CSV files, one per company, whose headers may differ."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    clean_name_column,
    is_missing_text,
    number_from_text,
    split_csv_line,
)
from ..schema import DATE, NUMERIC_FIELDS, PAGE_FIELDS, RAW_SCHEMA, SYMBOL
from ..session import few_listing_tasks, few_reading_tasks, is_absent, materialise, read_or_empty

# The symbol is the file name without its ending.
FILE_STEM = r"([^/]+)\.csv$"

_PATH = "_path"


@dataclass(frozen=True)
class CompanyFiles:
    """Result of a folder scan.

    ``parsed``: every data line with its values, its file and, when it cannot be used, a reason.
    """

    spark: SparkSession
    folder: str
    nested: bool
    parsed: DataFrame

    def files(self) -> DataFrame:
        """Path, length and time of change of every file found."""
        return list_files(self.spark, self.folder, self.nested)

    def rows(self) -> DataFrame:
        """The usable rows."""
        return self.parsed.where(F.col("_reason").isNull()).drop(_PATH, "_line", "_reason")

    def quarantine(self) -> DataFrame:
        """The other lines, with file and reason."""
        return self.parsed.where(F.col("_reason").isNotNull()).select(
            F.col(_PATH).alias("path"),
            F.col("_line").alias("line"),
            F.col("_reason").alias("reason"),
        )

    def audit(self) -> DataFrame:
        """Usable and quarantined rows per file; files without a row are listed with 0."""
        usable = F.col("_reason").isNull()
        counts = self.parsed.groupBy(F.col(_PATH).alias("path")).agg(
            F.count_if(usable).alias("row_count"), F.count_if(~usable).alias("quarantined")
        )
        return self.files().join(counts, "path", "left").select(
            "path",
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
            F.coalesce("quarantined", F.lit(0)).alias("quarantined"),
        )


def list_files(
    spark: SparkSession, folder: str, nested: bool = False, pattern: str = "*.csv"
) -> DataFrame:
    """Path, length and time of change of the files of a folder, stored; an absent folder has none.

    Spark reads no file without a byte and leaves it out of its rows, not out of its list of names:
    such a file has length 0 and no time."""
    try:
        reader = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", str(nested).lower())
        )
        with few_listing_tasks(spark):
            files = reader.load(folder)
    except AnalysisException as error:
        if not is_absent(error):
            raise
        return spark.createDataFrame([], "path string, length bigint, modified timestamp")
    found = files.select(
        F.col("_metadata.file_path").alias("path"), "length", F.col("modificationTime").alias("modified")
    )
    # The list and the rows differ in the slashes after the scheme.
    key = F.regexp_replace("path", r"^([\w.+-]+):/+", "$1:///").alias("_key")
    listed = spark.createDataFrame(pa.table({"path": pa.array(_input_files(files), pa.string())})).select(key)
    every = listed.join(found.select("*", key), "_key", "left").select(
        F.coalesce("path", "_key").alias("path"), F.coalesce("length", F.lit(0).cast("bigint")).alias("length"), "modified"
    )
    with few_reading_tasks(spark):
        return materialise(every, "listing")


def _input_files(files: DataFrame) -> list[str]:
    """As ``inputFiles()``, which asks the JVM for each name by itself. Names are percent-encoded, so
    none has a line end."""
    text = files.sparkSession._jvm.scala.Predef.genericWrapArray(files._jdf.inputFiles()).mkString("\n")
    return text.split("\n") if text else []


def _lines(spark: SparkSession, source: str | list[str], nested: bool) -> DataFrame | None:
    """Lines of all files, stored once with their file and place; None when the folder is absent.

    The text is read here and nowhere else: headers and values are taken from the stored lines.
    ``_at`` grows along the first split of a file (``_first``), which holds its first line."""
    reader = spark.read.option("pathGlobFilter", "*.csv").option(
        "recursiveFileLookup", str(nested).lower()
    )
    try:
        with few_listing_tasks(spark):
            text = reader.text(source)
    except AnalysisException as error:
        if not is_absent(error):
            raise
        return None
    lines = text.select(
        F.col("value").alias("_line"),
        F.col("_metadata.file_path").alias(_PATH),
        (F.col("_metadata.file_block_start") == 0).alias("_first"),
        F.monotonically_increasing_id().alias("_at"),
    )
    with few_reading_tasks(spark):
        return materialise(lines.where(F.trim("_line") != ""), "lines")


def symbol_from_path(path: Column, pattern: str = FILE_STEM) -> Column:
    """Symbol in a (percent-encoded) file path."""
    encoded = F.regexp_extract(path, pattern, 1)
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def _headers(lines: DataFrame, wanted: Sequence[str], symbol_pattern: str) -> DataFrame:
    """Per file its symbol, its header and the place of each wanted column. The header is the line
    that names the date; a file with different such lines is ambiguous. Without such a line it is the
    file's first one, if that names another known column."""

    def names(line: Column) -> Column:
        return F.transform(split_csv_line(line), lambda name: clean_name_column(name))

    line = F.col("_line")
    # The cheap test goes first: data lines never reach the split.
    dated = F.when(F.lower(line).contains("published") & F.array_contains(names(line), DATE), line)
    found = (
        lines.groupBy(_PATH)
        .agg(
            F.min(dated).alias("_header"),
            F.max(dated).alias("_other_header"),
            F.min_by(line, F.when(F.col("_first"), F.col("_at"))).alias("_top"),
        )
        .withColumn(
            "_top",
            F.when(F.arrays_overlap(names(F.col("_top")), F.array(*map(F.lit, NUMERIC_FIELDS))), F.col("_top")),
        )
        .withColumn("_header", F.coalesce("_header", "_top"))
        .withColumn("_other_header", F.coalesce("_other_header", "_top"))
        .withColumn("_names", names(F.col("_header")))
    )
    places = [
        (F.array_position("_names", name) - 1).cast("int").alias(f"_at_{name}") for name in wanted
    ]
    return found.where(F.col("_header").isNotNull()).select(
        _PATH,
        symbol_from_path(F.col(_PATH), symbol_pattern).alias(SYMBOL),
        "_header",
        "_other_header",
        F.size("_names").alias("_width"),
        *places,
    )


def scan_company_files(
    spark: SparkSession,
    folder: str,
    symbol_pattern: str = FILE_STEM,
    nested: bool = False,
    extra_columns: Sequence[str] = (),
) -> CompanyFiles:
    """Read all files of a folder at once, matching columns by header name, not by position.

    The files are read as lines, so a large file splits over many tasks, and stored. From the stored
    lines come each file's header and the places of the known columns, one row per file. That table is
    joined without a hint: Spark knows its stored size and broadcasts it only when it is small.

    A file without a date column is kept, its dates are NULL. A line is set aside when its file has no
    header or two different ones, when it has more fields than the header, or when a numeric field
    holds other text or a number out of range. Unknown columns are dropped unless named in
    ``extra_columns`` (kept as text). Line breaks inside quotes are not supported.
    """
    lines = _lines(spark, folder, nested)
    parsed = _nothing(spark, extra_columns) if lines is None else _parsed(lines, symbol_pattern, extra_columns)
    return CompanyFiles(spark, folder, nested, parsed)


def _nothing(spark: SparkSession, extra_columns: Sequence[str]) -> DataFrame:
    empty = spark.createDataFrame([], RAW_SCHEMA).select(*PAGE_FIELDS, SYMBOL)
    for name in [*extra_columns, _PATH, "_line", "_reason"]:
        empty = empty.withColumn(name, F.lit(None).cast("string"))
    return empty


def _parsed(lines: DataFrame, symbol_pattern: str, extra_columns: Sequence[str]) -> DataFrame:
    """Every data line with its values, its file and, when it cannot be used, a reason."""
    wanted = [*PAGE_FIELDS, *extra_columns]
    headers = materialise(_headers(lines, wanted, symbol_pattern), "headers")
    is_header = (F.col("_line") == F.col("_header")) | (F.col("_line") == F.col("_other_header"))
    cells = (
        lines.withColumn("_fields", split_csv_line(F.col("_line")))
        .join(headers, _PATH, "left")
        .where(~F.coalesce(is_header, F.lit(False)))
    )
    types = {field.name: field.dataType for field in RAW_SCHEMA.fields}
    texts = {name: F.get("_fields", F.col(f"_at_{name}")) for name in wanted}
    values = [
        number_from_text(texts[name], types[name]).alias(name)
        if name in NUMERIC_FIELDS
        else F.when(~is_missing_text(texts[name]), texts[name]).alias(name)
        for name in wanted
    ]
    # A filter on a projected value is pushed below the projection and computes it again. It is
    # not pushed below a generator, so this one, of one row per row, makes sure that every number
    # is parsed once.
    read = cells.select(F.inline(F.array(F.struct(*cells.columns, *values))))

    # Only a NULL looks at its text, so rows with all numbers, nearly all rows, skip it.
    unreadable = reduce(
        or_,
        [F.col(name).isNull() & ~is_missing_text(texts[name]) for name in NUMERIC_FIELDS],
    )
    reason = (
        F.when(F.col("_width").isNull(), "no header")
        .when(F.col("_header") != F.col("_other_header"), "two headers")
        .when(F.size("_fields") > F.col("_width"), "too many fields")
        .when(unreadable, "not a number")
    )
    return read.withColumn("_reason", reason).select(
        *PAGE_FIELDS, SYMBOL, *extra_columns, _PATH, "_line", "_reason"
    )


_VERSION = ["path", "length", "modified"]
_MANIFEST = "path string, length bigint, modified timestamp, load string"
_GLOB_SIGNS = re.compile(r"([\\{}\[\]*?])")


def refresh_company_files(
    spark: SparkSession,
    folder: str,
    kept: str,
    symbol_pattern: str = FILE_STEM,
    nested: bool = False,
) -> CompanyFiles:
    """As :func:`scan_company_files`, reading only the files that are new or have changed since the
    last run with the folder ``kept``.

    ``<kept>/manifest`` lists the files read, with length and time of change, ``<kept>/rows`` holds
    their parsed lines, both in one part per run (``load``). Rows are written before the manifest, so
    those of a run that was killed do not count and its files are read again. Rows of a file that has
    changed or gone stay stored but no longer show. Settings must stay the same between runs. Names of new
    files pass through the driver, as Spark's own listing does.
    """
    listing = list_files(spark, folder, nested).where("length > 0")
    manifest = read_or_empty(spark, f"{kept}/manifest", _MANIFEST)
    new = materialise(listing.join(manifest, _VERSION, "left_anti"), "new_files")
    paths = [row["path"] for row in new.select("path").collect()]
    empty = _nothing(spark, ())
    if paths:
        load = uuid.uuid4().hex
        lines = _lines(spark, [plain_path(path) for path in paths], nested)
        rows = _parsed(lines, symbol_pattern, ())
        rows.write.parquet(f"{kept}/rows/load={load}")
        new.withColumn("load", F.lit(load)).write.mode("append").parquet(f"{kept}/manifest")
        manifest = read_or_empty(spark, f"{kept}/manifest", _MANIFEST)
    stored = read_or_empty(spark, f"{kept}/rows", T.StructType([*empty.schema.fields, T.StructField("load", T.StringType())]))
    current = listing.join(manifest, _VERSION).select(F.col("path").alias(_PATH), "load")
    parsed = stored.join(current, [_PATH, "load"], "left_semi").select(*empty.columns)
    return CompanyFiles(spark, folder, nested, parsed)


def plain_path(name: str) -> str:
    """The name Spark lists a file by as a path it reads: decoded, signs of patterns escaped."""
    return _GLOB_SIGNS.sub(r"\\\1", unquote(name))
