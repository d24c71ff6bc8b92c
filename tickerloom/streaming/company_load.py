"""Resumable load of page files with progress per company.

Each company has a progress log of its own: a line of JSON for every page file read, with the rows it
brought. A company whose log holds an unreadable line starts again, and only its files are read
again; the others go on where they stopped. Pages logged in a file that cannot be read at all are
read again too.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..folders import write_folders
from ..schema import SYMBOL
from ..session import delete_folders, few_listing_tasks, few_reading_tasks, is_absent, materialise, read_or_empty
from ..sources.company_files import list_files, plain_path, symbol_from_path
from ..sources.pages import JSON_STEM, PARSED_SCHEMA, parse_pages, read_pages

FILES_A_SLICE = 10_000
_VERSION = ["path", "length", "modified"]
_ENTRY = "path string, length bigint, modified string, rows bigint"


def page_files(spark: SparkSession, landing: str, symbol_pattern: str = JSON_STEM) -> DataFrame:
    """``symbol, path, length, modified`` of every page file; the symbol is in the path."""
    files = list_files(spark, landing, nested=True, pattern="*.json").where("length > 0")
    return files.select(
        symbol_from_path(F.col("path"), symbol_pattern).alias(SYMBOL),
        "path",
        "length",
        F.col("modified").cast("string").alias("modified"),
    )


def _log_lines(spark: SparkSession, progress: str) -> DataFrame:
    """Every line of all progress logs: company, folder, entry and whether it is unreadable."""
    folder = F.regexp_extract("_file", r"^(.*/symbol=[^/]*)/[^/]*$", 1)
    try:
        # A damaged file has no lines, so its pages are new again.
        reader = spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true")
        with few_listing_tasks(spark):
            lines = reader.text(progress)
        lines = lines.select(F.col("value").alias("_line"), F.col("_metadata.file_path").alias("_file"))
    except AnalysisException as error:
        if not is_absent(error):
            raise
        lines = spark.createDataFrame([], "_line string, _file string")
    entry = F.from_json("_line", _ENTRY, {"mode": "PERMISSIVE"})
    read = lines.select(folder.alias("_folder"), entry.alias("_entry"))
    complete = F.col("_entry.path").isNotNull() & F.col("_entry.rows").isNotNull()
    symbol = symbol_from_path(F.col("_folder"), r"symbol=([^/]*)$")
    return read.select(
        symbol.alias(SYMBOL), "_folder", "_entry.*", (~F.coalesce(complete, F.lit(False))).alias("_broken")
    )


def broken_companies(spark: SparkSession, progress: str) -> DataFrame:
    """Companies with an unreadable line in their progress log, and the log's folder."""
    return _broken(_log_lines(spark, progress))


def _broken(logs: DataFrame) -> DataFrame:
    return logs.where("_broken").select(SYMBOL, "_folder").distinct()


def offsets(spark: SparkSession, progress: str) -> DataFrame:
    """Per company the page files read, their rows, and the number of the next row (from 1)."""
    return (
        _log_lines(spark, progress)
        .where("not _broken")
        .groupBy(SYMBOL)
        .agg(F.count(F.lit(1)).alias("pages"), F.sum("rows").alias("rows"))
        .withColumn("next_row", F.col("rows") + 1)
    )


def load_company_pages(
    spark: SparkSession, landing: str, staged: str, progress: str, symbol_pattern: str = JSON_STEM
) -> list[str]:
    """Stage the rows of all page files that are new to their company; returns the companies that
    were started again.

    Files are read in slices of companies' files. Rows are staged before the progress is logged: a run
    that was killed in between stages a slice again, and publishing drops the copies. Names of new files
    pass through the driver, as Spark's own listing does. The logs are read once, each being a small file.
    """
    with few_reading_tasks(spark):
        logs = materialise(_log_lines(spark, progress), "logs")
    broken = _broken(logs)
    restarted = broken.collect()
    delete_folders(spark, [plain_path(row["_folder"]) for row in restarted])
    logged = logs.join(broken, "_folder", "left_anti").select(*_VERSION)
    new = materialise(
        page_files(spark, landing, symbol_pattern).join(logged, _VERSION, "left_anti"), "new_pages"
    )
    names = [row["path"] for row in new.select("path").orderBy(SYMBOL, "path").toLocalIterator()]
    for start in range(0, len(names), FILES_A_SLICE):
        _load_slice(spark, new, names[start : start + FILES_A_SLICE], staged, progress, symbol_pattern)
    return sorted(row[SYMBOL] for row in restarted)


def _load_slice(
    spark: SparkSession, new: DataFrame, names: list[str], staged: str, progress: str, symbol_pattern: str
) -> None:
    part = f"{staged}/slice={uuid.uuid4().hex}"
    pages = read_pages(spark, [plain_path(name) for name in names], symbol_pattern)
    with few_reading_tasks(spark):
        parse_pages(pages).write.parquet(part)
    counts = (
        spark.read.schema(PARSED_SCHEMA).parquet(part)
        .groupBy(F.col("_path").alias("path"))
        .agg(F.count_if(F.col("_reason").isNull()).alias("rows"))
    )
    listed = spark.createDataFrame([(name,) for name in names], "path string")
    entries = new.join(listed, "path", "left_semi").join(counts, "path", "left").select(
        SYMBOL,
        F.to_json(F.struct(*_VERSION, F.coalesce("rows", F.lit(0)).alias("rows"))).alias("value"),
    )
    write_folders(entries, SYMBOL, progress, "text")


def staged_rows(spark: SparkSession, staged: str) -> DataFrame:
    """Every staged row, parsed (see ``pages.PARSED_SCHEMA``)."""
    return read_or_empty(spark, staged, T.StructType([*PARSED_SCHEMA.fields, T.StructField("slice", T.StringType())])).drop("slice")
