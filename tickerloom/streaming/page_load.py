"""Resumable load of landed pages."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import date_from_text
from ..schema import DATE, RAW_SCHEMA, SYMBOL
from ..session import delete_folder, read_or_empty
from ..sources.pages import PARSED_SCHEMA, parse_pages, quarantine, stream_pages, usable
from .history import merge_rows, stored_rows


def _run(spark: SparkSession, landing: str, staged: str, progress: str) -> None:
    def stage(batch: DataFrame, _: int) -> None:
        parse_pages(batch).write.mode("append").parquet(staged)

    query = (
        stream_pages(spark, landing)
        .writeStream.foreachBatch(stage)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def load_pages(spark: SparkSession, landing: str, staged: str, progress: str) -> None:
    """Stage the rows of all pages that landed since the last run, then stop.

    ``progress`` is the streaming checkpoint: a run that was killed goes on where it stopped. When
    the checkpoint cannot be read, it alone goes, and the landed pages are read again; staged and
    published rows stay. Rows may be staged twice; :func:`finalise` publishes them once.
    """
    try:
        _run(spark, landing, staged, progress)
    except StreamingQueryException as error:
        if not _unreadable_progress(error):
            raise
        delete_folder(spark, progress)
        _run(spark, landing, staged, progress)


def _unreadable_progress(error: StreamingQueryException) -> bool:
    # Texts of Spark's metadata log when a file of the checkpoint is cut short or altered.
    text = str(error)
    signs = ("Incomplete log file", "Malformed log file", "Log file was malformed", "UnsupportedLogVersion")
    return any(sign.lower() in text.lower() for sign in signs)


def finalise(spark: SparkSession, staged: str, final: str) -> DataFrame:
    """Publish the staged rows that ``final`` lacks, each once, and clear the stage. Unusable rows
    go to ``<final>_quarantine`` in the same way. Published rows stay; of them only the digests in
    the partitions of the staged rows are read. A run that was killed can be run again. No row order
    is stored: sort by date when reading."""
    parsed = read_or_empty(spark, staged, PARSED_SCHEMA)
    year = F.year(date_from_text(F.col(DATE)))
    merge_rows(usable(parsed), final, SYMBOL, year)
    merge_rows(quarantine(parsed), f"{final}_quarantine", "path", F.lit(None))
    delete_folder(spark, staged)
    return published_rows(spark, final)


def published_rows(spark: SparkSession, final: str) -> DataFrame:
    """The published rows; none where nothing was published yet."""
    return stored_rows(spark, final, RAW_SCHEMA)
