"""Daily rows, appended when they are new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import undated_rows, unseen_rows
from ..schema import DATE, RAW_SCHEMA, SYMBOL
from ..session import create_empty_file, exists, file_names, materialise, read_or_empty

YEAR = "year"


def write_history(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store a panel by year, so that a day's append reads and writes one year only."""
    df.withColumn(YEAR, F.year(DATE)).write.mode(mode).partitionBy(YEAR).parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def history_rows(spark: SparkSession, path: str) -> DataFrame:
    """The appended rows with the columns of ``RAW_SCHEMA``, days as dates; none where there are none."""
    fields = [T.StructField(DATE, T.DateType()) if f.name == DATE else f for f in RAW_SCHEMA.fields]
    return read_or_empty(spark, path, T.StructType(fields)).select(*RAW_SCHEMA.names)


def append_batch(spark: SparkSession, history: str, batch: DataFrame, number: int = 0) -> None:
    """Append the rows of a batch whose (symbol, day) the history lacks. Running it again with the
    same batch adds nothing, so a replayed micro-batch is harmless. Rows without a symbol or a day
    go to ``<history>_quarantine/batch=<number>``, replacing what an earlier run left there."""
    batch = materialise(batch, "batch")  # read three times; survives a lost executor
    undated_rows(batch).write.mode("overwrite").parquet(f"{history}_quarantine/batch={number}")
    dated = batch.dropna(subset=[SYMBOL, DATE])
    span = dated.agg(F.min(DATE).alias("first"), F.max(DATE).alias("last")).first()
    if span["first"] is None:
        return
    stored = read_or_empty(spark, history, dated.withColumn(YEAR, F.lit(0)).schema).where(
        F.col(YEAR).between(span["first"].year, span["last"].year)
    )
    write_history(unseen_rows(stored.drop(YEAR), dated), history, "append")


def commit_batch(spark: SparkSession, history: str, stream: str, batch: DataFrame, number: int) -> bool:
    """Append a batch of a stream once: ``<history>_commits/<stream>/<number>`` is written after the
    rows, and a batch that has it is not touched again, whatever it holds when it is replayed. One
    that was killed before its commit is appended again, which adds what is missing. Tells whether
    the batch was appended."""
    done = f"{history}_commits/{stream}/{number}"
    if exists(spark, done):
        return False
    append_batch(spark, history, batch, number)
    create_empty_file(spark, done)
    return True


def committed_batches(spark: SparkSession, history: str, stream: str) -> list[int]:
    """Numbers of the batches of a stream that are in the history."""
    return sorted(int(name) for name in file_names(spark, f"{history}_commits/{stream}"))


def stream_daily_append(
    spark: SparkSession, incoming: DataFrame, history: str, progress: str, stream: str = "daily"
) -> None:
    """Run ``commit_batch`` on everything that has arrived, then stop. Late days are accepted, as
    the test is against the stored rows and not against a watermark. A stream that starts with a new
    ``progress`` folder counts its batches from 0, so it needs a new name too."""
    query = (
        incoming.writeStream.foreachBatch(
            lambda batch, number: commit_batch(batch.sparkSession, history, stream, batch, number)
        )
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def dedupe_recent(incoming: DataFrame, event_time: str, delay: str = "7 days") -> DataFrame:
    """Bounded-state alternative: drop repeats of a (symbol, day) that arrive within ``delay`` of
    each other. ``event_time`` may be a timestamp without zone; the watermark needs one with."""
    return (
        incoming.withColumn(event_time, F.col(event_time).cast("timestamp"))
        .withWatermark(event_time, delay)
        .dropDuplicatesWithinWatermark([SYMBOL, DATE])
    )


def stream_recent(incoming: DataFrame, event_time: str, path: str, progress: str, delay: str = "7 days") -> None:
    """Append everything that has arrived to ``path`` without repeats, by :func:`dedupe_recent`, then
    stop. The state of a (symbol, day) goes when the watermark passes its first row by ``delay``;
    the file sink lists its files by batch, so a replayed batch is not written twice."""
    query = (
        dedupe_recent(incoming, event_time, delay)
        .writeStream.format("parquet")
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
