"""A corpus pipeline: each stage is one operator, written as Parquet and read again.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import decontamination, line_dedup, near_join, packing, toxicity
from tickerloom.llm.queries import BATCH_ROWS, table
from tickerloom.session import fresh_path


def reject_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that are not scored as toxic. Labels of training rows are read, never scored."""
    labels = table(spark, folder, "labels")
    scored = toxicity.toxicity_scores(docs, toxicity.learn_lexicon(docs, labels))
    return scored.where("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without lines that are near copies of an earlier line."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_join.keep_one_of_each(docs)


def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the passages they share with the benchmark."""
    cut = decontamination.remove_passages(docs, table(spark, folder, "benchmark"))
    return cut.withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sequences of the documents that are left, in padded buckets and batches."""
    return packing.length_buckets(docs)


def _small_batches(stage):
    """The stage with Arrow batches of few rows, as texts may be long."""

    def run_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, folder)

    return run_stage


STAGES = [
    ("toxicity", _small_batches(reject_toxic)),
    ("line_dedup", _small_batches(drop_repeated_lines)),
    ("near_join", _small_batches(keep_one_of_each)),
    ("decontamination", _small_batches(cut_benchmark_passages)),
    ("packing", pack),
]

# The toxicity score is a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in order, over the whole of ``documents``."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
