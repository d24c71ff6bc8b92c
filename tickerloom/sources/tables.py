"""Tables, named datasets, merged CSV, databases."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import is_missing_text, number_from_text
from ..schema import RAW_SCHEMA

_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


# -- merged CSV ---------------------------------------------------------------------------------


def write_csv(df: DataFrame, path: str) -> None:
    """Replace a CSV dataset; every part has a header."""
    df.write.mode("overwrite").csv(path, header=True)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Read a CSV dataset written with ``schema``. Numbers are read as text first, because the CSV
    reader turns some spellings of infinity into NULL and stops on none."""
    text = T.StructType([T.StructField(field.name, T.StringType()) for field in schema.fields])
    raw = spark.read.csv(path, header=True, schema=text, enforceSchema=False)

    def cell(field: T.StructField) -> F.Column:
        value = F.col(field.name)
        if isinstance(field.dataType, T.NumericType):
            value = number_from_text(value, field.dataType)
        else:
            value = F.when(~is_missing_text(value), value).try_cast(field.dataType)
        return value.alias(field.name)

    return raw.select(*[cell(field) for field in schema.fields])


# -- catalog tables -----------------------------------------------------------------------------


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a catalog table, optionally at a path all executors share."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


# -- named datasets -----------------------------------------------------------------------------


def _dataset_path(base: str, key: str) -> str:
    if not _NAME.fullmatch(key):
        raise ValueError(f"not a dataset name: {key!r}")
    return f"{base.rstrip('/')}/{key}"


def save_dataset(df: DataFrame, base: str, key: str) -> None:
    """Store a DataFrame under a name, replacing what was there."""
    df.write.mode("overwrite").parquet(_dataset_path(base, key))


def append_dataset(df: DataFrame, base: str, key: str) -> None:
    """Add rows to a named dataset, creating it if need be."""
    df.write.mode("append").parquet(_dataset_path(base, key))


def load_dataset(spark: SparkSession, base: str, key: str) -> DataFrame:
    """The DataFrame stored under a name; an unknown name is an error."""
    try:
        return spark.read.parquet(_dataset_path(base, key))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ValueError(f"no dataset named {key!r}") from error


# -- databases ----------------------------------------------------------------------------------


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    partition: tuple[str, str, str, int] | None = None,
) -> DataFrame:
    """Read a database table. ``partition`` is (column, lower, upper, tasks): without it one task
    reads the whole table. Credentials come with ``options``, from the caller's configuration."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(options or {}))
    if partition is not None:
        column, lower, upper, tasks = partition
        reader = reader.options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=str(tasks)
        )
    return reader.load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    batch_rows: int = 5000,
) -> None:
    """Replace a database table, sending ``batch_rows`` rows at a time."""
    df.write.format("jdbc").mode("overwrite").options(
        url=url, dbtable=table, batchsize=str(batch_rows), **(options or {})
    ).save()
