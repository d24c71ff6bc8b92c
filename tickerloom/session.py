"""Session defaults and the folder jobs share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tickerloom")
        .config("spark.ui.enabled", "false")
        # A status tracker forgets stages beyond these, skipped ones first.
        .config("spark.ui.retainedStages", "100000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tickerloom-")
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/tickerloom/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str, partition_by: str | None = None) -> str:
    """Write a table to a fresh path in the shared folder; returns the path."""
    path = fresh_path(df.sparkSession, name)
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    writer.parquet(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: every reader sees the same rows,
    and a lost executor re-reads files instead of recomputing the lineage. Like Spark's own
    checkpoints the files stay until the folder is cleaned."""
    return df.sparkSession.read.schema(df.schema).parquet(store(df, name))


_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_OPEN_COST = "spark.sql.files.openCostInBytes"


@contextmanager
def _at_most(spark: SparkSession, setting: str, value: int) -> Iterator[None]:
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, str(value if before is None else min(value, _bytes(before))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def _bytes(text: str) -> int:
    """A number, or a size with a unit, as Spark's settings have it."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", text.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def few_listing_tasks(spark: SparkSession) -> AbstractContextManager[None]:
    """Within it, readers list many folders or files with some tasks a core. By default Spark gives
    each of them, up to 10,000, a task of its own."""
    return _at_most(spark, _LISTING_TASKS, max(32, 4 * spark.sparkContext.defaultParallelism))


def few_reading_tasks(spark: SparkSession) -> AbstractContextManager[None]:
    """Within it, jobs read up to 128 small files a task. By default a file counts as 4 MB besides its
    bytes, so a task reads 32, and starting the tasks takes longer than reading."""
    return _at_most(spark, _OPEN_COST, 1 << 20)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A parquet folder, or no rows where it is absent."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if not is_absent(error):
            raise
        return spark.createDataFrame([], schema)


def is_absent(error: AnalysisException) -> bool:
    """Whether a read failed because its folder does not exist."""
    return error.getCondition() == "PATH_NOT_FOUND"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whichever file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def delete_folders(spark: SparkSession, paths: Iterable[str]) -> None:
    """As :func:`delete_folder` for many folders of one file system."""
    system, jvm_path, settings = None, spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm_path(path)
        system = system or target.getFileSystem(settings)
        system.delete(target, True)


def create_empty_file(spark: SparkSession, path: str) -> None:
    """A file without a byte, on whichever file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(target)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whichever file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds; an absent folder holds nothing."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(target)] if system.exists(target) else []
