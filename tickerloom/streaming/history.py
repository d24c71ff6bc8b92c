"""A table of rows that is merged into again and again, without reading it again.

Rows lie in partitions by a hash of one column (``_bucket``) and by year (``_year``), each with a
digest of all its cells (``_d1``, ``_d2``). A merge reads the digests, and nothing else, of the
partitions its rows fall into.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise, read_or_empty

BUCKETS = 16
ROWS_A_FILE = 1_000_000

_PLACE = ["_bucket", "_year"]
_DIGEST = ["_d1", "_d2"]
_ADDED = [
    *[T.StructField(name, T.LongType()) for name in _DIGEST],
    *[T.StructField(name, T.IntegerType()) for name in _PLACE],
]


def _digests(names: list[str]) -> list[Column]:
    """128 bits over all cells. A hash passes over NULLs, so their places are hashed too."""
    cells = [F.col(name) for name in names]
    gaps = F.concat(*[F.when(cell.isNull(), "1").otherwise("0") for cell in cells])
    return [F.xxhash64(F.lit(salt), gaps, *cells).alias(name) for salt, name in enumerate(_DIGEST)]


def placed(rows: DataFrame, key: str, year: Column) -> DataFrame:
    """Different rows with the partition they belong to; rows without a year are in year 0."""
    return (
        rows.select("*", *_digests(rows.columns))
        .dropDuplicates(_DIGEST)
        .withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))
        .withColumn("_year", F.coalesce(year, F.lit(0)).cast("int"))
    )


def touched_digests(spark: SparkSession, path: str, schema: T.StructType, places: list[tuple[int, int]]) -> DataFrame:
    """Digests stored in the given partitions. The test is on literals, so other partitions are not
    even listed as files to read."""
    stored = read_or_empty(spark, path, T.StructType([*schema.fields, *_ADDED]))
    years: dict[int, list[int]] = {}
    for bucket, year in places:
        years.setdefault(year, []).append(bucket)
    wanted = [(F.col("_year") == year) & F.col("_bucket").isin(buckets) for year, buckets in years.items()]
    return stored.where(reduce(or_, wanted, F.lit(False))).select(*_PLACE, *_DIGEST)


def merge_rows(rows: DataFrame, path: str, key: str, year: Column) -> None:
    """Add the rows that ``path`` lacks, each once, cells compared whole with NULL equal to NULL.

    Running it again with the same rows adds nothing, also after a run that was killed half-way. The
    partitions touched, at most ``BUCKETS`` a year, are counted on the driver; a partition with many
    new rows is written by several tasks.
    """
    spark, schema = rows.sparkSession, rows.schema
    new = materialise(placed(rows, key, year), "placed")
    counts = new.groupBy(*_PLACE).agg(F.ceil(F.count(F.lit(1)) / ROWS_A_FILE).alias("_slices")).collect()
    if not counts:
        return
    known = touched_digests(spark, path, schema, [(row["_bucket"], row["_year"]) for row in counts])
    slices = spark.createDataFrame(counts, "_bucket int, _year int, _slices long")
    (
        new.join(known, [*_PLACE, *_DIGEST], "left_anti")
        .join(F.broadcast(slices), _PLACE)
        .withColumn("_slice", F.pmod("_d1", "_slices"))
        .repartition(*_PLACE, "_slice")
        .select(*schema.names, *_DIGEST, *_PLACE)
        .write.mode("append")
        .partitionBy(*_PLACE)
        .parquet(path)
    )


def stored_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a table written by :func:`merge_rows`; none where it is absent."""
    return read_or_empty(spark, path, schema).select(*schema.names)
