"""Rows stored once with a count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 65_536


def expand_copies(df: DataFrame, count: str) -> DataFrame:
    """Repeat each row ``count`` times (0 drops it) and drop the count.

    Counts are cut into blocks that are dealt out over the tasks, so a huge count is neither one
    array nor one task.
    """
    columns = [name for name in df.columns if name != count]
    last_block = F.floor((F.col(count) - 1) / BLOCK)
    blocks = df.where(F.col(count) > 0).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"), last_block))
    )
    size = F.least(F.lit(BLOCK).cast("long"), F.col(count) - F.col("_block") * BLOCK)
    return (
        blocks.withColumn("_size", size)
        .repartition(*columns, "_block")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_size")))
        .select(*columns)
    )
