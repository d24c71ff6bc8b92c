"""Train / test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DATE, TARGET
from ..session import materialise
from .copies import expand_copies

_DIGITS = 3  # hex digits per refinement: 4096 cells a class


def row_token(parts: Sequence[Column], seed: int) -> Column:
    """Repeatable random order: md5 of the parts of the key and the seed."""
    return F.md5(F.concat_ws("|", *[part.cast("string") for part in parts], F.lit(str(seed))))


def class_quotas(sizes: DataFrame, test_percent: int) -> DataFrame:
    """Test rows per class from ``(label, n)``.

    The test total is rounded up; the train total is shared among the classes in proportion, what
    is left over going to the largest remainders; the test set is the rest of each class.
    """
    everything = Window.partitionBy(F.lit(0))  # one row per class
    big = "decimal(19,0)"
    shares = (
        sizes.withColumn("_all", F.sum("n").over(everything))
        .withColumn("_train", F.col("_all") - F.expr(f"(_all * {int(test_percent)} + 99) div 100"))
        .withColumn("_product", F.expr(f"cast(n as {big}) * cast(_train as {big})"))
        .withColumn("_floor", F.expr("_product div _all"))
        .withColumn("_rest", F.expr("_product % _all"))
        .withColumn("_spare", F.col("_train") - F.sum("_floor").over(everything))
        .withColumn("_rank", F.row_number().over(everything.orderBy(F.desc("_rest"), "label")))
    )
    extra = F.when(F.col("_rank") <= F.col("_spare"), 1).otherwise(0)
    return shares.select("label", (F.col("n") - F.col("_floor") - extra).alias("need"))


def _cut(cells: DataFrame, need: DataFrame) -> DataFrame:
    """The cell in which a class reaches its quota: ``(label, cell, n, need)``, ``need`` being what
    the cell itself must give. ``cells`` is ``(label, cell, n)`` with at most 4096 cells a class."""
    upto = F.sum("n").over(Window.partitionBy("label").orderBy("cell"))
    before = F.col("_upto") - F.col("n")
    return (
        cells.withColumn("_upto", upto)
        .join(F.broadcast(need), "label")
        .where((before < F.col("need")) & (F.col("need") <= F.col("_upto")))
        .select("label", "cell", "n", (F.col("need") - before).alias("need"))
    )


def _count_cells(rows: DataFrame) -> DataFrame:
    return rows.groupBy("label", "cell").agg(F.count(F.lit(1)).alias("n"))


def stratified_split(
    df: DataFrame,
    key: Sequence[str] | None = None,
    label: str = TARGET,
    classes: Sequence[int] = (0, 1),
    test_percent: int = 20,
    seed: int = 42,
) -> DataFrame:
    """Add ``is_test``: exactly the class quotas of rows, lowest ``row_token`` first.

    Ranking a class directly would put it in one task. Instead the quota is located by counting
    rows per token prefix (4096 cells, combined on the map side), once more inside the cell where
    it falls, and then per token; what remains is a comparison per row with the cut of its class.
    Only key and label are read for that, three times: ``df`` should be a stored table. The cuts,
    one row per class, are written after each step, so that no plan nests another, and broadcast.

    ``key`` should tell different rows apart (default: a hash of all columns). Rows that share a
    token are divided in the order of their columns, copies of one row by count. ``classes`` lists
    the labels; a row with another label is an error.
    """
    parts = [F.col(name) for name in key] if key else [F.xxhash64(*df.columns)]
    listed = F.col(label).isin(list(classes))
    token = F.when(listed, row_token(parts, seed)).otherwise(
        F.raise_error(F.lit(f"{label} must be one of {list(classes)}"))
    )
    rows = df.withColumn("_token", token)
    slim = rows.select(F.col(label).alias("label"), F.col("_token").alias("token"))

    first = F.substring("token", 1, _DIGITS)
    second = F.substring("token", 1 + _DIGITS, _DIGITS)
    coarse = _count_cells(slim.withColumn("cell", first))
    sizes = coarse.groupBy("label").agg(F.sum("n").alias("n"))
    cut = materialise(_cut(coarse, class_quotas(sizes, test_percent)), "cut")
    near = slim.join(F.broadcast(cut.select("label", F.col("cell").alias("_c1"))), "label")
    near = near.where(first == F.col("_c1"))

    cells = _count_cells(near.withColumn("cell", second))
    cut = materialise(_cut(cells, cut.select("label", "need")), "cut")
    near = near.join(F.broadcast(cut.select("label", F.col("cell").alias("_c2"))), "label")
    near = near.where(second == F.col("_c2"))

    cells = _count_cells(near.withColumn("cell", F.col("token")))
    cut = materialise(_cut(cells, cut.select("label", "need")), "cut")
    cut = cut.select(F.col("label").alias(label), F.col("cell").alias("_cut"), "n", "need")

    # A class without a quota has no cut: all its rows are train rows.
    placed = rows.join(F.broadcast(cut), label, "left")
    tied = F.coalesce((F.col("_token") == F.col("_cut")) & (F.col("need") < F.col("n")), F.lit(False))
    below = F.coalesce(F.col("_token") <= F.col("_cut"), F.lit(False))
    decided = placed.where(~tied).select(*df.columns, below.alias("is_test"))
    return decided.unionByName(_divide_ties(rows, cut.where("need < n"), df.columns, label))


def _divide_ties(rows: DataFrame, cut: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Rows that share the cut token while only some of them belong to the test set: copies, as a
    rule. ``cut`` is empty unless the cut falls on such rows, and AQE then drops this branch.
    Copies collapse to one row and a count."""
    tied = rows.join(F.broadcast(cut), label).where(F.col("_token") == F.col("_cut"))
    distinct = tied.groupBy(*columns, "need").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(label).orderBy(*columns))
    test = F.greatest(
        F.lit(0).cast("long"),
        F.least(F.col("_n"), F.col("need") - (F.col("_upto") - F.col("_n"))),
    )
    parts = F.array(
        F.struct(F.lit(True).alias("is_test"), F.col("_test").alias("_rows")),
        F.struct(F.lit(False).alias("is_test"), (F.col("_n") - F.col("_test")).alias("_rows")),
    )
    divided = distinct.withColumn("_upto", upto).withColumn("_test", test)
    return expand_copies(divided.select(*columns, F.inline(parts)), "_rows")


def split_by_date(df: DataFrame, cutoff: str) -> DataFrame:
    """Add ``is_test``: days from ``cutoff`` on. Unlike the stratified split, no later day is used
    to predict an earlier one."""
    return df.withColumn("is_test", F.col(DATE) >= F.to_date(F.lit(cutoff)))
