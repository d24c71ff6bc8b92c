"""Classification scores from (truth, prediction) pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """Rows per (truth, prediction); everything else is computed from this small table."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 when there is nothing to divide by."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.try_divide(part, whole))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def binary_metrics(
    df: DataFrame, truth: str, prediction: str, positive: int = 1
) -> DataFrame:
    """One row: the four cells, accuracy, and precision, recall, F1 of the positive class."""
    return binary_from_counts(confusion(df, truth, prediction), positive)


def binary_from_counts(counts: DataFrame, positive: int = 1) -> DataFrame:
    """``binary_metrics`` from the table that ``confusion`` returns."""
    is_true = F.col("truth") == positive
    is_predicted = F.col("prediction") == positive

    def cell(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    cells = counts.agg(
        cell(is_true & is_predicted).alias("tp"),
        cell(~is_true & is_predicted).alias("fp"),
        cell(is_true & ~is_predicted).alias("fn"),
        cell(~is_true & ~is_predicted).alias("tn"),
        cell(F.col("truth") == F.col("prediction")).alias("_right"),
        cell(F.lit(True)).alias("_all"),
    )
    return (
        cells.withColumn("accuracy", _ratio(F.col("_right"), F.col("_all")))
        .withColumn("precision", _ratio(F.col("tp"), F.col("tp") + F.col("fp")))
        .withColumn("recall", _ratio(F.col("tp"), F.col("tp") + F.col("fn")))
        .withColumn("f1", _f1(F.col("precision"), F.col("recall")))
        .drop("_right", "_all")
    )


def classification_report(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """One row per label that occurs, then ``accuracy``, ``macro avg`` and ``weighted avg``.

    Columns: section, precision, recall, f1, support. The accuracy row has its value in ``f1``.
    """
    return report_from_counts(confusion(df, truth, prediction))


def report_from_counts(counts: DataFrame) -> DataFrame:
    """``classification_report`` from the table that ``confusion`` returns."""
    hit = F.when(F.col("truth") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")
    sides = F.array(
        F.struct(
            F.col("truth").alias("label"), F.col("n").alias("support"),
            none.alias("predicted"), hit.alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("label"), none.alias("support"),
            F.col("n").alias("predicted"), none.alias("hits"),
        ),
    )
    per_label = (
        counts.select(F.inline(sides))
        .groupBy("label")
        .agg(*[F.sum(name).alias(name) for name in ("support", "predicted", "hits")])
        .withColumn("precision", _ratio(F.col("hits"), F.col("predicted")))
        .withColumn("recall", _ratio(F.col("hits"), F.col("support")))
        .withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    )

    scores = ("precision", "recall", "f1")
    # A rollup gives the label rows and the totals in one pass over the label table.
    rolled = per_label.rollup("label").agg(
        F.grouping("label").alias("_total"),
        F.sum("support").alias("support"),
        F.sum("hits").alias("hits"),
        *[F.avg(name).alias(name) for name in scores],
        *[F.sum(F.col(name) * F.col("support")).alias(f"_w_{name}") for name in scores],
    )
    missing = F.lit(None).cast("double")

    def row(section: Column, *values: Column) -> Column:
        return F.struct(
            section.alias("section"),
            *[value.alias(name) for name, value in zip(scores, values)],
            F.col("support").alias("support"),
        )

    label_rows = F.array(row(F.col("label").cast("string"), *[F.col(name) for name in scores]))
    total_rows = F.array(
        row(F.lit("accuracy"), missing, missing, _ratio(F.col("hits"), F.col("support"))),
        row(F.lit("macro avg"), *[F.col(name) for name in scores]),
        row(
            F.lit("weighted avg"),
            *[_ratio(F.col(f"_w_{name}"), F.col("support")) for name in scores],
        ),
    )
    return rolled.select(
        F.inline(F.when(F.col("_total") == 1, total_rows).otherwise(label_rows))
    )


def render_report(metrics: DataFrame, report: DataFrame, title: str) -> str:
    """Text of both tables. They hold 1 row and (labels + 3) rows."""
    scores = metrics.first()
    lines = {row["section"]: row for row in report.collect()}
    totals = ["accuracy", "macro avg", "weighted avg"]
    labels = sorted(set(lines) - set(totals), key=lambda text: (len(text), text))
    width = max(len(name) for name in lines)

    def cells(*values: object) -> str:
        return "".join(
            f"{value:>10.2f}" if isinstance(value, float) else f"{value:>10}" for value in values
        )

    def line(name: str) -> str:
        row = lines[name]
        blank = name == "accuracy"
        pair = ("", "") if blank else (row["precision"], row["recall"])
        return f"{name:>{width}} {cells(*pair, row['f1'], row['support'])}"

    return "\n".join(
        [
            title,
            "=" * len(title),
            "",
            "target 1: the next close is above this close; target 0: it is not",
            "",
            *[
                f"{name:<10}: {scores[name.lower()]:.4f}"
                for name in ("Accuracy", "Precision", "Recall", "F1")
            ],
            "",
            f"{'':>{width}} {cells('precision', 'recall', 'f1-score', 'support')}",
            "",
            *[line(name) for name in labels],
            "",
            *[line(name) for name in totals],
            "",
        ]
    )
