from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickerloom.operators import clean, features


def successors(df):
    """Sorted (symbol, date, close, next close) tuples."""
    rows = df.select("symbol", "published_date", "close", "next_close").collect()
    return sorted(map(tuple, rows), key=str)


def test_next_is_the_next_valid_row(bars):
    rows = bars(
        [("A", "2024-01-02", 5.0), ("A", "2024-01-03", -1.0), ("A", "2024-01-09", 6.0),
         ("A", "2024-01-10", 6.0), ("B", "2024-01-01", 1.0)]
    )
    labelled = rows.transform(clean.clean_panel).transform(features.label_next_up)
    found = [tuple(r) for r in labelled.orderBy("published_date").select(
        F.col("published_date").cast("string"), "next_close", "target").collect()]
    assert found == [("2024-01-02", 6.0, 1), ("2024-01-09", 6.0, 0)]


def test_features(bars):
    row = bars([("A", "2024-01-02", 11.0)]).transform(features.price_features).first()
    assert row["price_range"] == 3.0 and row["daily_return"] == 0.1


def test_features_that_exist_in_fixed_order(spark):
    df = spark.createDataFrame(
        [(1, 2.0, 3.0, "x"), (0, None, 3.0, "x"), (None, 1.0, 1.0, "x"), (1, 1.0, float("nan"), "x")],
        "target int, close double, open double, note string",
    )
    matrix = features.feature_matrix(df)
    assert matrix.columns == ["open", "close", "target"] and matrix.count() == 1


def test_equal_days_keep_both_rows(spark, bars):
    rows = bars([("A", "2024-01-02", 5.0), ("A", "2024-01-02", 5.0), ("A", "2024-01-03", 6.0)])
    rows = rows.withColumn("per_change", F.monotonically_increasing_id().cast("double"))
    labelled = rows.transform(clean.parse_dates).transform(features.label_next_up)
    assert sorted(row["target"] for row in labelled.collect()) == [0, 1]


def brute_force(rows: list[tuple]) -> list[tuple]:
    """Next close by sorting; only for rows whose ties have one close."""
    frame = pd.DataFrame(rows, columns=["symbol", "day", "close"]).sort_values(["symbol", "day"])
    frame["next"] = frame.groupby("symbol")["close"].shift(-1)
    return sorted(
        ((s, d, c, None if pd.isna(n) else n) for s, d, c, n in frame.itertuples(index=False)),
        key=str,
    )


def test_a_symbol_with_most_rows(bars):
    """Symbol A holds most rows, one of its days many copies; each day has one close."""
    dice = random.Random(7)
    rows = [("A", f"2024-01-{d:02d}", float(dice.randint(1, 9))) for d in range(1, 20)]
    rows += [rows[4]] * 40
    rows += [(s, f"2024-02-{d:02d}", float(dice.randint(1, 9))) for s in "BC" for d in range(1, 5)]
    found = features.next_close(bars(rows).transform(clean.parse_dates)).withColumn(
        "published_date", F.col("published_date").cast("string")
    )
    assert successors(found) == brute_force(rows)


def test_ties_are_ordered_like_one_window(spark, bars):
    """Many different rows on few days, with missing and far days, and missing closes."""
    dice = random.Random(11)
    days = ["2024-01-01", "2024-01-02", "2024-01-05", "9999-12-31", "no day"]
    rows = [("A", dice.choice(days), float(dice.randint(1, 50))) for _ in range(300)]
    df = bars(rows).withColumn(
        "status", F.when(F.col("close") % 3 == 0, F.lit(None)).otherwise(F.col("status"))
    ).withColumn("close", F.when(F.col("close") != 7, F.col("close")))
    df = df.transform(clean.parse_dates)
    ties = [name for name in df.columns if name not in ("symbol", "published_date")]
    by_date = Window.partitionBy("symbol").orderBy(
        F.asc_nulls_last("published_date"), F.xxhash64(*ties), *ties
    )
    plain = df.withColumn("next_close", F.lead("close").over(by_date))
    found = features.next_close(df)
    assert found.count() == 300
    assert successors(found) == successors(plain)


def test_no_rows_and_rows_without_a_symbol(spark, bars):
    df = bars([("A", "2024-01-02", 5.0)]).transform(clean.parse_dates)
    assert features.next_close(df.limit(0)).count() == 0
    none = df.withColumn("symbol", F.lit(None).cast("string"))
    assert [row["next_close"] for row in features.next_close(df.union(none)).collect()] == [None, None]


def test_movement_column(bars):
    assert bars([("A", "2024-01-02", 11.0)]).transform(features.movement_label).first()[
        "movement"
    ] == "up"
