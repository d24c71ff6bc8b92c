from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import clean, ordering


@pytest.fixture
def shuffled(bars):
    dice = random.Random(3)
    rows = [(s, f"2024-01-{d:02d}", float(d)) for s in ("B", "A", "C") for d in range(1, 25)]
    rows.append(("A", "no day", 99.0))
    dice.shuffle(rows)
    return bars(rows).transform(clean.parse_dates), rows


def key(row):
    return (row[0], row[1] == "no day", row[1])


def test_order_puts_missing_days_last(shuffled):
    df, rows = shuffled
    found = [(r["symbol"], r["close"]) for r in ordering.sorted_panel(df).collect()]
    assert found == [(s, c) for s, _, c in sorted(rows, key=key)]


@pytest.mark.parametrize("parts", [1, 7])
def test_positions_run_from_zero(shuffled, parts):
    df, rows = shuffled
    placed = ordering.with_position(df.repartition(parts)).collect()
    found = {r["position"]: (r["symbol"], r["close"]) for r in placed}
    assert found == {i: (s, c) for i, (s, _, c) in enumerate(sorted(rows, key=key))}


def test_without_dates_the_symbol_decides(spark):
    df = spark.createDataFrame([("B", 1), ("A", 2)], "symbol string, x int")
    assert [r["symbol"] for r in ordering.sorted_panel(df).collect()] == ["A", "B"]


def test_first_rows(shuffled):
    df, rows = shuffled
    found = sorted((r["symbol"], r["close"]) for r in ordering.first_n(df, 30).collect())
    assert found == sorted((s, c) for s, _, c in sorted(rows, key=key)[:30])


def test_first_row_of_each_symbol(spark, bars):
    rows = [("A", "no day", 1.0), ("A", "2024-01-03", 2.0), ("A", "2024-01-02", 3.0),
            ("B", "no day", 4.0)]
    df = bars(rows).transform(clean.parse_dates)
    extra = df.limit(1).withColumn("symbol", F.lit(None).cast("string"))
    found = ordering.first_per_symbol(df.unionByName(extra))
    assert found.columns == df.columns
    assert {r["symbol"]: r["close"] for r in found.collect()} == {"A": 3.0, "B": 4.0}


def test_copies_spread_over_tasks(spark, bars):
    copies = bars([("A", "2024-01-01", 1.0)]).crossJoin(spark.range(20_000)).drop("id").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [len(part) for part in ordering.sorted_panel(copies).rdd.glom().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 20_000 and max(sizes) < 15_000
