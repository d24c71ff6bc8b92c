from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tickerloom.operators import date_vote, distinct_sketches, ordering


def frame(spark, rows):
    return spark.createDataFrame(rows, "symbol string, published_date string")


def days(df):
    return sorted((row["symbol"], str(row["published_date"])) for row in df.collect())


def test_every_source_has_its_spelling(spark):
    rows = [("iso", "2024-01-02"), ("iso", "2024-01-13"), ("iso", "x"), ("iso", None)]
    rows += [("eu", "02/01/2024"), ("eu", "13/01/2024"), ("us", "01/02/2024"), ("us", "01/13/2024")]
    rows += [("dot", "02.01.2024"), ("none", "?"), ("empty", None), (None, "2024-01-05")]
    df = frame(spark, rows)
    won = {row["symbol"]: tuple(row)[1:] for row in date_vote.vote(df).collect()}
    assert won["iso"] == ("yyyy-MM-dd", 2, 1, False)
    assert won["eu"] == ("dd/MM/yyyy", 2, 0, False) and won["us"] == ("MM/dd/yyyy", 2, 0, False)
    assert won["none"] == (None, 0, 1, False) and won["empty"] == (None, 0, 0, False)
    found = days(date_vote.parse_by_vote(df).where("symbol is not null and published_date is not null"))
    both = [(symbol, day) for symbol in ("iso", "eu", "us") for day in ("2024-01-02", "2024-01-13")]
    assert found == sorted([*both, ("dot", "2024-01-02")])
    assert date_vote.parse_by_vote(df).count() == len(rows)
    null = date_vote.parse_by_vote(df).where("symbol is null").first()
    assert null["published_date"] == dt.date(2024, 1, 5)


def test_days_close_together_decide(spark):
    df = frame(spark, [("us", f"01/{day:02d}/2024") for day in range(1, 13)])
    won = date_vote.vote(df).first()
    assert (won["date_format"], won["ambiguous"]) == ("MM/dd/yyyy", True)
    assert date_vote.vote(df.limit(0)).collect() == []


def test_sketches_of_days_can_be_united(spark, tmp_path):
    rows = [(f"S{n % 3_000}", f"2024-01-{n % 28 + 1:02d}") for n in range(30_000)]
    df = frame(spark, [*rows, ("late", None)]).withColumn("published_date", F.col("published_date").cast("date"))
    path = str(tmp_path / "sketches")
    first = df.where("published_date < '2024-01-15'")
    for part in (first, df, first):  # rows that come again change nothing
        distinct_sketches.add_sketches(part, path)
    counted = distinct_sketches.distinct_counts(distinct_sketches.stored_sketches(spark, path), F.lit("all")).first()
    assert abs(counted["estimate"] - 3_000) <= 0.05 * 3_000
    once = distinct_sketches.distinct_counts(distinct_sketches.daily_sketches(df), F.lit("all")).first()
    assert abs(once["estimate"] - counted["estimate"]) <= 1
    assert distinct_sketches.distinct_counts(distinct_sketches.stored_sketches(spark, path + "x"), F.lit(1)).collect() == []


def test_many_first_rows_are_cut_from_ranges(spark):
    rows = [(f"S{n % 7}", f"2024-01-{n % 28 + 1:02d}") for n in range(700)]
    df = frame(spark, rows)
    expected = sorted(rows)
    for n in (0, 1, 300, 699, 700, 5_000):
        found = sorted(tuple(row) for row in ordering.first_n(df, n, one_task=0 if n else 1).collect())
        assert found == expected[:n]
    plan = ordering.first_n(df, 300, one_task=10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "SinglePartition" not in plan
