from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import pytest

from tickerloom.operators import split


def rows_of(spark, count, share, seed=1):
    dice = random.Random(seed)
    rows = [(f"k{i}", i * 1.0, int(dice.random() < share)) for i in range(count)]
    return spark.createDataFrame(rows, "name string, x double, target int"), rows


def expected(rows, percent=20, seed=42):
    """Plain ranking per class, quotas by largest remainder."""
    sizes = Counter(target for _, _, target in rows)
    total = len(rows)
    train = total - math.ceil(total * percent / 100)
    shares = {c: n * train // total for c, n in sizes.items()}
    spare = train - sum(shares.values())
    by_rest = sorted(sizes, key=lambda c: (-(sizes[c] * train % total), c))
    for c in by_rest[:spare]:
        shares[c] += 1
    chosen = set()
    for c in sizes:
        names = sorted(
            (name for name, _, target in rows if target == c),
            key=lambda name: hashlib.md5(f"{name}|{seed}".encode()).hexdigest(),
        )
        chosen.update(names[: sizes[c] - shares[c]])
    return chosen


@pytest.mark.parametrize("count, share", [(2001, 0.4), (17, 0.5), (5, 0.0), (1, 1.0)])
def test_same_rows_as_a_plain_ranking(spark, count, share):
    df, rows = rows_of(spark, count, share)
    found = split.stratified_split(df, key=["name"]).collect()
    assert len(found) == count
    assert {row["name"] for row in found if row["is_test"]} == expected(rows)


@pytest.mark.parametrize("parts", [1, 9])
def test_partitions_do_not_matter(spark, parts):
    df, rows = rows_of(spark, 300, 0.3)
    found = split.stratified_split(df.repartition(parts), key=["name"], test_percent=35)
    assert {r["name"] for r in found.where("is_test").collect()} == expected(rows, 35)


def test_copies_are_divided_by_count(spark):
    rows = [("same", 1.0, 1)] * 100 + [(f"k{i}", 1.0, 0) for i in range(50)]
    df = spark.createDataFrame(rows, "name string, x double, target int")
    found = split.stratified_split(df)
    counts = {(r["target"], r["is_test"]): r["count"] for r in
              found.groupBy("target", "is_test").count().collect()}
    assert counts == {(1, True): 20, (1, False): 80, (0, True): 10, (0, False): 40}


def test_unlisted_labels_are_an_error(spark):
    df = spark.createDataFrame([("a", 1.0, 7)], "name string, x double, target int")
    with pytest.raises(Exception, match="must be one of"):
        split.stratified_split(df).collect()


def test_split_by_date(spark):
    df = spark.sql(
        "select explode(sequence(date'2024-01-01', date'2024-01-10')) as published_date"
    )
    assert split.split_by_date(df, "2024-01-08").where("is_test").count() == 3
