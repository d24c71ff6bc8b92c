from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom import functions as cells


def column(spark, values, kind="string"):
    return spark.createDataFrame([(value,) for value in values], f"x {kind}")


def apply(spark, values, expression, kind="string"):
    df = column(spark, values, kind)
    return [row[0] for row in df.select(expression(F.col("x"))).collect()]


NAMES = [" Published Date ", "open.", "S.No.", "\tClose\n", "﻿published_date", "DT_Row_Index"]


def test_names():
    assert [cells.clean_name(name) for name in NAMES] == [
        "published_date", "open", "sno", "close", "published_date", "dt_row_index",
    ]
    assert cells.clean_name("S.No.", drop_dots=False) == "s.no."


@pytest.mark.parametrize("drop_dots", [True, False])
def test_names_in_a_column_follow_the_same_rule(spark, drop_dots):
    found = apply(spark, NAMES, lambda x: cells.clean_name_column(x, drop_dots))
    assert found == [cells.clean_name(name, drop_dots) for name in NAMES]


def test_csv_lines(spark):
    lines = ["a,b,,", '"a,b",c', 'x,"say ""hi""",', '"1,200.5",2', "alone"]
    assert apply(spark, lines, cells.split_csv_line) == [
        ["a", "b", "", ""], ["a,b", "c"], ["x", 'say "hi"', ""], ["1,200.5", "2"], ["alone"],
    ]


def test_numbers(spark):
    texts = ["1.5", " 2 ", "-3e2", "nan", "NaN", "", "N/A", None, "inf", "-inf", "Infinity", "1,2", "x"]
    infinity = float("inf")
    assert apply(spark, texts, cells.number_from_text) == [
        1.5, 2.0, -300.0, None, None, None, None, None, infinity, -infinity, infinity, None, None,
    ]
    whole = apply(
        spark, ["-1", "1.0", "nan", "x"], lambda x: cells.number_from_text(x, T.IntegerType())
    )
    assert whole == [-1, 1, None, None]


def test_dates(spark):
    texts = ["2021-02-07", "2021/02/07", "07.02.2021", "not-a-date", "", None]
    day = dt.date(2021, 2, 7)
    assert apply(spark, texts, cells.date_from_text) == [day, None, None, None, None, None]
    extra = apply(spark, texts, lambda x: cells.date_from_text(x, ["yyyy/MM/dd", "dd.MM.yyyy"]))
    assert extra == [day, day, day, None, None, None]


def test_non_finite_values(spark):
    values = [1.0, float("nan"), float("inf"), float("-inf"), None, 0.0]
    found = apply(spark, values, cells.finite_or_null, "double")
    assert found == [1.0, None, None, None, None, 0.0]


def test_movement(spark):
    nan = float("nan")
    rows = [(1.0, 2.0), (2.0, 1.0), (1.0, 1.0), (None, 1.0), (1.0, None), (1.0, nan), (nan, 1.0)]
    df = spark.createDataFrame(rows, "o double, c double")
    found = [row[0] for row in df.select(cells.movement(F.col("o"), F.col("c"))).collect()]
    assert found == ["up", "down", "same", "same", "same", "same", "same"]
