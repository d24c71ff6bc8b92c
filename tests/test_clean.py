from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import clean, joins

NAN = float("nan")
INF = float("inf")


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2)], [" Published Date", "Open."])
    assert clean.normalize_columns(df).columns == ["published_date", "open"]
    assert clean.normalize_columns(df, drop_dots=False).columns == ["published_date", "open."]
    with pytest.raises(ValueError, match="collide"):
        clean.normalize_columns(df.toDF("a b", "A_B"))


def test_dedupe_compares_whole_rows_and_precedes_dates(spark, bars):
    rows = bars([("A", "2024-01-02", 1.0), ("A", "2024-1-2", 1.0), ("A", "2024-01-02", 1.0)])
    unique = clean.dedupe_rows(rows)
    assert unique.count() == 2  # two spellings of one day stay two rows
    assert clean.parse_dates(unique).select("published_date").distinct().count() == 1


def test_dedupe_takes_missing_values_as_equal(spark):
    df = spark.createDataFrame([(None, NAN), (None, NAN), (1, NAN)], "a int, b double")
    assert clean.dedupe_rows(df).count() == 2


def test_dates_are_optional(spark):
    df = spark.createDataFrame([("A",)], ["symbol"])
    assert clean.parse_dates(df).columns == ["symbol"]


def test_missing_change_counts_as_zero(spark):
    df = spark.createDataFrame([(None,), (NAN,), (2.0,)], "per_change double")
    assert [row[0] for row in clean.fill_change(df).collect()] == [0.0, 0.0, 2.0]


@pytest.mark.parametrize(
    "column, value, kept",
    [
        ("open", None, 0), ("open", 0.0, 0), ("open", NAN, 0), ("close", -1.0, 0),
        ("high", INF, 0), ("low", None, 0), ("traded_quantity", None, 0),
        ("traded_amount", NAN, 0), ("symbol", None, 0), ("published_date", "x", 0),
        ("per_change", None, 1), ("per_change", INF, 1), ("status", None, 1),
        ("traded_quantity", 0.0, 1),
    ],
)
def test_which_rows_are_valid(bars, column, value, kept):
    rows = bars([("A", "2024-01-02", 11.0)])
    kind = rows.schema[column].dataType
    rows = rows.withColumn(column, F.lit(value).cast(kind))
    assert clean.clean_panel(rows).count() == kept


def test_nan_is_not_a_positive_price(bars):
    rows = bars([("A", "2024-01-02", NAN), ("A", "2024-01-03", 1.0)])
    assert clean.positive_prices(rows).count() == 1


def test_price_filters_reach_the_scan(spark, bars, tmp_path):
    bars([("A", "2024-01-02", 1.0)]).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    cleaned = rows.transform(clean.dedupe_rows).transform(clean.clean_panel)
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].splitlines()[0]
    assert "GreaterThan(open,0.0)" in pushed


def test_union_matches_names_not_positions(spark):
    a = spark.createDataFrame([(1, 2)], ["x", "y"])
    b = spark.createDataFrame([(3, 4)], ["z", "x"])
    rows = joins.union_by_name([a, b]).orderBy("x").collect()
    assert [row.asDict() for row in rows] == [
        {"x": 1, "y": 2, "z": None}, {"x": 4, "y": None, "z": 3},
    ]
