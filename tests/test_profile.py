from __future__ import annotations

from tickerloom.operators import profile

NAN = float("nan")


def test_gaps_and_types(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1), ("b", NAN, None), (None, None, 3)], "s string, x double, i int"
    )
    gaps = [tuple(row) for row in profile.profile(df).collect()]
    assert gaps == [("s", 1, 3, 3), ("x", 2, 3, 3), ("i", 1, 3, 3)]
    summary = [tuple(row) for row in profile.column_summary(df).collect()]
    assert summary == [(0, "s", "string", 2), (1, "x", "double", 1), (2, "i", "int", 2)]


def test_audit(spark):
    df = spark.createDataFrame([("A", 1)] * 3 + [("A", 2), ("B", 1)], "symbol string, x int")
    assert profile.merge_audit(df).first().asDict() == {
        "rows_before": 5, "removed": 2, "final_rows": 3, "companies": 2,
    }
    assert profile.merge_audit(df.limit(0)).first().asDict() == {
        "rows_before": 0, "removed": 0, "final_rows": 0, "companies": 0,
    }
    found = {row["symbol"]: (row["row_count"], row["distinct_rows"])
             for row in profile.rows_per_symbol(df).collect()}
    assert found == {"A": (4, 2), "B": (1, 1)}
