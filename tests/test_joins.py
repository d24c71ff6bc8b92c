from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tickerloom.operators import joins
from tickerloom.sources.companies import companies


def test_company_dimension(spark):
    table = companies(spark)
    assert table.count() == 128 and table.select("symbol").distinct().count() == 128
    sectors = {r["sector"]: r["count"] for r in table.groupBy("sector").count().collect()}
    assert sectors == {
        "commercial banks": 26, "development banks": 17, "finance": 17, "tourism": 4,
        "hydro": 47, "investment": 5, "life insurance": 12,
    }


def test_unknown_symbols_stay(spark):
    df = spark.createDataFrame([("NMB",), ("??",)], ["symbol"])
    attached = joins.attach_company(df)
    found = {r["symbol"]: (r["company_id"], r["sector"]) for r in attached.collect()}
    assert found == {"NMB": (1, "commercial banks"), "??": (None, None)}
    assert "BroadcastHashJoin" in attached._jdf.queryExecution().executedPlan().toString()


def test_any_dimension(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    names = spark.createDataFrame([("a", "A")], "k string, name string")
    found = sorted(map(tuple, joins.attach_dimension(df, names, "k").collect()))
    assert found == [("a", 1, "A"), ("b", 2, None)]


def test_work_list(spark):
    loaded = spark.createDataFrame([("NMB",), ("NMB",), ("SBL",)], ["symbol"])
    left = joins.pending_companies(companies(spark), loaded)
    assert left.count() == 126 and left.where("symbol = 'NMB'").isEmpty()


def panel(spark, rows):
    return spark.createDataFrame(
        [(s, dt.date.fromisoformat(d), c) for s, d, c in rows],
        "symbol string, published_date date, close double",
    )


def test_only_unseen_days_are_added(spark):
    history = panel(spark, [("A", "2024-01-01", 1.0), ("A", "2024-01-02", 2.0),
                            ("B", "2024-01-01", 3.0)])
    new = panel(spark, [("A", "2024-01-02", 9.0), ("A", "2024-01-03", 5.0),
                        ("A", "2024-01-03", 4.0), ("C", "2023-12-31", 7.0)])
    found = sorted((r[0], str(r[1]), r[2]) for r in joins.append_new_rows(history, new).collect())
    assert found == [
        ("A", "2024-01-01", 1.0), ("A", "2024-01-02", 2.0), ("A", "2024-01-03", 4.0),
        ("B", "2024-01-01", 3.0), ("C", "2023-12-31", 7.0),
    ]


def test_an_empty_delivery_changes_nothing(spark):
    history = panel(spark, [("A", "2024-01-01", 1.0)])
    assert joins.append_new_rows(history, history.where(F.lit(False))).count() == 1


def test_history_is_read_only_where_the_delivery_lies(spark, tmp_path):
    panel(spark, [("A", "2024-01-01", 1.0)]).write.parquet(str(tmp_path / "h"))
    history = spark.read.parquet(str(tmp_path / "h"))
    unseen = joins.unseen_rows(history, panel(spark, [("A", "2024-01-01", 1.0)]))
    plan = unseen._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "ReadSchema: struct<symbol:string,published_date:date>" in scan
    assert "published_date" in scan.split("DataFilters")[1].split("Format")[0]
