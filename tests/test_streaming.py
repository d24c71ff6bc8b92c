from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickerloom.streaming import daily_append, page_load


@pytest.fixture
def places(tmp_path):
    names = {name: tmp_path / name for name in ("landing", "staged", "progress", "final")}
    names["landing"].mkdir()
    return {name: str(path) for name, path in names.items()}, names


def land(folder, name, days, symbol="AAA"):
    rows = [{"DT_Row_Index": i, "published_date": day, "close": "2.5"} for i, day in enumerate(days)]
    page = {"symbol": symbol, "recordsTotal": 9, "data": rows}
    (folder / name).write_text(json.dumps(page) + "\n")


def staged_days(spark, places):
    rows = spark.read.parquet(places["staged"]).select("published_date").collect()
    return sorted(row[0] for row in rows)


def load(spark, places):
    page_load.load_pages(spark, places["landing"], places["staged"], places["progress"])


def test_a_second_run_reads_only_new_pages(spark, places):
    paths, folders = places
    land(folders["landing"], "1.json", ["2024-01-03", "2024-01-02"])
    load(spark, paths)
    load(spark, paths)
    assert staged_days(spark, paths) == ["2024-01-02", "2024-01-03"]
    land(folders["landing"], "2.json", ["2024-01-01", "2024-01-02"])  # one row repeats
    land(folders["landing"], "3.json", [])
    load(spark, paths)
    assert len(staged_days(spark, paths)) == 4
    final = page_load.finalise(spark, paths["staged"], paths["final"])
    assert final.count() == 3 and not folders["staged"].exists()


def final_days(spark, paths):
    rows = page_load.finalise(spark, paths["staged"], paths["final"])
    return sorted(row["published_date"] for row in rows.collect())


def test_a_second_cycle_keeps_the_history(spark, places):
    paths, folders = places
    land(folders["landing"], "1.json", ["2024-01-02", "2024-01-03"])
    load(spark, paths)
    assert final_days(spark, paths) == ["2024-01-02", "2024-01-03"]
    (folders["landing"] / "1.json").unlink()
    land(folders["landing"], "2.json", ["2024-01-03", "2024-01-04"])
    load(spark, paths)
    assert final_days(spark, paths) == ["2024-01-02", "2024-01-03", "2024-01-04"]
    load(spark, paths)  # nothing landed
    assert final_days(spark, paths) == ["2024-01-02", "2024-01-03", "2024-01-04"]


def test_unreadable_pages_are_published_as_quarantine(spark, places):
    paths, folders = places
    land(folders["landing"], "1.json", ["2024-01-02"])
    (folders["landing"] / "2.json").write_text('{"symbol": "AAA", "data": [{"close"\n')
    for _ in range(2):
        load(spark, paths)
        assert final_days(spark, paths) == ["2024-01-02"]
    lost = spark.read.parquet(f"{paths['final']}_quarantine").collect()
    assert [(row["reason"], row["path"][-6:]) for row in lost] == [("not a page", "2.json")]


def test_a_broken_checkpoint_restarts_the_load(spark, places):
    paths, folders = places
    land(folders["landing"], "1.json", ["2024-01-02"])
    load(spark, paths)
    for name in ("offsets", "commits"):
        for path in (folders["progress"] / name).iterdir():
            path.write_text("garbage")
    land(folders["landing"], "2.json", ["2024-01-03"])
    load(spark, paths)
    assert set(staged_days(spark, paths)) == {"2024-01-02", "2024-01-03"}
    assert final_days(spark, paths) == ["2024-01-02", "2024-01-03"]


def panel(spark, rows):
    return spark.createDataFrame(
        [(s, dt.date.fromisoformat(d) if d else None, c) for s, d, c in rows],
        "symbol string, published_date date, close double",
    )


def stored(spark, path):
    rows = daily_append.read_history(spark, path).collect()
    return sorted((r["symbol"], str(r["published_date"]), r["close"]) for r in rows)


def test_days_are_appended_once(spark, tmp_path):
    history, arriving = str(tmp_path / "history"), str(tmp_path / "arriving")
    daily_append.write_history(panel(spark, [("A", "2023-12-29", 1.0), ("A", "2024-01-02", 2.0)]), history)
    day = panel(spark, [("A", "2024-01-02", 9.0), ("A", "2024-01-03", 3.0), ("A", "2024-01-03", 4.0)])
    late = panel(spark, [("B", "2023-12-28", 5.0), ("A", None, 6.0)])
    day.coalesce(1).write.parquet(arriving)
    stream = spark.readStream.schema(day.schema).parquet(arriving)
    daily_append.stream_daily_append(spark, stream, history, str(tmp_path / "progress"))
    late.coalesce(1).write.mode("append").parquet(arriving)
    daily_append.stream_daily_append(spark, stream, history, str(tmp_path / "progress"))
    expected = [("A", "2023-12-29", 1.0), ("A", "2024-01-02", 2.0), ("A", "2024-01-03", 3.0),
                ("B", "2023-12-28", 5.0)]
    assert stored(spark, history) == expected
    daily_append.append_batch(spark, history, day)  # a replayed batch
    daily_append.append_batch(spark, history, day.limit(0))
    assert stored(spark, history) == expected
    undated = spark.read.parquet(f"{history}_quarantine").collect()
    assert [(r["reason"], json.loads(r["line"])["close"]) for r in undated] == [
        ("no symbol or day", 6.0)
    ]


def test_bounded_state_dedupe(spark, tmp_path):
    rows = panel(spark, [("A", "2024-01-02", 1.0), ("A", "2024-01-02", 1.0), ("B", "2024-01-02", 1.0)])
    rows = rows.withColumn("ts", F.col("published_date").cast("timestamp_ntz"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = (
        daily_append.dedupe_recent(stream, "ts").writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
