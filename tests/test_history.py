from __future__ import annotations

import json
import os
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickerloom.sources import company_files
from tickerloom.streaming import company_load, daily_append, history

SCHEMA = "symbol string, day string, close double"


def merge(spark, rows, path):
    frame = spark.createDataFrame(rows, SCHEMA)
    history.merge_rows(frame, path, "symbol", F.year(F.col("day").try_cast("date")))


def stored(spark, path):
    rows = history.stored_rows(spark, path, spark.createDataFrame([], SCHEMA).schema).collect()
    return sorted((tuple(row) for row in rows), key=str)


def test_rows_are_merged_once(spark, tmp_path):
    path = str(tmp_path / "table")
    first = [("A", "2023-01-02", 1.0), ("A", "2023-01-02", 1.0), ("A", None, None), ("B", "no day", None)]
    more = [("A", "2023-01-02", None), (None, "2023-01-02", 1.0), ("A", "2024-01-02", 0.0)]
    merge(spark, first, path)
    for _ in range(2):
        merge(spark, [*first, *more], path)
    assert stored(spark, path) == sorted({*first, *more}, key=str)
    merge(spark, [], path)
    assert stored(spark, path) == sorted({*first, *more}, key=str)


def test_gaps_in_other_places_are_other_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    frame = spark.createDataFrame([(1, None, 1), (1, 1, None), (None, 1, 1)], "a int, b int, c int")
    history.merge_rows(frame, path, "a", F.lit(None))
    assert history.stored_rows(spark, path, frame.schema).count() == 3


def test_other_partitions_are_not_read(spark, tmp_path):
    """Files of untouched partitions may even be damaged."""
    path = str(tmp_path / "table")
    merge(spark, [(f"S{n}", f"{year}-01-02", 1.0) for n in range(40) for year in (2022, 2023)], path)
    damaged = [*Path(path).glob("_bucket=*/_year=2022/*.parquet")]
    assert damaged
    for file in damaged:
        file.write_bytes(b"no parquet")
    merge(spark, [("S1", "2023-01-02", 1.0), ("S1", "2023-01-03", 2.0)], path)
    schema = spark.createDataFrame([], SCHEMA).schema
    places = [tuple(row) for row in history.placed(
        spark.createDataFrame([("S1", "2023-01-03", 2.0)], SCHEMA), "symbol", F.lit(2023)
    ).select("_bucket", "_year").collect()]
    known = history.touched_digests(spark, path, schema, places)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "ReadSchema: struct<_d1:bigint,_d2:bigint>" in plan
    own = history.read_or_empty(spark, path, schema).where("symbol = 'S1' and _year = 2023")
    assert own.count() == 2


@pytest.fixture
def landing(tmp_path):
    def land(symbol, name, days):
        place = tmp_path / "landing" / symbol
        place.mkdir(parents=True, exist_ok=True)
        rows = [{"published_date": day, "close": "2.5"} for day in days]
        (place / f"{symbol}.{name}.json").write_text(json.dumps({"recordsTotal": 9, "data": rows}) + "\n")

    return land


def load(spark, tmp_path):
    places = [str(tmp_path / name) for name in ("landing", "staged", "progress")]
    return company_load.load_company_pages(spark, *places)


def staged(spark, tmp_path):
    rows = company_load.staged_rows(spark, str(tmp_path / "staged")).groupBy("symbol").count().collect()
    return {row["symbol"]: row["count"] for row in rows}


def test_only_the_broken_company_starts_again(spark, tmp_path, landing):
    landing("007", "1", ["2024-01-02", "2024-01-03"])
    landing("B B", "1", ["2024-01-02"])
    assert load(spark, tmp_path) == [] and staged(spark, tmp_path) == {"007": 2, "B B": 1}
    assert load(spark, tmp_path) == [] and staged(spark, tmp_path) == {"007": 2, "B B": 1}
    landing("007", "2", ["2024-01-04"])
    for file in (tmp_path / "progress").glob("symbol=B*/*.txt"):
        file.write_text("garbage\n")
        (file.parent / f".{file.name}.crc").unlink()
    assert load(spark, tmp_path) == ["B B"]
    assert staged(spark, tmp_path) == {"007": 3, "B B": 2}
    offsets = {tuple(row) for row in company_load.offsets(spark, str(tmp_path / "progress")).collect()}
    assert offsets == {("007", 2, 3, 4), ("B B", 1, 1, 2)}
    for file in (tmp_path / "progress").glob("symbol=007/*.txt"):
        file.write_text("no longer what its checksum says\n")
    assert load(spark, tmp_path) == [] and staged(spark, tmp_path) == {"007": 6, "B B": 2}
    shutil.rmtree(tmp_path / "progress" / "symbol=B%20B", ignore_errors=True)
    shutil.rmtree(tmp_path / "progress" / "symbol=B B", ignore_errors=True)
    assert load(spark, tmp_path) == [] and staged(spark, tmp_path) == {"007": 6, "B B": 3}


def test_slices_of_files(spark, tmp_path, landing, monkeypatch):
    monkeypatch.setattr(company_load, "FILES_A_SLICE", 2)
    for n in range(5):
        landing(f"S{n}", "1", ["2024-01-02"] * (n % 3))
    load(spark, tmp_path)
    assert staged(spark, tmp_path) == {"S1": 1, "S2": 2, "S4": 1}
    assert company_load.offsets(spark, str(tmp_path / "progress")).count() == 5
    assert load(spark, tmp_path) == [] and staged(spark, tmp_path) == {"S1": 1, "S2": 2, "S4": 1}


def test_progress_is_written_by_several_tasks(spark, tmp_path, landing):
    """However few bytes the logs have, as each company's log is a file."""
    for n in range(24):
        landing(f"S{n}", "1", ["2024-01-02"])
    load(spark, tmp_path)
    logs = [*(tmp_path / "progress").glob("symbol=*/*.txt")]
    assert len(logs) == 24 and len({log.name[:10] for log in logs}) > 1


def test_nothing_landed(spark, tmp_path):
    assert load(spark, tmp_path) == [] and staged(spark, tmp_path) == {}


def test_a_batch_is_committed_once(spark, tmp_path):
    path = str(tmp_path / "history")
    day = spark.createDataFrame([("A", "2024-01-02", 1.0)], "symbol string, published_date string, close double")
    day = day.withColumn("published_date", F.col("published_date").cast("date"))
    daily_append.append_batch(spark, path, day, 0)  # killed before its commit
    assert daily_append.committed_batches(spark, path, "daily") == []
    assert daily_append.commit_batch(spark, path, "daily", day, 0)
    other = day.withColumn("symbol", F.lit("B"))
    assert not daily_append.commit_batch(spark, path, "daily", other, 0)
    assert daily_append.committed_batches(spark, path, "daily") == [0]
    assert [row["symbol"] for row in daily_append.read_history(spark, path).collect()] == ["A"]
    assert daily_append.commit_batch(spark, path, "daily", other, 1)
    assert daily_append.read_history(spark, path).count() == 2


HEADER = "published_date,open,close"


def test_a_second_scan_reads_new_files_only(spark, tmp_path):
    folder, kept = tmp_path / "in", str(tmp_path / "kept")
    folder.mkdir()
    old, changed, gone = folder / "A {1}.csv", folder / "B.csv", folder / "C.csv"
    old.write_text(f"{HEADER}\n2024-01-02,1,2\n")
    changed.write_text(f"{HEADER}\n2024-01-02,1,2\n")
    gone.write_text(f"{HEADER}\n2024-01-02,x,2\n")

    def scan():
        found = company_files.refresh_company_files(spark, str(folder), kept)
        again = company_files.scan_company_files(spark, str(folder))
        return found, again

    found, again = scan()
    assert sorted(found.rows().collect(), key=str) == sorted(again.rows().collect(), key=str)
    assert found.quarantine().count() == 1
    stamp = old.stat()
    old.write_text(f"{HEADER}\n2024-01-02,9,9\n")  # same length and time: must not be looked at
    os.utime(old, ns=(stamp.st_atime_ns, stamp.st_mtime_ns))
    changed.write_text(f"{HEADER}\n2024-01-02,1,2\n2024-01-03,3,4\n")
    gone.unlink()
    (folder / "D.csv").write_text("close,open\n5,6\n")
    found, _ = scan()
    rows = {(row["symbol"], row["published_date"], row["open"], row["close"]) for row in found.rows().collect()}
    assert rows == {
        ("A {1}", "2024-01-02", 1.0, 2.0),
        ("B", "2024-01-02", 1.0, 2.0),
        ("B", "2024-01-03", 3.0, 4.0),
        ("D", None, 6.0, 5.0),
    }
    assert found.quarantine().count() == 0
    assert {row["path"].rsplit("/", 1)[1]: row["row_count"] for row in found.audit().collect()} == {
        "A%20%7B1%7D.csv": 1, "B.csv": 2, "D.csv": 1
    }


def test_files_without_a_date_or_a_byte(spark, tmp_path):
    (tmp_path / "A.csv").write_text("\n close , Open.\r\n1,2\r\nclose,open\n3,4\n")
    (tmp_path / "B.csv").write_text("")
    (tmp_path / "C.csv").write_text("x,y\n1,2\n")
    scan = company_files.scan_company_files(spark, str(tmp_path))
    rows = sorted((row["symbol"], row["published_date"], row["close"], row["open"]) for row in scan.rows().collect())
    assert rows == [("A", None, 1.0, 2.0), ("A", None, 3.0, 4.0)]
    audit = {row["path"].rsplit("/", 1)[1]: (row["row_count"], row["quarantined"]) for row in scan.audit().collect()}
    assert audit["B.csv"] == (0, 0) and audit["C.csv"] == (0, 2) and audit["A.csv"] == (2, 1)
