from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tickerloom.sources import company_files, pages, tables

HEADER = "published_date,open,high,low,close,per_change,traded_quantity,traded_amount,status"
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LINE = "2024-01-02,1.0,4.0,0.5,2.0,nan,10.0,20.0,-1"


@pytest.fixture
def folder(tmp_path):
    def write(files):
        place = tmp_path / "companies"
        place.mkdir(exist_ok=True)
        for name, text in files.items():
            (place / name).write_text(text)
        return str(place)

    return write


def by_symbol(df):
    return {row["symbol"]: row for row in df.collect()}


def test_headers_may_differ(spark, folder):
    place = folder(
        {
            "AAA.csv": f"{HEADER}\n{LINE}\n",
            "BBB.csv": " Close , Published Date.,open,note\n7.5,2024-02-01,7.0,x\n\n",
            "C C+D.csv": f"{HEADER}\r\n{LINE}\r\n",
            "EMPTY.csv": "",
            "HEAD.csv": f"{HEADER}\n",
            "notes.txt": "published_date\nx\n",
        }
    )
    scan = company_files.scan_company_files(spark, place)
    rows = by_symbol(scan.rows())
    assert set(rows) == {"AAA", "BBB", "C C+D"}
    assert (rows["AAA"]["open"], rows["AAA"]["per_change"], rows["AAA"]["status"]) == (1.0, None, -1)
    assert (rows["BBB"]["close"], rows["BBB"]["open"], rows["BBB"]["high"]) == (7.5, 7.0, None)
    assert rows["BBB"]["published_date"] == "2024-02-01"
    assert rows["C C+D"]["status"] == -1
    assert scan.quarantine().isEmpty()
    audit = scan.audit().collect()
    assert len(audit) == 5 and sum(row["row_count"] > 0 for row in audit) == 3


def test_bad_lines_are_set_aside(spark, folder):
    place = folder(
        {
            "AAA.csv": f"{HEADER}\n{LINE}\n{LINE},extra\n2024-01-03,abc,1,1,1,1,1,1,0\n"
            "2024-01-04,1,2\n",
            "NOHEAD.csv": f"{LINE}\n",
            "TWO.csv": f"{HEADER}\n{LINE}\npublished_date,close\n2024-01-05,3\n",
        }
    )
    scan = company_files.scan_company_files(spark, place)
    assert scan.rows().count() == 2  # the short line has missing values
    reasons = sorted(row["reason"] for row in scan.quarantine().collect())
    assert reasons == ["no header", "not a number", "too many fields", "two headers", "two headers"]
    audit = {row["path"].rsplit("/", 1)[1]: (row["row_count"], row["quarantined"])
             for row in scan.audit().collect()}
    assert audit == {"AAA.csv": (2, 2), "NOHEAD.csv": (0, 1), "TWO.csv": (0, 2)}


def test_quoted_fields_and_extra_columns(spark, folder):
    place = folder({"AAA.csv": 'published_date,Remark,close\n"2024-01-02","a, ""b""",3\n'})
    row = company_files.scan_company_files(spark, place, extra_columns=["remark"]).rows().first()
    assert (row["published_date"], row["remark"], row["close"]) == ("2024-01-02", 'a, "b"', 3.0)


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_the_size_of_the_header_table_decides_the_join(spark, folder, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        place = folder({f"S{i}.csv": f"{HEADER}\n{LINE}\n" for i in range(5)})
        rows = company_files.scan_company_files(spark, place).rows()
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (threshold != "-1")
        assert rows.count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_symbol_from_a_folder_name(spark, tmp_path):
    place = tmp_path / "nested" / "symbol=007"
    place.mkdir(parents=True)
    (place / "part-0.csv").write_text(f"{HEADER}\n{LINE}\n")
    scan = company_files.scan_company_files(
        spark, str(tmp_path / "nested"), r"symbol=([^/]+)/[^/]+\.csv$", nested=True
    )
    assert scan.rows().first()["symbol"] == "007"


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    for n in range(80):
        (tmp_path / f"symbol=S{n}").mkdir()
        (tmp_path / f"symbol=S{n}" / "part 0.csv").write_text(f"{HEADER}\n{LINE}\n" if n else "")
    context, before = spark.sparkContext, spark.conf.get(LISTING_TASKS)
    context.setJobGroup("many folders", "")
    try:
        scan = company_files.scan_company_files(spark, str(tmp_path), r"symbol=([^/]+)/[^/]+\.csv$", nested=True)
        audit = [row["row_count"] for row in scan.audit().collect()]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(audit) == [0] + [1] * 79 and spark.conf.get(LISTING_TASKS) == before
    tracker = context.statusTracker()
    stages = [stage for job in tracker.getJobIdsForGroup("many folders") for stage in tracker.getJobInfo(job).stageIds]
    assert max(tracker.getStageInfo(stage).numTasks for stage in stages) < 80


@pytest.mark.parametrize("exists", [True, False])
def test_nothing_to_scan(spark, tmp_path, exists):
    place = tmp_path / "none"
    if exists:
        place.mkdir()
    scan = company_files.scan_company_files(spark, str(place))
    assert scan.rows().isEmpty() and scan.quarantine().isEmpty() and scan.audit().isEmpty()


def test_named_datasets(spark, tmp_path):
    base = str(tmp_path / "datasets")
    with pytest.raises(ValueError, match="no dataset named 'prices'"):
        tables.load_dataset(spark, base, "prices")
    with pytest.raises(ValueError, match="not a dataset name"):
        tables.save_dataset(spark.range(1), base, "../prices")
    tables.save_dataset(spark.range(3), base, "prices")
    tables.save_dataset(spark.range(10, 12), base, "prices")
    assert sorted(r[0] for r in tables.load_dataset(spark, base, "prices").collect()) == [10, 11]
    tables.append_dataset(spark.range(12, 13), base, "prices")
    assert tables.load_dataset(spark, base, "prices").count() == 3


def test_tables_are_replaced(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.write_table(spark.range(3), "replaced_table", path)
    tables.write_table(spark.range(5).withColumn("x", F.lit("a")), "replaced_table", path)
    found = tables.read_table(spark, "replaced_table")
    assert found.count() == 5 and found.columns == ["id", "x"]
    spark.sql("drop table replaced_table")


def test_csv_keeps_every_value(spark, bars, tmp_path):
    rows = bars([("A,B", "2024-01-02", float("inf")), ('say "x"', "2024-01-03", 0.1 + 0.2),
                 ("C", None, None)])
    path = str(tmp_path / "merged")
    tables.write_csv(rows, path)
    found = tables.read_csv(spark, path)
    assert sorted(map(str, found.collect())) == sorted(map(str, rows.collect()))


def answer(rows, total=None, symbol=None):
    page = {"data": rows}
    if total is not None:
        page["recordsTotal"] = total
    if symbol is not None:
        page["symbol"] = symbol
    return json.dumps(page)


def price(number, day, close):
    return {"DT_Row_Index": number, "published_date": day, "close": close, "status": "1"}


def test_pages(spark, tmp_path):
    first = answer([price(1, "2024-01-03", "3.5"), price(2, "2024-01-02", 2)], 3)
    lines = {
        "AAA.json": f"{first}\n{first}\n" + answer([price(3, "2024-01-01", "inf")], 3),
        "BBB.2.json": answer([]) + "\n" + json.dumps({"recordsTotal": "4"}),
        "any.json": answer([price(1, "2024-01-01", 1.0)], 1, symbol="CCC") + "\nnot json\n",
    }
    for name, text in lines.items():
        (tmp_path / name).write_text(text)
    landed = pages.read_pages(spark, str(tmp_path))
    rows = pages.explode_pages(landed)
    assert "DT_Row_Index" not in rows.columns
    found = sorted((r["symbol"], r["published_date"], r["close"]) for r in rows.distinct().collect())
    assert found == [
        ("AAA", "2024-01-01", float("inf")), ("AAA", "2024-01-02", 2.0),
        ("AAA", "2024-01-03", 3.5), ("CCC", "2024-01-01", 1.0),
    ]
    audit = {r["symbol"]: (r["announced"], r["landed"], r["missing"])
             for r in pages.page_completeness(landed).collect()}
    assert audit["AAA"] == (3, 3, 0) and audit["BBB"] == (4, 0, 4) and audit["CCC"] == (1, 1, 0)


def test_unusable_pages_and_cells_are_set_aside(spark, tmp_path):
    rows = [
        {"Published Date": "2024-01-02", " Close ": "1,234.50", "status": "1"},
        {"published_date": "2024-01-03", "close": "abc"},
        {"published_date": "2024-01-04", "close": "1.0d"},
        {"published_date": "2024-01-05", "close": "2", "status": "3000000000"},
        {"published_date": None, "close": None, "other": "x"},
    ]
    text = answer(rows, 5) + '\n{"data": [{"close": "1"\n' + json.dumps({"data": "none"}) + "\n"
    (tmp_path / "AAA.json").write_text(text)
    landed = pages.read_pages(spark, str(tmp_path))
    parsed = pages.parse_pages(landed, thousands=",")
    found = sorted((str(r["published_date"]), r["close"]) for r in pages.usable(parsed).collect())
    assert found == [("2024-01-02", 1234.5), ("None", None)]
    reasons = sorted(r["reason"] for r in pages.quarantine(parsed).collect())
    assert reasons == ["not a number"] * 3 + ["not a page"] * 2
    plain = pages.quarantine(pages.parse_pages(landed))
    assert plain.where("reason = 'not a number'").count() == 4


def test_overlapping_pages_count_rows_once(spark, tmp_path):
    days = [f"2024-01-{day:02d}" for day in range(1, 6)]
    first = answer([price(i, day, 1) for i, day in enumerate(days[:3])], 6)
    second = answer([price(i, day, 1) for i, day in enumerate(days[2:])], 6)
    (tmp_path / "AAA.json").write_text(f"{first}\n{second}\n")
    row = pages.page_completeness(pages.read_pages(spark, str(tmp_path))).first()
    assert (row["announced"], row["landed"], row["missing"]) == (6, 5, 1)


def test_one_number_rule_for_all_lines(spark, folder):
    place = folder(
        {
            "AAA.csv": f"{HEADER}\n2024-01-02,1.0d,1,1,1,1,1,1,0\n2024-01-03,1.0d,1,1,1,,1,1,0\n"
            "2024-01-04,0x1p3,1,1,1,1,1,1,0\n2024-01-05,1,1,1,1,1,1,1,3000000000\n"
            "2024-01-06,-Infinity,1,1,1,1,1,inf,0\n"
        }
    )
    scan = company_files.scan_company_files(spark, place)
    assert [r["published_date"] for r in scan.rows().collect()] == ["2024-01-06"]
    assert [r["reason"] for r in scan.quarantine().collect()] == ["not a number"] * 4


def test_files_are_listed_once_and_read_by_few_tasks(spark, tmp_path):
    for n in range(1200):
        (tmp_path / f"S{n} {n % 3}.csv").write_text(f"{HEADER}\n{LINE}\n" if n % 10 else "")
    context, before = spark.sparkContext, spark.conf.get("spark.sql.files.openCostInBytes")
    context.setJobGroup("small files", "")
    try:
        listed = company_files.list_files(spark, str(tmp_path)).collect()
        rows = company_files.scan_company_files(spark, str(tmp_path)).rows().count()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert rows == 1080 and spark.conf.get("spark.sql.files.openCostInBytes") == before
    assert len({row["path"] for row in listed}) == len(listed) == 1200
    assert sum(row["length"] == 0 and row["modified"] is None for row in listed) == 120
    assert all(row["modified"] is not None for row in listed if row["length"])
    # A file counted as 4 MB, so that a task read 32.
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("small files") for s in tracker.getJobInfo(job).stageIds]
    assert max(tracker.getStageInfo(stage).numTasks for stage in stages) <= 32


def test_sizes_of_settings():
    from tickerloom.session import _bytes

    assert [_bytes(text) for text in ("4194304", "4MB", "64k", "1g", " 7 b")] == [4194304, 4 << 20, 64 << 10, 1 << 30, 7]


def test_numbers_of_pages_are_parsed_once(spark, tmp_path):
    (tmp_path / "A.json").write_text(json.dumps({"data": [{"published_date": "2024-01-02", "close": "2.5"}]}) + "\n")
    plan = pages.parse_pages(pages.read_pages(spark, str(tmp_path)))._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("RLIKE") <= 8  # numeric fields
