from __future__ import annotations

import json
import random
from pathlib import Path

import pytest

from tickerloom import __main__ as command_line
from tickerloom.operators import model
from tickerloom.plans import pipeline
from tickerloom.sources import tables
from tickerloom.sources.tables import load_dataset

HEADER = "published_date,open,high,low,close,per_change,traded_quantity,traded_amount,status"


@pytest.fixture(scope="module")
def companies(tmp_path_factory):
    """Twelve companies whose close alternates, so that the next move can be learned."""
    folder = tmp_path_factory.mktemp("companies")
    dice = random.Random(5)
    for number in range(12):
        lines = [HEADER]
        for day in range(1, 29):
            up = day % 2
            opened = 100 + 10 * up + dice.random()
            close = 100 - 10 * up + dice.random()
            lines.append(f"2024-01-{day:02d},{opened},130,80,{close},nan,10,1000,0")
        lines.append(lines[-1])  # an exact copy
        lines.append("2024-02-01,0,130,80,90,1,10,1000,0")  # not a valid price
        (folder / f"S{number}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def settings(companies, place, **other):
    return pipeline.Settings(
        folder=companies,
        hand_over=pipeline.HandOver(str(place / "tables"), other.pop("kind", "dataset")),
        model_path=str(place / "model"),
        report_path=str(place / "report"),
        trees=10,
        depth=4,
        **other,
    )


def test_whole_flow(spark, companies, tmp_path):
    chosen = settings(companies, tmp_path, merged_csv=str(tmp_path / "merged"))
    text = pipeline.run(spark, chosen)
    assert "weighted avg" in text
    base = str(tmp_path / "tables")
    assert tables.read_csv(spark, str(tmp_path / "merged")).count() == 12 * 29
    raw = load_dataset(spark, base, pipeline.RAW)
    done = load_dataset(spark, base, pipeline.PROCESSED)
    test = load_dataset(spark, base, pipeline.TEST)
    assert raw.count() == 12 * 29 and done.count() == 12 * 27
    assert test.count() == 65  # a fifth of 324, rounded up
    assert test.columns[:2] == ["symbol", "published_date"] and test.columns[-1] == "target"
    report = {r["section"]: r for r in spark.read.parquet(chosen.report_path).collect()}
    assert report["accuracy"]["f1"] > 0.95
    stored = "\n".join(r[0] for r in spark.read.text(f"{chosen.report_path}_text").collect())
    assert stored.split() == text.split()
    again = model.predict(model.load_model(chosen.model_path), test)
    assert again.where("prediction = target").count() / 65 == report["accuracy"]["f1"]


def test_stages_return_counts(spark, companies, tmp_path):
    chosen = settings(companies, tmp_path)
    counts = pipeline.ingest(pipeline.merge(spark, chosen), chosen)
    # The copied line is one row; the change is missing everywhere but on the last day.
    assert counts["row_count"] == 12 * 29 and counts["per_change"] == 12 * 28
    assert pipeline.preprocess(spark, chosen)["per_change"] == 0


def test_small_flow_through_tables(spark, companies, tmp_path):
    chosen = settings(companies, tmp_path, kind="table", first_rows=100, cutoff="2024-01-20")
    pipeline.run(spark, chosen)
    assert spark.table(pipeline.RAW).count() == 100
    assert sorted(r[0] for r in spark.table(pipeline.RAW).select("symbol").distinct().collect()) == [
        "S0", "S1", "S10", "S11",
    ]
    assert spark.table(pipeline.TEST).where("published_date < '2024-01-20'").isEmpty()
    for name in (pipeline.RAW, pipeline.PROCESSED, pipeline.TEST):
        spark.sql(f"drop table {name}")


def test_an_empty_folder_writes_nothing(spark, tmp_path):
    (tmp_path / "none").mkdir()
    chosen = settings(str(tmp_path / "none"), tmp_path)
    assert pipeline.run(spark, chosen) is None
    assert not (tmp_path / "tables").exists()


def test_stages_from_the_command_line(spark, companies, tmp_path):
    base = str(tmp_path / "run")
    words = ["--folder", companies, "--base", base, "--trees", "5", "--depth", "3"]
    for stage in ("ingest", "preprocess", "train"):
        command_line.main([stage, *words])
    assert "macro avg" in command_line.main(["evaluate", *words])
    assert load_dataset(spark, f"{base}/tables", pipeline.TEST).count() == 65


def test_landed_pages_join_the_flow(spark, companies, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    row = {"published_date": "2024-01-02", "open": "1", "high": "2", "low": "1", "close": "2"}
    page = {"symbol": "NABIL", "recordsTotal": 1, "data": [row]}
    (landing / "1.json").write_text(json.dumps(page) + "\n")
    words = ["--folder", companies, "--base", str(tmp_path / "run"), "--landing", str(landing)]
    assert command_line.main(["load", *words]).endswith("companies without a row")
    chosen = command_line.settings(command_line.parser().parse_args(["ingest", *words]))
    merged = pipeline.merge(spark, chosen)
    assert merged.rows.count() == 12 * 29 + 1
    assert merged.rows.where("symbol = 'NABIL'").first()["close"] == 2.0
    pipeline.ingest(merged, chosen)
    assert not Path(merged.path.removeprefix("file:")).exists()


def test_a_database_is_only_read_in_parallel(tmp_path):
    with pytest.raises(ValueError, match="needs url and partition"):
        pipeline.HandOver(str(tmp_path), "jdbc", "jdbc:any")
    words = ["--folder", "f", "--base", "b", "--hand-over", "jdbc", "--url", "jdbc:any"]
    words += ["--partition", "published_date,2000-01-01,2030-01-01,40"]
    over = command_line.settings(command_line.parser().parse_args(words)).hand_over
    assert over.partition == ("published_date", "2000-01-01", "2030-01-01", 40)


def test_daily_rows_are_appended_and_merged(spark, companies, tmp_path):
    incoming, history, kept = (str(tmp_path / name) for name in ("incoming", "history", "kept"))
    chosen = settings(companies, tmp_path, incoming=incoming, history=history, kept=kept)
    row = ("2024-03-01", 100.0, 130.0, 80.0, 90.0, 0.0, 10.0, 1000.0, 0, "S1")
    day = spark.createDataFrame([row, row, (None, *row[1:])], pipeline.RAW_SCHEMA)
    for expected in ([0], [0, 1]):
        day.write.mode("append").parquet(incoming)
        assert pipeline.append(spark, chosen) == expected
        merged = pipeline.merge(spark, chosen)  # the second time no company file is read
        assert merged.rows.where("published_date = '2024-03-01'").count() == 1
        assert merged.rows.count() == 12 * 29 + 1
