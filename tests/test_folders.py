from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tickerloom import folders

ODD = ["AAA", "a/b c", 'x="1"%', "é[1]", "", None, "T,1"]


@pytest.fixture(scope="module")
def rows(spark):
    texts = ["plain", 'say "a, b"', " lead", "", None, "back\\slash", "ü"]
    numbers = [1.0, float("nan"), float("inf"), -0.0, None, 1e-7, 12345678.9]
    data = [(s, texts[n], numbers[n], [n, None]) for n, s in enumerate(ODD)]
    data += [("AAA", f"row {n}", float(n), []) for n in range(5000)]  # longer than a block
    return spark.createDataFrame(data, "symbol string, ` Some Text.` string, number double, list array<int>")


def _content(spark, path, kind):
    read = spark.read.option("header", True).option("inferSchema", False).format(kind).load(path)
    return sorted(map(str, read.collect())), sorted(read.columns)


@pytest.mark.parametrize("kind", ["csv", "json", "text"])
def test_files_are_those_of_the_writer(spark, rows, tmp_path, kind, monkeypatch):
    df = {"csv": rows.drop("list"), "json": rows, "text": rows.select("symbol", F.col("` Some Text.`").alias("value"))}[kind]
    df = df.where("value is not null") if kind == "text" else df
    folders.write_folders(df, "symbol", str(tmp_path / "own"), kind)
    with monkeypatch.context() as context:
        context.setattr(folders, "_local_place", lambda *_: None)
        folders.write_folders(df, "symbol", f"{tmp_path}/spark", kind)
    own, by_spark = (sorted(p.name for p in (tmp_path / name).iterdir() if p.is_dir()) for name in ("own", "spark"))
    assert own == by_spark
    assert all(len([*p.glob("part-*")]) == 1 for p in (tmp_path / "own").iterdir())
    assert _content(spark, f"{tmp_path}/own", kind) == _content(spark, f"{tmp_path}/spark", kind)


@pytest.mark.parametrize("local", [True, False])
def test_files_are_added_or_replaced(spark, tmp_path, local, monkeypatch):
    if not local:
        monkeypatch.setattr(folders, "_local_place", lambda *_: None)
    path = f"{tmp_path}/out"
    make = lambda values: spark.createDataFrame([(s, v) for s, v in values], "symbol string, close double")
    folders.write_folders(make([("A", 1.0), ("B", 2.0)]), "symbol", path, "csv")
    folders.write_folders(make([("A", 3.0)]), "symbol", path, "csv")
    read = lambda: sorted((r["symbol"], r["close"]) for r in spark.read.csv(path, header=True).collect())
    assert read() == [("A", "1.0"), ("A", "3.0"), ("B", "2.0")]
    folders.write_folders(make([("A", 4.0), ("C", 5.0)]), "symbol", path, "csv", replace=True)
    assert read() == [("A", "4.0"), ("B", "2.0"), ("C", "5.0")]


def test_a_damaged_file_is_noticed(spark, tmp_path):
    lines = spark.createDataFrame([("A", f"line {n}") for n in range(20_000)], "symbol string, value string")
    folders.write_folders(lines, "symbol", str(tmp_path), "text")
    assert spark.read.text(f"{tmp_path}/symbol=A").count() == 20_000
    (file,) = (tmp_path / "symbol=A").glob("part-*")
    data = bytearray(file.read_bytes())
    data[150_000] ^= 1
    file.write_bytes(data)
    reader = spark.read.option("ignoreCorruptFiles", "true")
    assert reader.text(f"{tmp_path}/symbol=A").count() < 20_000
