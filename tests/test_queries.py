"""Every registered query against its SQL counterpart, at the smallest scale."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in sorted(FOLDER.glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, database, name):
    found = entry.queries()[name](spark, str(FOLDER))
    rows = found.collect()
    if name not in entry.oracle_sql():
        assert rows
        return
    result = database.execute(entry.oracle_sql()[name])
    expected = table([item[0] for item in result.description], result.fetchall())
    assert table(found.columns, rows) == expected


def test_entry(spark):
    assert entry.entry(spark).count() == 378
