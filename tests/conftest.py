from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tickerloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def bars(spark):
    """Builder of small price rows: (symbol, day, close) with the rest filled in."""

    def build(rows):
        return spark.createDataFrame(
            [
                (day, 10.0, 12.0, 9.0, close, 0.0, 5.0, 50.0, 0, symbol)
                for symbol, day, close in rows
            ],
            "published_date string, open double, high double, low double, close double, "
            "per_change double, traded_quantity double, traded_amount double, status int, "
            "symbol string",
        )

    return build
