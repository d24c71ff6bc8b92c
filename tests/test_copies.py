from __future__ import annotations

import pytest

from tickerloom.operators import copies


@pytest.mark.parametrize("block", [1, 3, 65_536])
def test_rows_come_back_in_full(spark, monkeypatch, block):
    monkeypatch.setattr(copies, "BLOCK", block)
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 7), (None, 3)], "x string, n long")
    counts = {row["x"]: row["count"] for row in
              copies.expand_copies(df, "n").groupBy("x").count().collect()}
    assert counts == {"b": 1, "c": 7, None: 3}
