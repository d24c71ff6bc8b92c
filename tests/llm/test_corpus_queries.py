"""The registered corpus queries and the pipeline on the small tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tickerloom.llm import decontamination, near_join, queries, toxicity

FOLDER = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        database.execute(f"create view {path.stem} as select * from '{path}'")
    found = queries.QUERIES[name](spark, str(FOLDER))
    expected = database.execute(queries.ORACLES[name])
    names = [item[0] for item in expected.description]
    rows = sorted(str(row) for row in expected.fetchall())
    assert rows == sorted(str(tuple(r)) for r in found.select(*names).collect())


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


def test_pipeline_equals_its_operators(spark):
    folder = str(FOLDER)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, folder)
        if name == "packing":
            words = sum(len((r["text"] or "").split()) for r in docs.collect())
            assert sum(r["n_tokens"] for r in after.collect()) == words
            break
        assert after.columns == columns
        before, after_rows = docs.collect(), after.collect()
        ids = {r["doc_id"] for r in after_rows}
        assert ids <= {r["doc_id"] for r in before}
        if name == "toxicity":
            scored = toxicity.toxicity_scores(docs, toxicity.learn_lexicon(docs, queries.table(spark, folder, "labels")))
            assert ids == {r["doc_id"] for r in scored.where("predicted = 0").collect()}
        if name == "near_join":
            assert ids == {r["class_id"] for r in near_join.near_join(docs).collect()}
        if name == "decontamination":
            hits = decontamination.contamination(after, queries.table(spark, folder, "benchmark"))
            assert hits.where("contaminated").count() == 0 and len(after_rows) == len(before)
        docs = spark.createDataFrame(after_rows, after.schema)
