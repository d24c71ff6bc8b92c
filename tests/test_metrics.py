from __future__ import annotations

import pytest

from tickerloom.operators import metrics

# Truth, prediction and count: 207 hits, 309 false alarms, 618 misses, 866 correct zeros.
PUBLISHED = [(1, 1, 207), (0, 1, 309), (1, 0, 618), (0, 0, 866)]


def counts(spark, cells):
    return spark.createDataFrame(cells, "truth int, prediction int, n long")


def test_published_scores(spark):
    scores = metrics.binary_from_counts(counts(spark, PUBLISHED)).first()
    found = [f"{scores[name]:.4f}" for name in ("accuracy", "precision", "recall", "f1")]
    assert found == ["0.5365", "0.4012", "0.2509", "0.3087"]


def test_published_report(spark):
    table = counts(spark, PUBLISHED)
    report = metrics.report_from_counts(table)
    text = metrics.render_report(metrics.binary_from_counts(table), report, "Scores")
    lines = [line.split() for line in text.splitlines() if line.strip()]
    assert lines[0] == ["Scores"]
    assert ["Precision", ":", "0.4012"] in lines
    assert ["0", "0.58", "0.74", "0.65", "1175"] in lines
    assert ["1", "0.40", "0.25", "0.31", "825"] in lines
    assert ["accuracy", "0.54", "2000"] in lines
    assert ["macro", "avg", "0.49", "0.49", "0.48", "2000"] in lines
    assert ["weighted", "avg", "0.51", "0.54", "0.51", "2000"] in lines


def test_from_pairs(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "y int, p int")
    table = {(r["truth"], r["prediction"]): r["n"] for r in metrics.confusion(df, "y", "p").collect()}
    assert table == {(1, 1): 1, (1, 0): 1, (0, 0): 2}
    assert metrics.binary_metrics(df, "y", "p").first().asDict() == {
        "tp": 1, "fp": 0, "fn": 1, "tn": 2,
        "accuracy": 0.75, "precision": 1.0, "recall": 0.5, "f1": pytest.approx(2 / 3),
    }


@pytest.mark.parametrize("cells", [[(0, 0, 5)], [(1, 0, 3), (0, 0, 2)], []])
def test_nothing_to_divide_by_gives_zero(spark, cells):
    scores = metrics.binary_from_counts(counts(spark, cells)).first()
    assert scores["precision"] == scores["recall"] == scores["f1"] == 0.0


def test_labels_that_are_only_predicted(spark):
    report = metrics.report_from_counts(counts(spark, [(0, 2, 1), (0, 0, 1), (1, 1, 2)]))
    rows = {r["section"]: r for r in report.collect()}
    assert (rows["2"]["precision"], rows["2"]["recall"], rows["2"]["support"]) == (0.0, 0.0, 0)
    assert rows["macro avg"]["recall"] == pytest.approx((0.5 + 1.0 + 0.0) / 3)
    assert rows["accuracy"]["f1"] == 0.75 and rows["accuracy"]["precision"] is None
