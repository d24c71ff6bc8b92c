"""Columns named as the operators' own, text ids, and word families of the toxicity score."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tickerloom.llm import decontamination, line_dedup, near_join, token_counts, toxicity
from tickerloom.llm.components import unused_name

CLASHES = ("_id", "_toxic", "_kept", "_removed", "_counts", "_text", "passages", "doc_id_", "class_id", "score")


@pytest.fixture
def frame(spark):
    line = "one two three four five six seven eight nine ten eleven"
    rows = [("b", f"{line}\nx y"), ("a", line), (None, None), ("c", ""), ("c", "word")]
    df = spark.createDataFrame(rows, "name string, `the text` string")
    for name in CLASHES:
        df = df.withColumn(name, F.lit(f"keep {name}"))
    return df


def kept(rows):
    return all(row[name] == f"keep {name}" for row in rows for name in CLASHES)


def test_unused_names():
    assert unused_name(["a", "_ID", "_id_"], "_id") == "_id__" and unused_name([], "x") == "x"


def test_columns_with_clashing_names_stay(spark, frame):
    counted = token_counts.token_counts(frame, public_tokenizers.path("byte_bpe_50k.json"), "the text").collect()
    assert len(counted) == 5 and kept(counted)
    one = near_join.keep_one_of_each(frame, "name", "the text").collect()
    assert kept(one) and {row["name"] for row in one} == {"a", "b", "c", None}
    lines = line_dedup.dedup_lines(frame, "name", "the text").collect()
    assert kept(lines) and {(row["name"], row["the text"]) for row in lines} >= {("b", "x y"), ("c", "word")}
    benchmark = spark.createDataFrame([(1, "two three four five six seven eight nine ten eleven")], "item_id long, text string")
    cut = decontamination.remove_passages(frame, benchmark, "the text").collect()
    assert kept(cut) and {row["the text"] for row in cut} == {"one \n\nx y", "one \n", None, "", "word"}
    labels = frame.select("name", F.lit(0).alias("toxic"), "_id", "_toxic").distinct()
    assert toxicity.learn_lexicon(frame, labels, "name", "the text").terms


def test_links_of_text_ids(spark):
    rows = [("b", "one two three four five"), ("a", "one two three four five"), ("c", "six")]
    found = near_join.near_join(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {tuple(row) for row in found} == {("a", "a", 1), ("b", "a", 1), ("c", "c", 0)}


def prose(rnd, size):
    return [rnd.choice("ab cd ef gh ij kl mn op qr st".split()) + rnd.choice("uvwxyz") for _ in range(size)]


def test_one_word_of_a_family_does_not_decide(spark):
    """Toxic rows use several words of a family, some clean rows happen to use one."""
    rnd = random.Random(6)
    endings = [a + b for a in "abcdefgh" for b in "rstuvw"]
    toxic = [prose(rnd, 40) + [f"grolmak{e}" for e in rnd.sample(endings, 4)] for _ in range(60)]
    clean = [prose(rnd, 40) + ([f"grolmak{rnd.choice(endings)}"] if n % 5 == 0 else []) for n in range(600)]
    rows = [(n, " ".join(words)) for n, words in enumerate(toxic + clean)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(n, int(n < 60)) for n, _ in rows], "doc_id long, toxic int")
    lexicon = toxicity.learn_lexicon(docs, labels)
    assert list(lexicon.stems) == ["grolmak"]
    predicted = {row["doc_id"] for row in toxicity.toxicity_scores(docs, lexicon).where("predicted = 1").collect()}
    assert predicted == set(range(60))


def test_terms_that_look_like_ordinary_words_are_not_misspelled(spark):
    """Clean rows are full of words near to one term, none is near to the other."""
    rnd = random.Random(7)
    near = [f"kelimant{a}{b}" for a in "abcdefgh" for b in "rstuvw"]
    toxic = [prose(rnd, 30) + [rnd.choice(["kelimante", "vorzuckel"])] for _ in range(120)]
    clean = [prose(rnd, 30) + [rnd.choice(near)] for _ in range(600)]
    rows = [(n, " ".join(words)) for n, words in enumerate(toxic + clean)]
    labels = spark.createDataFrame([(n, int(n < 120)) for n, _ in rows], "doc_id long, toxic int")
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    scorer = toxicity.Scorer(lexicon)
    assert {"kelimante", "vorzuckel"} <= set(lexicon.terms)
    assert scorer.score("some text with kelimantzz in it") < toxicity.THRESHOLD
    assert scorer.score("some text with vorzuckl in it") >= toxicity.THRESHOLD


def test_long_quotations_and_long_words():
    scorer = toxicity.Scorer(toxicity.Lexicon({"idiot": 0.9, "x" * 80: 0.9}, {}))
    assert scorer.score('"' + "word " * 200 + 'idiot"') < toxicity.THRESHOLD
    assert scorer.score("x" * 80) >= toxicity.THRESHOLD
