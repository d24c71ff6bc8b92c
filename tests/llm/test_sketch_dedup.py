"""Near copies by sketches against brute force, and on null, empty, repeated and odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerloom.llm import sketch_dedup
from tickerloom.llm.components import UnionFind


def shingles(text):
    words = sketch_dedup.words(text)
    size = min(len(words), 4)
    return {tuple(words[at : at + size]) for at in range(len(words) - size + 1)} if words else set()


def brute_force(rows):
    sets = [(ident, shingles(text)) for ident, text in rows]
    found = UnionFind()
    for place, (one, mine) in enumerate(sets):
        for other, theirs in sets[:place]:
            if mine and theirs and 100 * len(mine & theirs) >= 80 * len(mine | theirs):
                found.union(one, other)
    return {(ident, len(mine), found.find(ident), found.find(ident) == ident) for ident, mine in sets}


def families(seed, bases, copies, size=60, changes=6):
    rnd = random.Random(seed)
    rows = []
    for _ in range(bases):
        base = [f"w{rnd.randrange(5000)}" for _ in range(size)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rnd.randint(0, changes)):
                words[rnd.randrange(size)] = f"x{rnd.randrange(5000)}"
            rows.append((len(rows), " ".join(words)))
    return rows


def answers(df):
    return {tuple(row) for row in df.select("doc_id", "n_shingles", "component_id", "kept").collect()}


@pytest.mark.parametrize(("hubs", "block"), [(2, 1 << 21), (1, 700)])
def test_components_equal_brute_force(spark, monkeypatch, hubs, block):
    monkeypatch.setattr(sketch_dedup, "HUB_ROUNDS", hubs)
    monkeypatch.setattr(sketch_dedup, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(sketch_dedup, "CHUNK", 7)
    rows = families(3, 12, 14) + [(1000 + n, text) for n, (_, text) in enumerate(families(5, 40, 1))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert answers(sketch_dedup.near_copies(docs)) == brute_force(rows)


def test_a_bucket_of_thousands_of_lookalikes(spark):
    """Texts about 0.75 alike share many buckets; only the few planted pairs are links."""
    rnd = random.Random(11)
    base = [f"w{n}" for n in range(200)]
    rows = []
    for ident in range(1500):
        words = list(base)
        for at in rnd.sample(range(200), 7):
            words[at] = f"x{ident}_{at}"
        rows.append((ident, " ".join(words)))
    planted = []
    for ident in rnd.sample(range(1500), 60):
        words = rows[ident][1].split()
        words[rnd.randrange(200)] = "changed"
        planted.append((ident, 2000 + ident))
        rows.append((2000 + ident, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {row["doc_id"]: row["component_id"] for row in sketch_dedup.near_copies(docs).collect()}
    assert all(found[one] == found[other] for one, other in planted)
    sets = {ident: shingles(text) for ident, text in rows}
    union = UnionFind()
    for place, (one, _) in enumerate(rows):
        for other, _ in rows[:place]:
            both = len(sets[one] & sets[other])
            if 100 * both >= 80 * (len(sets[one]) + len(sets[other]) - both):
                union.union(one, other)
    assert found == {ident: union.find(ident) for ident in sets}


def test_sketches_fill_and_concentrate():
    rnd = np.random.default_rng(2)
    for size in (1, 3, 64, 5000):
        hashes = rnd.integers(0, 1 << 63, size).astype(np.uint64)
        sketch = sketch_dedup.sketches(hashes, np.array([size]))
        assert (sketch != sketch_dedup._EMPTY).all()
        assert (sketch == sketch_dedup.sketches(hashes[::-1], np.array([size]))).all()
    agree = []
    for _ in range(200):
        both = rnd.integers(0, 1 << 63, 120).astype(np.uint64)
        sets = np.concatenate([both[:110], both[10:]])
        one, other = sketch_dedup.sketches(sets, np.array([110, 110]))
        agree.append((one == other).mean())
    assert abs(np.mean(agree) - 100 / 120) < 0.02 and np.std(agree) < 0.06


def test_pairs_of_just_the_similarity_share_a_band():
    rnd = np.random.default_rng(7)
    met = 0
    for _ in range(2000):
        pool = rnd.integers(0, 1 << 63, 100).astype(np.uint64)
        sets = np.concatenate([pool[:90], pool[10:]])  # 80 of 100
        keys = sketch_dedup.band_keys(sketch_dedup.sketches(sets, np.array([90, 90])))
        met += bool((keys[0] == keys[1]).any())
    assert met >= 1995 and sketch_dedup.recall(0.8) > 0.9997


def test_odd_rows(spark):
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "One word"),
        (5, "one WORD"),
        (5, "one word"),
        (6, "é" * 50_000),
        (None, "x y z a b c"),
        (7, "one  word \x0c"),
        (8, "word one"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clash = docs.withColumn("content", F.lit("a")).withColumn("bucket", F.lit(1)).withColumn("digest", F.lit(2))
    found = sorted((tuple(row) for row in sketch_dedup.near_copies(clash).collect()), key=str)
    assert found == sorted(
        [
            (1, 0, 1, True),
            (2, 0, 2, True),
            (3, 0, 3, True),
            (4, 1, 4, True),
            (5, 1, 4, False),
            (5, 1, 4, False),
            (6, 1, 6, True),
            (7, 1, 4, False),
            (8, 1, 8, True),
            (None, 3, None, True),
        ],
        key=str,
    )
    assert sketch_dedup.near_copies(docs.limit(0)).collect() == []


def test_text_ids(spark):
    rows = [("b", "one two three four"), ("a", "one two three four"), ("c", "five")]
    found = sketch_dedup.near_copies(spark.createDataFrame(rows, "name string, body string"), "name", "body")
    assert answers(found) == {("a", 1, "a", True), ("b", 1, "a", False), ("c", 1, "c", True)}
