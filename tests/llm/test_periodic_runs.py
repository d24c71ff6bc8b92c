"""Runs of repeated words against brute force, and on null, empty, long and repeated rows."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tickerloom.llm import periodic_runs


def brute_force(words, least=12):
    found = {}
    for period in range(1, len(words) // 2 + 1):
        place = 0
        while place < len(words) - period:
            start = place
            while place < len(words) - period and words[place] == words[place + period]:
                place += 1
            length = place - start + period
            if place > start and length >= max(least, 2 * period):
                found.setdefault((start, length), period)
            place += 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda run: (run[0], run[2]))


def some_words(rnd):
    size, letters = rnd.randint(0, rnd.choice([5, 30, 120])), rnd.choice([1, 2, 3, 20])
    words = [rnd.randrange(letters) for _ in range(size)]
    if size > 3 and rnd.random() < 0.6:
        start, period = rnd.randrange(size), rnd.randint(1, size // 3)
        words[start:] = [words[start + n % period if start + period <= size else start] for n in range(size - start)]
    return words


def test_runs_equal_brute_force():
    rnd = random.Random(4)
    for _ in range(150):
        texts = [some_words(rnd) for _ in range(rnd.randint(0, 6))]
        found = periodic_runs.find_runs([np.array(words, np.int64) for words in texts])
        assert [[tuple(run) for run in runs.tolist()] for runs in found] == [brute_force(words) for words in texts]


@pytest.mark.parametrize("limit", [50, 1_000_000])
def test_runs_of_a_text_rich_in_them(monkeypatch, limit):
    monkeypatch.setattr(periodic_runs, "CANDIDATES", limit)
    short, long = [0], [0, 1]
    while len(long) < 400:
        short, long = long, long + short
    (found,) = periodic_runs.find_runs([np.array(long)])
    assert [tuple(run) for run in found.tolist()] == brute_force(long)


def test_extensions_equal_comparison():
    rnd = random.Random(8)
    words = [rnd.randrange(2) for _ in range(300)] * 2
    symbols = np.array([-1, *words, -2])
    x = np.array([rnd.randint(1, 300) for _ in range(500)])
    y = x + np.array([rnd.choice([1, 2, 300, 250]) for _ in range(500)])
    after, before = periodic_runs.extensions(symbols, np.zeros(len(symbols), np.int64), x, y)
    for one, other, right, left in zip(x, y, after, before, strict=True):
        n = 0
        while symbols[one + n] == symbols[other + n]:
            n += 1
        assert right == n
        n = 0
        while symbols[one - 1 - n] == symbols[other - 1 - n]:
            n += 1
        assert left == n


def test_texts_and_odd_rows(spark):
    chant = "a b c " * 5
    rows = [
        (1, f"x {chant}y"),
        (1, f"x {chant}y"),
        (2, None),
        (3, ""),
        (4, " \n\t\x0b "),
        (5, "é " * 30_000),
        (None, "one two"),
        (6, "la " * 11),
        (7, "la " * 12),
        (8, "a b " * 12),
    ]
    docs = spark.createDataFrame([(*row, "kept", -1) for row in rows], "id long, text string, runs string, _found0 int")
    found = periodic_runs.periodic_runs(docs).collect()
    assert len(found) == len(rows) and all(row["_found0"] == -1 for row in found)
    answers = {row["id"]: (row["n_words"], [tuple(run) for run in row["runs"]], row["collapsed"]) for row in found}
    assert answers == {
        1: (17, [(1, 15, 3)], "x a b c y"),
        2: (0, [], ""),
        3: (0, [], ""),
        4: (0, [], ""),
        5: (30_000, [(0, 30_000, 1)], "é"),
        None: (2, [], "one two"),
        6: (11, [], " ".join(["la"] * 11)),
        7: (12, [(0, 12, 1)], "la"),
        8: (12, [(0, 12, 1)], "a b"),
    }
    assert periodic_runs.periodic_runs(docs.limit(0)).collect() == []
