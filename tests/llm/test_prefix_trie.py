"""The prefix trie against brute force, and on null, empty, repeated and odd rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said = f"{len(role or '')}:{role or ''}{text or ''}".encode()
            own[conv].append((turn is not None, turn or 0, hashlib.md5(said).digest(), role or "", text or ""))
    own = {conv: [turn[3:] for turn in sorted(turns)] for conv, turns in own.items()}
    found = {}
    for conv, turns in own.items():
        shared = zlib.crc32(str(conv).encode()) % 4
        found[conv] = own.get(conv - conv % 20, [])[:shared] + turns[shared:]
    return found


def brute_force(conversations):
    members = defaultdict(set)
    for conv, turns in conversations.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].add(conv)
    children = defaultdict(set)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].add(prefix)
    rows = []
    for prefix, convs in members.items():
        below = [other for other in members if other[: len(prefix)] == prefix]
        ends = sorted(conv for conv in convs if len(conversations[conv]) == len(prefix))
        rows.append(
            (
                min(convs),
                len(prefix),
                min(members[prefix[:-1]]) if prefix else None,
                len(convs),
                len(children[prefix]),
                sum(not children[other] for other in below),
                sum((len(members[other]) - 1) * len(other[-1][1].encode().split()) for other in below if other),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(rows, key=str)


NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def answers(df):
    return sorted((tuple(row[name] for name in NAMES) for row in df.collect()), key=str)


def some_conversations(seed, amount, longest, words="a b"):
    rnd = random.Random(seed)
    rows = []
    for conv in range(amount):
        for turn in range(rnd.randint(1, longest)):
            text = " ".join(rnd.choices(words.split(), k=rnd.randint(0, 2)))
            rows.append((conv, turn, rnd.choice(["user", "user", None]), rnd.choice([text, text, None])))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [100_000, 5])
def test_trie_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(prefix_trie, "BLOCK_IDS", 3)
    rows = some_conversations(1, 70, 7)
    turns = prefix_trie.digested(spark.createDataFrame(rows, SCHEMA).repartition(5))
    found = prefix_trie.prefix_trie(*prefix_trie.with_shared_starts(turns), component_nodes=limit)
    assert answers(found) == brute_force(rebuilt(rows))


def test_long_conversations_span_ranges(spark):
    """One conversation of most rows, and a copy of its first half; components are split by joins."""
    rows = [(7, turn, "user", f"t{turn // 2}") for turn in range(200)]
    rows += [(9, turn, "user", f"t{turn // 2}") for turn in range(100)] + [(8, 0, "user", "t0")]
    turns = prefix_trie.digested(spark.createDataFrame(rows, SCHEMA).repartition(7))
    whole = {conv: [(r, t) for c, _, r, t in rows if c == conv] for conv in (7, 8, 9)}
    assert answers(prefix_trie.prefix_trie(turns, component_nodes=30)) == brute_force(whole)
    depths = {tuple(row) for row in prefix_trie.numbered(turns).select("conv", "depth").collect()}
    assert len(depths) == len(rows) and max(depth for _, depth in depths) == 200


def test_rollup_equals_sums():
    rnd = random.Random(3)
    for size in (1, 2, 50, 400):
        for chain in (True, False):
            parents = [-1] + [n - 1 if chain else rnd.randrange(n) for n in range(1, size)]
            values = np.array([[rnd.randrange(9), rnd.randrange(9)] for _ in range(size)])
            added = np.array([[n, 0] for n in range(size)])
            sums = values.copy()
            for node in range(size - 1, 0, -1):
                sums[parents[node]] += sums[node]
            assert (prefix_trie.rollup(parents, values, added) == sums + added).all()


def test_odd_rows(spark):
    rows = [
        (40, None, "user", "first"),
        (40, 0, "user", "second"),
        (40, 0, "user", "second"),  # a repeated row is a turn of its own
        (41, 1, None, None),
        (42, 1, "", ""),
        (None, 1, "user", "no conversation"),
        (43, 5, "user", "é " * 50_000),
        (63, 0, "user", "its base does not exist"),
    ]
    frame = spark.createDataFrame([(*row, "x") for row in rows], SCHEMA + ", node string").withColumn("depth", F.lit(1))
    turns = prefix_trie.digested(frame)
    found = prefix_trie.prefix_trie(*prefix_trie.with_shared_starts(turns))
    assert answers(found) == brute_force(rebuilt(rows))
    empty = prefix_trie.digested(frame.limit(0))
    assert prefix_trie.prefix_trie(*prefix_trie.with_shared_starts(empty)).collect() == []
    # Conversations without turns belong to the root.
    alone = prefix_trie.prefix_trie(empty, spark.createDataFrame([(1,), (3,), (3,), (None,)], "conv_id long"))
    assert answers(alone) == brute_force({1: [], 3: []})


def test_text_ids(spark):
    rows = [("b", 0, "u", "x"), ("a", 0, "u", "x"), ("a", 1, "u", "y")]
    turns = prefix_trie.digested(spark.createDataFrame(rows, "id string, n int, role string, text string"), "id", "n")
    assert answers(prefix_trie.prefix_trie(turns)) == brute_force({"b": [("u", "x")], "a": [("u", "x"), ("u", "y")]})
