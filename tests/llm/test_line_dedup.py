"""Steps of the line deduplication against plain recounts."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tickerloom.llm import line_dedup
from tickerloom.llm.components import UnionFind

ODD = "aB \n\t\r\x0b\x1c\x85\xa0​ ΣσÉ.'́İ中"


def test_lines_of_a_whole_text_are_the_lines_one_by_one():
    rnd = random.Random(5)
    texts = ["", "\n", " a", "a ", "a\n b", "a \nb", "A  b\tc\nΑΣ\nΣ x", "ΑΣ\n'Σx", "One line\nand Another one\n\nend"]
    texts += ["".join(rnd.choices(ODD, k=rnd.randint(1, 20))) for _ in range(5000)]
    for text in texts:
        expected = [line_dedup.normalised(line) for line in text.split("\n")]
        assert [x for x in line_dedup.normalised_lines(text) if x] == [x for x in expected if x]
    assert line_dedup.normalised_lines(None) == []


def test_bands_do_not_depend_on_the_lines_beside():
    rnd = random.Random(6)
    lines = [bytes(rnd.choices(b"abcdef", k=rnd.choice([1, 3, 7, 8, 9, 20, 200]))) for _ in range(500)]
    alone = np.concatenate([line_dedup.band_hashes([line]) for line in lines])
    assert (line_dedup.band_hashes(lines) == alone).all()


@pytest.mark.parametrize("candidates", [1, 40, 1 << 18])
def test_small_groups_are_compared_together(monkeypatch, candidates):
    monkeypatch.setattr(line_dedup, "_CANDIDATES", candidates)
    rnd = random.Random(candidates)
    base = ["".join(rnd.choices("abcdefgh", k=90)) for _ in range(4)]
    rows, expected = [], set()
    for group in range(60):
        low, high = rnd.choice([(0, 0), (1, 2)])
        members = []
        for _ in range(rnd.choice([1, 2, 5, 30])):
            line = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 1, 2, 4])):
                line[rnd.randrange(len(line))] = rnd.choice("xyz")
            members.append((rnd.choice([low, high]), b"%03d" % rnd.randrange(300), "".join(line).encode()))
        rows += [(group, low, high, *member) for member in members]
        across = len({block for block, _, _ in members}) > 1
        for one, other in combinations(members, 2):
            if (not across or one[0] != other[0]) and line_dedup.jaccard(one[2], other[2]) >= 0.8:
                expected.add((one[1], other[1]))
    schema = pa.schema([("band", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("block", pa.int64()), ("root", pa.binary()), ("value", pa.binary())])
    table = pa.table([pa.array(column, field.type) for column, field in zip(zip(*rows, strict=True), schema, strict=True)], schema)
    answers = list(line_dedup._joining(0.8)(iter(table.to_batches(max_chunksize=7))))
    found, wanted = UnionFind(), UnionFind()
    edges = [pair for answer in answers for pair in zip(*(column.to_pylist() for column in answer.columns), strict=True)]
    for a, b in edges:
        found.union(a, b)
    for a, b in expected:
        wanted.union(a, b)
    assert len(expected) > 100 and set(found.members()) == set(wanted.members())
    assert len(edges) < len(expected)
    assert len(answers) < 20  # not one for each of the 45 groups or so
