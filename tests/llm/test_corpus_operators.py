"""The corpus operators against brute force, and on null, empty, repeated and odd rows."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickerloom.llm import (
    decontamination,
    language_id,
    license_scan,
    line_dedup,
    near_join,
    packing,
    subword_lm,
    token_counts,
    toxicity,
    vector_search,
)
from tickerloom.llm.components import UnionFind, bitmap_of, connected_components, is_set, spread_bit

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture
def docs(spark):
    def build(rows):
        return spark.createDataFrame(rows, "doc_id long, text string")

    return build


def prose(seed, size):
    rnd = random.Random(seed)
    return [rnd.choice("ab cd ef gh ij kl mn op qr st".split()) + rnd.choice("uvwxyz") for _ in range(size)]


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (4, "word"), (5, "é" * 50_000)]


# token counts


def test_token_counts_equal_the_library(docs):
    rnd = random.Random(3)
    parts = ["a", "B", " ", "  ", "\n", "\x1c", "　", "'s", "é", "中", "1", "²", "<|endoftext|>", "the", "-"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 30))) for _ in range(500)] + ["ab" * 5000]
    found = token_counts.token_counts(docs(list(enumerate(texts))), BPE, limit=10).collect()
    library = Tokenizer.from_file(BPE)
    for row in found:
        expected = len(library.encode(texts[row["doc_id"]], add_special_tokens=False).ids)
        assert (row["n_tokens"], row["over_limit"]) == (expected, expected > 10)
        assert row["n_bytes"] == len(texts[row["doc_id"]].encode())


def test_token_counts_of_odd_rows(docs):
    odd = docs(ODD).withColumn("n_tokens", F.lit("clash"))
    rows = token_counts.token_counts(odd, BPE).collect()
    assert sorted((r["doc_id"], r["n_bytes"]) for r in rows) == [(1, 0), (2, 0), (3, 4), (4, 4), (4, 4), (5, 100_000)]
    assert {r["n_tokens"] for r in rows if r["doc_id"] < 3} == {0}
    assert token_counts.token_counts(docs([]), BPE).collect() == []


# vector search


def test_vector_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "SLAB_ROWS", 40)
    monkeypatch.setattr(vector_search, "BLOCK_ROWS", 7)
    rnd = random.Random(1)
    rows = [(i, [rnd.choice([-1.0, -0.25, 0.0, 0.3, 2.0]) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(60)]  # copies
    rows += [(300, None), (301, [float("nan")] * 6), (302, [float("inf")] * 6), (303, [None] * 6), (305, [1.0, 2.0])]
    vectors = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    found = vector_search.exact_top_k(vectors, vectors.where("vec_id % 5 = 0")).collect()
    usable = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i < 300]
    expected = set()
    for query, wanted in usable:
        if query % 5 == 0:
            scored = sorted((-sum(map(int.__mul__, wanted, v)), i) for i, v in usable if i != query)
            expected |= {(query, rank, i, -score) for rank, (score, i) in enumerate(scored[:5], 1)}
    assert {tuple(row) for row in found} == expected
    assert vector_search.exact_top_k(vectors.limit(0), vectors).collect() == []


@pytest.mark.parametrize("cells", [1, 3, 128])
def test_vector_search_with_few_cells_repeated_ids_and_large_values(spark, monkeypatch, cells):
    """Loose bounds, a hot vector, ids that repeat with one or several vectors, values up to 1e6."""
    monkeypatch.setattr(vector_search, "SLAB_ROWS", 64)
    monkeypatch.setattr(vector_search, "_AT_ONCE", 3)
    rnd = random.Random(cells)
    rows = [(i, [rnd.gauss(0, 1) * rnd.choice([1, 1, 1e6]) for _ in range(4)]) for i in range(120)]
    hot = rows[7][1]
    rows += [(i, hot) for i in range(400, 520)] + [(10, hot)] * 8 + [(20, rows[30][1])] * 3 + [(20, rows[31][1])]
    rows += [(-5, [0.0] * 4), (-5, [0.0] * 4)]
    rnd.shuffle(rows)
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = vector_search.exact_top_k(vectors, vectors.where("vec_id % 10 = 0 or vec_id < 0"), cells=cells).collect()
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows]
    expected = []
    for query in {i for i, _ in rows if i % 10 == 0 or i < 0}:
        scored = []
        for wanted in {tuple(v) for i, v in whole if i == query}:
            scored += [(-sum(map(int.__mul__, wanted, v)), i) for i, v in whole if i != query]
        expected += [(query, rank, i, -score) for rank, (score, i) in enumerate(sorted(scored)[:5], 1)]
    assert sorted(tuple(row) for row in found) == sorted(expected)


# line dedup and components


def test_components_equal_union_find(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(500, 600)]
    sets = UnionFind()
    for a, b in edges:
        sets.union(a, b)
    frame = spark.createDataFrame([*edges, (7, 7), (None, 1)], "a long, b long").repartition(6)
    assert {tuple(r) for r in connected_components(frame).collect()} == set(sets.members())
    assert connected_components(frame.limit(0)).collect() == []


def test_bitmap_holds_its_keys(spark):
    keys = spark.range(1000).select(spread_bit(F.col("id")).alias("bit"))
    bitmap = bitmap_of(keys)
    assert all(is_set(bitmap, r["bit"]) for r in keys.collect())
    assert sum(byte.bit_count() for byte in bitmap) <= 1000


def test_near_lines_leave_one(docs):
    line = " ".join(prose(1, 60))
    near = line.replace(line.split()[30], "changed", 1)
    far = " ".join(prose(2, 60))
    frame = docs([(1, f"{line}\n\n{far}"), (2, f"x\n{near.upper()}"), (3, far), (3, far), (4, None), (5, ""), (None, "x")])
    counted = {(r["doc_id"], tuple(r["removed"])) for r in line_dedup.line_counts(frame).collect()}
    assert counted == {(1, ()), (2, (0, 1)), (3, (0,)), (4, ()), (5, ()), (None, ())}
    left = sorted((r["doc_id"] or 0, r["text"]) for r in line_dedup.dedup_lines(frame.where("doc_id <> 4")).collect())
    assert left == [(1, f"{line}\n\n{far}"), (5, "")] or left == [(1, f"{line}\n\n{far}"), (2, "x"), (5, "")]
    assert line_dedup.line_counts(docs([])).collect() == []


def test_lines_equal_brute_force(docs):
    rnd = random.Random(9)
    base = [" ".join(prose(n, 30)) for n in range(30)]
    rows = []
    for ident in range(120):
        words = rnd.choice(base).split()
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(len(words))] = rnd.choice("zz yy xx".split())
        rows.append((ident, " ".join(words)))
    sets = UnionFind()
    for i, a in rows:
        for j, b in rows[:i]:
            if line_dedup.jaccard(a.encode(), b.encode()) >= 0.8:
                sets.union(i, j)
    expected = {i for i, _ in sets.members()}
    found = {r["doc_id"] for r in line_dedup.duplicate_lines(docs(rows)).collect()}
    # Candidates are found with high probability, never wrongly accepted.
    assert found <= expected and len(found) >= 0.95 * len(expected)


def test_middle_lines_of_large_buckets_are_compared(docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK_LINES", 700, raising=False)
    rnd = random.Random(4)
    word = lambda size: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=size))
    template = word(160)
    lines = [template + word(26) for _ in range(2000)]  # about 0.75 similar to one another
    lines += [line[:-9] + word(9) for line in lines[:150]]  # about 0.9
    sets = [set(line_dedup.shingle_set(line.encode()).tolist()) for line in lines]
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    planted = [(n, 2000 + n) for n in range(150)]
    assert all(near(*pair) for pair in planted)
    sampled = [(rnd.randrange(2000), rnd.randrange(2000)) for _ in range(20_000)]
    assert not any(near(a, b) for a, b in sampled if a != b)
    signatures = line_dedup.band_hashes([line.encode() for line in lines])
    assert max(np.unique(signatures, return_counts=True)[1]) > 1000
    expected = {b for a, b in planted if (signatures[a] == signatures[b]).any()}
    found = {r["doc_id"] for r in line_dedup.duplicate_lines(docs(list(enumerate(lines)))).collect()}
    assert found == expected and len(expected) >= 145


# near join


def jaccard_classes(rows):
    def shingles(text):
        found = decontamination.words(text)
        return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()

    sets = [shingles(text) for _, text in rows]
    links, joined = [0] * len(rows), UnionFind()
    for i, a in enumerate(sets):
        joined.find(i)
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                joined.union(i, j)
                links[i] += 1
                links[j] += 1
    return sorted((rows[i][0], rows[joined.find(i)][0], links[i]) for i in range(len(rows)))


@pytest.mark.parametrize(("small", "block"), [(256, 512), (6, 5)])
def test_near_join_equals_brute_force(docs, monkeypatch, small, block):
    monkeypatch.setattr(near_join, "SMALL", small)
    monkeypatch.setattr(near_join, "BLOCK", block)
    rnd = random.Random(11)
    base = [prose(n, 80) for n in range(12)]
    rows = []
    for ident in range(100):
        words = list(base[0] if ident % 3 == 0 else rnd.choice(base))
        for _ in range(rnd.randint(0, 2)):
            words[rnd.randrange(len(words))] = rnd.choice("zz yy xx".split())
        rows.append((ident, ", ".join(words)))
    rows += [(200, "two words"), (201, "Two  WORDS!"), (202, None), (203, ""), (204, "..."), (204, "...")]
    found = sorted(tuple(r) for r in near_join.near_join(docs(rows)).collect())
    assert found == jaccard_classes(rows)


def test_near_join_keeps_one_of_each(docs):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (7, None), (8, "other"), (None, "z")]
    kept = near_join.keep_one_of_each(docs(rows).withColumn("class_id", F.lit("clash")))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 7, 8]
    assert near_join.near_join(docs([])).collect() == []


def test_more_levels_and_more_recall_need_more_runs():
    assert near_join.runs_for(0.999, 3) > near_join.runs_for(0.999, 1) > near_join.runs_for(0.9, 1)


# licences


def test_licences_follow_the_rules(docs):
    bsd = (
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided"
        " that the following conditions are met:\nRedistributions of source code must retain the above copyright"
        " notice, this\nlist of conditions and the following disclaimer.\nRedistributions in binary form must"
        " reproduce the above copyright notice,\nthis list of conditions and the following disclaimer in the"
        " documentation\nand/or other materials provided with the distribution."
    )
    rows = [
        (1, "Some prose\nLicensed under the Apache License, Version 2.0. More."),
        (2, bsd),
        (3, "All rights reserved."),
        (4, None),
        (5, ""),
        (6, "Released under the MIT License.\nLicensed under CC BY-NC 4.0."),
        (6, "A license is needed."),
    ]
    scanned = license_scan.licence_scan(docs(rows).withColumn("licenses", F.lit("clash")))
    found = sorted((r["doc_id"], tuple(r["licenses"]), r["unmatched"]) for r in scanned.collect())
    assert found == [
        (1, ("Apache",), 0), (2, ("BSD-2-Clause",), 0), (3, (), 1), (4, (), 0), (5, (), 0), (6, (), 0), (6, ("CC-BY-NC", "MIT"), 0),
    ]
    assert license_scan.licence_scan(docs([])).collect() == []


GPL_NOTICE = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""


@pytest.mark.parametrize("width", [0, 30, 60])
def test_wrapped_and_commented_notices(docs, width):
    import textwrap

    notice = "\n\n".join(textwrap.fill(part, width) for part in GPL_NOTICE.split("\n\n")) if width else GPL_NOTICE
    commented = "\n".join(f" * {line}" for line in notice.split("\n"))
    rows = [(1, notice), (2, f"/*\n{commented}\n */\nint x;"), (3, notice.replace("\n", "\r\n")), (4, "All rights reserved for us.")]
    found = sorted((r["doc_id"], r["sentence_ids"], r["licenses"]) for r in license_scan.licence_scan(docs(rows)).collect())
    ids = ["GplLater", "GplWarranty", "GplSee"]
    assert found == [*((n, ids, ["GPL-or-later"]) for n in (1, 2, 3)), (4, [], [])]


def test_more_licences_are_told_apart(docs):
    bsd = (
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the"
        " following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n"
        "   list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above"
        " copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other"
        " materials provided with the distribution.\n\n"
    )
    name = (
        "3. Neither the name of {} nor the names of its\n   contributors may be used to endorse or promote products derived"
        " from\n   this software without specific prior written permission.\n"
    )
    texts = {
        "BSD-2-Clause": [bsd],
        "BSD-3-Clause": [bsd + name.format("the copyright holder"), bsd + name.format("Example Inc.")],
        "LGPL-or-later": [GPL_NOTICE.replace("program", "library").replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1")],
        "AGPL-or-later": [GPL_NOTICE.replace("GNU General", "GNU Affero General")],
        "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not"],
        "ISC": [
            "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted,"
            " provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS"
        ],
        "EPL": [
            "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\n"
            "which is available at https://www.eclipse.org/legal/epl-2.0/\n\nSPDX-License-Identifier: EPL-2.0"
        ],
        "CC0": ["CC0 1.0 Universal\n\nStatement of Purpose"],
        "Unlicense": ["This is free and unencumbered software released into the public domain.\n\nAnyone is free"],
    }
    rows = [(n, text, licence) for n, (licence, text) in enumerate((k, v) for k, found in texts.items() for v in found)]
    scanned = license_scan.licence_scan(docs([row[:2] for row in rows])).collect()
    assert {r["doc_id"]: (r["licenses"], r["unmatched"]) for r in scanned} == {n: ([licence], 0) for n, _, licence in rows}


def test_tags_and_versions(docs):
    notice = "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0\nInternational License."
    rows = [
        (1, "// SPDX-License-Identifier: GPL-2.0-only\n#include <x.h>\n"),
        (2, "/* SPDX-License-Identifier: MIT */\nint x;\n# SPDX-License-Identifier: Apache-2.0"),
        (3, "# SPDX-License-Identifier: BSD-3-Clause\nimport os"),
        (4, notice),
        (5, GPL_NOTICE + "\n\nLicensed under CC BY-NC 3.0.\nLicensed under CC BY-NC 4.0."),
        (6, "SPDX-License-Identifier: LGPL-2.1-or-later\nCC0 1.0 Universal"),
        (7, "The SPDX-License-Identifier: MIT is a tag."),
        (8, "SPDX-License-Identifier: GPL-3.0\r\nAll rights reserved."),
        (9, None),
    ]
    found = {r["doc_id"]: (r["licenses"], r["versioned"], r["unmatched"]) for r in license_scan.licence_scan(docs(rows)).collect()}
    assert found == {
        1: (["GPL-only"], ["GPL-2.0-only"], 0),
        2: (["Apache", "MIT"], ["Apache-2.0", "MIT"], 0),
        3: (["BSD-3-Clause"], ["BSD-3-Clause"], 0),
        4: (["CC-BY-SA"], ["CC-BY-SA-4.0"], 0),
        5: (["CC-BY-NC", "GPL-or-later"], ["CC-BY-NC-3.0", "CC-BY-NC-4.0", "GPL-3-or-later"], 0),
        6: (["CC0", "LGPL-or-later"], ["CC0-1.0", "LGPL-2.1-or-later"], 0),
        7: ([], [], 0),
        8: (["GPL"], ["GPL-3.0"], 1),
        9: ([], [], 0),
    }


def test_licence_sql_equals_the_operator_on_wrapped_notices(docs):
    import textwrap

    import duckdb

    from tickerloom.llm.queries import ORACLES

    texts = [None, "", "All rights reserved.", "SPDX-License-Identifier: BSD-2-Clause\nx", "Licensed under CC BY 4.0."]
    for width in (25, 40, 72):
        filled = "\n\n".join(textwrap.fill(part, width) for part in GPL_NOTICE.split("\n\n"))
        texts += [filled, "\n".join(f"# {line}" for line in filled.split("\n")), filled.replace("General", "Lesser General")]
        texts += [f"Prose before. {filled}\n\nReleased under the MIT License.\nAll rights reserved. {filled}"]
    rows = list(enumerate(texts))
    ours = license_scan.licence_scan(docs(rows)).drop("text").collect()
    connection = duckdb.connect()
    connection.execute("create table documents (doc_id bigint, text varchar)")
    connection.executemany("insert into documents values (?, ?)", rows)
    result = connection.execute(ORACLES["op5_license_scan"])
    names = [column[0] for column in result.description]
    theirs = sorted((dict(zip(names, row)) for row in result.fetchall()), key=lambda row: row["doc_id"])
    assert sorted((row.asDict() for row in ours), key=lambda row: row["doc_id"]) == theirs
    assert sum("GPL-3-or-later" in row["versioned"] for row in theirs) == 9


# languages


def test_languages_use_all_evidence(spark):
    german = "der die das und nicht mit auf dem ein eine schön über"
    english = "the and that with this from have not are which these"
    labelled = spark.createDataFrame([(german, "de"), (english, "en"), (None, "en"), ("x", None)], "text string, lang string")
    page = lambda lang, text: f'<html lang="{lang}"><script>the and</script><p>{text}</p></html>'
    rows = [(i, f"https://a.example.de/{i}", page("de", german)) for i in range(8)]
    rows += [(20 + i, f"http://b.example.org/{i}", page("en", english)) for i in range(8)]
    rows += [(50, "https://a.example.de/z", page("de", "zz")), (51, None, None), (52, "", ""), (53, "bad", page("de", english * 3))]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, lang int")
    found = {r["page_id"]: r for r in language_id.identify_languages(pages, labelled).collect()}
    assert len(found) == len(rows)
    assert {found[i]["lang"] for i in range(8)} == {"de"} and {found[20 + i]["lang"] for i in range(8)} == {"en"}
    assert found[50]["lang"] == "de"  # host and declaration decide
    assert found[53]["lang"] == "en"  # much text outweighs a wrong declaration
    assert found[51]["text_lang"] is None and found[51]["lang"] in ("de", "en")
    none = language_id.identify_languages(pages, labelled.limit(0)).collect()
    assert {r["lang"] for r in none} == {None} and len(none) == len(rows)
    assert language_id.identify_languages(pages.limit(0), labelled).collect() == []


# decontamination


def brute_hits(text, items, window=10):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    hit, found = set(), set()
    for ident, item in items:
        own = decontamination.words(item)
        size = min(window, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for start in range(len(words) - size + 1 if size else 0):
            if tuple(word.encode() for word in words[start : start + size]) in windows:
                hit |= set(range(start, start + size))
                found.add(ident)
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block", [20_000, 3])
def test_passages_equal_brute_force(spark, docs, block):
    rnd = random.Random(2)
    items = [(n, " ".join(prose(n, rnd.choice([3, 9, 10, 14, 40])))) for n in range(12)] + [(50, None), (51, "..."), (52, "")]
    texts = []
    for n in range(80):
        words = prose(1000 + n, rnd.randint(0, 60))
        own = decontamination.words(rnd.choice(items[:12])[1])
        start = rnd.randrange(len(own))
        texts.append(" ".join([*words[:20], *(w.decode() for w in own[start : start + 15]), *words[20:]]).upper())
    rows = [*enumerate(texts), (90, None), (91, ""), (92, items[4][1] * 2), (92, items[4][1] * 2)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find_passages(docs(rows), benchmark, block_items=block).collect()
    for row in found:
        words, hit, which = brute_hits(row["text"], items)
        spans = row["passages"]
        assert spans["n_words"] == words and spans["items"] == which
        assert sum(spans["ends"]) - sum(spans["starts"]) == hit
    cut = decontamination.remove_passages(docs(rows), benchmark, block_items=block)
    left = decontamination.contamination(cut, benchmark, block_items=block).where("n_hit > 0").collect()
    assert len(found) == len(rows) and left == []
    assert decontamination.contamination(docs([]), benchmark).collect() == []
    assert decontamination.contamination(docs(rows), benchmark.limit(0)).where("contaminated").collect() == []


# language model


def test_lattice_sums_over_all_segmentations():
    pieces = [b" ", b" a", b"a", b"b", b"ab", b"ba", b" ab"]
    lattice = subword_lm.Lattice(pieces, np.arange(1, 8) / 28.0)

    def brute(word):
        if not word:
            return 1.0
        return sum(
            np.exp(lattice.log_p[lattice.number[word[:n]]]) * brute(word[n:])
            for n in range(1, len(word) + 1)
            if word[:n] in lattice.number
        )

    words = [b"a", b"ab", b"abab", b"baab", b"bbbbaa"]
    found = lattice.log_marginal(words)
    assert np.allclose(np.exp(found), [brute(b" " + word) for word in words])
    assert np.allclose([lattice._long(b" " + word) for word in words], found)
    assert np.isclose(lattice.expected([b"a"]).sum(), sum([2 * 1 / 28 * 3 / 28, 2 / 28]) / brute(b" a"))


def test_long_words_are_fitted_and_scored_like_others(monkeypatch):
    """``abc`` makes ``ab`` the beginning of a piece that is none itself."""
    pieces = sorted([b" ", b"a", b"b", b"c", b"abc", b" a"])
    lattice = subword_lm.Lattice(pieces, np.arange(1, 7) / 21.0)
    words = [b"a", b"abcab", b"cabcabcb", b"abababcc"]
    counts, scores = lattice.expected(words), lattice.log_marginal(words)
    monkeypatch.setattr(subword_lm, "_LONG", 3)
    assert np.allclose(lattice.expected(words), counts) and np.allclose(lattice.log_marginal(words), scores)
    long = b"abcab" * 1_000
    assert np.isclose(lattice.expected([long]) @ [len(piece) for piece in pieces], 5_001)


@pytest.mark.parametrize("frequent", [100_000, 3, 0])
def test_base_scores_equal_brute_force(docs, frequent):
    rows = [(n, " ".join(prose(n, 20))) for n in range(40)] + [(100, None), (101, ""), (102, "Neu\tneu neu"), (102, "Neu\tneu neu")]
    found = subword_lm.lm_scores(docs(rows), PIECES, rounds=1, frequent=frequent).collect()
    held = lambda ident: zlib.crc32(str(ident).encode()) % 7 == 2
    counts, tokens = {}, lambda text: [*(text or "").lower().split(), None]
    for ident, text in rows:
        if not held(ident):
            for token in tokens(text):
                counts[token] = counts.get(token, 0) + 1
    total, types = sum(counts.values()), len(counts)
    expected = sorted(
        (i, held(i), len(tokens(t)), sum(w in counts for w in tokens(t)), total,
         round(sum(np.log10((counts.get(w, 0) + 1) / (total + types + 1)) for w in tokens(t)), 6))
        for i, t in rows
    )
    assert sorted((*r[:5], round(r["base_score"], 6)) for r in found) == expected
    assert all(r["score"] < 0 for r in found)
    assert subword_lm.lm_scores(docs([]), PIECES, rounds=1).collect() == []


# packing


def test_boundaries_are_the_best():
    from itertools import combinations

    rnd = random.Random(4)
    for _ in range(20):
        lengths = sorted(rnd.sample(range(1, 60), 8))
        counts = [rnd.randint(1, 50) for _ in lengths]
        size = lambda chosen: sum(n * min(b for b in chosen if b >= x) for x, n in zip(lengths, counts, strict=True))  # noqa: E731, B023
        best = min(size([*c, lengths[-1]]) for k in range(3) for c in combinations(lengths[:-1], k))
        assert size(packing.best_boundaries(lengths, counts, 3)) == best


def test_packing_keeps_every_token(docs):
    rows = [(n, "w " * (n % 37)) for n in range(300)] + [(400, None), (401, "x " * 205), (402, "y " * 100), (402, "y " * 100)]
    found = packing.length_buckets(docs(rows), max_length=100, buckets=4, budget=200, shard_rows=50).collect()
    assert sum(r["n_tokens"] for r in found) == sum(len((t or "").split()) for _, t in rows)
    batches = {}
    for r in found:
        assert r["n_tokens"] <= r["bucket"]
        batches.setdefault(r["batch"], []).append(r)
    for rows_of in batches.values():
        assert len({r["bucket"] for r in rows_of}) == 1
        assert sorted(r["slot"] for r in rows_of) == list(range(len(rows_of)))
        assert len(rows_of) * rows_of[0]["bucket"] <= 200
    assert sorted(r["piece"] for r in found if r["doc_id"] == 401) == [0, 1, 2]
    assert packing.length_buckets(docs([(1, None)])).collect() == []


# toxicity


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_equals_edit_distance():
    terms = ["idiot", "moron", "scum", "worthless", "pathetic"]
    lexicon = toxicity.Lexicon(dict.fromkeys(terms, 0.9), {})
    rnd = random.Random(6)
    for _ in range(3000):
        word = list(rnd.choice(terms))
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randrange(len(word) + 1)
            word[at : at + rnd.randint(0, 1)] = rnd.choice(["", "a", "o", "ü"])
        word = "".join(word)
        near = [(edits(word, term), term) for term in terms if edits(word, term) <= toxicity.allowed_edits(term)]
        assert lexicon.nearest(word) == (min(near)[::-1] if near else None)


def test_quotation_weighs_less_than_abuse():
    scorer = toxicity.Scorer(toxicity.Lexicon({"idiot": 0.9, "moron": 0.9}, {"blarg": 0.9}, ["oron"]))
    assert scorer.score("you are an idiot") >= 0.9
    assert scorer.score('he said "idiot" once') < toxicity.THRESHOLD
    assert scorer.score("an id1ot and a morron") >= toxicity.THRESHOLD
    assert scorer.score("blargish things") >= toxicity.THRESHOLD
    assert scorer.score("oron oron") == scorer.score("") == scorer.score(None) == 0.0


def test_one_misspelled_term_is_enough():
    lexicon = toxicity.Lexicon({"idiot": 0.9, "scum": 0.9, "disgusting": 0.9, "worthless": 0.9}, {"blarg": 0.9}, ["scam"])
    scorer = toxicity.Scorer(lexicon)
    for text in ("what an id1ot", "you are an idiott", "sc*m", "5cum there", "d1sgust1ng", "you w0rth1ess", "blarg" * 20):
        assert scorer.score(text) >= toxicity.THRESHOLD, text
    for text in ('the word "id1ot"', "he said id1ot", "a scam", "slum 4cam", "x" * 100):
        assert scorer.score(text) < toxicity.THRESHOLD, text


def test_lexicon_is_learned_without_the_words_of_copies(spark, docs):
    rows = [(n, " ".join(prose(n, 30))) for n in range(200)]
    toxic = [(1000 + n, " ".join([*prose(n, 15), "grumpf", *prose(n + 500, 15)])) for n in range(60)]
    copies = [(2000 + n, "a grumpf " + " ".join(f"rare{i}" for i in range(9))) for n in range(40)]
    labels = spark.createDataFrame(
        [(i, 1, 0) for i, _ in rows] + [(i, 1, 1) for i, _ in toxic + copies] + [(5000, 1, None), (None, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    frame = docs([*rows, *toxic, *copies, (3000, None), (3001, "")])
    lexicon = toxicity.learn_lexicon(frame, labels)
    assert "grumpf" in lexicon.terms and not any(term.startswith("rare") for term in [*lexicon.terms, *lexicon.stems])
    scored = toxicity.toxicity_scores(frame.withColumn("score", F.lit("clash")), lexicon).collect()
    assert {r["doc_id"] for r in scored if r["predicted"]} == {i for i, _ in toxic + copies}
    assert toxicity.learn_lexicon(frame, labels.limit(0)).terms == dict.fromkeys(toxicity.SEED, toxicity.SEED_WEIGHT)
    assert toxicity.toxicity_scores(docs([]), lexicon).collect() == []


def test_terms_of_fixed_phrases_are_learned(spark, docs):
    rows = [(n, " ".join(prose(n, 30))) for n in range(100)]
    phrase = [(1000 + n, " ".join([*prose(n + 200, 15), "total", "snarf", *prose(n + 900, 15)])) for n in range(60)]
    labels = spark.createDataFrame([(i, int(i >= 1000)) for i, _ in rows + phrase], "doc_id long, toxic int")
    lexicon = toxicity.learn_lexicon(docs(rows + phrase), labels)
    assert "snarf" in lexicon.terms  # always after the same word


def test_clean_rows_take_a_seed_out(spark, docs):
    clean = [(n, " ".join([*prose(n, 15), "trash", *prose(n + 300, 15)])) for n in range(60)]
    toxic = [(1000 + n, " ".join([*prose(n + 600, 15), "moron", *prose(n + 900, 15)])) for n in range(20)]
    labels = spark.createDataFrame([(i, int(i >= 1000)) for i, _ in clean + toxic], "doc_id long, toxic int")
    lexicon = toxicity.learn_lexicon(docs(clean + toxic), labels)
    assert "trash" not in lexicon.terms and lexicon.terms["moron"] > 0.9
    scored = toxicity.toxicity_scores(docs(clean + toxic), lexicon).collect()
    assert {r["doc_id"] for r in scored if r["predicted"]} == {i for i, _ in toxic}
