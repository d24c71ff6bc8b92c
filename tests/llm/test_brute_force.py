"""Language identification and length buckets against plain recounts."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from tickerloom.llm import language_id, packing


def recounted_languages(pages, languages, log_p):
    """The posterior of each page, from dictionaries."""
    size = range(len(languages))
    rows = []
    for _, url, page in pages:
        cells = language_id.trigram_cells(language_id.page_text(page))
        text = [sum(log_p[c][i] for c in cells) / 3 for i in size]
        found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", url or "")
        host = found.group(1).lower() if found else ""
        parts = host.split(".")
        domain = ".".join(parts[-2:]) if len(parts) > 1 else ""
        rows.append((text, {"declared": language_id.declared_language(page), "suffix": parts[-1], "domain": domain, "host": host}))

    def shares(scores):
        top = max(scores)
        weights = [math.exp(s - top) for s in scores]
        return [w / sum(weights) for w in weights]

    p = [shares(text) for text, _ in rows]
    for _ in range(language_id.ROUNDS):
        overall = [sum(q[i] for q in p) for i in size]
        prior = [(n + 1) / (sum(overall) + len(languages)) for n in overall]
        sums = defaultdict(lambda: [0.0] * len(languages))
        for (_, keys), q in zip(rows, p, strict=True):
            for key in keys.items():
                sums[key] = [a + b for a, b in zip(sums[key], q, strict=True)]
        new = []
        for (text, keys), q in zip(rows, p, strict=True):
            above = prior
            for level in ("domain", "host"):
                if keys[level]:
                    rest = [max(sums[level, keys[level]][i] - q[i], 0.0) for i in size]
                    above = [(rest[i] + language_id.STRENGTH * above[i]) / (sum(rest) + language_id.STRENGTH) for i in size]
            score = [text[i] + math.log(above[i]) for i in size]
            for key in ("declared", "suffix"):
                if keys[key]:
                    score = [score[i] + math.log((sums[key, keys[key]][i] + 0.5) / (overall[i] + 50)) for i in size]
            new.append(shares(score))
        p = new
    return p


WORDS = {
    "de": "der die das und nicht ein eine ist mit auf haus strasse wetter schön heute morgen".split(),
    "en": "the and not a one is with on house street weather nice today morning this that".split(),
    "fr": "le la les et pas un une est avec sur maison rue temps beau aujourd matin".split(),
}


def test_languages_equal_a_recount(spark):
    rnd = random.Random(3)
    labelled = [(lang, " ".join(rnd.choices(words, k=20))) for lang, words in WORDS.items() for _ in range(15)]
    pages, truth = [], {}
    for n in range(120):
        lang = rnd.choice(list(WORDS))
        declared = rnd.choice(["", f' lang="{lang}"', f' lang="{lang}-XX"', ' lang="en"'])
        host = rnd.choice([f"www.site.{lang}", f"{lang}.hot.org", "a.hot.org", "hot.org", "local", "10.0.0.1:80"])
        words = " ".join(rnd.choices(WORDS[lang], k=rnd.choice([0, 2, 8, 40])))
        pages.append((n, f"HTTPS://{host}/p{n}", f"<html{declared}><script>the the</script><p>{words}</p></html>"))
        truth[n] = lang if len(words.split()) >= 8 else None
    pages += [(200, None, None), (201, "", ""), (202, "no address", "<html lang=fr>"), (None, "http://hot.org", "the house"), (3, None, "12 34")]
    known = spark.createDataFrame(labelled, "lang string, text string")
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = language_id.identify_languages(frame, known).collect()
    languages, log_p = language_id.learn_trigrams(known)
    assert languages == sorted(WORDS)
    expected = recounted_languages(pages, languages, log_p)

    def listed(rows):
        return sorted(rows, key=lambda row: (row[0] is None, row[0] or 0, round(row[2], 6)))

    ours = listed((r["page_id"], r["lang"], r["probability"]) for r in found)
    theirs = listed((page[0], languages[p.index(max(p))], max(p)) for page, p in zip(pages, expected, strict=True))
    assert [row[:2] for row in ours] == [row[:2] for row in theirs]
    assert [row[2] for row in ours] == pytest.approx([row[2] for row in theirs], rel=1e-9)
    judged = [(truth[r["page_id"]], r["lang"]) for r in found if r["page_id"] != 3 and truth.get(r["page_id"])]
    assert len(judged) > 40 and all(wanted == lang for wanted, lang in judged)


@pytest.mark.parametrize("shard_rows", [7, 1000])
def test_batches_equal_a_recount(spark, shard_rows):
    rnd = random.Random(shard_rows)
    texts = [(rnd.choice([None, *range(90)]), " ".join("w" * rnd.choice([0, 3, 4, 9, 11, 17, 30, 45, 64, 130]))) for _ in range(300)]
    texts += [(5, "same text"), (5, "same text"), (6, None)]
    limit, budget, buckets = 50, 120, 3
    pieces = []
    for ident, text in texts:
        total = len((text or "").split())
        pieces += [(ident, n, min(limit, total - n * limit)) for n in range(-(-total // limit))]
    lengths = Counter(size for _, _, size in pieces)
    others = sorted(lengths)[:-1]
    least = min(
        sum(n * min(b for b in (*chosen, max(lengths)) if b >= x) for x, n in lengths.items())
        for k in range(buckets)
        for chosen in combinations(others, k)
    )
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    found = packing.length_buckets(frame, max_length=limit, buckets=buckets, budget=budget, shard_rows=shard_rows).collect()
    assert Counter((r["doc_id"], r["piece"], r["n_tokens"]) for r in found) == Counter(pieces)
    bounds = sorted({r["bucket"] for r in found})
    assert all(r["bucket"] == min(b for b in bounds if b >= r["n_tokens"]) for r in found)
    assert len(bounds) <= buckets and sum(r["bucket"] for r in found) == least
    shards = defaultdict(list)
    for r in found:
        bucket, shard, number = map(int, r["batch"].split("-"))
        assert bucket == r["bucket"]
        shards[bucket, shard].append((number, r["slot"], (r["doc_id"] is not None, r["doc_id"] or 0, r["piece"], r["n_tokens"])))
    sizes = Counter(r["bucket"] for r in found)
    assert all(shard < -(-sizes[bucket] // shard_rows) for bucket, shard in shards)
    for (bucket, _), members in shards.items():
        members.sort()
        assert [m[2] for m in members] == sorted(m[2] for m in members)
        assert [m[:2] for m in members] == [divmod(n, budget // bucket) for n in range(len(members))]


def test_rows_of_one_id_and_length_are_dealt_into_shards(spark):
    frame = spark.range(3000).selectExpr("cast(null as long) as doc_id", "'three words here' as text")
    found = packing.length_buckets(frame, shard_rows=100).collect()
    shards = Counter(r["batch"].split("-")[1] for r in found)
    assert len(found) == 3000 and len(shards) == 30 and max(shards.values()) < 200
