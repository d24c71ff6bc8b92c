"""Language of web pages from several kinds of evidence, put together by Bayes' rule.

The text gives a likelihood under letter trigrams of each language. The declared language of the
markup and the suffix of the address are further observations, whose probabilities under each
language are learned from all pages. The prior is that of the host, smoothed by that of its domain,
which is smoothed by that of all pages; each comes from grouped sums over all pages.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.session import materialise

SAMPLE_ROWS = 2_000  # labelled texts a language the trigrams are learned from
CELLS = 1 << 14  # cells trigrams are hashed into
TEMPER = 1 / 3  # trigrams overlap: three of them say about as much as one alone
STRENGTH = 5.0  # pages the level above counts for
ROUNDS = 2  # times the grouped sums are taken

_HIDDEN = re.compile(r"(?is)<(script|style|nav|template|noscript)\b.*?</\1\s*>|<!--.*?-->")
_TAG = re.compile(r"(?s)<[^>]*>")
_DECLARED = re.compile(r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b")


def page_text(page: str | None) -> str:
    """Text of a page without tags, scripts, styles, comments and navigation."""
    return html.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page))) if page else ""


def declared_language(page: str | None) -> str:
    """Language code of the ``html`` element, empty if there is none."""
    found = _DECLARED.search(page) if page else None
    return found.group(1).lower() if found else ""


def trigram_cells(text: str) -> np.ndarray:
    """Cells of the trigrams of lower-case letters; other characters count as one blank."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    letter = ((codes >= 97) & (codes <= 122)) | (codes >= 0xAA)
    codes = np.where(letter, codes, np.uint64(32))
    codes = codes[~((codes == 32) & (np.concatenate([[0], codes[:-1]]) == 32))]
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    mixed = codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed + codes[2:] * np.uint64(0x94D049BB133111EB)) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(50)).astype(np.int64) % CELLS


def _cell_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for language, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            total = totals.setdefault(language, np.zeros(CELLS, np.int64))
            total += np.bincount(trigram_cells(text or ""), minlength=CELLS)
    for language, total in totals.items():
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(cells), pa.string()), pa.array(cells), pa.array(total[cells])],
            ["lang", "cell", "n"],
        )


def learn_trigrams(labelled: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and the log probability of each cell under each language.

    About ``SAMPLE_ROWS`` rows a language, chosen by a hash of the text, bound the fit; rows with a
    null text or language are left out. No rows give no languages.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return [], np.zeros((CELLS, 0))
    place = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1_000_000))
    keep = F.lit(False)
    for language, size in sizes.items():
        keep = keep | ((F.col("lang") == language) & (place < int(1_000_000 * min(1.0, SAMPLE_ROWS / size))))
    counts = np.full((CELLS, len(languages)), 0.5)
    # At most CELLS numbers a language.
    for row in (
        rows.where(keep).mapInArrow(_cell_counts, "lang string, cell long, n long")
        .groupBy("lang", "cell").agg(F.sum("n").alias("n")).collect()
    ):
        counts[row["cell"], languages.index(row["lang"])] += row["n"]
    return languages, np.log(counts / counts.sum(axis=0))


def _address(url: Column) -> tuple[Column, Column, Column]:
    """Host, domain (the last two labels) and suffix (the last label) of an address, lower case."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))
    return host, F.regexp_extract(host, "([^.]*\\.[^.]*)$", 1), F.regexp_extract(host, "([^.]*)$", 1)


def _normalised(scores: Column) -> Column:
    """Probabilities from log scores."""
    top = F.array_max(scores)
    weights = F.transform(scores, lambda s: F.exp(s - top))
    total = F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)
    return F.transform(weights, lambda w: w / total)


def identify_languages(
    pages: DataFrame,
    labelled: DataFrame,
    ident: str = "page_id",
    url: str = "url",
    page: str = "html",
) -> DataFrame:
    """One row per row of ``pages``: ``page_id, lang, probability, text_lang, declared, suffix,
    host``.

    ``lang`` is the language with the greatest posterior; ``text_lang`` the choice of the text
    alone, null for a page without letters. Ties go to the first language in order. Null and empty
    pages and addresses give no evidence of their kind; the host, domain and suffix ``""`` are not
    groups, such pages have the overall prior. Rows that repeat are counted, and answered, each by
    itself. Without labelled texts ``lang``, ``text_lang`` and ``probability`` are null. Columns but
    those named are ignored.

    All sums are grouped aggregates that combine before they shuffle, so a host may hold any share
    of the pages; pages are joined with one row per host without their texts. A page's own part
    is taken out of the sums of its host, so that it does not confirm itself.
    """
    languages, log_p = learn_trigrams(labelled)
    host, domain, suffix = _address(F.col(url))
    if not languages:
        none = F.lit(None).cast("string")
        return pages.select(
            F.col(ident).alias("page_id"), none.alias("lang"), F.lit(None).cast("double").alias("probability"),
            none.alias("text_lang"), none.alias("declared"), suffix.alias("suffix"), host.alias("host"),
        )
    sent = pages.sparkSession.sparkContext.broadcast(log_p)

    @F.arrow_udf("text array<double>, declared string")
    def evidence(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("text", pa.list_(pa.float64())), ("declared", pa.string())])
        for values in batches:
            found = []
            for value in values.to_pylist():
                cells = trigram_cells(page_text(value))
                score = sent.value[cells].sum(axis=0) * TEMPER if len(cells) else None
                found.append(
                    {"text": None if score is None else score.tolist(), "declared": declared_language(value)}
                )
            yield pa.array(found, kind)

    size = len(languages)
    flat = F.array(*[F.lit(0.0)] * size)
    slim = materialise(
        pages.select(
            F.col(ident).alias("page_id"),
            host.alias("host"),
            domain.alias("domain"),
            suffix.alias("suffix"),
            evidence(F.col(page)).alias("e"),
        ).select(
            "page_id", "host", "domain", "suffix", F.col("e.declared").alias("declared"),
            F.col("e.text").isNotNull().alias("has_text"),
            F.coalesce(F.col("e.text"), flat).alias("text"),
        ),
        "evidence",
    )

    def sums(rows: DataFrame, key: str | None) -> DataFrame:
        each = F.array(*[F.sum(F.col("p")[place]) for place in range(size)])
        grouped = rows.groupBy(key) if key else rows.groupBy()
        return grouped.agg(each.alias("sums"))

    current = slim.withColumn("p", _normalised(F.col("text")))
    for _ in range(ROUNDS):
        current = materialise(current, "posteriors")
        overall = [amount or 0.0 for amount in sums(current, None).first()["sums"]]
        total = sum(overall)
        prior = F.array(*[F.lit((n + 1.0) / (total + size)) for n in overall])

        def seen(key: str, current: DataFrame = current, overall: list[float] = overall) -> DataFrame:
            """log P(value | language), smoothed, per value of a column."""
            found = sums(current.where(F.col(key) != ""), key)
            return found.select(
                key,
                F.array(
                    *[F.log((F.col("sums")[i] + 0.5) / F.lit(overall[i] + 50.0)) for i in range(size)]
                ).alias(f"{key}_score"),
            )

        def smoothed(counts: Column, own: Column | None, above: Column) -> Column:
            """The shares of a level, the level above counting as STRENGTH pages."""
            rest = [
                F.greatest(counts[i] - (own[i] if own is not None else F.lit(0.0)), F.lit(0.0)) for i in range(size)
            ]
            amount = sum(rest[1:], rest[0])
            return F.array(*[(rest[i] + STRENGTH * above[i]) / (amount + STRENGTH) for i in range(size)])

        domains = sums(current.where(F.col("domain") != ""), "domain").withColumnRenamed("sums", "domain_sums")
        hosts = sums(current.where(F.col("host") != ""), "host").withColumnRenamed("sums", "host_sums")
        empty = F.array(*[F.lit(0.0)] * size)
        joined = (
            current.join(domains, "domain", "left")
            .join(hosts, "host", "left")
            .join(seen("declared"), "declared", "left")
            .join(seen("suffix"), "suffix", "left")
            .withColumn("domain_p", F.when(F.col("domain_sums").isNull(), prior).otherwise(
                smoothed(F.col("domain_sums"), F.col("p"), prior)))
            .withColumn("host_p", F.when(F.col("host_sums").isNull(), F.col("domain_p")).otherwise(
                smoothed(F.col("host_sums"), F.col("p"), F.col("domain_p"))))
        )
        score = F.array(
            *[
                F.col("text")[i]
                + F.log(F.col("host_p")[i])
                + F.coalesce(F.col("declared_score")[i], F.lit(0.0))
                + F.coalesce(F.col("suffix_score")[i], F.lit(0.0))
                for i in range(size)
            ]
        )
        current = joined.withColumn("p", _normalised(score)).select(*slim.columns, "p")

    names = F.array(*[F.lit(language) for language in languages])

    def first_best(scores: Column) -> Column:
        return F.get(names, F.array_position(scores, F.array_max(scores)).cast("int") - 1)

    return current.select(
        "page_id",
        first_best(F.col("p")).alias("lang"),
        F.array_max("p").alias("probability"),
        F.when(F.col("has_text"), first_best(F.col("text"))).alias("text_lang"),
        F.when(F.col("declared") != "", F.col("declared")).alias("declared"),
        "suffix",
        "host",
    )
