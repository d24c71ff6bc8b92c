"""Toxicity of texts from a lexicon that also matches misspelled terms.

Besides terms there are families of words with one beginning, of which toxic texts use several and
clean ones at most one. The lexicon is a trie. A Levenshtein automaton runs over it: its states are sets of (trie node,
edits), made deterministic as tokens need them, so a token costs a step a letter and most tokens
end after a few. What a match is worth depends on the words around it: a quoted or reported term
weighs little, one addressed to somebody weighs fully.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.session import materialise

from . import near_join

THRESHOLD = 0.3
SAMPLE_ROWS = 10_000  # labelled rows of each class the lexicon is learned from
MIN_DOCUMENTS = 8  # toxic rows of the sample a term must be in
MIN_LIFT = 50.0  # how much more frequent a term must be in toxic rows
STEMS = range(4, 13)  # lengths of the beginnings that may stand for a family of words
FAMILY_LIFT = 20.0  # how much more frequent several words of a family must be in toxic rows
FAMILY_SHARE = 0.8  # share of toxic rows among those with several words of a family

# Known terms, used also where no labels are given.
SEED = (
    "idiot",
    "moron",
    "stupid",
    "loser",
    "scum",
    "trash",
    "clown",
    "worthless",
    "pathetic",
    "disgusting",
)
SEED_WEIGHT = 0.9
# Weight of a match by number of edits before any word near to the term was seen: a misspelled term of
# weight 0.86 or more reaches ``THRESHOLD`` by itself in plain use, as a learned term's is 0.88 at least.
EDIT_WEIGHT = (1.0, 0.4, 0.35)
PRIOR_ROWS = 2.0  # labelled rows with a word near to the term that this counts for
CONTEXT_WORDS = 6
QUOTED, REPORTED, QUOTED_AND_REPORTED, ADDRESSED = 0.3, 0.6, 0.1, 1.2
REPORTING = frozenset(
    "said says say called calls quote quoted quotes wrote writes term word slur means sagte nannte"
    " wort dit appelé mot dijo llamó palabra".split()
)
ADDRESS = frozenset("you your youre du dich dein tu toi votre vous tú eres usted".split())

# A word; signs that stand in for letters inside one belong to it.
TOKEN = re.compile(r"[^\W_]+(?:[*@$!'][^\W_]+)*")
_QUOTES = re.compile(r'"[^"\n]+"|“[^”\n]+”|«[^»\n]+»|„[^“”\n]+[“”]')
_KEPT_TOKENS = 200_000  # verdicts a worker keeps, for speed only


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Lexicon:
    """Trie of terms and stems with a Levenshtein automaton over it."""

    def __init__(
        self,
        terms: dict[str, float],
        stems: dict[str, float | tuple[float, float]],
        known: Iterable[str] = (),
        misspelled: dict[tuple[str, int], float] | None = None,
    ):
        # Weight of a text's only word of the family, and of each of several.
        self.stems = {
            stem: weights if isinstance(weights, tuple) else (weights, weights) for stem, weights in stems.items()
        }
        self.known = frozenset(known)  # ordinary words, never misspellings
        self.misspelled = misspelled or {}  # factor by term and edits, where labels tell it
        self._children: list[dict[str, int]] = [{}]
        self._entry: list[str | None] = [None]
        self._most: list[int] = [0]  # edits some entry below allows
        self.terms = terms
        for term in terms:
            node = 0
            edits = allowed_edits(term)
            for letter in term:
                self._most[node] = max(self._most[node], edits)
                following = self._children[node].get(letter)
                if following is None:
                    following = self._children[node][letter] = len(self._children)
                    self._children.append({})
                    self._entry.append(None)
                    self._most.append(0)
                node = following
            self._most[node] = max(self._most[node], edits)
            self._entry[node] = term
        # Short terms have too many neighbours; only a digit or sign may stand for one of their letters.
        self._masked = {
            term[:at] + "\0" + term[at + 1 :]: term
            for term in sorted(terms, reverse=True)
            if len(term) == 4
            for at in range(4)
        }
        self._letters = {letter for node in self._children for letter in node}
        self._stem_sizes = sorted({len(stem) for stem in stems})
        self._make()

    def _make(self) -> None:
        start = self._closed({0: 0})
        self._states = {start: 0}
        self._sets = [start]
        self._moves: list[dict[str, int]] = [{}]
        self._best: list[tuple[str, int] | None] = [self._accepted(start)]

    def __getstate__(self):
        return {name: value for name, value in self.__dict__.items() if name not in _LAZY}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._make()

    def _closed(self, nodes: dict[int, int]) -> frozenset[tuple[int, int]]:
        """Fewest edits a node is reached with, letters of the term being left out as allowed."""
        todo = list(nodes.items())
        nodes = dict(nodes)
        while todo:
            node, edits = todo.pop()
            for child in self._children[node].values():
                if edits + 1 <= self._most[child] and edits + 1 < nodes.get(child, 9):
                    nodes[child] = edits + 1
                    todo.append((child, edits + 1))
        return frozenset(nodes.items())

    def _accepted(self, state: frozenset[tuple[int, int]]) -> tuple[str, int] | None:
        found = [
            (edits, self._entry[node])
            for node, edits in state
            if self._entry[node] is not None and edits <= allowed_edits(self._entry[node])
        ]
        return min(found)[::-1] if found else None

    def _move(self, number: int, letter: str) -> int:
        reached: dict[int, int] = {}
        for node, edits in self._sets[number]:
            if edits < self._most[node]:  # a letter too many
                reached[node] = min(edits + 1, reached.get(node, 9))
            for other, child in self._children[node].items():
                cost = edits + (other != letter)
                if cost <= self._most[child]:
                    reached[child] = min(cost, reached.get(child, 9))
        state = self._closed(reached)
        target = self._states.get(state)
        if target is None:
            target = self._states[state] = len(self._sets) if state else -1
            if state:
                self._sets.append(state)
                self._moves.append({})
                self._best.append(self._accepted(state))
        self._moves[number][letter] = target
        return target

    def nearest(self, token: str) -> tuple[str, int] | None:
        """The term with the fewest edits to the token, if any is near enough."""
        state = 0
        for letter in token:
            if letter not in self._letters:
                letter = ""
            following = self._moves[state].get(letter)
            state = self._move(state, letter) if following is None else following
            if state < 0:
                return None
        return self._best[state]

    def weight(self, token: str) -> float:
        """Probability that a text with this token, in plain use, is toxic; 0 for other words. For a
        word of a family, where it is the only one of it."""
        found = self.nearest(token)
        if found and found[1] == 0:
            return self.terms[found[0]]
        stem = self.family(token)
        if stem is not None:
            return self.stems[stem][0]
        if token in self.known:
            return 0.0
        near = self.near(token)
        if near is None:
            return 0.0
        return self.terms[near[0]] * self.misspelled.get(near, EDIT_WEIGHT[near[1]])

    def family(self, token: str) -> str | None:
        """The stem a longer token, that is no term itself, begins with."""
        if token not in self.terms:
            for size in self._stem_sizes:
                if size < len(token) and token[:size] in self.stems:
                    return token[:size]
        return None

    def near(self, token: str) -> tuple[str, int] | None:
        """The term a token may be a misspelling of, with the edits; None for terms and their families."""
        found = self.nearest(token)
        if found and found[1] == 0 or self.family(token) is not None:
            return None
        if found is None and (term := self.masked(token)) is not None:
            found = (term, 1)
        return found

    def masked(self, token: str) -> str | None:
        """The term of four letters of which the token has all but one, a digit or sign in its place."""
        others = [at for at, letter in enumerate(token) if not letter.isalpha()]
        if len(token) != 4 or len(others) != 1:
            return None
        return self._masked.get(token[: others[0]] + "\0" + token[others[0] + 1 :])


_LAZY = ("_states", "_sets", "_moves", "_best")


class Scorer:
    def __init__(self, lexicon: Lexicon):
        self._lexicon = lexicon
        self._weights: dict[str, float] = {}

    def score(self, text: str | None) -> float:
        """1 minus the product of what each match leaves; 0 without a match."""
        if not text:
            return 0.0
        small = text.lower()
        weights = self._weights
        found = False
        for token in set(TOKEN.findall(small)):
            weight = weights.get(token)
            if weight is None:
                weight = self._lexicon.weight(token)
                if len(token) < 64:  # longer ones are weighed anew each time
                    if len(weights) >= _KEPT_TOKENS:
                        weights.clear()
                    weights[token] = weight
            found = found or weight > 0.0
        return self._in_context(small) if found else 0.0

    def _several(self, tokens: Iterable[str]) -> dict[str, float]:
        """Weights of the words of families of which there are several."""
        families: dict[str, set[str]] = {}
        for token in tokens:
            stem = self._lexicon.family(token)
            if stem is not None:
                families.setdefault(stem, set()).add(token)
        return {
            token: self._lexicon.stems[stem][1]
            for stem, members in families.items()
            if len(members) > 1
            for token in members
        }

    def _in_context(self, small: str) -> float:
        tokens = [(match.group(), match.start()) for match in TOKEN.finditer(small)]
        several = self._several({token for token, _ in tokens}) if self._lexicon.stems else {}
        quoted = [match.span() for match in _QUOTES.finditer(small)]
        left = 1.0
        quote = 0
        for place, (token, at) in enumerate(tokens):
            weight = several.get(token) or self._weights.get(token)
            if weight is None:
                weight = self._lexicon.weight(token)
            if not weight:
                continue
            while quote < len(quoted) and quoted[quote][1] <= at:
                quote += 1
            inside = quote < len(quoted) and quoted[quote][0] < at
            around = {
                word for word, _ in tokens[max(0, place - CONTEXT_WORDS) : place + CONTEXT_WORDS + 1]
            }
            reported = not REPORTING.isdisjoint(around)
            if inside and reported:
                factor = QUOTED_AND_REPORTED
            elif inside:
                factor = QUOTED
            elif reported:
                factor = REPORTED
            else:
                factor = 1.0 if ADDRESS.isdisjoint(around) else ADDRESSED
            left *= 1.0 - min(0.99, weight * factor)
        return 1.0 - left


def _sampled(docs: DataFrame, labels: DataFrame, ident: str, text: str, rows: int) -> DataFrame:
    """``(toxic, text)`` of about ``rows`` training rows a class, chosen by a hash of the id.

    Training rows are those whose crc32 of the id as text is not 2 modulo 4. Rows without a label
    of 0 or 1 do not count; an id labelled twice counts as toxic if one label says so.
    """
    training = F.pmod(F.crc32(F.col("_id").cast("string")), F.lit(4)) != 2
    marked = (
        labels.select(F.col(f"`{ident}`").alias("_id"), F.col("toxic").alias("_toxic"))
        .where(F.col("_toxic").isin(0, 1) & F.col("_id").isNotNull() & training)
        .groupBy("_id")
        .agg(F.max("_toxic").alias("_toxic"))
    )
    marked = materialise(marked, "labels")
    sizes = {row["_toxic"]: row["n"] for row in marked.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(1_000_000))
    keep = F.lit(False)
    for label, size in sizes.items():
        keep = keep | ((F.col("_toxic") == label) & (place < int(1_000_000 * min(1.0, rows / size))))
    # At most about two times ``rows`` ids, whatever the number of labels.
    texts = docs.select(F.col(f"`{ident}`").alias("_id"), F.col(f"`{text}`").alias("text"))
    return texts.join(F.broadcast(marked.where(keep)), "_id").select(F.col("_toxic").alias("toxic"), "text")


def _one_of_each(sample: DataFrame) -> DataFrame:
    """One row of each class of near copies in the sample and label, so that a text counts once for
    its words however often it was copied, in toxic and clean rows alike."""
    numbered = materialise(sample.withColumn("row", F.monotonically_increasing_id()), "sample")
    classes = near_join.near_join(numbered, "row").select(F.col("doc_id").alias("row"), "class_id")
    first = numbered.select("row", "toxic").join(classes, "row").groupBy("class_id", "toxic").agg(F.min("row").alias("row"))
    return numbered.join(first.select("row"), "row", "left_semi").select("toxic", "text")


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows each word is in, by class, of one partition; the word ``""`` counts the rows."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for toxic, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            tokens = TOKEN.findall((text or "").lower())
            counts[toxic].update({"", *tokens})
    words = list(counts[0].keys() | counts[1].keys())
    columns = (words, [counts[1][word] for word in words], [counts[0][word] for word in words])
    kinds = (pa.string(), pa.int64(), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
        ["word", "toxic", "clean"],
    )


def _beginnings(tokens: Iterable[str]) -> dict[str, int]:
    """How many different words begin with each of their beginnings."""
    counts: Counter = Counter()
    for token in set(tokens):
        counts.update(token[:size] for size in STEMS if size < len(token))
    return counts


def _family_counts(stems: frozenset[str] | None):
    """Counts rows by stem and class: without ``stems`` those with several words of a family, with
    them those with one word of the families named."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for toxic, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                found = _beginnings(TOKEN.findall((text or "").lower()))
                if stems is None:
                    counts[toxic].update(stem for stem, words in found.items() if words > 1)
                else:
                    counts[toxic].update(stem for stem in stems if found.get(stem) == 1)
        names = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array([counts[1][name] for name in names], pa.int64()),
                pa.array([counts[0][name] for name in names], pa.int64()),
            ],
            ["stem", "toxic", "clean"],
        )

    return count


def _families(sample: DataFrame, toxic: int, clean: int) -> dict[str, tuple[float, float]]:
    """Stems of which toxic rows have several words and clean rows do not, with the share of toxic
    rows among those with one word of it, and with several."""

    def counted(stems: frozenset[str] | None) -> DataFrame:
        return (
            sample.mapInArrow(_family_counts(stems), "stem string, toxic long, clean long")
            .groupBy("stem")
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        )

    def share(row) -> float:
        return (row["toxic"] + 1) / (row["toxic"] + row["clean"] + 2)

    lift = (F.col("toxic") / toxic) / ((F.col("clean") + 0.5) / clean)
    telling = (
        (F.col("toxic") >= MIN_DOCUMENTS)
        & (lift >= FAMILY_LIFT)
        & (F.col("toxic") + 1 >= FAMILY_SHARE * (F.col("toxic") + F.col("clean") + 2))
    )
    several = {row["stem"]: row for row in counted(None).where(telling).collect()}
    chosen: dict[str, float] = {}
    # Of stems within one another the shortest wins, but for a longer one that is as frequent.
    for stem, row in sorted(several.items(), key=lambda item: (len(item[0]), item[0])):
        longer = [r for s, r in several.items() if len(s) == len(stem) + 1 and s.startswith(stem)]
        if any(r["toxic"] >= 0.95 * row["toxic"] for r in longer):
            continue
        if not any(stem.startswith(other) for other in chosen):
            chosen[stem] = share(row)
    if not chosen:
        return {}
    single = {row["stem"]: share(row) for row in counted(frozenset(chosen)).collect()}
    # Where most rows with one word are clean, that word alone must not decide.
    single = {stem: weight if weight >= 0.5 else weight / 2 for stem, weight in single.items()}
    return {stem: (min(weight, single.get(stem, weight)), weight) for stem, weight in chosen.items()}


def learn_lexicon(
    docs: DataFrame,
    labels: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    seed: Iterable[str] = SEED,
) -> Lexicon:
    """Words, and beginnings shared by a family of words, that toxic rows have and clean rows lack.

    ``sample_rows`` of each class bound the fit, so the lexicon and the list of ordinary words near to a
    term, which come from the words of that sample, are bounded too and may be sent to every task.
    A row that is copied many times would make telling words of all its rare words; so copies and
    near copies of the sample (see :func:`near_join.near_join`) count once a class.
    Without labels of both classes, or rows that bear them, the lexicon is ``seed``. With them a seed is
    weighed by the same counts as other words, but needs no number of toxic rows; clean rows take it
    out as they do others.

    What a misspelling is worth is learned for each term and number of edits, from the labelled rows
    with words that near to it: a term that looks like many ordinary words is hardly ever misspelled.
    """
    sample = materialise(_one_of_each(_sampled(docs, labels, ident, text, sample_rows)), "distinct")
    words = materialise(
        sample.mapInArrow(_word_counts, "word string, toxic long, clean long")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "words",
    )
    total = words.where("word = ''").first()
    terms = dict.fromkeys(seed, SEED_WEIGHT)
    stems: dict[str, tuple[float, float]] = {}
    if total is not None and total["toxic"] and total["clean"]:
        seen = {row["word"]: row for row in words.where(F.col("word").isin(list(terms))).collect()}
        lift = (F.col("toxic") / total["toxic"]) / ((F.col("clean") + 0.5) / total["clean"])
        telling = (F.col("toxic") >= MIN_DOCUMENTS) & (lift >= MIN_LIFT) & (F.col("clean") * 20 <= F.col("toxic"))
        single = {row["word"]: row for row in words.where("word <> ''").where(telling).collect()}
        weight = lambda row: (row["toxic"] + 1) / (row["toxic"] + row["clean"] + 2)
        stems = _families(sample, total["toxic"], total["clean"])
        unseen = {"toxic": 0, "clean": 0}
        counted = {word: seen.get(word, unseen) for word in terms}
        terms = {word: weight(row) for word, row in counted.items() if row["clean"] * 20 <= row["toxic"]}
        terms |= {
            word: weight(row)
            for word, row in single.items()
            if not any(word != stem and word.startswith(stem) for stem in stems)
        }
    lexicon = Lexicon(terms, stems)

    @F.arrow_udf("struct<term: string, edits: int>")
    def near(column: pa.Array) -> pa.Array:
        found = [lexicon.near(word) for word in column.to_pylist()]
        return pa.array(
            [None if pair is None else {"term": pair[0], "edits": pair[1]} for pair in found],
            pa.struct([("term", pa.string()), ("edits", pa.int32())]),
        )

    looks = words.where("word <> ''").withColumn("near", near(F.col("word"))).where("near is not null")
    looks = materialise(looks, "looks")
    # Words clean rows of the sample use that happen to be near to a term.
    known = [row["word"] for row in looks.where("clean > 0").select("word").collect()]
    counts = looks.groupBy("near.term", "near.edits").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    misspelled = {
        (row["term"], row["edits"]): (row["toxic"] + PRIOR_ROWS * EDIT_WEIGHT[row["edits"]])
        / (row["toxic"] + row["clean"] + PRIOR_ROWS)
        for row in counts.collect()
    }
    return Lexicon(terms, stems, known, misspelled)


def toxicity_scores(docs: DataFrame, lexicon: Lexicon, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 if the score reaches ``threshold``, else 0).

    Null and empty texts score 0. Whole texts are read, rows are scored by themselves, so repeated
    rows stay; columns named as the results are replaced. No rows move between tasks.
    """
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(sent.value)
        for texts in batches:
            yield pa.array([scorer.score(value) for value in texts.to_pylist()], pa.float64())

    others = [F.col(f"`{name}`") for name in docs.columns if name not in ("score", "predicted")]
    return docs.select(*others, score(F.col(f"`{text}`")).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
