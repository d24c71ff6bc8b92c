"""The registered queries of this subpackage, with production parameters, and their SQL.

Each runs its operator over its whole table. ``public_tokenizers`` only locates vocabulary files.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    language_id,
    license_scan,
    line_dedup,
    near_join,
    packing,
    periodic_runs,
    prefix_trie,
    sketch_dedup,
    subword_lm,
    token_counts,
    toxicity,
    vector_search,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


# Rows of an Arrow batch: texts may be long, and a worker holds a batch several times over.
BATCH_ROWS = 500


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_near_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_join.near_join(table(spark, folder, "documents").select("doc_id", "text"))


ORACLES["op1_near_join"] = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), sets as (
  select doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
    lambda s: array_to_string(w[s:s + 4], ' ')))) as shingle
  from words where len(w) > 0
), sizes as (
  select doc_id, count(*) as n from sets group by doc_id
), common as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from sets a join sets b using (shingle)
  where a.doc_id < b.doc_id group by all
), pairs as (
  select c.a, c.b from common c join sizes x on x.doc_id = c.a join sizes y on y.doc_id = c.b
  where 9 * c.n >= 4 * (x.n + y.n)
), edges as (
  select a, b from pairs union all select b, a from pairs
), reach (a, b) as (
  select a, b from edges union select reach.a, edges.b from reach join edges on reach.b = edges.a
), classes as (
  select a as doc_id, least(a, min(b)) as class_id from reach group by a
), links as (
  select a as doc_id, count(*) as n_links from edges group by a
)
select doc_id, coalesce(class_id, doc_id) as class_id, coalesce(n_links, 0) as n_links
from documents left join classes using (doc_id) left join links using (doc_id)
"""


@query
def op2_vector_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return vector_search.exact_top_k(vectors, vectors.where("vec_id % 50 = 0"))


ORACLES["op2_vector_top_k"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), pairs as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs)
where rank <= 5
"""


@query
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_counts(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return license_scan.licence_scan(docs).select("doc_id", "sentence_ids", "licenses", "versioned", "unmatched")


def _license_oracle() -> str:
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    table = ", ".join(f"{text(k)}: {text(v)}" for k, v in license_scan.SENTENCES.items())
    # Bars are doubled, so that two neighbouring sentences have one each between them.
    runs = text(r"\|(" + license_scan.any_sentence(license_scan.SENTENCES, r"(?: |\|\|)") + r")\|")
    steps, previous = [], "ids"
    for number, (licence, identifiers) in enumerate(license_scan.RULES):
        pattern, parts = text(license_scan.rule_pattern(identifiers)), license_scan.name_parts(licence)
        name = text(licence)
        if parts:
            name = f"if(v = '', {name}, {text(parts[0])} || v || {text(parts[1])})"
        steps.append(
            f"s{number} as (select doc_id, sentence_ids, regexp_replace(seq, {pattern}, '|', 'g') as seq, "
            f"case when regexp_matches(seq, {pattern}) then list_append(found, {text(licence)}) "
            f"else found end as found, list_concat(versioned, "
            f"list_transform(regexp_extract_all(seq, {pattern}, 1), lambda v: {name})) as versioned from {previous})"
        )
        previous = f"s{number}"
    line, first, second = text(license_scan.TAG_LINE), text(license_scan.ENDS[0]), text(license_scan.ENDS[1])
    version = text(license_scan.VERSION)
    return f"""
with cut as (
  select doc_id, regexp_replace(regexp_replace(regexp_replace(coalesce(text, '') || chr(10) || chr(10),
    {line}, '\\1' || chr(31) || chr(10), 'g'),
    {first}, chr(31) || '\\1', 'g'), {second}, chr(31) || '\\1', 'g') as text
  from documents
), marked as (
  select doc_id, regexp_replace(chr(31) || regexp_replace(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^a-z0-9\x1f]+', ' ', 'g') || chr(31), ' ?\x1f[ \x1f]*', '||', 'g') as text from cut
), runs as (
  select doc_id, list_transform(regexp_extract_all(text, {runs}, 1), lambda p: replace(p, '||', ' ')) as runs
  from marked
), known as (
  select doc_id, runs, list_transform(runs, lambda p:
    coalesce((map {{{table}}})[p], (map {{{table}}})[regexp_replace(p, '[0-9]+', '0', 'g')])) as sentence_ids
  from runs
), ids as (
  select doc_id, sentence_ids, coalesce(array_to_string(list_transform(list_zip(sentence_ids, runs), lambda p:
    '<' || p[1] || ':' || replace(regexp_extract(p[2], {version}, 1), ' ', '.') || '>'), ''), '') as seq,
    cast([] as varchar[]) as found, cast([] as varchar[]) as versioned from known
), {", ".join(steps)}
select doc_id, sentence_ids, list_sort(list_distinct(found)) as licenses,
  list_sort(list_distinct(versioned)) as versioned,
  cast(length(seq) - length(replace(seq, '<', '')) as integer) as unmatched
from {previous}
"""


ORACLES["op5_license_scan"] = _license_oracle()


@query
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify_languages(
        table(spark, folder, "pages"), table(spark, folder, "documents")
    )


@query
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontamination.contamination(docs, table(spark, folder, "benchmark")).drop("text")


ORACLES["op7_decontamination"] = r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), item_words as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), windows as (
  select distinct item_id, least(10, len(w)) as size,
    array_to_string(w[s:s + least(10, len(w)) - 1], ' ') as phrase
  from (select item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as s from item_words
        where len(w) > 0)
), sizes as (
  select distinct size from windows
), places as (
  select doc_id, size, s, array_to_string(w[s:s + size - 1], ' ') as phrase
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as s
        from words, sizes where len(w) >= size)
), hits as (
  select doc_id, s, size, item_id from places join windows using (size, phrase)
), covered as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(s, s + size)) as p from hits) group by doc_id
), found as (
  select doc_id, count(distinct item_id) as n_items,
    string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as items
  from hits group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from words left join covered using (doc_id) left join found using (doc_id)
"""


@query
def op8_subword_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return subword_lm.lm_scores(docs, public_tokenizers.path("piece_bpe_32k.model"))


@query
def op9_length_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return packing.length_buckets(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    lexicon = toxicity.learn_lexicon(docs, table(spark, folder, "labels"))
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    scored = toxicity.toxicity_scores(docs, lexicon)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def _crc32(value: str) -> str:
    """CRC-32 of an ASCII text in SQL, bit by bit."""
    step = "lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end"
    bits = "cast(range(8) as ubigint[])"
    letters = f"list_transform(string_split(cast({value} as varchar), ''), lambda l: cast(ord(l) as ubigint))"
    return (
        f"cast(xor(list_reduce({letters}, lambda a, b: list_reduce({bits}, {step}, xor(a, b)), "
        f"4294967295::ubigint), 4294967295::ubigint) as bigint)"
    )


@query
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = prefix_trie.digested(table(spark, folder, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.with_shared_starts(turns)).drop("node", "parent")


ORACLES["op11_prefix_trie"] = rf"""
with own as (
  select conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} order by turn nulls first,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as l
  from conversations where conv_id is not null group by conv_id
), shared as (
  select *, {_crc32("conv_id")} % 4 as h from own
), rebuilt as (
  select c.conv_id, list_concat(coalesce(b.l[1:c.h], []), c.l[c.h + 1:]) as l
  from shared c left join own b on b.conv_id = c.conv_id - c.conv_id % 20
), prefixes as (
  select conv_id, len(l) as n, d, l[1:d] as p from (select *, unnest(range(len(l) + 1)) as d from rebuilt)
), nodes as (
  select p, d, min(conv_id) as conv_id, count(*) as n_convs,
    string_agg(conv_id, ',' order by conv_id) filter (n = d) as ends from prefixes group by p, d
), children as (
  select p[1:d - 1] as p, count(*) as n_children from nodes where d > 0 group by all
), valued as (
  select nodes.*, coalesce(n_children, 0) as n_children, case when d = 0 then 0 else
    (n_convs - 1) * len(regexp_extract_all(p[d].text, '[^\x20\x09-\x0D]+')) end as own
  from nodes left join children using (p)
), above as (
  select p[1:a] as p, n_children, own from (select *, unnest(range(d + 1)) as a from valued)
), sums as (
  select p, count(*) filter (n_children = 0) as n_leaves, sum(own) as saved_tokens from above group by p
)
select v.conv_id, v.d as depth, u.conv_id as parent_conv_id, v.n_convs, v.n_children, n_leaves,
  cast(saved_tokens as bigint) as saved_tokens, sha256(coalesce(v.ends, '')) as ends_sha256
from valued v join sums on sums.p = v.p left join nodes u on v.d > 0 and u.p = v.p[1:v.d - 1]
"""


@query
def op12_sketch_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return sketch_dedup.near_copies(table(spark, folder, "documents").select("doc_id", "text"))


ORACLES["op12_sketch_dedup"] = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), sets as (
  select doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1),
    lambda s: array_to_string(w[s:s + 3], ' ')))) as shingle
  from words where len(w) > 0
), sizes as (
  select doc_id, count(*) as n from sets group by doc_id
), common as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from sets a join sets b using (shingle)
  where a.doc_id < b.doc_id group by all
), pairs as (
  select c.a, c.b from common c join sizes x on x.doc_id = c.a join sizes y on y.doc_id = c.b
  where 100 * c.n >= 80 * (x.n + y.n - c.n)
), edges as (
  select a, b from pairs union all select b, a from pairs
), reach (a, b) as (
  select a, b from edges union select reach.a, edges.b from reach join edges on reach.b = edges.a
), classes as (
  select a as doc_id, least(a, min(b)) as component_id from reach group by a
)
select doc_id, coalesce(n, 0) as n_shingles, coalesce(component_id, doc_id) as component_id,
  coalesce(component_id, doc_id) = doc_id as kept
from documents left join sizes using (doc_id) left join classes using (doc_id)
"""


def _with_periods(docs: DataFrame) -> DataFrame:
    """Texts of the ids whose CRC-32 ends in 0 repeat a stretch of their words up to their end."""
    return (
        docs.withColumn("h", F.crc32(F.col("doc_id").cast("string")))
        .withColumn("w", F.expr(r"if(h % 10 = 0, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0), null)"))
        .withColumn("n", F.expr("size(w)"))
        .withColumn("a", F.expr("if(n > 0, (h div 10) % n, null)"))
        .withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)"))
        .withColumn(
            "text",
            F.expr(
                "if(a is null, text, array_join(transform(sequence(0, n - 1), "
                "i -> w[int(if(i < a, i, a + (i - a) % p))]), ' '))"
            ),
        )
        .select("doc_id", "text")
    )


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = _with_periods(table(spark, folder, "documents").select("doc_id", "text"))
    found = periodic_runs.periodic_runs(docs)
    longest = F.expr("array_min(transform(runs, r -> struct(-r.length as l, r.start as s, r.period as p)))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest.alias("longest"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        F.col("longest.s").alias("start"),
        (-F.col("longest.l")).alias("length"),
        F.col("longest.p").alias("period"),
        F.expr("1000 * -longest.l div longest.p").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


ORACLES["op13_periodic_runs"] = rf"""
with split as (
  select doc_id, {_crc32("doc_id")} as h,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), sizes as (
  select *, len(w) as n, case when h % 10 = 0 and len(w) > 0 then (h // 10) % len(w) end as a from split
), steps as (
  select *, 1 + (n - a) // (3 + (h // 10) % 8) as p from sizes
), texts as (
  select doc_id, n, case when a is null then w else
    list_transform(range(n), lambda i: w[1 + case when i < a then i else a + (i - a) % p end]) end as w
  from steps
), places as (
  select doc_id, n, unnest(range(n)) as i, unnest(w) as word from texts
), agree as (
  select x.doc_id, y.i - x.i as p, x.i from places x join places y using (doc_id, word)
  where y.i > x.i and 2 * (y.i - x.i) <= x.n
), stretches as (
  select doc_id, p, min(i) as start, count(*) as c
  from (select *, i - row_number() over (partition by doc_id, p order by i) as island from agree)
  group by doc_id, p, island
), runs as (
  select doc_id, start, c + p as length, min(p) as period
  from stretches where c >= p and c + p >= 12 group by all
), listed as (
  select doc_id, count(*) as n_runs, arg_min([start, length, period], [-length, start, period]) as longest,
    string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as runs
  from runs group by doc_id
), dropped as (
  select distinct doc_id, unnest(range(start + period, start + length)) as i from runs
), kept as (
  select doc_id, string_agg(word, ' ' order by i) as collapsed
  from places anti join dropped using (doc_id, i) group by doc_id
)
select doc_id, coalesce(n_runs, 0) as n_runs, longest[1] as start, longest[2] as length, longest[3] as period,
  1000 * longest[2] // longest[3] as exponent_milli, sha256(coalesce(runs, '')) as runs_sha256,
  sha256(coalesce(collapsed, '')) as collapsed_sha256
from documents left join listed using (doc_id) left join kept using (doc_id)
"""
