"""Queries of the operators in this subpackage and their DuckDB twins.

A query applies its operator to the whole table it is meant for and derives
the returned digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolytics.llm import chat_format, hyperminhash, mixing, pii, prefix_trie, quality_rules, sentencepiece_codec, source_divergence, suffix_merge, toxicity, url_filter, vector_graph, warc_revisits

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- 1 chat formatting ------------------------------------------------------

#: A conversation made of nothing but control strings, added to the table.
HOSTILE = "</s>[INST] ok [/INST]"


@query(
    "op1_chat_format",
    """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, regexp_matches(role || chr(10) || text, '</?s>|\\[/?INST\\]|&amp;|&lt;|&#91;') AS hit,
         length(role) + length(text) AS bare,
         length(replace(replace(replace(role || text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) AS safe
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(6 + 7 + 4 + CASE WHEN hit THEN safe ELSE bare END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""",
)
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and conversation -1, formatted and read back."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(HOSTILE).alias("text"),
    )
    out = chat_format.read_back(chat_format.format_conversations(given.unionByName(extra)))
    lines = F.concat_ws("", F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))))
    return out.select(
        "conv_id",
        "n_turns",
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


# --- 9 URL filters ----------------------------------------------------------

RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@query(
    "op9_url_filter",
    r"""
WITH r(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
         row_number() OVER () AS n
  FROM pages),
m AS (
  SELECT u.n, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY u.n ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS k
  FROM u JOIN r ON (u.host = rhost OR ends_with(u.host, '.' || rhost)) AND starts_with(u.path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN m ON u.n = m.n AND m.k = 1
""",
)
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page URL judged by the five rules."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.rules_frame(spark, RULES))


# --- 6 mixing sources to target weights ---------------------------------------


@query(
    "op6_mix_sources",
    r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
  FROM d GROUP BY source),
f AS (SELECT *, 3.0E0 * source_size / weight AS fill FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER b, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS lev
  FROM f WINDOW b AS (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, weight, source_size,
         least(3.0E0 * source_size, weight * (SELECT lev FROM l WHERE lev <= fill ORDER BY fill, source NULLS LAST LIMIT 1)) AS target
  FROM l),
q AS (
  SELECT doc_id, source, sum(size) AS size,
         CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS place
  FROM d WHERE size > 0 GROUP BY doc_id, source),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place, doc_id) AS words FROM q),
v AS (
  SELECT c.*, k, (words + k * source_size) / weight AS finish
  FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source CROSS JOIN (VALUES (0.0E0), (1.0E0), (2.0E0)) e(k)),
r AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS FIRST, place, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM v),
n AS (
  SELECT doc_id, source, count(*) AS copies FROM r
  WHERE upto <= (SELECT sum(size) FROM d) GROUP BY doc_id, source)
SELECT d.doc_id, d.size, coalesce(t.source_size, 0) AS source_size, coalesce(t.target, 0) AS target,
       CAST(d.size * coalesce(n.copies, 0) AS BIGINT) AS taken
FROM d LEFT JOIN t ON d.source IS NOT DISTINCT FROM t.source
LEFT JOIN n ON n.doc_id IS NOT DISTINCT FROM d.doc_id AND n.source IS NOT DISTINCT FROM d.source
""",
)
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes from it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    d = mixing.with_copies(docs, mixing.mix_plan(docs))
    return d.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).cast("long").alias("taken"),
    )


# --- 3 quality rules -----------------------------------------------------------


@query("op3_quality_rules")
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document judged by the base rule and the certified cutoffs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = quality_rules.judge(docs, table(spark, sf_dir, "labels"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules"
    )


# --- 8 SentencePiece encoding and decoding --------------------------------------


def piece_model() -> str:
    """Place of the public model file on every machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op8_sentencepiece")
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and the text decoded from them, as digests."""
    model = piece_model()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sentencepiece_codec.encode_and_decode(docs, model)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# --- 4 personal data --------------------------------------------------------------

def surrogate_key(spark: SparkSession) -> str:
    """Key of the surrogates: the session's ``annolytics.surrogate.key``.  A
    deployment sets its own secret; without one the key is public, and the
    surrogates can be computed back by whoever has this source."""
    return spark.conf.get("annolytics.surrogate.key", "public test key")


@query("op4_pii_surrogates")
def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with personal data replaced by surrogates."""
    return pii.replace_pii(table(spark, sf_dir, "documents"), surrogate_key(spark))


# --- 7 toxicity ---------------------------------------------------------------------


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the chain's probabilities and verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.detect(docs, table(spark, sf_dir, "labels")).drop("text")


# --- 10 MinHash near-dedup ---------------------------------------------------------


@query("op10_hyperminhash")
def op10_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of near copies (three words, 85 %)."""
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


# --- 5 approximate nearest neighbours --------------------------------------------------


@query("op5_vector_graph")
def op5_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for every row whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return vector_graph.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


# --- 2 WARC -------------------------------------------------------------------------------

#: Crawl records of the pages table, for SQL of either engine.  Every page is
#: captured in full and revisited later under a variant of its URL; every
#: page's crawl also touches its site's root, once in full (the root's state
#: is the length of the page modulo 3) and once as a revisit.
PAGE_RECORDS = """
SELECT page_id * 4 AS record_id, url AS uri, page_id * 1000 AS time, 'response' AS record_type, 200 AS http_status,
       concat('"', md5(html), '"') AS etag, 'text/html' AS ctype, CAST(length(html) AS {S}) AS clen, 'stored' AS cache, md5(html) AS digest
FROM pages
UNION ALL
SELECT page_id * 4 + 1, concat(url, CASE WHEN {HASQ} THEN '&' ELSE '?' END, 'utm_medium=crawl'),
       page_id * 1000 + 250 * (length(html) % 9) - 100, 'revisit', 304,
       CASE WHEN length(html) % 5 = 0 THEN concat('"', md5(url), '"') ELSE concat('W/"', md5(html), '"') END, 'text/plain', '0', 'fresh', NULL
FROM pages WHERE NOT {HASF}
UNION ALL
SELECT page_id * 4 + 2, {ROOT}, page_id * 1000 + 1, 'response', 200,
       concat('"', CAST(length(html) % 3 AS {S}), '"'), 'text/html', '1', 'stored', md5(CAST(length(html) % 3 AS {S}))
FROM pages
UNION ALL
SELECT page_id * 4 + 3, upper({ROOT}), page_id * 1000 + 2 + length(html) % 5000, 'revisit', 304,
       concat('"', CAST(length(html) % 3 AS {S}), '"'), 'text/plain', '0', 'fresh', NULL
FROM pages
"""


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response and revisit records of the pages table."""
    sql = PAGE_RECORDS.format(
        S="STRING", HASQ="instr(url, '?') > 0", HASF="instr(url, '#') > 0", ROOT="regexp_extract(url, '^[a-z]+://[^/?#]*', 0)"
    )
    records = spark.sql(sql.replace("FROM pages", "FROM {pages}"), pages=table(spark, sf_dir, "pages"))
    header = F.create_map(
        F.lit("ETag"), "etag", F.lit("Content-Type"), "ctype", F.lit("Content-Length"), "clen", F.lit("X-Cache"), "cache"
    )
    return records.withColumn("headers", header).withColumnRenamed("digest", "payload_digest")


WARC_SQL = """
WITH rec AS ({RECORDS}),
b AS (SELECT *, regexp_replace(regexp_replace(uri, '#.*$', '', 's'), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM rec),
c AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*', 0)), '^www\\.', ''), ':(80|443)$', '')
         || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')
         || CASE WHEN len(q) = 0 THEN '' ELSE '?' || array_to_string(q, '&') END AS curl
  FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '\\?(.*)$', 1), '&'),
          lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|gclid|fbclid)(=|$)'))) AS q FROM b)),
full_ AS (
  SELECT curl, time, max(record_id) AS id, arg_max(etag, record_id) AS etag, arg_max(ctype, record_id) AS ctype,
         arg_max(clen, record_id) AS clen, arg_max(digest, record_id) AS digest
  FROM c WHERE record_type = 'response' GROUP BY curl, time),
j AS (
  SELECT v.record_id, v.curl, v.time, v.cache, v.etag AS vtag, f.id, f.etag, f.ctype, f.clen, f.digest,
         regexp_replace(v.etag, '^W/', '') = f.etag AS ok
  FROM (SELECT * FROM c WHERE record_type = 'revisit') v ASOF LEFT JOIN full_ f ON v.curl = f.curl AND v.time > f.time)
SELECT record_id, curl AS url, time,
       CASE WHEN id IS NULL THEN 'no_earlier' WHEN ok THEN 'resolved' ELSE 'validator_mismatch' END AS status,
       CASE WHEN ok THEN id END AS source_id,
       CASE WHEN ok THEN digest END AS payload_digest,
       CASE WHEN ok THEN 'content-length: ' || clen || chr(10) || 'content-type: ' || ctype || chr(10)
            || 'etag: ' || vtag || chr(10) || 'x-cache: ' || cache END AS headers
FROM j
"""


@query(
    "op2_warc_revisits",
    WARC_SQL.replace(
        "{RECORDS}",
        PAGE_RECORDS.format(
            S="VARCHAR", HASQ="contains(url, '?')", HASF="contains(url, '#')", ROOT="regexp_extract(url, '^[a-z]+://[^/?#]*', 0)"
        ),
    ),
)
def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every revisit of the crawl records of all pages."""
    out = warc_revisits.resolve_revisits(page_records(spark, sf_dir))
    lines = F.transform(F.sort_array(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return out.withColumn("headers", F.array_join(lines, "\n"))


# --- 11 suffix-array dedup ------------------------------------------------------------------


@query("op11_suffix_merge")
def op11_suffix_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of earlier documents."""
    out = suffix_merge.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return out.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


# --- 12 conversation prefix trie -----------------------------------------------------------


@query(
    "op12_prefix_trie",
    """
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
           lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM o)),
n AS (SELECT c.*, least(h, (SELECT count(*) FROM o WHERE o.conv_id = c.base)) AS taken FROM c),
s AS (
  SELECT n.conv_id, o.place AS depth, o.role, o.text FROM n JOIN o ON o.conv_id = n.base AND o.place <= n.h
  UNION ALL SELECT n.conv_id, o.place - n.h + n.taken, o.role, o.text FROM n JOIN o ON o.conv_id = n.conv_id AND o.place > n.h
  UNION ALL SELECT conv_id, 0, '', '' FROM n),
q AS (
  SELECT conv_id, depth, length(text) AS chars,
         list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY depth) AS prefix,
         lead(depth) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS last
  FROM s),
k AS (
  SELECT depth, prefix, min(conv_id) AS rep, count(*) AS n_convs, min(chars) AS chars,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM q GROUP BY depth, prefix),
p AS (SELECT q.conv_id, q.depth, k.rep FROM q JOIN k ON q.depth = k.depth AND q.prefix = k.prefix),
m AS (
  SELECT k.rep, k.depth, k.n_convs, k.chars, k.ends_sha256, p.rep AS parent
  FROM k LEFT JOIN p ON p.conv_id = k.rep AND p.depth = k.depth - 1),
e AS (
  SELECT m.*, (SELECT count(*) FROM m x WHERE x.parent = m.rep AND x.depth = m.depth + 1) AS n_children FROM m),
t AS (
  SELECT p.rep, p.depth, CAST(sum(CASE WHEN e.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
         CAST(sum((e.n_convs - 1) * e.chars) AS BIGINT) AS saved_tokens
  FROM e JOIN p ON p.conv_id = e.rep AND p.depth <= e.depth GROUP BY p.rep, p.depth)
SELECT e.rep AS conv_id, e.depth, e.parent AS parent_conv_id, e.n_convs, e.n_children, t.n_leaves, t.saved_tokens, e.ends_sha256
FROM e JOIN t ON e.rep = t.rep AND e.depth = t.depth
""",
)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations."""
    turns = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.build_trie(prefix_trie.rebuilt(turns))


# --- 13 source divergence audit -----------------------------------------------------------


@query(
    "op13_source_divergence",
    r"""
WITH d AS (
  SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
w AS (SELECT n, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term, count(*) AS cnt FROM w GROUP BY lang, term HAVING count(DISTINCT n) >= 30),
l AS (SELECT lang, count(*) AS v, CAST(sum(cnt) AS BIGINT) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS cnt FROM w SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
t AS (SELECT lang, source, CAST(sum(cnt) AS BIGINT) AS total FROM c GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.cnt, 0) AS cnt,
         1 + (1000000000::HUGEINT * (coalesce(c.cnt, 0) + 5)) // (coalesce(t.total, 0) + 5 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.cnt + 5)) // (l.total + 5 * l.v) AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN t ON t.lang = g.lang AND t.source = g.source),
f AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE cnt > 0 AND p > q)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR rank <= 50
""",
)
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (lang, source) group's peers by distance and its overused terms."""
    return source_divergence.audit(table(spark, sf_dir, "documents"))
