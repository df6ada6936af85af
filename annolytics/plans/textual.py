"""Registered queries: text features (§2.6) and vocabulary / tokens (§2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from annolytics.functions import text as T
from annolytics.functions.stats import hash_filter
from annolytics.operators import clean as C
from annolytics.operators import features as FE
from annolytics.operators import vocab as V
from annolytics.plans.cleaning import cleaned, with_texts
from annolytics.plans.oracle import CLEAN
from annolytics.plans.registry import query
from annolytics.session import cut_lineage
from annolytics.sources.views import read_table

WS = T.WS
WC = T.WORD_CHAR
TOK = "[^" + WS + "]+"
NL = "\\n+"
SUFFIXES = "|".join(T.LEGAL_SUFFIXES)
REFS = "|".join(T.REFERENCE_WORDS) + "|\\p{Nd}+\\.[" + WS + "]*(" + "|".join(T.REFERENCE_UNITS) + ")"
# RE2 has no look-behind and an ASCII \b: the word boundary is a consumed
# non-word character, and white space is doubled first so that a match ending
# in white space leaves a boundary for the next one.
NUMBERING_RE2 = "(^|[^" + WC + "])\\p{Nd}+\\.[" + WS + "]|(^|[^" + WC + "])[a-z]\\)[" + WS + "]"


def _cnt(ch: str) -> str:
    return f"(length(text) - length(replace(text, '{ch}', '')))"


def feature_ctes(src: str, keys: str, p: str = "") -> str:
    """CTEs ``fa``/``fb``/``feat`` computing the 28 features of ``src``
    (columns ``keys`` + ``text``) with DuckDB list functions; ``p`` prefixes
    the CTE names."""
    paren = f"({_cnt('(')} + {_cnt(')')})"
    per_word = "CASE WHEN len(words) > 0 THEN {x} * 1.0 / len(words) ELSE 0.0 END"
    return f""",
{p}fa AS (
  SELECT {keys}, text, regexp_extract_all(text, '{TOK}') AS words,
         list_filter(string_split_regex(text, '[.!?][{WS}]+|{NL}'), lambda s: regexp_matches(s, '[^{WS}]')) AS sents
  FROM {src}),
{p}fb AS (
  SELECT *, list_transform(words, lambda w: length(w)) AS wl,
         list_transform(sents, lambda s: len(regexp_extract_all(s, '{TOK}'))) AS sl
  FROM {p}fa),
{p}feat0 AS (
  SELECT {keys},
    CAST(length(text) AS INTEGER) AS char_count,
    CAST(len(words) AS INTEGER) AS word_count,
    CAST(greatest(1, len(sents)) AS INTEGER) AS sentence_count,
    coalesce(list_avg(sl), 0.0) AS avg_sentence_length,
    CAST(coalesce(list_max(sl), 0) AS INTEGER) AS max_sentence_length,
    CASE WHEN len(sl) > 1 THEN list_aggregate(sl, 'stddev_pop') ELSE 0.0 END AS std_sentence_length,
    coalesce(list_avg(wl), 0.0) AS avg_word_length,
    CAST(coalesce(list_max(wl), 0) AS INTEGER) AS max_word_length,
    CASE WHEN len(wl) > 1 THEN list_aggregate(wl, 'stddev_pop') ELSE 0.0 END AS std_word_length,
    {per_word.format(x="len(list_filter(wl, lambda x: x > 10))")} AS long_word_ratio,
    {per_word.format(x="len(list_filter(wl, lambda x: x > 15))")} AS very_long_word_ratio,
    CAST({_cnt(',')} AS INTEGER) AS comma_count,
    {per_word.format(x=_cnt(','))} AS comma_ratio,
    CAST({_cnt(';')} AS INTEGER) AS semicolon_count,
    CAST({_cnt(':')} AS INTEGER) AS colon_count,
    CAST({paren} AS INTEGER) AS paren_count,
    {per_word.format(x=paren)} AS paren_ratio,
    CAST({_cnt('[')} + {_cnt(']')} AS INTEGER) AS bracket_count,
    CAST(2 * {_cnt('"')} + {_cnt('„')} AS INTEGER) AS quote_count,
    CAST({_cnt('/')} AS INTEGER) AS slash_count,
    CAST({_cnt('-')} + {_cnt('–')} + {_cnt('—')} AS INTEGER) AS dash_count,
    CAST(len(regexp_extract_all(regexp_replace(text, '([{WS}])', '\\1\\1', 'g'), '{NUMBERING_RE2}')) AS INTEGER) AS numbering_count,
    CAST({_cnt('%')} AS INTEGER) AS percent_count,
    {per_word.format(x="len(regexp_extract_all(text, '\\p{Nd}+'))")} AS number_ratio,
    CAST(len(regexp_extract_all(lower(text), '({SUFFIXES})([^{WC}]|$)')) AS INTEGER) AS legal_suffix_count,
    CAST(len(regexp_extract_all(lower(text), '{REFS}')) AS INTEGER) AS reference_count,
    CASE WHEN length(text) > 0 THEN len(regexp_extract_all(text, '\\p{{Lu}}')) * 1.0 / length(text) ELSE 0.0 END AS uppercase_ratio
  FROM {p}fb),
{p}feat AS (
  SELECT *, 0.3 * avg_sentence_length + 2.0 * avg_word_length + 10.0 * long_word_ratio + 5.0 * comma_ratio
            + 10.0 * paren_ratio AS complexity_score
  FROM {p}feat0)"""


DOC_FEATS = "WITH docs AS (SELECT doc_id, text FROM documents)" + feature_ctes("docs", "doc_id")
INT_FEATURES = {
    "char_count", "word_count", "sentence_count", "max_sentence_length", "max_word_length", "comma_count",
    "semicolon_count", "colon_count", "paren_count", "bracket_count", "quote_count", "slash_count", "dash_count",
    "numbering_count", "percent_count", "legal_suffix_count", "reference_count",
}


def _sql_cols(names) -> str:
    return ", ".join(n if n in INT_FEATURES else f"round({n}, 6) AS {n}" for n in names)


def _spark_cols(names):
    return [F.col(n) if n in INT_FEATURES else F.round(n, 6).alias(n) for n in names]


def _doc_features(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return T.text_features(docs)


def _register_feature_group(key, names):
    @query(key, DOC_FEATS + f"\nSELECT doc_id, {_sql_cols(names)} FROM feat")
    def q(spark, sf_dir):
        return _doc_features(spark, sf_dir).select("doc_id", *_spark_cols(names))

    return q


_register_feature_group("text_features_length", T.LENGTH_FEATURES)
_register_feature_group("text_features_punctuation", T.PUNCTUATION_FEATURES)
_register_feature_group("text_features_patterns", T.PATTERN_FEATURES)
_register_feature_group("text_complexity", ("complexity_score",))

# Features of the cleaned training rows (texts with labels 1..5).
TRAIN_FEATS = CLEAN + feature_ctes("train", "annotation_id, label_numeric")
TEST_FEATS_CTES = feature_ctes("test", "annotation_id, label_numeric", p="t")


def split_features(spark, sf_dir, *keep, labelled=False):
    """Features of the cleaned training rows and of the hold-out rows, only
    the ``labelled`` ones if asked.  They are the expensive part and written
    once; statistics, scaling and fits read the table."""
    c = cleaned(spark, sf_dir)
    test = c.test.filter(F.col("label_numeric").isNotNull()) if labelled else c.test
    rows = [r.select(*keep, "text").withColumn("_split", F.lit(s)) for s, r in (("train", c.train), ("test", test))]
    feats = cut_lineage(_with_features(spark, sf_dir, cut_lineage(rows[0].unionByName(rows[1]))))
    return [feats.filter(F.col("_split") == s).drop("_split") for s in ("train", "test")]


def _with_features(spark, sf_dir, rows):
    """Written rows with the features in the place of the reference to their
    text.  Every text is read and analysed once, however many rows have it."""
    key = ["_d0", "_d1"]
    known = rows.filter(F.col("text").isNotNull()).select("*", *C.text_digest(rows)).drop("text")
    texts = read_table(spark, sf_dir, "documents").select("text").filter(F.col("text").isNotNull())
    texts = hash_filter(texts.select("text", *C.text_digest(texts)), known.select(*key), key)
    texts = texts.groupBy(*key).agg(F.min("text").alias("text"))
    known = known.join(cut_lineage(T.text_features(texts)), key, "left").drop(*key)
    return known.unionByName(T.text_features(rows.filter(F.col("text").isNull()).withColumn("text", F.lit(None).cast("string"))))


def _train_features(spark, sf_dir):
    t = cleaned(spark, sf_dir).train.select("annotation_id", "label_numeric", "text")
    return T.text_features(with_texts(spark, sf_dir, t))


@query(
    "feature_stats_by_class",
    TRAIN_FEATS
    + ",\nlong AS ("
    + "\nUNION ALL\n".join(
        f"SELECT '{f}' AS feature, label_numeric, CAST({f} AS DOUBLE) AS value FROM feat WHERE label_numeric IS NOT NULL"
        for f in T.KEY_FEATURES
    )
    + """)
SELECT feature, label_numeric, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std
FROM long GROUP BY feature, label_numeric""",
)
def q_feature_stats_by_class(spark, sf_dir):
    return FE.feature_stats_by_class(_train_features(spark, sf_dir))


@query(
    "feature_label_correlation",
    TRAIN_FEATS
    + ",\nr AS ("
    + "\nUNION ALL\n".join(
        f"SELECT '{f}' AS feature, covar_pop({f}, label_numeric) / sqrt(var_pop({f}) * var_pop(label_numeric)) AS r "
        f"FROM feat WHERE label_numeric IS NOT NULL"
        for f in T.ALL_FEATURES
    )
    + """),
r2 AS (SELECT feature, CASE WHEN isnan(r) OR isinf(r) THEN NULL ELSE r END AS r FROM r),
rk AS (SELECT feature, round(r, 6) AS r,
              CASE WHEN r > 0 THEN 'easier' WHEN r < 0 THEN 'harder' END AS direction,
              CAST(row_number() OVER (ORDER BY abs(r) DESC NULLS LAST, feature) AS INTEGER) AS rank
       FROM r2)
SELECT * FROM rk WHERE rank <= 15""",
)
def q_feature_label_correlation(spark, sf_dir):
    return FE.feature_label_correlation(_train_features(spark, sf_dir))


def _hist_sql(features, bins):
    union = "\nUNION ALL\n".join(
        f"SELECT '{f}' AS feature, label_numeric, CAST({f} AS DOUBLE) AS v FROM feat WHERE label_numeric IS NOT NULL"
        for f in features
    )
    return f""",
h AS ({union}),
r AS (SELECT feature, label_numeric, min(v) AS mn, max(v) AS mx FROM h GROUP BY 1, 2),
r2 AS (SELECT feature, label_numeric, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
              CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM r),
b AS (SELECT h.feature, h.label_numeric,
             least({bins - 1}, CAST(floor((v - lo) / ((hi - lo) / {bins})) AS INTEGER)) AS bin
      FROM h JOIN r2 ON r2.feature = h.feature AND r2.label_numeric = h.label_numeric),
grid AS (SELECT feature, label_numeric, lo, hi, unnest(range(0, {bins})) AS bin FROM r2)
SELECT g.feature, g.label_numeric, CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * (hi - lo) / {bins}, 6) AS bin_lo,
       round(lo + (g.bin + 1) * (hi - lo) / {bins}, 6) AS bin_hi, CAST(count(b.bin) AS BIGINT) AS n
FROM grid g LEFT JOIN b ON b.feature = g.feature AND b.label_numeric = g.label_numeric AND b.bin = g.bin
GROUP BY g.feature, g.label_numeric, g.bin, lo, hi"""


@query("feature_histograms_by_class", TRAIN_FEATS + _hist_sql(T.PLOT_FEATURES, 20) + "")
def q_feature_histograms_by_class(spark, sf_dir):
    h = FE.feature_histograms_by_class(_train_features(spark, sf_dir))
    return h.select("feature", "label_numeric", F.col("bin").cast("int").alias("bin"), "bin_lo", "bin_hi", F.col("n").cast("long").alias("n"))


@query(
    "standardise_features",
    TRAIN_FEATS
    + TEST_FEATS_CTES
    + ",\nst AS (SELECT "
    + ", ".join(
        f"avg({f}) AS m_{f}, CASE WHEN coalesce(stddev_pop({f}), 0) = 0 THEN 1.0 ELSE stddev_pop({f}) END AS s_{f}"
        for f in T.ALL_FEATURES
    )
    + " FROM feat)\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{split}' AS split, annotation_id, "
        + ", ".join(f"round((t.{f} - st.m_{f}) / st.s_{f}, 6) AS {f}" for f in T.ALL_FEATURES)
        + f" FROM {src} t CROSS JOIN st"
        for split, src in (("train", "feat"), ("test", "tfeat"))
    ),
)
def q_standardise_features(spark, sf_dir):
    tr, te = split_features(spark, sf_dir, "annotation_id")
    scaled = FE.standardise_features(tr, te, keep=["annotation_id"])
    cols = [F.round(f, 6).alias(f) for f in T.ALL_FEATURES]
    ztr, zte = (z.select(F.lit(s).alias("split"), "annotation_id", *cols) for s, z in zip(("train", "test"), scaled))
    return ztr.unionByName(zte)


# --- vocabulary and tokens ---------------------------------------------------------

TOKS = "list_filter(regexp_extract_all(lower(text), '[" + WC + "]+'), lambda x: length(x) > 1)"
VOCAB = f"""
WITH t AS (SELECT unnest({TOKS}) AS token FROM documents),
c AS (SELECT token, count(*) AS n FROM t GROUP BY token HAVING count(*) >= 1),
v AS (SELECT token, n AS count, CAST(row_number() OVER (ORDER BY n DESC, token) - 1 AS INTEGER) AS idx
      FROM c ORDER BY n DESC, token LIMIT 500)"""


def _docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


@query(
    "tokenize_words",
    f"""
SELECT doc_id, CAST(len({TOKS}) AS INTEGER) AS n_tokens, array_to_string({TOKS}, ' ') AS tokens
FROM documents""",
)
def q_tokenize_words(spark, sf_dir):
    t = V.tokenize_words(_docs(spark, sf_dir))
    return t.select("doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


@query("build_vocabulary", VOCAB + "\nSELECT * FROM v")
def q_build_vocabulary(spark, sf_dir):
    return V.build_vocabulary(_docs(spark, sf_dir))


@query(
    "bag_of_words",
    VOCAB
    + f""",
dt AS (SELECT doc_id, unnest({TOKS}) AS token FROM documents),
cn AS (SELECT dt.doc_id, v.idx, count(*) AS count FROM dt JOIN v ON v.token = dt.token GROUP BY 1, 2)
SELECT doc_id, idx, count, round(count / sqrt(sum(count * count) OVER (PARTITION BY doc_id)), 6) AS value FROM cn""",
)
def q_bag_of_words(spark, sf_dir):
    d = _docs(spark, sf_dir)
    b = V.bag_of_words(d, V.build_vocabulary(d), key="doc_id")
    return b.select("doc_id", "idx", "count", F.round("value", 6).alias("value"))


SPLIT_TOKENS = CLEAN + f""",
tk AS (SELECT 'train' AS split, CAST(len({TOKS}) + 2 AS INTEGER) AS n_tokens FROM train
       UNION ALL SELECT 'test', CAST(len({TOKS}) + 2 AS INTEGER) FROM test)"""


def _split_tokens(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    rows = c.train.select(F.lit("train").alias("split"), "text").unionByName(c.test.select(F.lit("test").alias("split"), "text"))
    return V.token_counts(with_texts(spark, sf_dir, rows))


@query(
    "token_length_stats",
    SPLIT_TOKENS + """
SELECT split, count(*) AS n, round(avg(n_tokens), 6) AS mean_tokens, min(n_tokens) AS min_tokens, max(n_tokens) AS max_tokens,
       round(quantile_cont(n_tokens, 0.5), 6) AS p50, round(quantile_cont(n_tokens, 0.75), 6) AS p75,
       round(quantile_cont(n_tokens, 0.9), 6) AS p90, round(quantile_cont(n_tokens, 0.95), 6) AS p95,
       round(quantile_cont(n_tokens, 0.99), 6) AS p99, round(quantile_cont(n_tokens, 1.0), 6) AS p100
FROM tk GROUP BY split""",
)
def q_token_length_stats(spark, sf_dir):
    return V.token_length_stats(_split_tokens(spark, sf_dir), by=["split"])


@query(
    "max_length_coverage",
    SPLIT_TOKENS + """,
ml(max_length) AS (VALUES (128), (256), (512))
SELECT split, CAST(max_length AS INTEGER) AS max_length,
       round(count(*) FILTER (WHERE n_tokens <= max_length) * 100.0 / count(*), 6) AS pct_fit,
       count(*) FILTER (WHERE n_tokens > max_length) AS n_truncated
FROM tk CROSS JOIN ml GROUP BY split, max_length""",
)
def q_max_length_coverage(spark, sf_dir):
    return V.max_length_coverage(_split_tokens(spark, sf_dir), by=["split"])


@query(
    "encode_fixed_length",
    VOCAB
    + f""",
tk AS (SELECT doc_id, {TOKS} AS toks FROM documents),
ex AS (SELECT doc_id, unnest(toks) AS token, unnest(range(1, len(toks) + 1)) AS pos FROM tk),
ids AS (SELECT ex.doc_id, ex.pos, coalesce(v.idx + 2, 1) AS id FROM ex LEFT JOIN v ON v.token = ex.token),
agg AS (SELECT doc_id, list(id ORDER BY pos) AS ids FROM ids GROUP BY doc_id),
cut AS (SELECT tk.doc_id, list_slice(coalesce(agg.ids, []), 1, 256) AS ids FROM tk LEFT JOIN agg ON agg.doc_id = tk.doc_id)
SELECT doc_id,
       array_to_string(list_concat(ids, list_transform(range(256 - len(ids)), lambda x: 0)), ',') AS input_ids,
       CAST(len(ids) AS INTEGER) AS n_real_tokens
FROM cut""",
)
def q_encode_fixed_length(spark, sf_dir):
    d = _docs(spark, sf_dir)
    e = V.encode_fixed_length(d, V.build_vocabulary(d), key="doc_id", max_length=256)
    return e.select(
        "doc_id",
        F.array_join("input_ids", ",").alias("input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_real_tokens"),
    )
