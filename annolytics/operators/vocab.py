"""Vocabulary, bag-of-words and fixed-length token encodings.

The vocabulary is bounded by ``max_features`` (default 500).  That bound is
what makes it safe to ship to every task, as the broadcast side of a hash
join (``bag_of_words``) or as a dictionary (``encode_fixed_length``).  Texts themselves are never
shuffled: only (key, token index, count / position) rows are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolytics.functions.stats import grouped_stats
from annolytics.functions.text import word_tokens
from annolytics.session import materialize

MAX_FEATURES = 500
MIN_FREQ = 1
PAD_ID = 0
UNK_ID = 1
ID_OFFSET = 2  # vocabulary index i is encoded as i + 2
SPECIAL_TOKENS = 2  # added to every sequence length (start and end marker)
MAX_LENGTHS = (128, 256, 512)
MAX_LENGTH = 256


def tokenize_words(df: DataFrame, text: str = "text") -> DataFrame:
    """V1: adds ``tokens`` (array<string>)."""
    return df.withColumn("tokens", word_tokens(text))


def build_vocabulary(df: DataFrame, text: str = "text", max_features: int = MAX_FEATURES, min_freq: int = MIN_FREQ) -> DataFrame:
    """V2: (token, count, idx) for the ``max_features`` most frequent tokens
    with count >= min_freq, ids 0.. by count descending, ties by token.

    Term counts are a partial+final aggregate; the top-k is a
    TakeOrderedAndProject (each task keeps k rows); the id window then runs
    over those k rows only."""
    toks = df.select(F.explode(word_tokens(text)).alias("token"))
    counts = toks.groupBy("token").agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") >= min_freq)
    top = counts.orderBy(F.desc("count"), F.asc("token")).limit(max_features)
    w = Window.orderBy(F.desc("count"), F.asc("token"))
    return top.select("token", "count", (F.row_number().over(w) - 1).cast("int").alias("idx"))


def bag_of_words(df: DataFrame, vocab: DataFrame, key: str, text: str = "text") -> DataFrame:
    """V3 in long form: (key, idx, count, value) with value the L2-normalised
    count; documents without vocabulary tokens have no rows (a zero vector).
    The vocabulary side is broadcast: its size is bounded by max_features."""
    toks = df.select(key, F.explode(word_tokens(text)).alias("token"))
    hits = toks.join(F.broadcast(vocab.select("token", "idx")), "token")
    counts = hits.groupBy(key, "idx").agg(F.count(F.lit(1)).alias("count"))
    norm = F.sqrt(F.sum(F.col("count") * F.col("count")).over(Window.partitionBy(key)))
    return counts.select(key, "idx", "count", (F.col("count") / norm).alias("value"))


def bag_of_words_vectors(df: DataFrame, vocab_tokens: Sequence[str], text: str = "text", output: str = "features"):
    """V3 for Spark ML: ``CountVectorizerModel`` over the fixed vocabulary
    plus an L2 ``Normalizer`` (both JVM-side, sparse vectors).  The token
    list is at most max_features long."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import CountVectorizerModel, Normalizer

    d = df.withColumn("_tokens", word_tokens(text))
    cv = CountVectorizerModel.from_vocabulary(list(vocab_tokens), inputCol="_tokens", outputCol="_counts")
    norm = Normalizer(inputCol="_counts", outputCol=output, p=2.0)
    return PipelineModel(stages=[cv, norm]).transform(d).drop("_tokens", "_counts")


def token_counts(df: DataFrame, text: str = "text", special: int = SPECIAL_TOKENS, tokens: Column | None = None) -> DataFrame:
    """Tokens per text plus the special tokens (V4 input).  ``tokens`` may be
    any array column, so another tokenizer plugs in."""
    t = tokens if tokens is not None else word_tokens(text)
    return df.withColumn("n_tokens", (F.size(t) + special).cast("int"))


def token_length_stats(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """V4: mean, min, max and exact 50/75/90/95/99/100 percentiles of
    ``n_tokens``."""
    specs = [("n_tokens", p, f"p{int(round(p * 100))}") for p in (0.5, 0.75, 0.9, 0.95, 0.99, 1.0)]
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("n_tokens"), 6).alias("mean_tokens"),
        F.min("n_tokens").alias("min_tokens"),
        F.max("n_tokens").alias("max_tokens"),
    ]
    # counting tokens reads every text: once for all statistics
    s = grouped_stats(materialize(df.select(*by, "n_tokens"), "token-counts"), list(by), aggs, specs)
    return s.select(
        *by, "n", "mean_tokens", "min_tokens", "max_tokens", *[F.round(a, 6).alias(a) for _, _, a in specs]
    )


def max_length_coverage(df: DataFrame, lengths: Sequence[int] = MAX_LENGTHS, by: Sequence[str] = ()) -> DataFrame:
    """V5: for each max length: % of texts that fit (<=) and how many are
    truncated; one aggregate, unpivoted."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for L in lengths:
        aggs.append(F.count_if(F.col("n_tokens") <= L).alias(f"fit{L}"))
    g = df.groupBy(*by).agg(*aggs)
    parts = []
    for L in lengths:
        parts += [F.lit(L), F.col(f"fit{L}"), F.col("_n") - F.col(f"fit{L}")]
    long = g.select(*by, "_n", F.stack(F.lit(len(lengths)), *parts).alias("max_length", "n_fit", "n_truncated"))
    return long.select(
        *by, "max_length", F.round(F.col("n_fit") * 100.0 / F.col("_n"), 6).alias("pct_fit"), F.col("n_truncated").cast("long").alias("n_truncated")
    )


def encode_fixed_length(
    df: DataFrame, vocab: DataFrame, key: str, text: str = "text", max_length: int = MAX_LENGTH, keep: Sequence[str] = ()
) -> DataFrame:
    """V6: per row: ``input_ids`` (vocabulary index + 2, unknown 1) truncated
    or padded with 0 to ``max_length``, and the 0/1 ``attention_mask``; ``keep``
    columns are carried along.

    The vocabulary (at most max_features rows) travels with the tasks as a
    dictionary; the first ``max_length`` tokens of a batch of texts are looked
    up together in Arrow.  No row is shuffled and none grows beyond
    ``max_length`` entries; rows that share a key stay rows of their own."""
    ids = {r["token"]: r["idx"] + ID_OFFSET for r in vocab.select("token", "idx").collect()}

    @F.arrow_udf("array<int>")
    def look_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = pa.array(list(ids), pa.string())
        numbers = pa.array([*ids.values(), UNK_ID], pa.int32())
        for tokens in batches:
            place = pc.fill_null(pc.index_in(tokens.flatten(), value_set=known), len(ids))
            offsets = pc.cumulative_sum(pc.fill_null(pc.list_value_length(tokens), 0).cast(pa.int32()))
            offsets = pa.concat_arrays([pa.array([0], pa.int32()), offsets])
            yield pa.ListArray.from_arrays(offsets, numbers.take(place))

    keep = [c for c in keep if c != key]
    tokens = F.slice(F.coalesce(word_tokens(text), F.array().cast("array<string>")), 1, max_length)
    d = df.select(key, *keep, look_up(tokens).alias("_ids"))
    pad = F.greatest(F.lit(0), F.lit(max_length) - F.size("_ids"))
    return d.select(
        key,
        *keep,
        F.concat("_ids", F.array_repeat(F.lit(PAD_ID), pad)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size("_ids")), F.array_repeat(F.lit(0), pad)).alias("attention_mask"),
    )
