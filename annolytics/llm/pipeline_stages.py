"""Stages of the corpus pipeline: toxicity, near-duplicates, personal data,
mixing, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs`` with their values, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolytics.llm import hyperminhash, mixing, pii, sentencepiece_codec, toxicity
from annolytics.llm.common import prefixed, restored
from annolytics.llm.queries import piece_model, surrogate_key, table
from annolytics.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def row_ids(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns renamed to doc_... and ``row``, the id of a
    row's document: doc_id, or where some id has several texts, a number in
    the order of (doc_id, digest of the text).  Null ids stay null."""
    rows = prefixed(docs, "doc_")
    known = rows.filter("doc_doc_id IS NOT NULL").select(F.col("doc_doc_id").alias("id"), F.coalesce(F.sha2("doc_text", 256), F.lit("")).alias("of"))
    twice = known.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id")
    twice = materialize(twice, "pipeline-repeated")
    texts = known.join(twice, "id", "left_semi").groupBy("id").agg(F.min("of").alias("a"), F.max("of").alias("b"))
    if twice.isEmpty() or texts.filter("a <> b").isEmpty():
        return rows.withColumn("row", F.col("doc_doc_id"))
    keys = known.distinct().sort("id", "of")
    keys = materialize(keys.withColumn("row", F.monotonically_increasing_id()), "pipeline-row-ids")
    same = (F.col("doc_doc_id") == F.col("id")) & (F.coalesce(F.sha2("doc_text", 256), F.lit("")) == F.col("of"))
    return materialize(rows.join(keys, same, "left").drop("id", "of"), "pipeline-numbered")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (five words, 80 %): the one
    with the smallest id.  Rows with one id and text are one document, of
    which the first in the order of the columns' JSON stays; rows with one id
    and different texts are different documents; rows without an id all stay."""
    rows = row_ids(docs)
    own = [c for c in rows.columns if c != "row"]
    near = hyperminhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), F.col("doc_text").alias("text")))
    judged = materialize(near.select("doc_id", "kept"), "pipeline-judged")
    by_id = judged.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    special = materialize(by_id.filter("NOT kept OR n > 1").select(F.col("doc_id").alias("special"), "kept"), "pipeline-special")
    plain = rows.join(special, F.col("row") == F.col("special"), "left_anti").select(*own)
    repeated = rows.join(special.filter("kept"), F.col("row") == F.col("special"), "left_semi")
    whole = F.struct(*own)
    first = repeated.groupBy("row").agg(F.min_by(whole, F.to_json(whole)).alias("first"))
    return plain.unionByName(first.select("first.*")).select(*restored(docs.columns, "doc_"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with surrogates for personal data."""
    return pii.replace_pii(docs, surrogate_key(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy of a document that the mix takes."""
    return mixing.mix(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    bare = docs.select("doc_id", "lang", "source", "text")
    coded = sentencepiece_codec.encode_and_decode(bare, piece_model(), "text", "ids", "decoded")
    return coded.select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"),
    )
