"""Deterministic annotation-shaped views over the shared parquet tables.

The driver tables carry no annotator exports, so the annotation table (the
15-column aggregated export, FIXTURES A2) is derived from ``events`` x
``documents``: each event is one annotation of one document.  The same
definitions are written in DuckDB SQL in ``annolytics.plans.oracle``.

Everything here is a lazy plan.  The document count is a scalar subquery
(evaluated once, from parquet metadata), not a driver-side ``count()``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


TEXT_TABLES = ("documents", "pages", "conversations", "benchmark")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table of the shared folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _doc_slot(event_id: Column, user_id: Column, n: Column) -> Column:
    """``(event_id^2 * 31 + user_id * 17) mod n`` without 64-bit overflow.

    Reducing ``event_id`` mod n before squaring keeps every intermediate
    below n^2 + 31n, so the expression stays exact for n up to ~3e9 rows
    (the direct form overflows once event_id passes ~5e8).
    """
    r = event_id % n
    return ((r * r) % n * 31 + (user_id % n) * 17) % n


def annotations_v(spark: SparkSession, sf_dir: str, text: Column | None = None, part: tuple[int, int] | None = None) -> DataFrame:
    """One row per annotation (FIXTURES B1).  ``text`` replaces the text by
    an expression over ``documents``, evaluated before the join, so that a
    caller that needs only a length does not move texts.  ``part`` ``(i, n)``
    keeps the annotations of the i-th of n sets of documents (by a hash of the
    id); the n parts together are the view.

    Columns: annotation_id (the order key), student_code, source_file, text,
    label_text, label_numeric, annotation_created_at, lead_time_seconds.
    """
    docs = read_table(spark, sf_dir, "documents")
    n = docs.agg(F.count(F.lit(1))).scalar()
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props")
    k = F.get_json_object("props", "$.k").try_cast("int")
    # every event is used (the whole table): each one annotates one document
    e = ev.select(
        "event_id",
        "ts",
        "user_id",
        "value",
        k.alias("k"),
        _doc_slot(F.col("event_id"), F.col("user_id"), n).alias("doc_id"),
    )
    d = docs.select("doc_id", (F.col("text") if text is None else text).alias("text"), "source")
    if part is not None:
        e, d = (x.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(part[1])) == part[0]) for x in (e, d))
    j = e.join(d, "doc_id")
    eid = F.col("event_id")
    return j.select(
        eid.alias("annotation_id"),
        F.concat(F.lit("U"), F.lpad((F.col("user_id") % 25).cast("string"), 2, "0")).alias("student_code"),
        F.when(eid % 101 == 0, F.lit(None).cast("string")).otherwise(F.col("source")).alias("source_file"),
        F.col("text"),
        F.when(eid % 89 == 0, F.lit("n/a"))
        .otherwise(F.concat((F.col("k") % 5 + 1).cast("string"), F.lit("-label")))
        .alias("label_text"),
        F.when(eid % 89 == 0, F.lit(None).cast("int")).otherwise(F.col("k") % 5 + 1).alias("label_numeric"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("annotation_created_at"),
        F.when(eid % 97 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("value") * (F.col("user_id") % 25 + 1) / F.lit(12.0))
        .alias("lead_time_seconds"),
    )


def scored_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True / predicted label pairs with a continuous score (FIXTURES B2)."""
    a = annotations_v(spark, sf_dir, text=F.length("text")).filter(F.col("label_numeric").isNotNull())
    ln = F.col("text")
    return a.select(
        "annotation_id",
        F.col("label_numeric").alias("true_label"),
        F.greatest(F.lit(1), F.least(F.lit(5), F.col("label_numeric") + (ln % 5).cast("int") - 2)).alias(
            "predicted_label"
        ),
        (F.col("label_numeric") + (ln % 41 - 20) / F.lit(10.0)).alias("score"),
        F.when(F.col("annotation_id") % 5 == 0, F.lit("test")).otherwise(F.lit("validation")).alias("split"),
    )


def logits_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five logits per embedding row (FIXTURES B3)."""
    emb = read_table(spark, sf_dir, "embeddings")
    zs = [(F.get(F.col("embedding"), i).cast("double") * 10).alias(f"z{i + 1}") for i in range(5)]
    return emb.select("vec_id", (F.col("label") % 5 + 1).alias("true_label"), *zs)


def logits_array(df: DataFrame, cols=("z1", "z2", "z3", "z4", "z5")) -> Column:
    return F.array(*[F.col(c) for c in cols])
