"""The corpus pipeline: toxicity, near-duplicates, personal data, mixing,
tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All stages
but the last return the columns of ``documents``.  The classifier, the
signatures and the tokenizer are not SQL, so there is no SQL form of the
whole; the tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from annolytics.llm.pipeline_stages import drop_near_duplicates, drop_toxic, encode_tokens, mix_sources, replace_personal_data
from annolytics.llm.queries import table
from annolytics.session import materialize

ORACLE_SQL = None

STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", replace_personal_data),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
