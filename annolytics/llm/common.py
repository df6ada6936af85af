"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of code points outside this class.
SPACE = r"[\x20\x09-\x0D]"


def words(text: Column) -> Column:
    """Words of a text in order, as an array (null text: no words).

    Trimming first leaves no empty piece at either end, so no lambda has to
    look at every word."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """The same rows with every column renamed, so that no name of a caller's
    extra column can clash with one that an operator adds."""
    return df.select(*[F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def restored(columns: list[str], prefix: str) -> list[Column]:
    """The columns that ``prefixed`` renamed, under their own names."""
    return [F.col(f"`{prefix}{c}`").alias(c) for c in columns]


#: Rows of text that one Arrow batch to a Python worker may hold.
BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batch size to ``BATCH_ROWS`` (a smaller
    setting stays): with whole texts in the rows, the default of 10,000 rows
    is tens of megabytes in the worker, and as much again outside the heap."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
