"""Incremental ingest of annotation exports with Structured Streaming.

The source project re-reads every export on each run.  Here new files landed
under ``<root>/<annotator>/`` are picked up by Spark's file stream source
(it remembers which files it has seen in the checkpoint), parsed with the
same schema, flattened with the same operator (S4) and appended to a Parquet
table; files that do not parse are listed beside it (S3).  ``availableNow`` processes everything pending and stops, so a
scheduler can run it like a batch job; a lost executor only replays the
uncommitted micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolytics.sources.exports import CORRUPT, EXCLUDED_FOLDERS, TASK_WITH_CORRUPT, _folder_of, flatten_annotations, unreadable


def export_stream(spark: SparkSession, root: str, pattern: str = "*.json", exclude=EXCLUDED_FOLDERS) -> DataFrame:
    """Streaming twin of ``scan_exports``: task rows of newly arrived files."""
    df = (
        spark.readStream.schema(TASK_WITH_CORRUPT)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(f"{root.rstrip('/')}/*/{pattern}")
    )
    path = F.col("_metadata.file_path")
    df = df.select(
        *[F.col(f.name) for f in TASK_WITH_CORRUPT.fields],
        _folder_of(path).alias("student_code"),
        F.col("_metadata.file_name").alias("json_filename"),
        # streams have no row ids: the task id (increasing in an export)
        # is the within-file order key
        F.col("id").try_cast("long").alias("task_pos"),
        path.alias("file_path"),
    )
    if exclude:
        df = df.filter(~F.lower(F.col("student_code")).isin([e.lower() for e in exclude]))
    return df


def unreadable_path(out_path: str) -> str:
    """Where the unreadable files of a table are listed: a folder that readers
    of the table skip."""
    return out_path.rstrip("/") + "/_unreadable_files"


def unreadable_files(spark: SparkSession, out_path: str) -> DataFrame:
    """S3 of the incremental ingest: (student_code, json_filename, file_path,
    batch_id) of every file that did not parse."""
    return spark.read.schema("student_code string, json_filename string, file_path string, batch_id long").parquet(unreadable_path(out_path))


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def commit_batch(tasks: DataFrame, batch_id: int, out_path: str) -> None:
    """Writes one micro-batch to both sinks: the flattened rows, and the files
    that did not parse.  Each sink's folder is named by the batch, so a batch
    that is replayed after a failure between the two writes replaces what it
    had written and nothing is there twice."""
    tasks = tasks.persist()
    try:
        _write(flatten_annotations(tasks.filter(~unreadable()).drop(CORRUPT, "file_path")), f"{out_path.rstrip('/')}/batch_id={batch_id}")
        bad = tasks.filter(unreadable()).select("student_code", "json_filename", "file_path").distinct()
        _write(bad, f"{unreadable_path(out_path)}/batch_id={batch_id}")
    finally:
        tasks.unpersist()


def ingest_new_exports(
    spark: SparkSession,
    root: str,
    out_path: str,
    checkpoint: str | None = None,
    pattern: str = "*.json",
):
    """Append the flattened rows of every not-yet-seen export file to
    ``out_path`` (Parquet, one folder a micro-batch) and stop when nothing is
    pending; unreadable files are listed once (``unreadable_files``).
    ``checkpoint`` defaults to a hidden folder inside ``out_path``, so every
    run that appends to one output continues one query, in any session.  The
    batch numbers come from the checkpoint: a new checkpoint needs a new
    ``out_path``."""
    if checkpoint is None:
        checkpoint = out_path.rstrip("/") + "/_ingest_checkpoint"
    q = (
        export_stream(spark, root, pattern)
        .writeStream.foreachBatch(lambda tasks, batch_id: commit_batch(tasks, batch_id, out_path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q
