"""Annotation exports: scan, quarantine, flatten.

Layout: ``<root>/<annotator>/*.json``; each file holds a JSON array of tasks
or a single task object.  The reader is Spark's multi-line JSON source with
an explicit schema (no inference pass), the annotator code comes from the
file's folder (``_metadata.file_path``), and flattening is
``posexplode`` + null-safe element access — all lazy, file splits in
parallel, no shuffle until a statistic is asked for.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolytics.functions.labels import parse_label
from annolytics.operators.clean import text_key
from annolytics.session import materialize, shuffles_deleted
from annolytics.sources.json_ranges import json_records

log = logging.getLogger(__name__)

# --- fixed values -------------------------------------------------------------------
# Annotator folders skipped at ingest (compared lower-cased).
EXCLUDED_FOLDERS = ("sample", "consensus")
# -------------------------------------------------------------------------------------
CORRUPT = "_corrupt_record"
#: Bytes from which a file is read by ranges instead of as one task.
LARGE_BYTES = 64 << 20

# Ids and numbers are read as text and cast row by row: a field of another
# type then costs that field, not its task or file.
CHOICES = T.StructType([T.StructField("choices", T.ArrayType(T.StringType()))])
RESULT = T.StructType([T.StructField("value", CHOICES)])
ANNOTATION = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("completed_by", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("lead_time", T.StringType()),
        T.StructField("result", T.ArrayType(RESULT)),
    ]
)
TASK = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("inner_id", T.StringType()),
        T.StructField("file_upload", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("data", T.StructType([T.StructField("text", T.StringType())])),
        T.StructField("annotations", T.ArrayType(ANNOTATION)),
    ]
)
TASK_WITH_CORRUPT = T.StructType(TASK.fields + [T.StructField(CORRUPT, T.StringType())])

AGGREGATED_SCHEMA = T.StructType(
    [
        T.StructField("student_code", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("json_filename", T.StringType()),
        T.StructField("task_id", T.LongType()),
        T.StructField("task_inner_id", T.LongType()),
        T.StructField("annotation_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("label_text", T.StringType()),
        T.StructField("label_numeric", T.IntegerType()),
        T.StructField("completed_by", T.LongType()),
        T.StructField("annotation_created_at", T.StringType()),
        T.StructField("annotation_updated_at", T.StringType()),
        T.StructField("task_created_at", T.StringType()),
        T.StructField("task_updated_at", T.StringType()),
        T.StructField("lead_time_seconds", T.DoubleType()),
    ]
)


def _folder_of(path: Column) -> Column:
    """Parent folder name of a file path; a Hive-style ``k=v`` folder (as
    Spark's own writer makes) yields ``v``."""
    folder = F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1)
    return F.regexp_replace(folder, r"^[^=/]*=", "")


def scan_exports(
    spark: SparkSession,
    root: str,
    pattern: str = "*.json",
    exclude: Sequence[str] = EXCLUDED_FOLDERS,
    large_bytes: int = LARGE_BYTES,
) -> DataFrame:
    """S1 + S2: every ``<root>/<annotator>/<pattern>`` file (not recursive)
    as task rows with ``student_code`` (folder), ``json_filename``,
    ``task_pos`` and the corrupt-record column.  Excluded folders are dropped
    by a filter on the file path, which Spark applies when listing files.

    Files of ``large_bytes`` or more are read by byte ranges
    (``json_ranges``), smaller ones as one task each; ``task_pos`` orders the
    tasks of a file in both."""
    glob = f"{root.rstrip('/')}/*/{pattern}"
    path = F.col("_metadata.file_path")
    wanted = ~F.lower(_folder_of(path)).isin([e.lower() for e in exclude]) if exclude else F.lit(True)
    small = _scan_whole(spark, root, glob).filter(wanted & (F.col("_metadata.file_size") < large_bytes))
    # A multi-line JSON file is one split, read in file order, so the row id
    # orders tasks within their file (only ever compared inside one file).
    small = small.select(
        *[F.col(f.name) for f in TASK_WITH_CORRUPT.fields],
        _folder_of(path).alias("student_code"),
        F.col("_metadata.file_name").alias("json_filename"),
        path.alias("_file_path"),
        F.monotonically_increasing_id().alias("task_pos"),
    )
    listed = spark.read.format("binaryFile").option("basePath", root).load(glob).select("path", "length")
    if listed.filter(F.col("length") >= large_bytes).isEmpty():
        return small
    return small.unionByName(_scan_ranges(spark, root, glob, large_bytes).filter(~F.lower("student_code").isin([e.lower() for e in exclude])))


def _scan_ranges(spark: SparkSession, root: str, glob: str, large_bytes: int) -> DataFrame:
    """Tasks of the large files; an unreadable file is one row, as it is for
    the multi-line reader, with the first broken record's text."""
    records, broken = json_records(spark, glob, large_bytes, root)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = records.withColumn("t", F.from_json("text", TASK_WITH_CORRUPT, options))
    # a field of another type costs that field only, broken syntax the file
    valid = F.when(F.col(f"t.{CORRUPT}").isNotNull(), F.try_parse_json("text").isNotNull()).otherwise(F.lit(True))
    parsed = parsed.select("path", "pos", valid.alias("valid"), *[F.col(f"t.{f.name}").alias(f.name) for f in TASK_WITH_CORRUPT.fields])
    parsed = materialize(parsed, "json-tasks")
    wrong = parsed.filter(~F.col("valid") | unreadable()).groupBy("path").agg(F.min(CORRUPT).alias(CORRUPT))
    wrong = wrong.unionByName(broken.select("path", F.lit("not an array of objects").alias(CORRUPT))).groupBy("path").agg(F.min(CORRUPT).alias(CORRUPT))
    good = parsed.drop("valid").join(wrong.select("path"), "path", "left_anti")
    rows = good.unionByName(wrong.withColumn("pos", F.lit(0).cast("long")), allowMissingColumns=True)
    name = F.element_at(F.split("path", "/"), -1)
    return rows.select(
        *[F.col(f.name) for f in TASK_WITH_CORRUPT.fields],
        _folder_of(F.col("path")).alias("student_code"),
        name.alias("json_filename"),
        F.col("path").alias("_file_path"),
        F.col("pos").alias("task_pos"),
    )


def _scan_whole(spark: SparkSession, root: str, glob: str) -> DataFrame:
    reader = (
        spark.read.schema(TASK_WITH_CORRUPT)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("basePath", root)
    )
    return reader.json(glob)


def unreadable() -> Column:
    """Whether a scanned row stands for a file that does not parse: the raw
    text in the corrupt-record column and no field of a task."""
    return F.col(CORRUPT).isNotNull() & F.col("id").isNull() & F.col("data").isNull() & F.col("annotations").isNull()


def quarantine_bad_files(tasks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S3: (good task rows, one row per unreadable file).  A file that fails
    to parse contributes no rows; the others go on.  A task with a field of
    an unexpected type is no reason to drop anything else of it."""
    bad_flag = unreadable()
    bad_files = (
        tasks.filter(bad_flag)
        .groupBy("student_code", "json_filename", "_file_path")
        .agg(F.count("id").alias("n_parsed_tasks"))
    )
    good = tasks.filter(~bad_flag).drop(CORRUPT)
    return good, bad_files


def flatten_annotations(tasks: DataFrame, order_columns: bool = True) -> DataFrame:
    """S4 + P1: one row per (task, annotation) in the 15-column layout.

    Tasks without annotations or without text are skipped; an annotation
    without a result, or whose first result has no choices, is skipped; the
    label is the first choice of the first result.  ``task_pos`` /
    ``annotation_pos`` keep the file order for "first" rules."""
    t = tasks.filter((F.size("annotations") > 0) & (F.length(F.col("data.text")) > 0))
    if "task_pos" not in t.columns:
        t = t.withColumn("task_pos", F.lit(None).cast("long"))
    x = t.select("*", F.posexplode("annotations").alias("annotation_pos", "a"))
    first_choice = F.get(F.col("a.result"), 0).getField("value").getField("choices")
    label_text = F.get(first_choice, 0)
    x = x.filter(F.size(F.col("a.result")) > 0).filter(label_text.isNotNull())
    lead = F.col("a.lead_time").try_cast("double")
    out = x.select(
        F.col("student_code"),
        F.col("file_upload").alias("source_file"),
        F.col("json_filename"),
        F.col("id").try_cast("long").alias("task_id"),
        F.col("inner_id").try_cast("long").alias("task_inner_id"),
        F.col("a.id").try_cast("long").alias("annotation_id"),
        F.col("data.text").alias("text"),
        label_text.alias("label_text"),
        parse_label(label_text).alias("label_numeric"),
        F.coalesce(
            F.col("a.completed_by").try_cast("long"), F.get_json_object("a.completed_by", "$.id").try_cast("long")
        ).alias("completed_by"),
        F.col("a.created_at").alias("annotation_created_at"),
        F.col("a.updated_at").alias("annotation_updated_at"),
        F.col("created_at").alias("task_created_at"),
        F.col("updated_at").alias("task_updated_at"),
        F.when(F.isnan(lead), None).otherwise(lead).alias("lead_time_seconds"),
        F.col("task_pos"),
        F.col("annotation_pos").cast("long").alias("annotation_pos"),
    )
    return out if order_columns else out.drop("task_pos", "annotation_pos")


def read_exports(spark: SparkSession, root: str, pattern: str = "*.json", exclude=EXCLUDED_FOLDERS):
    """J1 front half: scan -> quarantine -> flatten.  Returns (rows, bad files)."""
    good, bad = quarantine_bad_files(scan_exports(spark, root, pattern, exclude))
    return flatten_annotations(good), bad


def ingest_summary(rows: DataFrame) -> DataFrame:
    """Total records, unique annotators, unique texts, then the count per
    label (NULL label left out of the listing), as (metric, label, value)."""
    # exports are parsed once for all numbers
    rows = materialize(rows.select("student_code", "label_numeric", text_key(rows)), "summary-rows")
    totals = rows.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("student_code").alias("unique_annotators"),
        F.countDistinct("_text").alias("unique_texts"),
    )
    t = totals.select(
        F.stack(
            F.lit(3),
            F.lit("total_records"), F.col("total_records"),
            F.lit("unique_annotators"), F.col("unique_annotators"),
            F.lit("unique_texts"), F.col("unique_texts"),
        ).alias("metric", "value")
    ).select("metric", F.lit(None).cast("int").alias("label"), "value")
    per_label = (
        rows.filter(F.col("label_numeric").isNotNull())
        .groupBy("label_numeric")
        .agg(F.count(F.lit(1)).alias("value"))
        .select(F.lit("label_count").alias("metric"), F.col("label_numeric").alias("label"), "value")
    )
    return t.unionByName(per_label)


# --- exports from an annotation table (to land tables in export layout) -------


def task_json(df: DataFrame) -> Column:
    """One export task (JSON text) per annotation row of the A2 layout."""
    ann = F.struct(
        F.col("annotation_id").alias("id"),
        F.col("completed_by").alias("completed_by") if "completed_by" in df.columns else F.lit(None).cast("long").alias("completed_by"),
        F.col("annotation_created_at").alias("created_at"),
        F.col("annotation_created_at").alias("updated_at"),
        F.col("lead_time_seconds").alias("lead_time"),
        F.array(F.struct(F.struct(F.array(F.col("label_text")).alias("choices")).alias("value"))).alias("result"),
    )
    task = F.struct(
        F.col("annotation_id").alias("id"),
        F.col("annotation_id").alias("inner_id"),
        F.col("source_file").alias("file_upload"),
        F.col("annotation_created_at").alias("created_at"),
        F.col("annotation_created_at").alias("updated_at"),
        F.struct(F.col("text").alias("text")).alias("data"),
        F.array(ann).alias("annotations"),
    )
    return F.to_json(task)


#: Characters from which an export file, or all that a task holds back for
#: unfinished files, is passed on.
FILE_CHARS, HELD_CHARS = 4 << 20, 32 << 20


def _export_files(tasks_per_file: int):
    """Map function: (annotator, task) rows to (annotator, file)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, list[str]] = {}
        size: dict[str | None, int] = {}

        def file(code):
            del size[code]
            return pa.RecordBatch.from_arrays([pa.array([code], pa.string()), pa.array([f"[{','.join(held.pop(code))}]"], pa.string())], names=["student_code", "value"])

        for batch in batches:
            for code, task in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(code, []).append(task)
                size[code] = size.get(code, 0) + len(task)
                if len(held[code]) >= tasks_per_file or size[code] >= FILE_CHARS:
                    yield file(code)
                elif sum(size.values()) >= HELD_CHARS:
                    yield file(max(size, key=size.get))
        for code in [*held]:
            yield file(code)

    return run


def write_exports(df: DataFrame, root: str, tasks_per_file: int = 1000, compression: str = "none") -> str:
    """Write an annotation table in export layout: one folder per annotator,
    files of JSON arrays of at most ``tasks_per_file`` tasks, plain or
    compressed.  Files are cut where the rows are, so no text is shuffled; a
    task holds back a bounded number of characters, and each of its rows
    becomes one file (``maxRecordsPerFile=1``)."""
    spark = df.sparkSession
    rows = df.select("student_code", task_json(df).alias("t"))
    files = rows.mapInArrow(_export_files(tasks_per_file), "student_code string, value string")
    # files of several annotators are written side by side, not sorted first
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers, "0")
    spark.conf.set(writers, "64")
    try:
        with shuffles_deleted(spark):
            (
                files.write.mode("overwrite")
                .option("maxRecordsPerFile", 1)
                .option("compression", compression)
                .option("zlib.compress.level", "BEST_SPEED")
                .partitionBy("student_code")
                .text(root)
            )
    finally:
        spark.conf.set(writers, before)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never a
    machine-local temp folder)."""
    from annolytics.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
