"""Registered queries: scalar rules, hold-out, duplicates, cleaning (§2.2-2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from annolytics.functions import labels as L
from annolytics.operators import clean as C
from annolytics.plans.oracle import ANN, CLEAN
from annolytics.plans.registry import DRIVER_MIN_MEAN_LEAD, DRIVER_RULES, query
from annolytics.sources.views import annotations_v, read_table, scored_v


def cleaned(spark, sf_dir):
    """The cleaning steps over references: no annotation carries its text."""
    return C.clean(annotations_v(spark, sf_dir, text=C.text_reference()), DRIVER_RULES, min_mean_lead=DRIVER_MIN_MEAN_LEAD)


def with_texts(spark, sf_dir, rows):
    """Cleaned rows with their texts."""
    return C.attach_texts(rows, read_table(spark, sf_dir, "documents").select("text"))


def working(spark, sf_dir, text=None):
    return C.holdout_split(annotations_v(spark, sf_dir, text=text), DRIVER_RULES)[0]


@query(
    "parse_label",
    ANN + """
SELECT annotation_id, label_text,
       TRY_CAST(nullif(regexp_extract(label_text, '^([0-9]+)', 1), '') AS INTEGER) AS label_parsed
FROM ann""",
)
def q_parse_label(spark, sf_dir):
    a = annotations_v(spark, sf_dir)
    return a.select("annotation_id", "label_text", L.parse_label("label_text").alias("label_parsed"))


@query(
    "holdout_split",
    CLEAN + """
SELECT annotation_id, student_code, source_file, is_test FROM flag""",
)
def q_holdout_split(spark, sf_dir):
    a = annotations_v(spark, sf_dir)
    return a.select("annotation_id", "student_code", "source_file", C.holdout_flag(DRIVER_RULES).alias("is_test"))


@query(
    "holdout_rule_counts",
    CLEAN + """
SELECT 'U07' AS rule, CAST(count(*) FILTER (WHERE student_code = 'U07') AS BIGINT) AS records FROM ann
UNION ALL
SELECT 'U03 ~ SRC1', CAST(count(*) FILTER (WHERE student_code = 'U03' AND regexp_matches(source_file, 'SRC1', 'i')) AS BIGINT) FROM ann
UNION ALL
SELECT 'total', CAST(count(*) AS BIGINT) FROM test""",
)
def q_holdout_rule_counts(spark, sf_dir):
    return C.holdout_rule_counts(annotations_v(spark, sf_dir), DRIVER_RULES)


@query(
    "select_training_columns",
    CLEAN + """
SELECT * FROM selected""",
)
def q_select_training_columns(spark, sf_dir):
    return C.select_training_columns(working(spark, sf_dir))


@query(
    "add_text_length",
    ANN + """
SELECT annotation_id, CAST(length(text) AS INTEGER) AS text_length FROM ann""",
)
def q_add_text_length(spark, sf_dir):
    return C.add_text_length(annotations_v(spark, sf_dir)).select("annotation_id", "text_length")


@query(
    "filter_short_texts",
    CLEAN + """
SELECT annotation_id, text_length FROM long_enough""",
)
def q_filter_short_texts(spark, sf_dir):
    return cleaned(spark, sf_dir).long_enough.select("annotation_id", "text_length")


@query(
    "short_text_listing",
    CLEAN + """
SELECT annotation_id, CAST(length(text) AS INTEGER) AS text_length, student_code, label_numeric,
       lead_time_seconds, source_file, text
FROM working WHERE length(text) < 50""",
)
def q_short_text_listing(spark, sf_dir):
    return C.short_text_listing(working(spark, sf_dir))


@query(
    "short_length_counts",
    CLEAN + """
SELECT CAST(length(text) AS INTEGER) AS text_length, count(*) AS n
FROM working WHERE length(text) < 50 GROUP BY 1""",
)
def q_short_length_counts(spark, sf_dir):
    return C.short_length_counts(working(spark, sf_dir))


@query(
    "lead_time_buckets",
    ANN + """,
b AS (
  SELECT CASE WHEN lead_time_seconds < 2 THEN 0 WHEN lead_time_seconds < 5 THEN 1
              WHEN lead_time_seconds < 120 THEN 2 WHEN lead_time_seconds < 300 THEN 3
              WHEN lead_time_seconds >= 300 THEN 4 END AS bucket_order
  FROM ann),
names(bucket_order, bucket) AS (VALUES (0, '< 2s'), (1, '2-5s'), (2, '5s-2min'), (3, '2-5min'), (4, '> 5min'))
SELECT n.bucket_order, n.bucket,
       CAST(count(b.bucket_order) AS BIGINT) AS n,
       round(count(b.bucket_order) * 100.0 / (SELECT count(*) FROM ann), 6) AS pct
FROM names n LEFT JOIN b ON b.bucket_order = n.bucket_order
GROUP BY n.bucket_order, n.bucket""",
)
def q_lead_time_buckets(spark, sf_dir):
    return C.lead_time_buckets(annotations_v(spark, sf_dir))


@query(
    "fastest_rows",
    ANN + """
SELECT annotation_id, student_code, label_numeric, lead_time_seconds,
       CASE WHEN length(text) > 100 THEN concat(substring(text, 1, 100), '...') ELSE text END AS text_preview
FROM ann WHERE lead_time_seconds < 2
ORDER BY lead_time_seconds, annotation_id LIMIT 10""",
)
def q_fastest_rows(spark, sf_dir):
    a = annotations_v(spark, sf_dir)
    return C.fastest_rows(a).select(
        "annotation_id", "student_code", "label_numeric", "lead_time_seconds", L.text_preview("text").alias("text_preview")
    )


@query(
    "slowest_rows",
    ANN + """
SELECT annotation_id, student_code, label_numeric, lead_time_seconds,
       CASE WHEN length(text) > 100 THEN concat(substring(text, 1, 100), '...') ELSE text END AS text_preview
FROM ann WHERE lead_time_seconds >= 300
ORDER BY lead_time_seconds DESC, annotation_id LIMIT 10""",
)
def q_slowest_rows(spark, sf_dir):
    a = annotations_v(spark, sf_dir)
    return C.slowest_rows(a).select(
        "annotation_id", "student_code", "label_numeric", "lead_time_seconds", L.text_preview("text").alias("text_preview")
    )


@query(
    "text_preview",
    ANN + """
SELECT annotation_id,
       CASE WHEN length(text) > 100 THEN concat(substring(text, 1, 100), '...') ELSE text END AS text_preview
FROM ann""",
)
def q_text_preview(spark, sf_dir):
    return annotations_v(spark, sf_dir).select("annotation_id", L.text_preview("text").alias("text_preview"))


_DESC_SQL = """CASE {c} WHEN 1 THEN 'Nagyon nehezen érthető (Very difficult)'
  WHEN 2 THEN 'Nehezen érthető (Difficult)'
  WHEN 3 THEN 'Többé-kevésbé érthető (Somewhat understandable)'
  WHEN 4 THEN 'Érthető (Understandable)'
  WHEN 5 THEN 'Könnyen érthető (Easily understandable)' END"""

_SCORED = """,
scored AS (
  SELECT annotation_id, label_numeric AS true_label,
         greatest(1, least(5, label_numeric + CAST(length(text) % 5 AS INTEGER) - 2)) AS predicted_label,
         label_numeric + (length(text) % 41 - 20) / 10.0E0 AS score,
         CASE WHEN annotation_id % 5 = 0 THEN 'test' ELSE 'validation' END AS split
  FROM ann WHERE label_numeric IS NOT NULL)"""


@query(
    "label_descriptions",
    ANN + _SCORED + f"""
SELECT annotation_id, predicted_label, {_DESC_SQL.format(c='predicted_label')} AS label_description
FROM scored""",
)
def q_label_descriptions(spark, sf_dir):
    s = scored_v(spark, sf_dir)
    return s.select("annotation_id", "predicted_label", L.label_description("predicted_label").alias("label_description"))


@query(
    "score_to_class",
    ANN + _SCORED + """
SELECT annotation_id, score, CAST(least(5, greatest(1, round_even(score, 0))) AS INTEGER) AS predicted_class
FROM scored""",
)
def q_score_to_class(spark, sf_dir):
    s = scored_v(spark, sf_dir)
    return s.select("annotation_id", "score", L.score_to_class("score").alias("predicted_class"))


@query(
    "expected_vs_predicted",
    ANN + _SCORED + """,
samples AS (
  SELECT annotation_id,
         CASE WHEN label_numeric >= 4 THEN 'easy' WHEN label_numeric = 3 THEN 'medium'
              WHEN label_numeric = 2 THEN 'hard' WHEN label_numeric = 1 THEN 'very_hard' END AS expected_difficulty
  FROM ann WHERE label_numeric IS NOT NULL)
SELECT s.annotation_id, s.expected_difficulty, p.predicted_label,
       CASE s.expected_difficulty WHEN 'easy' THEN 4 WHEN 'medium' THEN 3 WHEN 'hard' THEN 2 WHEN 'very_hard' THEN 1 END AS expected_low,
       CASE s.expected_difficulty WHEN 'easy' THEN 5 WHEN 'medium' THEN 3 WHEN 'hard' THEN 2 WHEN 'very_hard' THEN 1 END AS expected_high,
       p.predicted_label BETWEEN
         CASE s.expected_difficulty WHEN 'easy' THEN 4 WHEN 'medium' THEN 3 WHEN 'hard' THEN 2 WHEN 'very_hard' THEN 1 END
         AND CASE s.expected_difficulty WHEN 'easy' THEN 5 WHEN 'medium' THEN 3 WHEN 'hard' THEN 2 WHEN 'very_hard' THEN 1 END
         AS matches
FROM samples s JOIN scored p ON p.annotation_id = s.annotation_id""",
)
def q_expected_vs_predicted(spark, sf_dir):
    from annolytics.operators.score import expected_vs_predicted

    a = annotations_v(spark, sf_dir).filter(F.col("label_numeric").isNotNull())
    lab = F.col("label_numeric")
    samples = a.select(
        "annotation_id",
        F.when(lab >= 4, "easy").when(lab == 3, "medium").when(lab == 2, "hard").when(lab == 1, "very_hard")
        .alias("expected_difficulty"),
    )
    preds = scored_v(spark, sf_dir).select("annotation_id", "predicted_label")
    return expected_vs_predicted(samples, preds, index="annotation_id")


# --- duplicates -----------------------------------------------------------------


@query(
    "duplicate_summary",
    CLEAN + """,
g AS (SELECT text, count(*) AS n FROM working WHERE text IS NOT NULL GROUP BY text)
SELECT CAST(sum(n) AS BIGINT) AS total_records, count(*) AS unique_texts,
       CAST(sum(n) - count(*) AS BIGINT) AS surplus_records,
       CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_in_duplicate_groups
FROM g""",
)
def q_duplicate_summary(spark, sf_dir):
    return C.duplicate_summary(working(spark, sf_dir))


@query(
    "top_duplicates",
    CLEAN + """
SELECT text, count(*) AS n FROM working WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1
ORDER BY n DESC, text LIMIT 10""",
)
def q_top_duplicates(spark, sf_dir):
    return C.top_duplicates(working(spark, sf_dir))


@query(
    "duplicate_label_variation",
    CLEAN + """
SELECT text, count(*) AS n_rows, count(label_numeric) AS n_labels,
       round(avg(label_numeric), 6) AS mean_label, round(stddev_samp(label_numeric), 6) AS std_label,
       min(label_numeric) AS min_label, max(label_numeric) AS max_label,
       count(DISTINCT student_code) AS n_annotators
FROM working WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1
ORDER BY n_labels DESC, text LIMIT 10""",
)
def q_duplicate_label_variation(spark, sf_dir):
    return C.duplicate_label_variation(working(spark, sf_dir))


@query(
    "resolve_duplicates",
    CLEAN + """,
own AS (
  SELECT *, count(*) OVER w AS c, count(label_numeric) OVER w AS l, min(label_numeric) OVER w AS lo, max(label_numeric) OVER w AS hi
  FROM selected WHERE text IS NOT NULL WINDOW w AS (PARTITION BY text, student_code))
SELECT 'by_text' AS groups, annotation_id, student_code, label_numeric, lead_time_seconds FROM deduped
UNION ALL
SELECT 'by_text_and_annotator', annotation_id, student_code, label_numeric, lead_time_seconds FROM own
QUALIFY row_number() OVER (
  PARTITION BY text, student_code
  ORDER BY CASE WHEN c = 2 AND l = 2 AND lo = hi THEN 0 ELSE coalesce(lead_time_seconds, -1e308) END DESC, annotation_id) = 1""",
)
def q_resolve_duplicates(spark, sf_dir):
    """Groups of one text, and the smaller groups of one text and annotator
    (mostly one or two rows, so that the rule for two equal labels bites)."""
    c = cleaned(spark, sf_dir)
    both = F.concat("student_code", F.lit(": "), F.col("text.d0").cast("string"), F.lit(" "), F.col("text.d1").cast("string"))
    own = c.selected.withColumn("text", C.text_reference(both))
    keep = ["annotation_id", "student_code", "label_numeric", "lead_time_seconds"]
    by_text = c.deduped.select(F.lit("by_text").alias("groups"), *keep)
    by_both = C.resolve_duplicates(own).select(F.lit("by_text_and_annotator").alias("groups"), *keep)
    return by_text.unionByName(by_both)


# --- annotator quality + funnel -------------------------------------------------


@query(
    "annotator_lead_times",
    CLEAN + """
SELECT student_code, round(avg(lead_time_seconds), 6) AS mean_lead_time,
       round(quantile_cont(lead_time_seconds, 0.5), 6) AS median_lead_time,
       count(lead_time_seconds) AS n_lead_times, count(*) AS n_rows
FROM long_enough GROUP BY student_code""",
)
def q_annotator_lead_times(spark, sf_dir):
    return C.annotator_lead_times(cleaned(spark, sf_dir).long_enough)


@query(
    "removed_annotators",
    CLEAN + """
SELECT student_code, round(mean_lead_time, 6) AS mean_lead_time, n_rows FROM rushed""",
)
def q_removed_annotators(spark, sf_dir):
    r = C.removed_annotators(cleaned(spark, sf_dir).long_enough, DRIVER_MIN_MEAN_LEAD)
    return r.select("student_code", F.round("mean_lead_time", 6).alias("mean_lead_time"), "n_rows")


@query(
    "remove_rushed_annotators",
    CLEAN + """
SELECT annotation_id, student_code, label_numeric, text_length FROM train""",
)
def q_remove_rushed_annotators(spark, sf_dir):
    return cleaned(spark, sf_dir).train.select("annotation_id", "student_code", "label_numeric", "text_length")


@query(
    "cleaning_funnel",
    CLEAN + """,
c AS (SELECT (SELECT count(*) FROM ann) AS initial, (SELECT count(*) FROM working) AS holdout,
             (SELECT count(*) FROM deduped) AS duplicates, (SELECT count(*) FROM long_enough) AS short_texts,
             (SELECT count(*) FROM train) AS rushed, (SELECT count(*) FROM test) AS test),
s(step_no, step, records_before, records_after) AS (
  SELECT 1, 'holdout', initial, holdout FROM c UNION ALL
  SELECT 2, 'duplicates', holdout, duplicates FROM c UNION ALL
  SELECT 3, 'short_texts', duplicates, short_texts FROM c UNION ALL
  SELECT 4, 'rushed_annotators', short_texts, rushed FROM c UNION ALL
  SELECT 5, 'final_train', initial, rushed FROM c UNION ALL
  SELECT 6, 'final_test', initial, test FROM c UNION ALL
  SELECT 7, 'final_total', initial, rushed + test FROM c)
SELECT CAST(step_no AS INTEGER) AS step_no, step, CAST(records_before AS BIGINT) AS records_before,
       CAST(records_after AS BIGINT) AS records_after,
       CASE WHEN step_no <= 4 THEN CAST(records_before - records_after AS BIGINT) END AS removed,
       CASE WHEN step_no <= 4 THEN round((records_before - records_after) * 100.0 / records_before, 6) END AS pct_removed
FROM s""",
)
def q_cleaning_funnel(spark, sf_dir):
    return C.cleaning_funnel(cleaned(spark, sf_dir))
