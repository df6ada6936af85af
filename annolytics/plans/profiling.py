"""Registered queries: profiling aggregations (§2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from annolytics.operators import clean as C
from annolytics.operators import profile as P
from annolytics.plans.cleaning import cleaned, working
from annolytics.plans.oracle import ANN, CLEAN
from annolytics.plans.registry import query
from annolytics.session import cut_lineage
from annolytics.sources.views import annotations_v


@query(
    "dataset_stats",
    CLEAN + """,
t AS (SELECT 'train' AS split, text, student_code, text_length, lead_time_seconds FROM train
      UNION ALL
      SELECT 'test', text, student_code, CAST(length(text) AS INTEGER), lead_time_seconds FROM test)
SELECT split, count(*) AS n_rows, count(DISTINCT text) AS n_unique_texts, count(DISTINCT student_code) AS n_annotators,
       round(avg(text_length), 6) AS mean_text_length, round(quantile_cont(text_length, 0.5), 6) AS median_text_length,
       round(avg(lead_time_seconds), 6) AS mean_lead_time, round(quantile_cont(lead_time_seconds, 0.5), 6) AS median_lead_time
FROM t GROUP BY split""",
)
def q_dataset_stats(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return P.dataset_stats(c.train, "train").unionByName(P.dataset_stats(c.test, "test"))


@query(
    "label_distribution",
    CLEAN + """
SELECT label_numeric, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
FROM train WHERE label_numeric IS NOT NULL GROUP BY label_numeric""",
)
def q_label_distribution(spark, sf_dir):
    return P.label_distribution(cleaned(spark, sf_dir).train)


@query(
    "label_text_distribution",
    CLEAN + """
SELECT label_text, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
FROM working WHERE label_text IS NOT NULL GROUP BY label_text""",
)
def q_label_text_distribution(spark, sf_dir):
    return P.label_text_distribution(working(spark, sf_dir))


@query(
    "cumulative_label_distribution",
    CLEAN + """,
g AS (SELECT label_numeric, count(*) AS n FROM train WHERE label_numeric IS NOT NULL GROUP BY 1)
SELECT label_numeric, n, CAST(sum(n) OVER (ORDER BY label_numeric) AS BIGINT) AS cum_n,
       round(sum(n) OVER (ORDER BY label_numeric) * 100.0 / sum(n) OVER (), 6) AS cum_pct
FROM g""",
)
def q_cumulative_label_distribution(spark, sf_dir):
    return P.cumulative_label_distribution(cleaned(spark, sf_dir).train)


@query(
    "dataset_overview",
    CLEAN + """
SELECT count(*) AS n_rows, count(DISTINCT text) AS n_unique_texts, count(DISTINCT student_code) AS n_annotators,
       count(DISTINCT source_file) AS n_source_files,
       round(avg(length(text)), 6) AS mean_text_length, round(quantile_cont(length(text), 0.5), 6) AS median_text_length,
       CAST(min(length(text)) AS INTEGER) AS min_text_length, CAST(max(length(text)) AS INTEGER) AS max_text_length,
       round(avg(lead_time_seconds), 6) AS mean_lead_time, round(quantile_cont(lead_time_seconds, 0.5), 6) AS median_lead_time,
       round(count(*) / count(DISTINCT student_code), 6) AS mean_rows_per_annotator,
       round(count(*) FILTER (WHERE label_numeric >= 4) * 100.0 / count(*), 6) AS pct_easy,
       round(count(*) FILTER (WHERE label_numeric <= 2) * 100.0 / count(*), 6) AS pct_hard
FROM working""",
)
def q_dataset_overview(spark, sf_dir):
    return P.dataset_overview(working(spark, sf_dir, text=C.text_reference()))


@query(
    "records_per_annotator",
    CLEAN + """
SELECT student_code, count(*) AS n_rows FROM train GROUP BY student_code""",
)
def q_records_per_annotator(spark, sf_dir):
    return P.records_per_annotator(cleaned(spark, sf_dir).train)


@query(
    "records_per_annotator_summary",
    CLEAN + """,
g AS (SELECT student_code, count(*) AS n FROM train GROUP BY 1)
SELECT round(avg(n), 6) AS mean_rows, round(quantile_cont(n, 0.5), 6) AS median_rows, min(n) AS min_rows,
       max(n) AS max_rows, round(stddev_samp(n), 6) AS std_rows
FROM g""",
)
def q_records_per_annotator_summary(spark, sf_dir):
    return P.records_per_annotator_summary(cleaned(spark, sf_dir).train)


@query(
    "describe_numeric",
    CLEAN + """
SELECT 'text_length' AS "column", count(text_length) AS count, round(avg(text_length), 6) AS mean,
       round(stddev_samp(text_length), 6) AS std, round(CAST(min(text_length) AS DOUBLE), 6) AS min,
       round(quantile_cont(text_length, 0.25), 6) AS p25, round(quantile_cont(text_length, 0.5), 6) AS p50,
       round(quantile_cont(text_length, 0.75), 6) AS p75, round(CAST(max(text_length) AS DOUBLE), 6) AS max
FROM train
UNION ALL
SELECT 'lead_time_seconds', count(lead_time_seconds), round(avg(lead_time_seconds), 6),
       round(stddev_samp(lead_time_seconds), 6), round(min(lead_time_seconds), 6),
       round(quantile_cont(lead_time_seconds, 0.25), 6), round(quantile_cont(lead_time_seconds, 0.5), 6),
       round(quantile_cont(lead_time_seconds, 0.75), 6), round(max(lead_time_seconds), 6)
FROM train""",
)
def q_describe_numeric(spark, sf_dir):
    return P.describe_numeric(cleaned(spark, sf_dir).train)


@query(
    "percentile_table",
    CLEAN + """
SELECT 'text_length' AS "column", CAST(unnest([1, 5, 10, 25, 50, 75, 90, 95, 99]) AS INTEGER) AS percentile,
       round(unnest(quantile_cont(text_length, [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])), 6) AS value,
       round(unnest(list_transform(quantile_cont(text_length, [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]), lambda x: x / 60.0)), 6) AS value_minutes
FROM train
UNION ALL
SELECT 'lead_time_seconds', CAST(unnest([5, 10, 25, 50, 75, 90, 95, 99]) AS INTEGER),
       round(unnest(quantile_cont(lead_time_seconds, [0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])), 6),
       round(unnest(list_transform(quantile_cont(lead_time_seconds, [0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]), lambda x: x / 60.0)), 6)
FROM train""",
)
def q_percentile_table(spark, sf_dir):
    return P.percentile_table(cleaned(spark, sf_dir).train)


@query(
    "lead_time_units",
    CLEAN + """
SELECT round(avg(lead_time_seconds), 6) AS mean_seconds, round(avg(lead_time_seconds) / 60.0, 6) AS mean_minutes,
       round(quantile_cont(lead_time_seconds, 0.5), 6) AS median_seconds,
       round(quantile_cont(lead_time_seconds, 0.5) / 60.0, 6) AS median_minutes,
       round(min(lead_time_seconds), 6) AS min_seconds, round(min(lead_time_seconds) / 60.0, 6) AS min_minutes,
       round(max(lead_time_seconds), 6) AS max_seconds, round(max(lead_time_seconds) / 60.0, 6) AS max_minutes
FROM train""",
)
def q_lead_time_units(spark, sf_dir):
    return P.lead_time_units(cleaned(spark, sf_dir).train)


@query(
    "lead_time_by_label",
    CLEAN + """
SELECT label_numeric, count(*) AS n, round(avg(lead_time_seconds), 6) AS mean_lead_time,
       round(quantile_cont(lead_time_seconds, 0.5), 6) AS median_lead_time,
       round(stddev_samp(lead_time_seconds), 6) AS std_lead_time
FROM train WHERE label_numeric IS NOT NULL GROUP BY label_numeric""",
)
def q_lead_time_by_label(spark, sf_dir):
    return P.lead_time_by_label(cleaned(spark, sf_dir).train)


@query(
    "missing_values",
    ANN + """
SELECT 'annotation_id' AS "column", count(*) FILTER (WHERE annotation_id IS NULL) AS n_missing FROM ann UNION ALL
SELECT 'student_code', count(*) FILTER (WHERE student_code IS NULL) FROM ann UNION ALL
SELECT 'source_file', count(*) FILTER (WHERE source_file IS NULL) FROM ann UNION ALL
SELECT 'text', count(*) FILTER (WHERE text IS NULL) FROM ann UNION ALL
SELECT 'label_text', count(*) FILTER (WHERE label_text IS NULL) FROM ann UNION ALL
SELECT 'label_numeric', count(*) FILTER (WHERE label_numeric IS NULL) FROM ann UNION ALL
SELECT 'annotation_created_at', count(*) FILTER (WHERE annotation_created_at IS NULL) FROM ann UNION ALL
SELECT 'lead_time_seconds', count(*) FILTER (WHERE lead_time_seconds IS NULL OR isnan(lead_time_seconds)) FROM ann""",
)
def q_missing_values(spark, sf_dir):
    return P.missing_values(annotations_v(spark, sf_dir))


@query(
    "annotator_vs_overall",
    CLEAN + """,
s AS (SELECT 'overall' AS scope, * FROM train UNION ALL SELECT 'U05', * FROM train WHERE student_code = 'U05')
SELECT scope, count(*) AS n_rows, round(avg(lead_time_seconds), 6) AS mean_lead_time,
       round(quantile_cont(lead_time_seconds, 0.5), 6) AS median_lead_time,
       round(count(*) FILTER (WHERE label_numeric = 1) * 100.0 / count(label_numeric), 6) AS pct_label_1,
       round(count(*) FILTER (WHERE label_numeric = 2) * 100.0 / count(label_numeric), 6) AS pct_label_2,
       round(count(*) FILTER (WHERE label_numeric = 3) * 100.0 / count(label_numeric), 6) AS pct_label_3,
       round(count(*) FILTER (WHERE label_numeric = 4) * 100.0 / count(label_numeric), 6) AS pct_label_4,
       round(count(*) FILTER (WHERE label_numeric = 5) * 100.0 / count(label_numeric), 6) AS pct_label_5
FROM s GROUP BY scope""",
)
def q_annotator_vs_overall(spark, sf_dir):
    return P.annotator_vs_overall(cleaned(spark, sf_dir).train, "U05")


@query(
    "histogram",
    CLEAN + """,
h AS (SELECT 'text_length' AS measure, CAST(text_length AS DOUBLE) AS v FROM train
      UNION ALL SELECT 'lead_time_seconds', lead_time_seconds FROM train WHERE lead_time_seconds <= 120
      UNION ALL SELECT 'rows_per_annotator', CAST(count(*) AS DOUBLE) FROM train GROUP BY student_code),
cfg(measure, bins) AS (VALUES ('text_length', 50), ('lead_time_seconds', 50), ('rows_per_annotator', 15)),
r AS (SELECT measure, min(v) AS mn, max(v) AS mx FROM h WHERE v IS NOT NULL GROUP BY measure),
r2 AS (SELECT r.measure, c.bins, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
              CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi
       FROM r JOIN cfg c ON c.measure = r.measure),
b AS (SELECT h.measure, least(r2.bins - 1, CAST(floor((v - lo) / ((hi - lo) / r2.bins)) AS INTEGER)) AS bin
      FROM h JOIN r2 ON r2.measure = h.measure WHERE v IS NOT NULL),
grid AS (SELECT measure, lo, hi, bins, unnest(range(0, bins)) AS bin FROM r2)
SELECT g.measure, CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * (hi - lo) / bins, 6) AS bin_lo,
       round(lo + (g.bin + 1) * (hi - lo) / bins, 6) AS bin_hi, CAST(count(b.bin) AS BIGINT) AS n
FROM grid g LEFT JOIN b ON b.measure = g.measure AND b.bin = g.bin
GROUP BY g.measure, g.bin, lo, hi, bins""",
)
def q_histogram(spark, sf_dir):
    t = cut_lineage(cleaned(spark, sf_dir).train.select("student_code", "text_length", "lead_time_seconds"))
    a = P.histogram(t, "text_length", 50).select(F.lit("text_length").alias("measure"), "*")
    b = P.histogram(t, "lead_time_seconds", 50, upper=120.0).select(F.lit("lead_time_seconds").alias("measure"), "*")
    per = P.records_per_annotator(t)
    c = P.histogram(per, "n_rows", 15).select(F.lit("rows_per_annotator").alias("measure"), "*")
    return a.unionByName(b).unionByName(c).select("measure", F.col("bin").cast("int").alias("bin"), "bin_lo", "bin_hi", F.col("n").cast("long").alias("n"))


@query(
    "box_stats",
    CLEAN + """,
q AS (SELECT label_numeric, count(*) AS n, quantile_cont(text_length, 0.25) AS q1,
             quantile_cont(text_length, 0.5) AS med, quantile_cont(text_length, 0.75) AS q3
      FROM train WHERE label_numeric IS NOT NULL GROUP BY label_numeric)
SELECT q.label_numeric, q.n, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
       round(CAST(min(t.text_length) FILTER (WHERE t.text_length BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE), 6) AS whisker_low,
       round(CAST(max(t.text_length) FILTER (WHERE t.text_length BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE), 6) AS whisker_high,
       count(*) FILTER (WHERE NOT (t.text_length BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM train t JOIN q ON q.label_numeric = t.label_numeric
GROUP BY q.label_numeric, q.n, q1, med, q3""",
)
def q_box_stats(spark, sf_dir):
    t = cleaned(spark, sf_dir).train.filter(F.col("label_numeric").isNotNull())
    return P.box_stats(t, "text_length", by=["label_numeric"])


@query(
    "ecdf",
    CLEAN + """,
g AS (SELECT text_length, count(*) AS n FROM train GROUP BY 1)
SELECT text_length, n, CAST(sum(n) OVER (ORDER BY text_length) AS BIGINT) AS cum_n,
       round(sum(n) OVER (ORDER BY text_length) * 100.0 / sum(n) OVER (), 6) AS cum_pct
FROM g""",
)
def q_ecdf(spark, sf_dir):
    return P.ecdf(cleaned(spark, sf_dir).train, "text_length")


@query(
    "length_lead_correlation",
    CLEAN + """
SELECT count(*) AS n, round(corr(text_length, lead_time_seconds), 6) AS pearson_r
FROM train WHERE text_length IS NOT NULL AND lead_time_seconds IS NOT NULL""",
)
def q_length_lead_correlation(spark, sf_dir):
    return P.correlation(cleaned(spark, sf_dir).train, "text_length", "lead_time_seconds")


@query(
    "post_filter_stats",
    CLEAN + """
SELECT count(*) AS n_rows, min(text_length) AS min_text_length, max(text_length) AS max_text_length,
       round(avg(text_length), 6) AS mean_text_length, round(quantile_cont(text_length, 0.5), 6) AS median_text_length,
       count(DISTINCT student_code) AS n_annotators,
       round(count(*) / count(DISTINCT student_code), 6) AS mean_rows_per_annotator,
       round(count(*) FILTER (WHERE label_numeric = 1) * 100.0 / count(label_numeric), 6) AS pct_label_1,
       round(count(*) FILTER (WHERE label_numeric = 2) * 100.0 / count(label_numeric), 6) AS pct_label_2,
       round(count(*) FILTER (WHERE label_numeric = 3) * 100.0 / count(label_numeric), 6) AS pct_label_3,
       round(count(*) FILTER (WHERE label_numeric = 4) * 100.0 / count(label_numeric), 6) AS pct_label_4,
       round(count(*) FILTER (WHERE label_numeric = 5) * 100.0 / count(label_numeric), 6) AS pct_label_5
FROM long_enough""",
)
def q_post_filter_stats(spark, sf_dir):
    return P.post_filter_stats(cleaned(spark, sf_dir).long_enough)
