"""Registered queries: annotator bias (§2.5) and splits / weights (§2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from annolytics.operators import bias as B
from annolytics.operators import split as W
from annolytics.plans.cleaning import cleaned
from annolytics.plans.oracle import CLEAN
from annolytics.plans.registry import query

D = """,
d AS (SELECT * FROM train WHERE label_numeric IS NOT NULL)"""


def _train(spark, sf_dir):
    return cleaned(spark, sf_dir).train


@query(
    "overall_label_share",
    CLEAN + D + """
SELECT label_numeric, count(*) AS n, round(count(*) * 1.0 / (SELECT count(*) FROM d), 6) AS share
FROM d GROUP BY label_numeric""",
)
def q_overall_label_share(spark, sf_dir):
    s = B.overall_label_share(_train(spark, sf_dir))
    return s.select("label_numeric", "n", F.round("share", 6).alias("share"))


CHI = (
    CLEAN
    + D
    + """,
sh AS (SELECT label_numeric, count(*) * 1.0 / (SELECT count(*) FROM d) AS share FROM d GROUP BY 1),
an AS (SELECT student_code, count(*) AS n, avg(label_numeric) AS mean_label, stddev_samp(label_numeric) AS std_label
       FROM d GROUP BY 1),
ob AS (SELECT student_code, label_numeric, count(*) AS o FROM d GROUP BY 1, 2),
grid AS (SELECT an.student_code, an.n, sh.share, coalesce(ob.o, 0) AS o
         FROM an CROSS JOIN sh
         LEFT JOIN ob ON ob.student_code = an.student_code AND ob.label_numeric = sh.label_numeric),
chi AS (SELECT student_code, sum((o - share * n) * (o - share * n) / (share * n)) AS chi2 FROM grid GROUP BY 1),
res AS (SELECT an.student_code, an.n, round(mean_label, 6) AS mean_label, round(std_label, 6) AS std_label,
               round(chi2, 6) AS chi2, round(exp(-chi2 / 2) * (1 + chi2 / 2), 6) AS p_value,
               exp(-chi2 / 2) * (1 + chi2 / 2) < 0.05 AS significant
        FROM an JOIN chi ON chi.student_code = an.student_code)"""
)


@query("annotator_chi_square", CHI + "\nSELECT * FROM res")
def q_annotator_chi_square(spark, sf_dir):
    return B.annotator_chi_square(_train(spark, sf_dir))


@query(
    "biased_annotator_count",
    CHI + """
SELECT count(*) FILTER (WHERE significant) AS n_significant, count(*) AS n_annotators,
       round(count(*) FILTER (WHERE significant) * 100.0 / count(*), 6) AS pct_significant
FROM res""",
)
def q_biased_annotator_count(spark, sf_dir):
    return B.biased_annotator_count(B.annotator_chi_square(_train(spark, sf_dir)))


@query(
    "annotator_label_matrix",
    CLEAN + D + """
SELECT student_code,
       round(count(*) FILTER (WHERE label_numeric = 1) * 100.0 / count(*), 6) AS pct_label_1,
       round(count(*) FILTER (WHERE label_numeric = 2) * 100.0 / count(*), 6) AS pct_label_2,
       round(count(*) FILTER (WHERE label_numeric = 3) * 100.0 / count(*), 6) AS pct_label_3,
       round(count(*) FILTER (WHERE label_numeric = 4) * 100.0 / count(*), 6) AS pct_label_4,
       round(count(*) FILTER (WHERE label_numeric = 5) * 100.0 / count(*), 6) AS pct_label_5,
       round(avg(label_numeric), 6) AS mean_label
FROM d GROUP BY student_code""",
)
def q_annotator_label_matrix(spark, sf_dir):
    return B.annotator_label_matrix(_train(spark, sf_dir))


@query(
    "bias_bands",
    CLEAN + D + """,
m AS (SELECT student_code, avg(label_numeric) AS m FROM d GROUP BY 1),
b AS (SELECT student_code, CASE WHEN m < 3.0 THEN 0 WHEN m < 3.5 THEN 1 WHEN m < 4.0 THEN 2 WHEN m < 4.5 THEN 3 ELSE 4 END AS band_order
      FROM m),
names(band_order, band) AS (VALUES (0, '< 3.0'), (1, '3.0-3.5'), (2, '3.5-4.0'), (3, '4.0-4.5'), (4, '>= 4.5'))
SELECT n.band_order, n.band, count(b.student_code) AS n_annotators,
       coalesce(string_agg(b.student_code, ', ' ORDER BY b.student_code), '') AS members
FROM names n LEFT JOIN b ON b.band_order = n.band_order
GROUP BY n.band_order, n.band""",
)
def q_bias_bands(spark, sf_dir):
    return B.bias_bands(_train(spark, sf_dir))


# --- splits and weights ------------------------------------------------------------


SPLIT_SQL = (
    CLEAN
    + D
    + """,
c AS (SELECT label_numeric, count(*) AS n_c FROM d GROUP BY 1),
tot AS (SELECT sum(n_c) AS n, ceil(sum(n_c) * 0.2) AS v FROM c),
q AS (SELECT label_numeric, n_c, n_c * tot.v / tot.n AS q FROM c CROSS JOIN tot),
q2 AS (SELECT *, floor(q) AS fl, q - floor(q) AS fr FROM q),
q3 AS (SELECT *, row_number() OVER (ORDER BY fr DESC, label_numeric) AS pos,
              (SELECT v FROM tot) - sum(fl) OVER () AS lft FROM q2),
quota AS (SELECT label_numeric, fl + CASE WHEN pos <= lft THEN 1 ELSE 0 END AS n_val FROM q3),
rk AS (SELECT annotation_id, label_numeric,
              row_number() OVER (PARTITION BY label_numeric
                                 ORDER BY md5(concat('42', '|', CAST(annotation_id AS VARCHAR)))) AS rk
       FROM d),
sp AS (SELECT rk.annotation_id, rk.label_numeric, CASE WHEN rk <= n_val THEN 'validation' ELSE 'train' END AS split
       FROM rk JOIN quota ON quota.label_numeric = rk.label_numeric)"""
)


@query("stratified_split", SPLIT_SQL + "\nSELECT * FROM sp")
def q_stratified_split(spark, sf_dir):
    s = W.stratified_split(_train(spark, sf_dir), key="annotation_id")
    return s.select("annotation_id", "label_numeric", "split")


@query(
    "split_report",
    SPLIT_SQL + """,
g AS (SELECT split, label_numeric, count(*) AS n FROM sp GROUP BY 1, 2)
SELECT split, label_numeric, n, round(n * 100.0 / sum(n) OVER (PARTITION BY split), 6) AS pct_in_split,
       CAST(sum(n) OVER (PARTITION BY split) AS BIGINT) AS split_size,
       round(sum(n) OVER (PARTITION BY split) * 100.0 / sum(n) OVER (), 6) AS split_pct
FROM g""",
)
def q_split_report(spark, sf_dir):
    return W.split_report(W.stratified_split(_train(spark, sf_dir), key="annotation_id"))


@query(
    "class_weights",
    CLEAN + D + """,
c AS (SELECT label_numeric, count(*) AS n_c FROM d GROUP BY 1)
SELECT label_numeric AS label, n_c, round((SELECT sum(n_c) FROM c) * 1.0 / ((SELECT count(*) FROM c) * n_c), 6) AS weight
FROM c""",
)
def q_class_weights(spark, sf_dir):
    w = W.class_weights(_train(spark, sf_dir))
    return w.select("label", "n_c", F.round("weight", 6).alias("weight"))


@query(
    "inverse_frequency_weights",
    CLEAN + D + """,
c AS (SELECT label_numeric, count(*) AS n_c FROM d GROUP BY 1)
SELECT d.annotation_id, d.label_numeric, round(1.0 / c.n_c, 6) AS weight
FROM d JOIN c ON c.label_numeric = d.label_numeric""",
)
def q_inverse_frequency_weights(spark, sf_dir):
    w = W.inverse_frequency_weights(_train(spark, sf_dir), key="annotation_id")
    return w.select("annotation_id", "label_numeric", F.round("weight", 6).alias("weight"))


@query(
    "balanced_resample",
    CLEAN + D + """,
c AS (SELECT label_numeric, count(*) AS n_c, row_number() OVER (ORDER BY label_numeric) - 1 AS class FROM d GROUP BY 1),
rk AS (SELECT annotation_id, label_numeric,
              row_number() OVER (PARTITION BY label_numeric
                                 ORDER BY md5(concat('42', '|', CAST(annotation_id AS VARCHAR)))) AS rk
       FROM d),
u AS (SELECT CAST('0x' || substr(md5(concat('42', '|', 'draw|', CAST(i AS VARCHAR))), 1, 13) AS BIGINT) / 4503599627370496.0E0
             * (SELECT count(*) FROM c) AS u
      FROM range(0, (SELECT count(*) FROM d)) r(i))
SELECT rk.annotation_id, rk.label_numeric
FROM u JOIN c ON c.class = CAST(floor(u.u) AS BIGINT)
JOIN rk ON rk.label_numeric = c.label_numeric AND rk.rk = CAST(floor((u.u - floor(u.u)) * c.n_c) AS BIGINT) + 1""",
)
def q_balanced_resample(spark, sf_dir):
    s = W.balanced_resample(_train(spark, sf_dir), key="annotation_id")
    return s.select("annotation_id", "label_numeric")


@query(
    "capped_class_sample",
    CLEAN + D + """,
rk AS (SELECT annotation_id, label_numeric,
              row_number() OVER (PARTITION BY label_numeric
                                 ORDER BY md5(concat('42', '|', CAST(annotation_id AS VARCHAR)))) AS rk
       FROM d)
SELECT annotation_id, label_numeric FROM rk WHERE rk <= 7 ORDER BY label_numeric, rk LIMIT 32""",
)
def q_capped_class_sample(spark, sf_dir):
    t = _train(spark, sf_dir).filter(F.col("label_numeric").isNotNull())
    return W.capped_class_sample(t, key="annotation_id").select("annotation_id", "label_numeric")


@query(
    "stratified_folds",
    CLEAN + D + """
SELECT annotation_id, label_numeric,
       CAST((row_number() OVER (PARTITION BY label_numeric
                                ORDER BY md5(concat('42', '|', CAST(annotation_id AS VARCHAR)))) - 1) % 5 AS INTEGER) AS fold
FROM d""",
)
def q_stratified_folds(spark, sf_dir):
    f = W.stratified_folds(_train(spark, sf_dir), key="annotation_id")
    return f.select("annotation_id", "label_numeric", "fold")
