"""Registered queries: scoring (§2.10), evaluation (§2.11), majority baseline."""

from __future__ import annotations

from pyspark.sql import functions as F

from annolytics.operators import evaluate as E
from annolytics.operators import score as S
from annolytics.plans.cleaning import _SCORED, cleaned
from annolytics.plans.oracle import ANN, CLEAN
from annolytics.plans.registry import query
from annolytics.sources.views import logits_v, read_table, scored_v

SC = ANN + _SCORED

# Logits view (FIXTURES B3) with a split on the id, and balanced class weights
# of its true labels.
LG = """
WITH lg AS (
  SELECT vec_id, label % 5 + 1 AS true_label,
         CAST(embedding[1] AS DOUBLE) * 10 AS z1, CAST(embedding[2] AS DOUBLE) * 10 AS z2,
         CAST(embedding[3] AS DOUBLE) * 10 AS z3, CAST(embedding[4] AS DOUBLE) * 10 AS z4,
         CAST(embedding[5] AS DOUBLE) * 10 AS z5,
         CASE WHEN vec_id % 5 = 0 THEN 'test' ELSE 'validation' END AS split
  FROM embeddings),
cw AS (SELECT true_label, count(*) AS n_c FROM lg GROUP BY 1),
w AS (SELECT true_label, (SELECT count(*) FROM lg) / ((SELECT count(*) FROM cw) * n_c) AS weight FROM cw),
x AS (SELECT lg.*, w.weight, greatest(z1, z2, z3, z4, z5) AS m FROM lg JOIN w ON w.true_label = lg.true_label),
y AS (SELECT *, m + ln(exp(z1 - m) + exp(z2 - m) + exp(z3 - m) + exp(z4 - m) + exp(z5 - m))
                - [z1, z2, z3, z4, z5][true_label] AS nll,
             list_position([z1, z2, z3, z4, z5], m) AS pred,
             exp(z1 - m) + exp(z2 - m) + exp(z3 - m) + exp(z4 - m) + exp(z5 - m) AS s
      FROM x)"""


def _logits_split(spark, sf_dir):
    lg = logits_v(spark, sf_dir)
    return lg.withColumn("split", F.when(F.col("vec_id") % 5 == 0, "test").otherwise("validation"))


# --- scoring ---------------------------------------------------------------------------


@query(
    "softmax_scores",
    LG + """
SELECT vec_id, true_label, CAST(pred AS INTEGER) AS predicted_label,
       round(exp(z1 - m) / s, 6) AS p1, round(exp(z2 - m) / s, 6) AS p2, round(exp(z3 - m) / s, 6) AS p3,
       round(exp(z4 - m) / s, 6) AS p4, round(exp(z5 - m) / s, 6) AS p5, round(1.0 / s, 6) AS confidence
FROM y""",
)
def q_softmax_scores(spark, sf_dir):
    s = S.softmax_scores(logits_v(spark, sf_dir))
    return s.select(
        "vec_id", "true_label", "predicted_label", *[F.round(f"p{i}", 6).alias(f"p{i}") for i in range(1, 6)],
        F.round("confidence", 6).alias("confidence"),
    )


@query(
    "score_records",
    LG + """
SELECT y.vec_id AS "index",
       CASE WHEN length(d.text) > 100 THEN concat(substring(d.text, 1, 100), '...') ELSE d.text END AS text,
       CAST(length(d.text) AS INTEGER) AS text_length, CAST(pred AS INTEGER) AS predicted_label,
       CASE pred WHEN 1 THEN 'Nagyon nehezen érthető (Very difficult)' WHEN 2 THEN 'Nehezen érthető (Difficult)'
         WHEN 3 THEN 'Többé-kevésbé érthető (Somewhat understandable)' WHEN 4 THEN 'Érthető (Understandable)'
         WHEN 5 THEN 'Könnyen érthető (Easily understandable)' END AS label_description,
       round(1.0 / s, 6) AS confidence,
       round(exp(z1 - m) / s, 6) AS p1, round(exp(z2 - m) / s, 6) AS p2, round(exp(z3 - m) / s, 6) AS p3,
       round(exp(z4 - m) / s, 6) AS p4, round(exp(z5 - m) / s, 6) AS p5
FROM y JOIN documents d ON d.doc_id = y.vec_id""",
)
def q_score_records(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    s = S.softmax_scores(logits_v(spark, sf_dir)).join(docs, "vec_id")
    r = S.score_records(s, index="vec_id", as_map=False)
    return r.select(
        "index", "text", "text_length", "predicted_label", "label_description", F.round("confidence", 6).alias("confidence"),
        *[F.round(f"p{i}", 6).alias(f"p{i}") for i in range(1, 6)],
    )


@query(
    "prediction_summary",
    LG + """
SELECT count(*) AS total, round(avg(1.0 / s), 6) AS avg_confidence,
       count(*) FILTER (WHERE pred = 1) AS n_label_1, count(*) FILTER (WHERE pred = 2) AS n_label_2,
       count(*) FILTER (WHERE pred = 3) AS n_label_3, count(*) FILTER (WHERE pred = 4) AS n_label_4,
       count(*) FILTER (WHERE pred = 5) AS n_label_5,
       round(count(*) FILTER (WHERE pred = 1) * 100.0 / count(*), 6) AS pct_label_1,
       round(count(*) FILTER (WHERE pred = 2) * 100.0 / count(*), 6) AS pct_label_2,
       round(count(*) FILTER (WHERE pred = 3) * 100.0 / count(*), 6) AS pct_label_3,
       round(count(*) FILTER (WHERE pred = 4) * 100.0 / count(*), 6) AS pct_label_4,
       round(count(*) FILTER (WHERE pred = 5) * 100.0 / count(*), 6) AS pct_label_5
FROM y""",
)
def q_prediction_summary(spark, sf_dir):
    return S.prediction_summary(S.softmax_scores(logits_v(spark, sf_dir)))


# --- evaluation over scored_v -------------------------------------------------------------


@query(
    "exact_accuracy",
    SC + """
SELECT split, count(*) AS n, round(avg(CASE WHEN true_label = predicted_label THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM scored GROUP BY split""",
)
def q_exact_accuracy(spark, sf_dir):
    return E.exact_accuracy(scored_v(spark, sf_dir))


@query(
    "within_k_accuracy",
    SC + """
SELECT split, count(*) AS n,
       round(avg(CASE WHEN abs(true_label - predicted_label) <= 1 THEN 1.0 ELSE 0.0 END), 6) AS within_1,
       round(avg(CASE WHEN abs(true_label - predicted_label) <= 2 THEN 1.0 ELSE 0.0 END), 6) AS within_2
FROM scored GROUP BY split""",
)
def q_within_k_accuracy(spark, sf_dir):
    return E.within_k_accuracy(scored_v(spark, sf_dir))


@query(
    "confusion_matrix",
    SC + """
SELECT s.split, CAST(t.true_label AS INTEGER) AS true_label,
       count(sc.predicted_label) FILTER (WHERE sc.predicted_label = 1) AS pred_1,
       count(sc.predicted_label) FILTER (WHERE sc.predicted_label = 2) AS pred_2,
       count(sc.predicted_label) FILTER (WHERE sc.predicted_label = 3) AS pred_3,
       count(sc.predicted_label) FILTER (WHERE sc.predicted_label = 4) AS pred_4,
       count(sc.predicted_label) FILTER (WHERE sc.predicted_label = 5) AS pred_5
FROM (SELECT DISTINCT split FROM scored) s CROSS JOIN range(1, 6) t(true_label)
LEFT JOIN scored sc ON sc.split = s.split AND sc.true_label = t.true_label
GROUP BY s.split, t.true_label""",
)
def q_confusion_matrix(spark, sf_dir):
    return E.confusion_matrix(scored_v(spark, sf_dir))


_MARGINS = """,
m AS (
  SELECT split, label, CAST(sum(is_true) AS BIGINT) AS support, CAST(sum(is_pred) AS BIGINT) AS n_pred,
         CAST(sum(tp) AS BIGINT) AS tp
  FROM (SELECT split, true_label AS label, 1 AS is_true, 0 AS is_pred,
               CASE WHEN true_label = predicted_label THEN 1 ELSE 0 END AS tp FROM scored
        UNION ALL
        SELECT split, predicted_label, 0, 1, 0 FROM scored)
  GROUP BY split, label),
pr AS (
  SELECT split, label, support, tp,
         CASE WHEN n_pred = 0 THEN 0.0 ELSE tp * 1.0 / n_pred END AS p,
         CASE WHEN support = 0 THEN 0.0 ELSE tp * 1.0 / support END AS r
  FROM m),
prf AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM pr)"""


@query(
    "classification_report",
    SC + _MARGINS + """
SELECT split, label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM prf""",
)
def q_classification_report(spark, sf_dir):
    return E.classification_report(scored_v(spark, sf_dir))


@query(
    "f1_averages",
    SC + _MARGINS + """
SELECT split, round(sum(tp) * 1.0 / sum(support), 6) AS accuracy,
       round(avg(p), 6) AS macro_precision, round(avg(r), 6) AS macro_recall, round(avg(f), 6) AS macro_f1,
       round(sum(p * support) / sum(support), 6) AS weighted_precision,
       round(sum(r * support) / sum(support), 6) AS weighted_recall,
       round(sum(f * support) / sum(support), 6) AS weighted_f1
FROM prf GROUP BY split""",
)
def q_f1_averages(spark, sf_dir):
    return E.f1_averages(scored_v(spark, sf_dir))


@query(
    "per_class_recall",
    SC + """
SELECT true_label AS label,
       round(coalesce(avg(CASE WHEN true_label = predicted_label THEN 1.0 ELSE 0.0 END) FILTER (WHERE split = 'validation'), 0.0), 6) AS recall_validation,
       round(coalesce(avg(CASE WHEN true_label = predicted_label THEN 1.0 ELSE 0.0 END) FILTER (WHERE split = 'test'), 0.0), 6) AS recall_test
FROM scored GROUP BY true_label""",
)
def q_per_class_recall(spark, sf_dir):
    return E.per_class_recall(scored_v(spark, sf_dir), ["validation", "test"])


@query(
    "quadratic_weighted_kappa",
    SC + """,
g AS (SELECT split, count(*) AS n, sum((true_label - predicted_label) * (true_label - predicted_label)) AS obs
      FROM scored GROUP BY split),
r AS (SELECT split, true_label AS i, count(*) AS ri FROM scored GROUP BY 1, 2),
c AS (SELECT split, predicted_label AS j, count(*) AS cj FROM scored GROUP BY 1, 2),
e AS (SELECT r.split, sum((i - j) * (i - j) * ri * cj) AS ex FROM r JOIN c ON r.split = c.split GROUP BY 1)
SELECT g.split, g.n, round(1 - obs / (ex * 1.0 / n), 6) AS kappa FROM g JOIN e ON e.split = g.split""",
)
def q_quadratic_weighted_kappa(spark, sf_dir):
    return E.quadratic_weighted_kappa(scored_v(spark, sf_dir))


@query(
    "mean_absolute_error",
    SC + """
SELECT split, count(*) AS n, round(avg(abs(true_label - predicted_label)), 6) AS mae,
       round(avg(abs(true_label - score)), 6) AS mae_score
FROM scored GROUP BY split""",
)
def q_mean_absolute_error(spark, sf_dir):
    return E.mean_absolute_error(scored_v(spark, sf_dir))


@query(
    "mean_squared_error",
    SC + """
SELECT split, count(*) AS n, round(avg((score - true_label) * (score - true_label)), 6) AS mse
FROM scored GROUP BY split""",
)
def q_mean_squared_error(spark, sf_dir):
    return E.mean_squared_error(scored_v(spark, sf_dir))


@query(
    "regression_report",
    SC + """,
rr AS (SELECT *, CAST(least(5, greatest(1, round_even(score, 0))) AS INTEGER) AS cls FROM scored)
SELECT split, count(*) AS n, round(avg(abs(true_label - score)), 6) AS mae_raw,
       round(avg(abs(true_label - cls)), 6) AS mae_rounded,
       round(avg(CASE WHEN cls = true_label THEN 1.0 ELSE 0.0 END), 6) AS exact,
       round(avg(CASE WHEN abs(cls - true_label) <= 1 THEN 1.0 ELSE 0.0 END), 6) AS within_1,
       round(avg(CASE WHEN abs(cls - true_label) <= 2 THEN 1.0 ELSE 0.0 END), 6) AS within_2
FROM rr GROUP BY split""",
)
def q_regression_report(spark, sf_dir):
    return E.regression_report(scored_v(spark, sf_dir))


# --- losses over logits_v -----------------------------------------------------------------


@query(
    "weighted_cross_entropy",
    LG + """
SELECT count(*) AS n, round(sum(weight * nll) / sum(weight), 6) AS weighted_cross_entropy FROM y""",
)
def q_weighted_cross_entropy(spark, sf_dir):
    return E.weighted_cross_entropy(logits_v(spark, sf_dir))


@query(
    "focal_loss",
    LG + """
SELECT count(*) AS n, round(avg(pow(1 - exp(-(weight * nll)), 2.5) * (weight * nll)), 6) AS focal_loss FROM y""",
)
def q_focal_loss(spark, sf_dir):
    return E.focal_loss(logits_v(spark, sf_dir))


@query(
    "evaluation_summary",
    LG + """
SELECT split, count(*) AS n, round(sum(weight * nll) / sum(weight), 6) AS loss,
       round(avg(CASE WHEN pred = true_label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(avg(CASE WHEN abs(pred - true_label) <= 1 THEN 1.0 ELSE 0.0 END), 6) AS within_1,
       round(avg(CASE WHEN abs(pred - true_label) <= 2 THEN 1.0 ELSE 0.0 END), 6) AS within_2
FROM y GROUP BY split""",
)
def q_evaluation_summary(spark, sf_dir):
    # class weights come from the whole table, losses are reported per split
    return E.evaluation_summary(_logits_split(spark, sf_dir))


# --- majority baseline (M1) ----------------------------------------------------------------


@query(
    "majority_baseline",
    CLEAN + """,
cnt AS (SELECT label_numeric, count(*) AS n FROM train WHERE label_numeric IS NOT NULL GROUP BY 1),
top AS (SELECT label_numeric, n FROM cnt ORDER BY n DESC, label_numeric LIMIT 1)
SELECT (SELECT label_numeric FROM top) AS majority_label,
       round((SELECT n FROM top) * 1.0 / (SELECT sum(n) FROM cnt), 6) AS train_share,
       count(*) AS n_test,
       round(avg(CASE WHEN label_numeric = (SELECT label_numeric FROM top) THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(avg(CASE WHEN abs(label_numeric - (SELECT label_numeric FROM top)) <= 1 THEN 1.0 ELSE 0.0 END), 6) AS within_1
FROM test WHERE label_numeric IS NOT NULL""",
)
def q_majority_baseline(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return E.majority_baseline(c.train, c.test)
