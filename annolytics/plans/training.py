"""Registered queries: Spark ML models (§2.9), batch scoring (I3) and the
composite jobs J2-J5 (§2.12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from annolytics.functions import text as T
from annolytics.functions.stats import hash_filter
from annolytics.operators import boosting as BO
from annolytics.operators import clean as C
from annolytics.operators import evaluate as E
from annolytics.operators import features as FE
from annolytics.operators import models as M
from annolytics.operators import profile as P
from annolytics.operators import score as S
from annolytics.operators import split as W
from annolytics.operators import vocab as V
from annolytics.plans.annotators import CHI
from annolytics.plans.oracle import CLEAN
from annolytics.plans.registry import DRIVER_MIN_MEAN_LEAD, DRIVER_RULES, query
from annolytics.session import cut_lineage
from annolytics.sources import exports as X
from annolytics.sources import tables as TB
from annolytics.sources.views import annotations_v, read_table
from annolytics.stages import Stages

KEEP = ["annotation_id", "label_numeric"]


def model_data(spark, sf_dir):
    """Standardised features of the cleaned training rows and the labelled
    hold-out rows, with vector/label/weight columns; checkpointed once so
    every fit and fold reads the materialised rows, not the whole lineage."""
    from annolytics.plans.textual import split_features

    tr, te = split_features(spark, sf_dir, *KEEP, labelled=True)
    ztr, zte = FE.standardise_features(tr, te, keep=KEEP)
    folds = W.stratified_folds(ztr, key="annotation_id")
    train = M.training_table(M.with_ml_columns(folds))
    test = M.with_ml_columns(zte, weighted=False)
    return train, test


def _model_stages(stages, spark, sf_dir):
    """``model_data`` as two stages of a job.  Vectors are put together again
    after reading, so that the stored tables hold plain columns."""
    made = []

    def part(i):
        def build():
            if not made:
                made.extend(model_data(spark, sf_dir))
            return made[i].drop("features")

        return build

    return tuple(M.assemble(stages.table(name, part(i))) for i, name in enumerate(("train", "test")))


def _report(preds_by_split) -> object:
    """split, n, accuracy, within_1, macro_f1 for predicted tables."""
    out = None
    for name, p in preds_by_split:
        p = cut_lineage(p.withColumn("split", F.lit(name)))  # the model runs once
        acc = E.within_k_accuracy(p, ks=(1,)).join(E.exact_accuracy(p).drop("n"), "split")
        f1 = E.f1_averages(p).select("split", "macro_f1")
        r = acc.join(f1, "split").select("split", "n", "accuracy", "within_1", "macro_f1")
        out = r if out is None else out.unionByName(r)
    return out


def _fit_report(estimator, spark, sf_dir):
    train, test = model_data(spark, sf_dir)
    model = estimator(train).fit(train)
    return _report([("train", M.predict(model, train, KEEP)), ("test", M.predict(model, test, KEEP))])


def _count(df) -> int:
    return df.count()


@query("train_logistic")
def q_train_logistic(spark, sf_dir):
    return _fit_report(lambda tr: M.logistic_regression(_count(tr)), spark, sf_dir)


@query("train_random_forest")
def q_train_random_forest(spark, sf_dir):
    return _fit_report(lambda tr: M.random_forest(), spark, sf_dir)


@query("train_gradient_boosting")
def q_train_gradient_boosting(spark, sf_dir):
    train, test = model_data(spark, sf_dir)
    model, _ = BO.fit_boosting(train, T.ALL_FEATURES, M.BOOST_ROUNDS, M.BOOST_DEPTH, M.BOOST_RATE)
    return _report([("train", M.predict(model, train, KEEP)), ("test", M.predict(model, test, KEEP))])


def _candidates(train):
    """Name -> function that returns the accuracies of the folds (M5) and a
    function that returns the model of all rows.  The boosting fits of the
    folds and of all rows share their passes."""

    def logistic(rows):
        return M.logistic_regression(rows.count())

    def boosting():
        model, folds = BO.fit_boosting(train, T.ALL_FEATURES, M.BOOST_ROUNDS, M.BOOST_DEPTH, M.BOOST_RATE, fold="fold")
        return folds, lambda: model

    return {
        "logistic_regression": lambda: (M.cross_validate(logistic, train)["fold_accuracies"], lambda: logistic(train).fit(train)),
        "random_forest": lambda: (M.cross_validate(M.random_forest(), train)["fold_accuracies"], lambda: M.random_forest().fit(train)),
        "gradient_boosting": boosting,
    }


def _cross_validated(train) -> dict[str, tuple]:
    """Candidate -> (mean and standard deviation of the fold accuracies, and
    the function that fits all rows)."""
    out = {}
    for name, run in _candidates(train).items():
        folds, fit = run()
        out[name] = (*M.mean_and_std(folds), fit)
    return out


@query("cross_validate_models")
def q_cross_validate_models(spark, sf_dir):
    train, _ = model_data(spark, sf_dir)
    rows = [(n, float(mean), float(std)) for n, (mean, std, _) in _cross_validated(train).items()]
    best = max(rows, key=lambda r: r[1])[0]
    return spark.createDataFrame(
        [(n, m, s, n == best) for n, m, s in rows], "model string, mean_accuracy double, std_accuracy double, best boolean"
    )


@query("train_ridge")
def q_train_ridge(spark, sf_dir):
    train, test = model_data(spark, sf_dir)
    model = M.ridge_regression(train)
    tr = M.ridge_predict(model, train).withColumn("split", F.lit("train"))
    te = M.ridge_predict(model, test).withColumn("split", F.lit("test"))
    return E.regression_report(tr.unionByName(te))


@query("feature_importance")
def q_feature_importance(spark, sf_dir):
    train, _ = model_data(spark, sf_dir)
    return M.feature_importance(M.random_forest().fit(train))


@query("train_bow_mlp")
def q_train_bow_mlp(spark, sf_dir):
    from annolytics.plans.cleaning import cleaned, with_texts

    c = cleaned(spark, sf_dir)
    tr, te = (r.filter(F.col("label_numeric").isNotNull()).select(*KEEP, "text") for r in (c.train, c.test))
    tr, te = (with_texts(spark, sf_dir, cut_lineage(r)) for r in (tr, te))
    vocab = V.build_vocabulary(tr)
    tokens = [r["token"] for r in vocab.orderBy("idx").collect()]  # <= max_features rows
    label0 = (F.col("label_numeric") - 1).cast("double")
    vtr, vte = (V.bag_of_words_vectors(r, tokens).drop("text").withColumn("label0", label0) for r in (tr, te))
    vtr = M.training_table(vtr)
    model = M.bow_mlp(len(tokens)).fit(vtr)
    return _report([("train", M.predict(model, vtr, KEEP)), ("test", M.predict(model, vte, KEEP))])


@query("fit_predict_report")
def q_fit_predict_report(spark, sf_dir):
    train, test = model_data(spark, sf_dir)
    scored = _cross_validated(train)
    best = max(scored, key=lambda n: scored[n][0])
    model = scored[best][2]()
    p = M.predict(model, train, KEEP).withColumn("split", F.lit("train")).unionByName(
        M.predict(model, test, KEEP).withColumn("split", F.lit("test"))
    )
    return E.classification_report(p).withColumn("model", F.lit(best))


def _score_documents(spark, sf_dir):
    """Fit the logistic model, then score every document text: features
    -> training standardisation -> model -> probabilities (batched on the
    executors by the model's transform)."""
    from annolytics.plans.cleaning import cleaned, with_texts

    c = cleaned(spark, sf_dir)
    tr = cut_lineage(T.text_features(with_texts(spark, sf_dir, c.train.select(*KEEP, "text"))))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    dfe = T.text_features(docs, keep_text=True)
    ztr, zdoc = FE.standardise_features(tr, dfe, keep=KEEP, keep_other=["doc_id", "text"])
    train = M.training_table(M.with_ml_columns(ztr))
    model = M.logistic_regression(train.count()).fit(train)
    return _scored(model, M.assemble(zdoc), ["doc_id", "text"])


def _scored(model, df, keep):
    """Class 1..5, p1..p5 and confidence of every row."""
    ps = [f"p{i}" for i in range(1, 6)]
    return S.score_texts(model, df).select(*keep, "predicted_label", *ps, "confidence")


@query("score_texts")
def q_score_texts(spark, sf_dir):
    s = _score_documents(spark, sf_dir)
    return S.score_records(s, index="doc_id", as_map=False)


def load_length_model():
    """A user's model as ``score_with_external_model`` takes it: called once in
    a Python worker, it returns the function from a batch of texts to logits.
    This one expects a difficulty that grows with the length of the text."""
    import numpy as np

    classes = np.arange(1, 6)

    def predict(texts: np.ndarray) -> np.ndarray:
        expected = 1.0 + np.minimum(np.array([len(t) for t in texts], dtype=float), 4000.0) / 1000.0
        distance = expected[:, None] - classes[None, :]
        return -distance * distance

    return predict


@query(
    "score_texts_external",
    """
WITH e AS (SELECT doc_id, text, 1.0E0 + least(length(coalesce(text, '')), 4000) / 1000.0E0 AS x FROM documents),
z AS (SELECT doc_id, text, -(x - 1) * (x - 1) AS z1, -(x - 2) * (x - 2) AS z2, -(x - 3) * (x - 3) AS z3,
             -(x - 4) * (x - 4) AS z4, -(x - 5) * (x - 5) AS z5 FROM e),
m AS (SELECT *, greatest(z1, z2, z3, z4, z5) AS m FROM z),
y AS (SELECT *, exp(z1 - m) + exp(z2 - m) + exp(z3 - m) + exp(z4 - m) + exp(z5 - m) AS s,
             list_position([z1, z2, z3, z4, z5], m) AS pred FROM m)
SELECT doc_id AS "index",
       CASE WHEN length(text) > 100 THEN concat(substring(text, 1, 100), '...') ELSE text END AS text,
       CAST(length(text) AS INTEGER) AS text_length, CAST(pred AS INTEGER) AS predicted_label,
       CASE pred WHEN 1 THEN 'Nagyon nehezen érthető (Very difficult)' WHEN 2 THEN 'Nehezen érthető (Difficult)'
         WHEN 3 THEN 'Többé-kevésbé érthető (Somewhat understandable)' WHEN 4 THEN 'Érthető (Understandable)'
         WHEN 5 THEN 'Könnyen érthető (Easily understandable)' END AS label_description,
       round(1.0 / s, 6) AS confidence, round(exp(z1 - m) / s, 6) AS p1, round(exp(z2 - m) / s, 6) AS p2,
       round(exp(z3 - m) / s, 6) AS p3, round(exp(z4 - m) / s, 6) AS p4, round(exp(z5 - m) / s, 6) AS p5
FROM y""",
)
def q_score_texts_external(spark, sf_dir):
    """I3 with a user's own model: every document in batches of 8."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    s = S.score_records(S.score_with_external_model(docs, "text", load_length_model), index="doc_id", as_map=False)
    return s.withColumns({c: F.round(c, 6) for c in ("confidence", "p1", "p2", "p3", "p4", "p5")})


# --- composite jobs ------------------------------------------------------------------


def _stages(spark, sf_dir, job, *params):
    """Resumable stages of a job over the annotation view."""
    inputs = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("documents", "events")]
    return Stages(spark, job, inputs, {"params": params})


@query(
    "clean_job",
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
FROM s
UNION ALL BY NAME
SELECT CAST(8 AS INTEGER) AS step_no, concat('stats_', split) AS step, count(*) AS n_rows, count(DISTINCT text) AS n_unique_texts,
       count(DISTINCT student_code) AS n_annotators,
       round(avg(text_length), 6) AS mean_text_length, round(quantile_cont(text_length, 0.5), 6) AS median_text_length,
       round(avg(lead_time_seconds), 6) AS mean_lead_time, round(quantile_cont(lead_time_seconds, 0.5), 6) AS median_lead_time
FROM (SELECT 'train' AS split, text, student_code, text_length, lead_time_seconds FROM train
      UNION ALL SELECT 'test', text, student_code, CAST(length(text) AS INTEGER), lead_time_seconds FROM test) t
GROUP BY split""",
)
def q_clean_job(spark, sf_dir):
    """CSV export (S6) -> read (S5) -> hold-out -> select -> duplicates
    (checkpointed: every later step reads it) -> length -> short filter ->
    rushed annotators -> write train/test (S7) -> funnel, and the statistics
    (G1) of what was written.

    The steps work on references; only the rows that S7 writes fetch their
    texts from the CSV."""
    from annolytics.plans.ingest import VIEW_COLUMNS

    a = annotations_v(spark, sf_dir).select(*VIEW_COLUMNS)
    with _stages(spark, sf_dir, "clean", DRIVER_RULES, DRIVER_MIN_MEAN_LEAD) as stages:
        path = f"{stages.folder}/csv"

        def read():
            return TB.read_annotations_csv(spark, path, schema=a.schema)

        def raw_rows():
            TB.write_annotations_csv(a, path, compression="gzip")
            return read().withColumn("text", C.text_reference())

        raw = stages.table("aggregated", raw_rows)
        working, test = C.holdout_split(raw, DRIVER_RULES)
        selected = C.select_training_columns(working)
        deduped = stages.table("deduped", lambda: C.add_text_length(C.resolve_duplicates(selected)))
        long_enough = C.filter_short_texts(deduped)
        train = stages.table("train", lambda: C.remove_rushed_annotators(long_enough, DRIVER_MIN_MEAN_LEAD))
        processed = X.scratch_path(spark, "processed")
        texts = read().select("annotation_id", "text", *[d.alias(f"d{i}") for i, d in enumerate(C.text_digest(a))])
        wanted = [r.select("annotation_id", "text.d0", "text.d1") for r in (train, test)]
        wanted = cut_lineage(wanted[0].unionByName(wanted[1]).filter(F.col("d0").isNotNull()))
        texts = cut_lineage(hash_filter(texts, wanted, ["annotation_id", "d0", "d1"]).select("text"))
        TB.write_train_test(C.attach_texts(train, texts), C.attach_texts(test, texts), processed)
        out = C.cleaning_funnel(C.Cleaned(raw, working, test, selected, deduped, long_enough, train, DRIVER_RULES, min_mean_lead=DRIVER_MIN_MEAN_LEAD))
        for split in ("train", "test"):
            stats = P.dataset_stats(spark.read.parquet(f"{processed}/{split}"))
            stats = stats.withColumns({"step_no": F.lit(8), "step": F.lit(f"stats_{split}")})
            out = out.unionByName(stats, allowMissingColumns=True)
        return stages.result(out, "clean-report")


@query(
    "bias_job",
    CHI + """,
mx AS (SELECT student_code,
       round(count(*) FILTER (WHERE label_numeric = 1) * 100.0 / count(*), 6) AS pct_label_1,
       round(count(*) FILTER (WHERE label_numeric = 2) * 100.0 / count(*), 6) AS pct_label_2,
       round(count(*) FILTER (WHERE label_numeric = 3) * 100.0 / count(*), 6) AS pct_label_3,
       round(count(*) FILTER (WHERE label_numeric = 4) * 100.0 / count(*), 6) AS pct_label_4,
       round(count(*) FILTER (WHERE label_numeric = 5) * 100.0 / count(*), 6) AS pct_label_5
       FROM d GROUP BY student_code)
SELECT res.*, mx.pct_label_1, mx.pct_label_2, mx.pct_label_3, mx.pct_label_4, mx.pct_label_5,
       CASE WHEN res.mean_label < 3.0 THEN '< 3.0' WHEN res.mean_label < 3.5 THEN '3.0-3.5'
            WHEN res.mean_label < 4.0 THEN '3.5-4.0' WHEN res.mean_label < 4.5 THEN '4.0-4.5' ELSE '>= 4.5' END AS band
FROM res JOIN mx ON mx.student_code = res.student_code""",
)
def q_bias_job(spark, sf_dir):
    """Cleaned set -> B1 -> B2 -> B4 -> B5 as one annotator table."""
    from annolytics.operators import bias as B
    from annolytics.plans.cleaning import cleaned

    with _stages(spark, sf_dir, "bias", DRIVER_RULES, DRIVER_MIN_MEAN_LEAD) as stages:
        t = stages.table("train", lambda: cleaned(spark, sf_dir).train)
        chi = B.annotator_chi_square(t)
        mat = B.annotator_label_matrix(t).drop("mean_label")
        return stages.result(chi.join(mat, "student_code").withColumn("band", B.band_of(F.col("mean_label"))), "bias-report")


@query("features_train_job")
def q_features_train_job(spark, sf_dir):
    """Features -> standardise -> weights -> LR / RF / GBT / ridge ->
    cross-validation (M5, the three classifiers) -> evaluation per model and
    split.  Rows of split ``cross_validation`` hold mean and standard
    deviation of the folds' accuracies."""
    with _stages(spark, sf_dir, "features-train", DRIVER_RULES, DRIVER_MIN_MEAN_LEAD) as stages:
        train, test = _model_stages(stages, spark, sf_dir)
        n = train.count()
        columns = "split string, n long, accuracy double, within_1 double, macro_f1 double, model string, std_accuracy double"

        def report(name, run):
            """Rows of one model: cross-validation, training and test rows."""
            folds, fit = run()
            m = fit()
            rows = _report([("train", M.predict(m, train, KEEP)), ("test", M.predict(m, test, KEEP))])
            mean, std = M.mean_and_std(folds)
            cv = spark.createDataFrame([("cross_validation", n, round(mean, 6), round(std, 6))], "split string, n long, accuracy double, std_accuracy double")
            return rows.unionByName(cv, allowMissingColumns=True).withColumn("model", F.lit(name))

        def ridge_report():
            m = M.ridge_regression(train)
            rows = _report([(s, M.ridge_predict(m, d).drop("score")) for s, d in (("train", train), ("test", test))])
            return rows.withColumns({"model": F.lit("ridge"), "std_accuracy": F.lit(None).cast("double")})

        names = [c.split()[0] for c in columns.split(", ")]
        parts = [stages.table(f"report-{name}", lambda name=name, run=run: report(name, run).select(*names)) for name, run in _candidates(train).items()]
        parts.append(stages.table("report-ridge", lambda: ridge_report().select(*names)))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return stages.result(out, "features-train-report")


def _evaluated(s, weights, splits=("validation", "test")):
    """E1-E13, one row per split, of (true_label, predicted_label, p1..p5,
    split); ``weights`` are the (label, weight) rows of the training set."""
    ps = [f"p{i}" for i in range(1, 6)]
    # log-probabilities are logits; the expected class is the score
    s = s.withColumns({f"z{i + 1}": F.log(F.greatest(F.col(p), F.lit(1e-300))) for i, p in enumerate(ps)})
    s = s.withColumn("score", sum((F.lit(i + 1) * F.col(p) for i, p in enumerate(ps)), F.lit(0.0)))
    recall = E.per_class_recall(s, splits)
    recall = recall.agg(F.sort_array(F.collect_list(F.struct("label", *[f"recall_{x}" for x in splits]))).alias("recall_by_split"))

    def rows(df, name):
        cells = F.struct(*[c for c in df.columns if c != "split"])
        return df.groupBy("split").agg(F.sort_array(F.collect_list(cells)).alias(name))

    reg = E.regression_report(s).drop("n")
    parts = [
        E.exact_accuracy(s).drop("n"),
        E.f1_averages(s).drop("accuracy"),
        E.quadratic_weighted_kappa(s).drop("n"),
        E.mean_absolute_error(s).drop("n"),
        E.mean_squared_error(s).drop("n"),
        E.weighted_cross_entropy(s, weights=weights).drop("n"),
        E.focal_loss(s, weights=weights).drop("n"),
        E.evaluation_summary(s, weights=weights).select("split", "loss"),
        reg.select("split", *[F.col(c).alias(f"regression_{c}") for c in reg.columns if c != "split"]),
        rows(E.confusion_matrix(s), "confusion_matrix"),
        rows(E.classification_report(s), "classification_report"),
    ]
    out = E.within_k_accuracy(s)
    for p in parts:
        out = out.join(p, "split")
    return out.crossJoin(F.broadcast(recall))  # one row


@query("score_evaluate_job")
def q_score_evaluate_job(spark, sf_dir):
    """Fit on four of the five training folds, score the fifth
    (validation) and the hold-out texts (test) in batches (I3 -> I1 -> I2),
    summarise the predictions (I4) and evaluate them against the annotators'
    labels (E1-E13): one row per split.  Features are standardised by all
    training rows, as in M5."""
    with _stages(spark, sf_dir, "score-evaluate", DRIVER_RULES, DRIVER_MIN_MEAN_LEAD) as stages:
        return stages.result(_scored_and_evaluated(stages, spark, sf_dir), "score-evaluate-report")


def _scored_and_evaluated(stages, spark, sf_dir):
    train, test = _model_stages(stages, spark, sf_dir)
    fit = train.filter("fold <> 0")
    weights = W.class_weights(fit).select("label", "weight")
    rows = fit.drop("weight").join(F.broadcast(weights.withColumnRenamed("label", "label_numeric")), "label_numeric")
    model = M.logistic_regression(fit.count()).fit(rows)
    s = _scored(model, train.filter("fold = 0"), KEEP).withColumn("split", F.lit("validation"))
    s = s.unionByName(_scored(model, test, KEEP).withColumn("split", F.lit("test")))
    scored = s.withColumn("true_label", F.col("label_numeric"))
    s = stages.table("scored", lambda: scored)
    summary = None
    for name in ("validation", "test"):
        one = S.prediction_summary(s.filter(F.col("split") == name)).withColumn("split", F.lit(name))
        summary = one if summary is None else summary.unionByName(one)
    return summary.join(_evaluated(s, weights), "split")
