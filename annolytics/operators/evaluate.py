"""Evaluation metrics over (true_label, predicted_label[,
score][, split]) tables.  Each metric is one grouped aggregate per split
(partial + final), so the cost is one scan whatever the table size; the
confusion matrix, kappa and F1 averages are built from per-label margins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolytics.functions.labels import score_to_class
from annolytics.functions.stats import ratio, ratio0

TRUE = "true_label"
PRED = "predicted_label"
SCORE = "score"
SPLIT = "split"
FOCAL_GAMMA = 2.5


def _by(df: DataFrame, split: str | None) -> list[str]:
    return [split] if split and split in df.columns else []


def _r(c: Column, name: str) -> Column:
    return F.round(c, 6).alias(name)


def exact_accuracy(df: DataFrame, split: str | None = SPLIT) -> DataFrame:
    """Share of rows with predicted == true."""
    return df.groupBy(*_by(df, split)).agg(
        F.count(F.lit(1)).alias("n"), _r(F.avg((F.col(TRUE) == F.col(PRED)).cast("double")), "accuracy")
    )


def within_k_accuracy(df: DataFrame, ks: Sequence[int] = (1, 2), split: str | None = SPLIT) -> DataFrame:
    """Share of rows with |true - predicted| <= k, for each k."""
    diff = F.abs(F.col(TRUE) - F.col(PRED))
    return df.groupBy(*_by(df, split)).agg(
        F.count(F.lit(1)).alias("n"), *[_r(F.avg((diff <= k).cast("double")), f"within_{k}") for k in ks]
    )


def confusion_matrix(df: DataFrame, k: int = 5, split: str | None = SPLIT) -> DataFrame:
    """Dense k x k counts (rows true 1..k, columns pred_1..pred_k), one
    aggregate of k*k conditional counts per split, unpivoted to k rows."""
    by = _by(df, split)
    aggs = [
        F.count_if((F.col(TRUE) == t) & (F.col(PRED) == p)).alias(f"c{t}_{p}") for t in range(1, k + 1) for p in range(1, k + 1)
    ]
    one = df.groupBy(*by).agg(*aggs)
    parts = []
    for t in range(1, k + 1):
        parts += [F.lit(t)] + [F.col(f"c{t}_{p}") for p in range(1, k + 1)]
    names = [TRUE] + [f"pred_{p}" for p in range(1, k + 1)]
    return one.select(*by, F.stack(F.lit(k), *parts).alias(*names))


def label_margins(df: DataFrame, split: str | None = SPLIT) -> DataFrame:
    """Per (split, label): support (true), predicted count, true positives —
    over every label seen as true or predicted.  Each row is emitted twice
    (as its true and its predicted label) and combined map-side."""
    by = _by(df, split)
    t, p = F.col(TRUE), F.col(PRED)
    pairs = F.array(
        F.struct(t.alias("label"), F.lit(1).alias("is_true"), F.lit(0).alias("is_pred"), (t == p).cast("int").alias("tp")),
        F.struct(p.alias("label"), F.lit(0).alias("is_true"), F.lit(1).alias("is_pred"), F.lit(0).alias("tp")),
    )
    e = df.select(*by, F.explode(pairs).alias("_e")).select(*by, "_e.*").filter(F.col("label").isNotNull())
    return e.groupBy(*by, "label").agg(
        F.sum("is_true").cast("long").alias("support"),
        F.sum("is_pred").cast("long").alias("n_pred"),
        F.sum("tp").cast("long").alias("tp"),
    )


def classification_report(df: DataFrame, split: str | None = SPLIT) -> DataFrame:
    """Per class precision, recall, F1 and support (0 when undefined)."""
    m = label_margins(df, split)
    prec = ratio0(F.col("tp"), F.col("n_pred"))
    rec = ratio0(F.col("tp"), F.col("support"))
    m = m.select(*_by(df, split), "label", "support", prec.alias("_p"), rec.alias("_r"))
    f1 = ratio0(2 * F.col("_p") * F.col("_r"), F.col("_p") + F.col("_r"))
    return m.select(
        *_by(df, split), "label", _r(F.col("_p"), "precision"), _r(F.col("_r"), "recall"), _r(f1, "f1"), "support"
    )


def f1_averages(df: DataFrame, split: str | None = SPLIT) -> DataFrame:
    """E5: accuracy, macro and support-weighted precision / recall / F1.
    Macro averages over labels seen as true or predicted (sklearn)."""
    by = _by(df, split)
    m = label_margins(df, split)
    p = ratio0(F.col("tp"), F.col("n_pred"))
    r = ratio0(F.col("tp"), F.col("support"))
    m = m.select(*by, "support", "tp", p.alias("p"), r.alias("r"))
    m = m.withColumn("f", ratio0(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")))
    n = F.sum("support")
    return m.groupBy(*by).agg(
        _r(F.sum("tp") / n, "accuracy"),
        _r(F.avg("p"), "macro_precision"),
        _r(F.avg("r"), "macro_recall"),
        _r(F.avg("f"), "macro_f1"),
        _r(F.sum(F.col("p") * F.col("support")) / n, "weighted_precision"),
        _r(F.sum(F.col("r") * F.col("support")) / n, "weighted_recall"),
        _r(F.sum(F.col("f") * F.col("support")) / n, "weighted_f1"),
    )


def per_class_recall(df: DataFrame, splits: Sequence[str], split: str = SPLIT) -> DataFrame:
    """Recall per true class for each split side by side (0 without
    support in that split)."""
    m = df.groupBy(split, F.col(TRUE).alias("label")).agg(
        F.count(F.lit(1)).alias("support"), F.count_if(F.col(TRUE) == F.col(PRED)).alias("tp")
    )
    wide = m.groupBy("label").pivot(split, list(splits)).agg(F.first(F.col("tp") / F.col("support")))
    return wide.select("label", *[_r(F.coalesce(F.col(s), F.lit(0.0)), f"recall_{s}") for s in splits])


def quadratic_weighted_kappa(df: DataFrame, split: str | None = SPLIT) -> DataFrame:
    """1 - n*sum (t-p)^2 / sum_ij (i-j)^2 r_i c_j, where the denominator
    is n*sum t^2 - 2*sum t*sum p + n*sum p^2: one pass of five sums.  A zero
    denominator (a single class everywhere) gives NULL."""
    t, p = F.col(TRUE).cast("double"), F.col(PRED).cast("double")
    g = df.filter(F.col(TRUE).isNotNull() & F.col(PRED).isNotNull()).groupBy(*_by(df, split)).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((t - p) * (t - p)).alias("sd"),
        F.sum(t).alias("st"),
        F.sum(p).alias("sp"),
        F.sum(t * t).alias("st2"),
        F.sum(p * p).alias("sp2"),
    )
    den = F.col("n") * F.col("st2") - 2 * F.col("st") * F.col("sp") + F.col("n") * F.col("sp2")
    kappa = F.lit(1.0) - ratio(F.col("n") * F.col("sd"), den)
    return g.select(*_by(df, split), "n", _r(kappa, "kappa"))


def mean_absolute_error(df: DataFrame, split: str | None = SPLIT, score: str | None = SCORE) -> DataFrame:
    """MAE of the predicted class, and of the continuous score if any."""
    aggs = [F.count(F.lit(1)).alias("n"), _r(F.avg(F.abs(F.col(TRUE) - F.col(PRED))), "mae")]
    if score and score in df.columns:
        aggs.append(_r(F.avg(F.abs(F.col(TRUE) - F.col(score))), "mae_score"))
    return df.groupBy(*_by(df, split)).agg(*aggs)


def mean_squared_error(df: DataFrame, split: str | None = SPLIT, score: str = SCORE) -> DataFrame:
    """MSE of a continuous score."""
    d = F.col(score) - F.col(TRUE)
    return df.groupBy(*_by(df, split)).agg(F.count(F.lit(1)).alias("n"), _r(F.avg(d * d), "mse"))


def _neg_log_p_true(logits: Sequence[str]) -> Column:
    """-log softmax(z)[true] via log-sum-exp (stable)."""
    z = [F.col(c).cast("double") for c in logits]
    m = F.greatest(*z)
    lse = m + F.log(sum((F.exp(x - m) for x in z[1:]), F.exp(z[0] - m)))
    zt = F.element_at(F.array(*z), F.col(TRUE).cast("int"))
    return lse - zt


def with_class_weights(df: DataFrame, weights: DataFrame | None, label: str = TRUE) -> DataFrame:
    """Attach ``weight`` per row from a (label, weight) table; by default the
    balanced weights of the table's own labels (W3)."""
    if weights is None:
        from annolytics.operators.split import class_weights

        weights = class_weights(df, label=label)
    # one row per class
    return df.join(F.broadcast(weights.withColumnRenamed("label", label)), label, "left").withColumn(
        "weight", F.coalesce(F.col("weight"), F.lit(1.0))
    )


def weighted_cross_entropy(
    df: DataFrame, logits: Sequence[str] = ("z1", "z2", "z3", "z4", "z5"), weights: DataFrame | None = None,
    split: str | None = SPLIT,
) -> DataFrame:
    """Sum w_y * (-log p_y) / sum w_y over the whole table (per split)."""
    w = with_class_weights(df, weights)
    ce = _neg_log_p_true(logits)
    return w.groupBy(*_by(df, split)).agg(
        F.count(F.lit(1)).alias("n"), _r(F.sum(F.col("weight") * ce) / F.sum("weight"), "weighted_cross_entropy")
    )


def focal_loss(
    df: DataFrame, logits: Sequence[str] = ("z1", "z2", "z3", "z4", "z5"), weights: DataFrame | None = None,
    gamma: float = FOCAL_GAMMA, split: str | None = SPLIT,
) -> DataFrame:
    """Mean of (1 - e^-c)^gamma * c with c the row's weighted cross-entropy."""
    w = with_class_weights(df, weights)
    c = F.col("weight") * _neg_log_p_true(logits)
    fl = F.pow(F.lit(1.0) - F.exp(-c), gamma) * c
    return w.groupBy(*_by(df, split)).agg(F.count(F.lit(1)).alias("n"), _r(F.avg(fl), "focal_loss"))


def evaluation_summary(
    df: DataFrame, logits: Sequence[str] = ("z1", "z2", "z3", "z4", "z5"), weights: DataFrame | None = None,
    split: str | None = SPLIT,
) -> DataFrame:
    """Per split: weighted loss, accuracy, within-1, within-2 in one
    aggregate (the prediction is the arg-max logit, first on ties)."""
    w = with_class_weights(df, weights)
    z = F.array(*[F.col(c).cast("double") for c in logits])
    pred = F.array_position(z, F.array_max(z)).cast("int")
    w = w.withColumn(PRED, pred)
    diff = F.abs(F.col(TRUE) - F.col(PRED))
    return w.groupBy(*_by(df, split)).agg(
        F.count(F.lit(1)).alias("n"),
        _r(F.sum(F.col("weight") * _neg_log_p_true(logits)) / F.sum("weight"), "loss"),
        _r(F.avg((diff == 0).cast("double")), "accuracy"),
        _r(F.avg((diff <= 1).cast("double")), "within_1"),
        _r(F.avg((diff <= 2).cast("double")), "within_2"),
    )


def regression_report(df: DataFrame, score: str = SCORE, split: str | None = SPLIT) -> DataFrame:
    """MAE of the raw score, then exact / within-1 / within-2 and MAE of
    the class after half-to-even rounding and clipping (P12)."""
    cls = score_to_class(F.col(score))
    diff = F.abs(F.col(TRUE) - cls)
    return df.groupBy(*_by(df, split)).agg(
        F.count(F.lit(1)).alias("n"),
        _r(F.avg(F.abs(F.col(TRUE) - F.col(score))), "mae_raw"),
        _r(F.avg(diff.cast("double")), "mae_rounded"),
        _r(F.avg((diff == 0).cast("double")), "exact"),
        _r(F.avg((diff <= 1).cast("double")), "within_1"),
        _r(F.avg((diff <= 2).cast("double")), "within_2"),
    )


def majority_baseline(train: DataFrame, test: DataFrame, label: str = "label_numeric") -> DataFrame:
    """M1: the most frequent training label (ties to the lowest) as the
    prediction for every test row; reports the class, its training share
    and the test accuracy / within-1, from two aggregates and a scalar."""
    counts = train.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # max over (count, -label): the most frequent label, the lowest on ties
    best = counts.agg(F.max(F.struct("n", (-F.col(label)).alias("neg"))).alias("b"), F.sum("n").alias("tot")).select(
        (-F.col("b.neg")).alias("majority_label"), (F.col("b.n") / F.col("tot")).alias("train_share"), F.lit(1).alias("_k")
    )
    # one row, broadcast to the test rows
    t = test.filter(F.col(label).isNotNull()).withColumn("_k", F.lit(1)).join(F.broadcast(best), "_k")
    m = F.col("majority_label")
    return t.groupBy("majority_label", "train_share").agg(
        F.count(F.lit(1)).alias("n_test"),
        _r(F.avg((F.col(label) == m).cast("double")), "accuracy"),
        _r(F.avg((F.abs(F.col(label) - m) <= 1).cast("double")), "within_1"),
    ).select("majority_label", _r(F.col("train_share"), "train_share"), "n_test", "accuracy", "within_1")
