"""Evaluation metrics: the published majority-baseline numbers, kappa,
scoring, chi-square, ridge closed form."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from annolytics.functions.stats import chi2_sf
from annolytics.operators import evaluate as E
from annolytics.operators import score as S


@pytest.fixture(scope="module")
def const_pred(spark):
    # 132 hold-out rows, 27 of class 4, every class present, always predict 4
    true = [4] * 27 + [1] * 20 + [2] * 25 + [3] * 30 + [5] * 30
    return spark.createDataFrame([(t, 4) for t in true], "true_label int, predicted_label int")


def test_majority_baseline_published_numbers(const_pred):
    r = E.f1_averages(const_pred, split=None).first()
    assert round(r.accuracy, 4) == 0.2045
    assert round(r.macro_f1, 4) == 0.0679
    assert round(r.weighted_f1, 4) == 0.0695


def test_kappa_constant_prediction_and_identity(spark, const_pred):
    assert E.quadratic_weighted_kappa(const_pred, split=None).first().kappa == 0.0
    ident = const_pred.select("true_label", F.col("true_label").alias("predicted_label"))
    assert E.quadratic_weighted_kappa(ident, split=None).first().kappa == 1.0


def test_kappa_against_matrix_form(spark):
    rng = np.random.default_rng(1)
    t = rng.integers(1, 6, 300)
    p = np.clip(t + rng.integers(-2, 3, 300), 1, 5)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(t, p)], "true_label int, predicted_label int")
    o = np.zeros((5, 5))
    for a, b in zip(t, p):
        o[a - 1, b - 1] += 1
    w = np.array([[(i - j) ** 2 for j in range(5)] for i in range(5)])
    e = np.outer(o.sum(1), o.sum(0)) / o.sum()
    exp = 1 - (w * o).sum() / (w * e).sum()
    assert math.isclose(E.quadratic_weighted_kappa(df, split=None).first().kappa, round(exp, 6), abs_tol=1e-6)


def test_within_k_monotone(const_pred):
    r = E.within_k_accuracy(const_pred, ks=(0, 1, 2, 3, 4), split=None).first()
    vals = [r[f"within_{k}"] for k in range(5)]
    assert vals == sorted(vals) and vals[-1] == 1.0


def test_confusion_is_dense(const_pred):
    rows = E.confusion_matrix(const_pred, split=None).collect()
    assert len(rows) == 5 and sum(r.pred_4 for r in rows) == 132


def test_softmax_probabilities(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 3.0, -1.0), (0.0, 0.0, 0.0, 0.0, 0.0)], "z1 double, z2 double, z3 double, z4 double, z5 double")
    rows = S.softmax_scores(df).collect()
    for r in rows:
        assert math.isclose(sum(r[f"p{i}"] for i in range(1, 6)), 1.0, abs_tol=1e-12)
        assert math.isclose(r.confidence, max(r[f"p{i}"] for i in range(1, 6)))
    assert rows[0].predicted_label == 3  # first of the tied maxima
    assert rows[1].predicted_label == 1


def test_chi_square_golden(spark):
    obs = [10, 20, 5, 7, 8]
    exp = [12, 15, 8, 7, 8]
    chi = sum((o - e) ** 2 / e for o, e in zip(obs, exp))
    assert math.isclose(chi, 3.125)
    points = [(chi, 4), (1.0, 1), (2.0, 3), (0.0, 3), (30.0, 5), (80.0, 4), (2000.0, 3), (2000.0, 4), (5.0, 2)]
    df = spark.createDataFrame(points, "x double, k int").select("x", "k", chi2_sf(F.col("x"), F.col("k")).alias("p"))
    got = {(r.x, r.k): r.p for r in df.collect()}
    assert round(got[(chi, 4)], 6) == 0.537129
    assert math.isclose(got[(1.0, 1)], math.erfc(math.sqrt(0.5)), rel_tol=1e-12)
    assert math.isclose(got[(2.0, 3)], 0.5724067044708798, rel_tol=1e-12)
    odd = math.erfc(math.sqrt(15)) + math.sqrt(60 / math.pi) * math.exp(-15) * (1 + 30 / 3)
    assert math.isclose(got[(30.0, 5)], odd, abs_tol=1e-12)
    assert got[(0.0, 3)] == 1.0 and got[(2000.0, 3)] == 0.0 and got[(2000.0, 4)] == 0.0
    assert math.isclose(got[(5.0, 2)], math.exp(-2.5)) and math.isclose(got[(80.0, 4)], math.exp(-40) * 41)



def test_ridge_matches_closed_form(spark):
    from pyspark.ml.feature import VectorAssembler

    from annolytics.operators.models import ridge_regression

    rng = np.random.default_rng(7)
    X = rng.normal(size=(60, 3))
    y = np.clip(np.round(X @ [0.8, -0.5, 0.3] + 3 + rng.normal(scale=0.5, size=60)), 1, 5)
    df = spark.createDataFrame([(float(a), float(b), float(c), int(t)) for (a, b, c), t in zip(X, y)], "a double, b double, c double, label_numeric int")
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    m = ridge_regression(df, alpha=1.0)
    Xc = X - X.mean(0)
    yc = y - y.mean()
    coef = np.linalg.solve(Xc.T @ Xc + np.eye(3), Xc.T @ yc)
    np.testing.assert_allclose(m.coefficients.toArray(), coef, rtol=1e-5, atol=1e-6)
    assert math.isclose(m.intercept, y.mean() - X.mean(0) @ coef, rel_tol=1e-5)
