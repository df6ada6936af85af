from annolytics.plans import training as P


def test_training_job_as_registered(spark, sf_dir):
    """All three classifiers with their real settings, and ridge."""
    rows = P.q_features_train_job(spark, sf_dir).collect()
    classifiers = ("logistic_regression", "random_forest", "gradient_boosting")
    assert {(r["model"], r["split"]) for r in rows} == {
        *((m, s) for m in (*classifiers, "ridge") for s in ("train", "test")),
        *((m, "cross_validation") for m in classifiers),
    }
    for r in rows:
        if r["split"] == "cross_validation":
            assert 0 < r["accuracy"] < 1 and r["std_accuracy"] >= 0
            assert r["n"] == next(x["n"] for x in rows if x["split"] == "train")
    by = {(r["model"], r["split"]): r["accuracy"] for r in rows}
    assert by["gradient_boosting", "train"] >= by["gradient_boosting", "cross_validation"]


def test_score_job_has_all_metrics_on_both_splits(spark, sf_dir):
    rows = P.q_score_evaluate_job(spark, sf_dir).collect()
    assert sorted(r["split"] for r in rows) == ["test", "validation"]
    for r in rows:
        assert [k for k in r.asDict() if r[k] is None] == []
        cells = [[c[f"pred_{p}"] for p in range(1, 6)] for c in r["confusion_matrix"]]
        n, hits = sum(map(sum, cells)), sum(cells[i][i] for i in range(5))
        near = sum(cells[i][j] for i in range(5) for j in range(5) if abs(i - j) <= 1)
        assert n == r["n"] == r["total"] and abs(hits / n - r["accuracy"]) < 1e-6 and abs(near / n - r["within_1"]) < 1e-6
        assert sum(c["support"] for c in r["classification_report"]) == n
        recall = {c["label"]: c["recall"] for c in r["classification_report"] if c["support"]}
        assert {c["label"]: c["recall_" + r["split"]] for c in r["recall_by_split"] if c["label"] in recall} == recall
        assert abs(r["loss"] - r["weighted_cross_entropy"]) < 1e-6 and r["focal_loss"] > 0 and r["mse"] > 0
        assert r["regression_mae_raw"] == r["mae_score"] and r["regression_within_2"] <= 1
