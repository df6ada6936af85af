"""Distributed building blocks against single-machine definitions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from annolytics.functions.stats import grouped_stats, hash_order, hashed_rank, quantiles_sorted, running_sum_sorted
from annolytics.operators import split as W
from annolytics.operators.split import balanced_resample, capped_class_sample


def test_quantiles_match_numpy_with_hot_group(spark):
    rng = np.random.default_rng(3)
    g = np.where(rng.random(3000) < 0.6, "hot", rng.choice(["a", "b", "c"], 3000))
    v = np.round(rng.exponential(10, 3000), 1)  # many ties
    v[:500] = 0.0  # a hot value
    df = spark.createDataFrame([(str(a), float(b)) for a, b in zip(g, v)], "g string, v double").repartition(6)
    ps = [0.0, 0.05, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {(r.g, r.q): r.value for r in quantiles_sorted(df, "v", ps, by=["g"]).collect()}
    for key in ["hot", "a", "b", "c"]:
        exp = np.percentile(v[g == key], [p * 100 for p in ps])
        for i, e in enumerate(exp):
            assert abs(got[(key, i)] - e) < 1e-9, (key, ps[i], got[(key, i)], e)


def test_hashed_rank_equals_row_number(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("g"))
    df = df.withColumn("h", hash_order(42, F.col("id")))
    a = hashed_rank(df, ["g"], "h", bucket_bits=8).select("id", "rank")
    b = df.select("id", F.row_number().over(Window.partitionBy("g").orderBy("h")).alias("rank"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stratified_split_properties(spark):
    labels = [1] * 13 + [2] * 40 + [3] * 7 + [4] * 100 + [5] * 33
    df = spark.createDataFrame([(i, l) for i, l in enumerate(labels)], "annotation_id long, label_numeric int")
    s1 = W.stratified_split(df, key="annotation_id")
    s2 = W.stratified_split(df.repartition(5), key="annotation_id")
    r1 = {r.annotation_id: r.split for r in s1.collect()}
    assert r1 == {r.annotation_id: r.split for r in s2.collect()}  # deterministic
    assert len(r1) == len(labels)  # complete, disjoint
    n_val = sum(1 for v in r1.values() if v == "validation")
    assert n_val == int(np.ceil(0.2 * len(labels)))
    per = {r.label_numeric: r.n for r in s1.filter("split = 'validation'").groupBy("label_numeric").agg(F.count("*").alias("n")).collect()}
    for lab in set(labels):
        assert abs(per.get(lab, 0) - labels.count(lab) * 0.2) <= 1


def test_class_weights_sum(spark):
    labels = [1] * 10 + [2] * 30 + [5] * 60
    df = spark.createDataFrame([(l,) for l in labels], "label_numeric int")
    w = W.class_weights(df).collect()
    assert abs(sum(r.n_c * r.weight for r in w) - len(labels)) < 1e-9


def test_folds_balanced(spark):
    labels = [1] * 50 + [2] * 23
    df = spark.createDataFrame([(i, l) for i, l in enumerate(labels)], "annotation_id long, label_numeric int")
    f = W.stratified_folds(df, key="annotation_id").groupBy("label_numeric", "fold").count().collect()
    for lab in (1, 2):
        counts = [r["count"] for r in f if r.label_numeric == lab]
        assert max(counts) - min(counts) <= 1


def test_running_sum_sorted_matches_cumsum(spark):
    rng = np.random.default_rng(7)
    v = np.unique(np.round(rng.exponential(50, 4000), 3))  # continuous, many distinct values
    n = rng.integers(1, 20, len(v))
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(v, n)], "v double, n long").repartition(7)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep several sort partitions
    try:
        got = running_sum_sorted(df, "v", "n").orderBy("v").toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert list(got["cum"]) == list(np.cumsum(n))
    assert set(got["total"]) == {int(n.sum())}


@pytest.mark.parametrize("conf", [{"spark.sql.exchange.reuse": "false"}, {"spark.sql.adaptive.enabled": "false", "spark.sql.exchange.reuse": "false"}])
def test_quantiles_do_not_depend_on_the_plan(spark, conf):
    """Exact values with exchange reuse off, AQE off, and a null group."""
    old = {k: spark.conf.get(k) for k in conf}
    rnd = np.random.default_rng(8)
    v = np.concatenate([rnd.random(30_000) * 1000, np.full(5_000, 500.0)])
    try:
        for k, x in conf.items():
            spark.conf.set(k, x)
        df = spark.createDataFrame(pd.DataFrame({"v": v, "i": range(len(v))})).repartition(7)
        df = df.withColumn("g", F.when(F.col("i") % 3 > 0, F.lit("hot")))
        got = {(r.g, r.q): r.value for r in quantiles_sorted(df, "v", [0.0, 0.1, 0.5, 0.9, 1.0], by=["g"]).collect()}
        i = np.arange(len(v))
        for g, part in (("hot", v[i % 3 > 0]), (None, v[i % 3 == 0])):
            for q, p in enumerate([0.0, 0.1, 0.5, 0.9, 1.0]):
                assert got[(g, q)] == pytest.approx(np.quantile(part, p), abs=1e-9)
        counts = df.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        run = sorted((r.v, r.cum, r.total) for r in running_sum_sorted(counts, "v", "n").collect())
        values, sizes = np.unique(v, return_counts=True)
        assert [c for _, c, _ in run] == list(np.cumsum(sizes)) and {t for *_, t in run} == {len(v)}
        stats = {r.g: r.med for r in grouped_stats(df, ["g"], [F.count(F.lit(1)).alias("n")], [("v", 0.5, "med")]).collect()}
        assert stats[None] == pytest.approx(np.median(v[i % 3 == 0]))
    finally:
        for k, x in old.items():
            spark.conf.set(k, x)


def test_resample_is_reproducible_and_balanced(spark):
    rows = [(i, 1 if i % 10 else 2) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, label_numeric int")
    a = balanced_resample(df, "id").groupBy("label_numeric").count().collect()
    assert all(abs(r["count"] - 2000) < 250 for r in a)
    ids = lambda d: sorted(r[0] for r in balanced_resample(d, "id").select("id").collect())
    assert ids(df) == ids(df.repartition(13))


def test_capped_sample_takes_a_small_frame_whole(spark):
    small = spark.createDataFrame([(1, 1), (2, None)], "id long, label_numeric int")
    assert capped_class_sample(small, "id").count() == 2
    large = spark.createDataFrame([(i, i % 5 + 1) for i in range(500)], "id long, label_numeric int")
    got = capped_class_sample(large, "id")
    assert got.columns == ["id", "label_numeric"] and got.count() == 32


def test_resample_has_exactly_n_draws_within_binomial_bounds(spark):
    df = spark.createDataFrame([(i, 1 if i % 10 else 2 + i % 3) for i in range(2000)] + [(9999, None)], "id long, label_numeric int")
    classes = df.filter("label_numeric IS NOT NULL").select("label_numeric").distinct().count()
    for n in (1, 37, 2000, 5000):
        for seed in (1, 42):
            got = balanced_resample(df, "id", n=n, seed=seed)
            assert got.columns == df.columns and got.count() == n
    counts = {r["label_numeric"]: r["count"] for r in balanced_resample(df, "id", n=5000).groupBy("label_numeric").count().collect()}
    p = 1 / classes
    # six standard deviations of a binomial count
    assert all(abs(c - 5000 * p) < 6 * (5000 * p * (1 - p)) ** 0.5 for c in counts.values()) and len(counts) == classes
    # inside a class every row has the same chance: no row of the large class comes too often
    most = balanced_resample(df, "id", n=5000).filter("label_numeric = 1").groupBy("id").count().agg(F.max("count")).first()[0]
    assert most <= 12
    assert balanced_resample(df.filter("false"), "id").count() == 0
