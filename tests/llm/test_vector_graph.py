import re

import numpy as np
from pyspark.sql import functions as F

from annolytics.llm import vector_graph as G


def search(spark, rows, k=20, **kw):
    df = spark.createDataFrame([(i, v, 0.5, "x") for i, v in rows], "vec_id long, embedding array<float>, score double, query_id string")
    out = G.nearest(df, F.col("vec_id") % 20 == 0, k=k, **kw).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return got


def exact(rows, k):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in ok:
        if q % 20 == 0:
            near = sorted((-float(sum(a * b for a, b in zip(x, y))), i) for i, y in ok if i != q and len(y) == len(x))
            out[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(near[:k])]
    return out


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(G, "SHARD_ROWS", 400)
    rnd = np.random.default_rng(3)
    centre = rnd.normal(size=(8, 24))
    v = np.vstack([rnd.normal(size=(900, 24)), centre[rnd.integers(0, 8, 500)] + 0.01 * rnd.normal(size=(500, 24))])
    v *= rnd.uniform(0.5, 2.0, size=(len(v), 1))  # norms differ
    rows = [(i, [float(np.float32(t)) for t in x]) for i, x in enumerate(v)]
    got, want = search(spark, rows), exact(rows, 20)
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i, _ in got[q]} & {i for _, i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.95
    for q in want:
        assert [r for r, _, _ in got[q]] == list(range(1, 21))
        order = [(-s, i) for _, i, s in got[q]]
        assert order == sorted(order)
        scores = {i: s for _, i, s in want[q]}
        assert all(scores.get(i, s) == s for _, i, s in got[q])


def test_copies_are_exact(spark):
    a, b = [1.0, 2.0], [2.0, 1.0]
    rows = [(i, a) for i in range(0, 120)] + [(i, b) for i in range(200, 203)]
    got = search(spark, rows, k=5)
    assert got == exact(rows, 5)


def test_unusable_vectors(spark):
    rows = [(0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (60, [float("nan"), 1.0]), (80, [float("inf"), 1.0]), (100, [None, 1.0]), (None, [1.0, 1.0]), (120, []), (1, [0.5, 0.5]), (140, [1.0, 2.0, 3.0]), (0, [1.0, 0.0])]
    got = search(spark, rows)
    assert {q: [i for _, i, _ in r] for q, r in got.items()} == {0: [1]}
    assert search(spark, []) == {}


def test_pruning_keeps_diverse_edges():
    x = np.array([[0, 0], [1, 0], [1.05, 0], [0, 1], [-1, 0]], np.float32)
    out = G.robust_prune(x, np.array([0]), np.array([[1, 2, 3, 4, -1, 1]], np.int32), 4, 1.2)
    assert set(out[0]) == {1, 3, 4, -1}


def test_copies_of_one_vector_are_cut_before_they_meet(spark):
    rows = [(i, [1.0, 0.0] if i % 3 else [float(i), 1.0]) for i in range(3000)]
    got = G.smallest_ids(spark.createDataFrame(rows, "id long, v array<double>"), 5)
    out = got.collect()
    assert sorted((r["place"], r["id"], r["class"]) for r in out if r["v"] == [1.0, 0.0]) == [(1, 1, 1), (2, 2, 1), (3, 4, 1), (4, 5, 1), (5, 7, 1)]
    assert len(out) == 1005
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and re.search(r"hashpartitioning\(.*salt", plan)
