import random

import numpy as np
import pytest

from annolytics.llm import toxicity as X


def corpus(n, seed):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rnd.randint(0, 400)}".replace("w", "wo").translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(rnd.randint(5, 80))]
        toxic = rnd.random() < 0.2
        if toxic:
            for _ in range(rnd.randint(1, 4)):
                words.insert(rnd.randint(0, len(words)), rnd.choice(["vile", "scum", "Böse,", "гад"]))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1 if rnd.random() < 0.5 else 0, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_edges(spark, docs_of):
    rows, labels = corpus(1500, 1)
    lab = spark.createDataFrame(labels[:1000] + [(None, 1, 1), (3, 1, None), (99_999, 0, 1)], "doc_id long, quality int, toxic int")
    odd = [(5000, None, "en", "s"), (5001, "", "en", None), (None, "scum " * 50_000, "en", "s"), (5002, "!!! 123", "en", "s")]
    docs = docs_of(rows + odd)
    out = X.detect(docs, lab).collect()
    assert len(out) == len(rows) + len(odd)
    got = {r["doc_id"]: r for r in out}
    held = [(got[i]["toxic"], bool(t)) for i, _, t in labels[1000:]]
    assert sum(a == b for a, b in held) / len(held) >= 0.98
    assert not got[5000]["toxic"] and not got[5001]["toxic"] and not got[5002]["toxic"] and got[None]["toxic"]
    assert all(r["kept"] != r["toxic"] for r in out)
    assert {"n", "digest", "p_dense", "p_repeated", "p_toxic"} <= set(out[0].asDict())


def test_chain_feeds_earlier_probabilities(spark, docs_of):
    rows, labels = corpus(400, 2)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chain = X.fit_chain(docs_of(rows), lab, n_tokens=20)
    n = len(chain.vocabulary) + 1
    assert [len(w) for w in chain.weights] == [n, n + 1, n + 2]
    texts = ["vile scum here", "nothing here"]
    x = np.log1p(X.counts(texts, {t: i for i, t in enumerate(chain.vocabulary)})[0])
    first = X.probability(x, chain.weights[0])
    second = X.probability(np.c_[x, first], chain.weights[1])
    third = X.probability(np.c_[x, first, second], chain.weights[2])
    assert np.allclose(chain.score(texts), np.c_[first, second, third])


def test_logistic_fit_is_stationary():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(400, 3))
    y = (x @ [1.0, -2.0, 0.0] + rnd.normal(size=400) > 0.3).astype(float)
    w = X.fit_logistic(x, y, l2=1.0)
    p = X.probability(x, w)
    assert np.allclose(x.T @ (p - y) + w[:3], 0, atol=1e-4) and abs((p - y).sum()) < 1e-3


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(1, 0, 1)]])
def test_without_two_classes_nothing_is_rejected(spark, docs_of, labels):
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = X.detect(docs_of([(1, "vile", "en", "s"), (2, None, "en", "s")]), lab).collect()
    assert len(out) == 2 and all(r["kept"] for r in out)
    assert X.detect(docs_of([]), lab).count() == 0


def plain_chain(rows, fold_of, n_tokens, min_rows, min_chi, l2, folds=5):
    """The chain on (id, text, y) rows, without Spark: weights of the final
    models and out-of-fold probabilities."""

    def choose(some):
        n, pos = len(some), sum(y for _, _, y in some)
        seen = {}
        for _, t, y in some:
            for w in set(X.tokens(t)):
                a, m = seen.get(w, (0, 0))
                seen[w] = a + y, m + 1
        chi = {w: (a - m * pos / n) ** 2 * n * n / (m * (n - m + 0.5) * pos * (n - pos) / n) for w, (a, m) in seen.items() if m >= min_rows}
        best = sorted((w for w in chi if chi[w] >= min_chi), key=lambda w: (-chi[w], w))[:n_tokens]
        return best, np.array([seen[w][0] > seen[w][1] * pos / n for w in best], dtype=bool)

    fold = np.array([fold_of[i] for i, _, _ in rows])
    y = np.array([float(v) for _, _, v in rows])
    parts = [[r for r, f in zip(rows, fold) if f != k] for k in range(folds + 1)]
    chosen = [choose(p) for p in parts]
    tables = [X.counts([t for _, t, _ in rows], {w: i for i, w in enumerate(c[0])}) for c in chosen]
    earlier, final = np.zeros((len(rows), 0)), []
    for category in X.CATEGORIES:
        p = np.zeros(len(rows))
        for k in range(folds + 1):
            x, n = tables[k]
            keep = fold != k
            label = X.categories(x, chosen[k][1], n, y)[category]
            full = np.hstack([np.log1p(x), earlier])
            w = X.fit_part(full[keep], label[keep], l2)
            if k < folds:
                p[~keep] = X.probability(full[~keep], w)
            else:
                final.append(w)
        earlier = np.c_[earlier, p]
    return chosen[folds][0], final, earlier


def test_equals_a_plain_chain(spark, docs_of, monkeypatch):
    from pyspark.sql import functions as F

    rows, labels = corpus(600, 4)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = docs_of(rows)
    seen = {}
    original = X.materialize
    monkeypatch.setattr(X, "materialize", lambda df, name: seen.setdefault(name, []).append(original(df, name)) or seen[name][-1])
    chain = X.fit_chain(docs, lab, n_tokens=12, min_chi=5.0)
    fold_of = {r["doc_id"]: r["fold"] for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(5)).alias("fold")).collect()}
    vocabulary, final, earlier = plain_chain([(i, t, labels[i][2]) for i, t, _, _ in rows], fold_of, 12, 5, 5.0, 0.3)
    assert list(chain.vocabulary) == vocabulary and len(vocabulary) >= 4
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(chain.weights, final))
    got = sorted(tuple(np.round(r["earlier"], 6)) for r in seen["toxicity-design"][-1].collect())
    assert np.allclose(got, sorted(map(tuple, np.round(earlier, 6))), atol=2e-6)
