"""Toxicity by a classifier chain.

Three categories are predicted one after the other by linear (logistic)
models: ``dense`` (toxic, with at least two cue words per hundred words),
``repeated`` (toxic, with at least two cue words) and ``toxic`` (the label
itself).  Each later model gets the earlier categories' probabilities as
further features.  For training these are out-of-fold predictions: tokens,
cues and weights of the model that predicts a fold come from the other folds
alone, so a later model sees earlier probabilities of the quality it will meet
when scoring; the models that score are fitted on all training rows.

Features are log(1 + count) of the ``n_tokens`` word forms with the largest
chi-square statistic against the label (and at least ``min_chi``, so that
words that differ by chance stay out); cue words are those of them that
occur more often in toxic rows.  Fitting uses at most about ``train_rows``
labelled rows, chosen by a hash of the document id; everything else
(scoring) covers every document.  The rejecting threshold maximises the F0.5
measure of the out-of-fold predictions, in the middle of the best range.

Scale: labels are bounded before they are broadcast, the text table is read
once for training and once for scoring, and no text is shuffled.

Defined cases: a null or empty text has no words and the probability of a
text without cue words; labels without a document or without a value are
ignored, several labels of a document count as their maximum; without a
toxic (or without a clean) training row every probability is 0 and nothing
is rejected; a null doc_id cannot be labelled but is scored; other columns
pass through, except that those named like the added ones are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolytics.llm.common import prefixed, restored, small_batches
from annolytics.session import materialize

CATEGORIES = ("dense", "repeated", "toxic")
ADDED = ("p_dense", "p_repeated", "p_toxic", "toxic", "kept")
WORD = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def counts(texts: Sequence[str | None], index: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the indexed tokens per text, and the number of all tokens."""
    x, n = np.zeros((len(texts), len(index))), np.zeros(len(texts))
    for i, text in enumerate(texts):
        found = tokens(text)
        n[i] = len(found)
        for t in found:
            j = index.get(t)
            if j is not None:
                x[i, j] += 1
    return x, n


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights (bias last) of an L2-penalised logistic model, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], l2)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        curvature = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curvature, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


@dataclass(frozen=True)
class Chain:
    """A fitted chain: tokens in feature order, one weight vector per
    category, and the threshold on the last one's probability."""

    vocabulary: tuple[str, ...]
    weights: tuple[np.ndarray, ...]
    threshold: float

    def score(self, texts: Sequence[str | None]) -> np.ndarray:
        """Probabilities of the categories, one row per text."""
        x = np.log1p(counts(texts, {t: i for i, t in enumerate(self.vocabulary)})[0])
        for w in self.weights:
            x = np.hstack([x, probability(x, w)[:, None]])
        return x[:, len(self.vocabulary) :]


def training_rows(docs: DataFrame, labels: DataFrame, train_rows: int) -> DataFrame:
    """(doc_id, text, y) of at most about ``train_rows`` labelled documents."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("double").alias("y"))
    n = known.count()
    share = min(1.0, train_rows / max(n, 1))
    picked = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(share * 1_000_000))
    picked = picked.select(F.col("doc_id").alias("_id"), "y")
    # about train_rows rows of two numbers
    return docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).drop("_id")


def choose_tokens(rows: DataFrame, folds: int, n_tokens: int, min_rows: int, min_chi: float) -> list[list[tuple[str, bool]]]:
    """Per part (the folds without fold 0, 1, ..., and all of them) the
    ``n_tokens`` tokens with the largest chi-square statistic of at least
    ``min_chi`` on that part's rows, each with whether it is a cue (more
    frequent in toxic rows)."""

    def distinct(frames):
        for pdf in frames:
            out = [(t, y, f) for text, y, f in zip(pdf["text"], pdf["y"], pdf["fold"]) for t in set(tokens(text))]
            yield pd.DataFrame(out, columns=["token", "y", "fold"])

    seen = rows.select("text", "y", "fold").mapInPandas(distinct, "token string, y double, fold int")
    totals = {r["fold"]: (r["n"], r["pos"]) for r in rows.groupBy("fold").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("pos")).collect()}
    per_fold = [c for k in range(folds) for c in (F.sum(F.when(F.col("fold") == k, F.col("y")).otherwise(0.0)).alias(f"a{k}"), F.count_if(F.col("fold") == k).alias(f"m{k}"))]
    by = materialize(seen.groupBy("token").agg(F.sum("y").alias("a"), F.count(F.lit(1)).cast("double").alias("m"), *per_fold).filter(F.col("m") >= min_rows), "toxicity-tokens")
    chosen = []
    for part in range(folds + 1):
        own = {k: v for k, v in totals.items() if k != part}
        n, pos = sum(v[0] for v in own.values()), sum(v[1] for v in own.values())
        neg = n - pos
        if not pos or not neg:
            chosen.append([])
            continue
        m = F.col("m") - (F.col(f"m{part}") if part < folds else 0)
        hits = F.col("a") - (F.col(f"a{part}") if part < folds else 0)
        rows_of = by.select("token", hits.alias("a"), m.cast("double").alias("m")).filter(F.col("m") >= min_rows)
        expected = F.col("m") * pos / n
        chi = F.pow(F.col("a") - expected, 2) * (n * n) / (F.col("m") * (F.lit(n) - F.col("m") + 0.5) * pos * neg / n)
        top = rows_of.withColumn("chi", chi).filter(F.col("chi") >= min_chi).orderBy(F.desc("chi"), "token").limit(n_tokens)
        chosen.append([(r["token"], r["a"] > r["m"] * pos / n) for r in top.collect()])
    return chosen


def categories(counts: np.ndarray, cues: np.ndarray, n: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Labels of the categories, from counts of a part's tokens."""
    hits = counts[:, cues].sum(axis=1)
    return {"dense": y * (hits * 50 >= np.maximum(n, 1)), "repeated": y * (hits >= 2), "toxic": y}


def fit_part(x: np.ndarray, y: np.ndarray, l2: float) -> np.ndarray:
    """Weights of one category on one part; a category that never or always
    holds has a constant probability."""
    if 0 < y.sum() < len(y):
        return fit_logistic(x, y, l2)
    return np.r_[np.zeros(x.shape[1]), -30.0 if not y.sum() else 30.0]


def fit_chain(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: int = 16_384,
    n_tokens: int = 256,
    min_rows: int = 5,
    min_chi: float = 20.0,
    folds: int = 5,
    l2: float = 0.3,
) -> Chain:
    """Fits the chain; one Spark job per category, a task per fold.  Part k
    leaves fold k out of everything: its tokens, cues and weights come from
    the other folds, and predict fold k."""
    fold = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(folds)).cast("int").alias("fold")
    rows = materialize(training_rows(docs, labels, train_rows).select("doc_id", "text", "y", fold), "toxicity-rows")
    chosen = choose_tokens(rows, folds, n_tokens, min_rows, min_chi)
    if not chosen[folds]:
        return Chain((), tuple(np.array([0.0] * i + [-30.0]) for i in range(len(CATEGORIES))), 2.0)
    everything = sorted({t for part in chosen for t, _ in part})
    index = {t: i for i, t in enumerate(everything)}
    places = [np.array([index[t] for t, _ in part], dtype=np.int64) for part in chosen]
    cues = [np.array([c for _, c in part], dtype=bool) for part in chosen]

    def counted(frames):
        for pdf in frames:
            x, n = counts(list(pdf["text"]), index)
            at = [np.flatnonzero(r) for r in x]
            yield pd.DataFrame(
                {"fold": pdf["fold"], "y": pdf["y"], "n": n, "at": at, "times": [r[i] for r, i in zip(x, at)], "earlier": [np.zeros(0)] * len(pdf)}
            )

    table = rows.mapInPandas(counted, "fold int, y double, n double, at array<int>, times array<double>, earlier array<double>")
    table = materialize(table, "toxicity-design")

    def matrix(pdf, part):
        """Counts of the part's tokens."""
        x = np.zeros((len(pdf), len(everything)))
        for i, (at, times) in enumerate(zip(pdf["at"], pdf["times"])):
            x[i, at] = times
        return x[:, places[part]]

    final = []
    for category in CATEGORIES:

        def fit(key, pdf):
            part = key[0]
            c = matrix(pdf, part)
            y = categories(c, cues[part], pdf["n"].to_numpy(), pdf["y"].to_numpy())[category]
            w = fit_part(np.hstack([np.log1p(c), np.vstack(pdf["earlier"])]), y, l2)
            return pd.DataFrame({"part": [part], "w": [w]})

        parts = table.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(folds)))).filter("part <> fold")
        fitted = {r["part"]: np.array(r["w"]) for r in parts.groupBy("part").applyInPandas(fit, "part int, w array<double>").collect()}
        final.append(fitted[folds])

        def out_of_fold(frames):
            for pdf in frames:
                earlier = np.vstack(pdf["earlier"]) if len(pdf) else np.zeros((0, 0))
                p = np.zeros(len(pdf))
                for part in set(pdf["fold"]):
                    mine = (pdf["fold"] == part).to_numpy()
                    x = np.hstack([np.log1p(matrix(pdf[mine], part)), earlier[mine]])
                    # a part without rows of its own kind has no model
                    w = fitted.get(part)
                    p[mine] = probability(x, w) if w is not None else 0.0
                yield pdf.assign(earlier=list(np.hstack([earlier, p[:, None]])))

        table = materialize(table.mapInPandas(out_of_fold, table.schema), "toxicity-design")
    last = F.element_at("earlier", -1)
    cells = table.groupBy(F.floor(last * 200).alias("cell")).agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n")).collect()
    vocabulary = tuple(t for t, _ in chosen[folds])
    return Chain(vocabulary, tuple(final), best_threshold([(r["cell"] / 200, r["pos"], r["n"]) for r in cells]))


def best_threshold(cells: Sequence[tuple[float, float, int]]) -> float:
    """Middle of the range of thresholds with the best F-measure (precision
    counted twice recall, so that clean documents stay) over (lower edge,
    positives, rows) cells of the probability."""
    positives = sum(p for _, p, _ in cells)
    if not positives:
        return 2.0
    scores = []
    for t in (i / 200 for i in range(1, 200)):
        hit = sum(p for e, p, _ in cells if e >= t)
        named = sum(n for e, _, n in cells if e >= t)
        scores.append((round(1.25 * hit / (0.25 * positives + named), 9) if named else 0.0, t))
    best = max(s for s, _ in scores)
    good = [t for s, t in scores if s == best]
    return (good[0] + good[-1]) / 2


def _judged(docs: DataFrame, labels: DataFrame, options: dict) -> DataFrame:
    """``docs`` with all columns renamed to doc_..., and the added ones."""
    small_batches(docs.sparkSession)
    chain = fit_chain(docs, labels, **options)
    scored = T.StructType([T.StructField(f"p_{c}", T.DoubleType()) for c in CATEGORIES])

    @F.pandas_udf(scored)
    def score(text: pd.Series) -> pd.DataFrame:
        # few texts at a time: a row of counts per text
        parts = [chain.score(list(text.iloc[i : i + 512])) for i in range(0, len(text), 512)]
        return pd.DataFrame(np.vstack(parts) if parts else np.zeros((0, len(CATEGORIES))), columns=[f"p_{c}" for c in CATEGORIES])

    d = prefixed(docs, "doc_").withColumn("scored", score("doc_text")).select("*", "scored.*").drop("scored")
    toxic = F.col("p_toxic") >= F.lit(float(chain.threshold))
    return d.withColumn("toxic", toxic).withColumn("kept", ~F.col("toxic"))


def detect(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` with p_dense, p_repeated, p_toxic, toxic and kept."""
    own = [c for c in docs.columns if c not in ADDED]
    return _judged(docs, labels, options).select(*restored(own, "doc_"), *ADDED)


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the chain does not reject, unchanged."""
    return _judged(docs, labels, options).filter("kept").select(*restored(docs.columns, "doc_"))
