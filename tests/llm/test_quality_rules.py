import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from annolytics.llm import quality_rules as Q


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(tri)
    places = {i + k for i, x in enumerate(tri) if n[x] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines), len(lines) - len(set(lines)), len(places)


TEXTS = [
    None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a a", "x y z x y z x y", "a\nb\na\n \n\na", "é😀 # é😀 # é😀", "a\x0bb\x0cc\rd",
    "a\u00a0b c", "#*$%&|<>", "\n\n", "one two three four one two three", "b a b a b a b",
]


def test_counts(docs_of):
    rnd = random.Random(2)
    texts = TEXTS + [" ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 200))) for _ in range(40)] + ["w " * 30_000]
    docs = docs_of([(i, t, "en", "s") for i, t in enumerate(texts)])
    got = {r["doc_id"]: r for r in Q.with_counts(docs).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_lines"], r["n_dup_lines"], r["n_repeat_words"]) == brute(t), t


@pytest.mark.parametrize("n,p", [(10, 0.1), (500, 0.01), (3000, 0.05), (20_000, 0.0167)])
def test_binomial_cdf(spark, n, p):
    ks = sorted({0, 1, n // 100, int(n * p), int(n * p) + 3, n // 2, n})
    got = [r[0] for r in spark.createDataFrame([(k,) for k in ks], "k long").select(Q.binomial_cdf(F.col("k"), F.lit(n), p)).collect()]
    for k, g in zip(ks, got):
        want = math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
        assert g == pytest.approx(min(1.0, want), rel=1e-8, abs=1e-300)


def test_certified_cutoffs(spark):
    # stratum A: the rule separates; B: too few labels; C: the rule would reject many good rows
    rows = [("A", 1, 0.001)] * 2000 + [("A", 0, 0.4)] * 100 + [("B", 1, 0.0)] * 10 + [("B", 0, 0.9)] * 5
    rows += [("C", 1, 0.45)] * 1000 + [("C", 1, 0.0)] * 1000 + [("C", 0, 0.45)] * 50 + [(None, 1, 0.0)] * 2000 + [(None, 0, 0.06)] * 9
    df = spark.createDataFrame([(s, g, x, 0.0, 0.0) for s, g, x in rows], "s string, g int, symbol_ratio double, dup_line_ratio double, repeat_ratio double")
    got = {(r["s"], r["rule"]): r["cutoff"] for r in Q.certify_cutoffs(df, "s", "g").collect()}
    assert got == {("A", "symbol_ratio"): 0.3, (None, "symbol_ratio"): 0.05}


def test_false_rejections_stay_under_the_bound(spark):
    rnd = random.Random(9)
    rows = [("A", 1, rnd.random() ** 30, 0.0, rnd.random() ** 9) for _ in range(4000)] + [("A", 0, rnd.random(), 0.0, 0.3) for _ in range(500)]
    df = spark.createDataFrame(rows, "s string, g int, symbol_ratio double, dup_line_ratio double, repeat_ratio double")
    cut = {r["rule"]: r["cutoff"] for r in Q.certify_cutoffs(df, "s", "g", alpha=0.06).collect()}
    fresh = [(rnd.random() ** 30, rnd.random() ** 9) for _ in range(20_000)]
    lost = sum(a > cut.get("symbol_ratio", 9) or b > cut.get("repeat_ratio", 9) for a, b in fresh)
    assert cut and lost / len(fresh) <= 0.06


def test_judge(spark, docs_of):
    good = [(i, " ".join(f"w{i}x{j}" for j in range(60)), "en", "s") for i in range(600)]
    bad = [(1000 + i, " ".join(f"w{i}y{j}$$$$" for j in range(60)), "en", "s") for i in range(60)]
    odd = [(2000, None, "en", "s"), (2001, "short", None, "s"), (2002, "a b c " * 40, "en", "s"), (None, good[0][1], None, "s")]
    labels = [(i, 1) for i, *_ in good] + [(i, 0) for i, *_ in bad] + [(1, None), (None, 1), (99_999, 0)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r["doc_id"]: r for r in Q.judge(docs_of(good + bad + odd), lab).collect()}
    assert all(got[i]["kept"] for i, *_ in good) and not any(got[i]["kept"] for i, *_ in bad)
    assert got[1003]["failed_rules"] == ["symbol_ratio"]
    assert got[2000]["base_failed"] and got[2001]["base_failed"] and got[2002]["base_failed"]
    assert got[None]["kept"]


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.judge(docs_of([]), none).count() == 0
    assert Q.judge(docs_of([(1, "$ " * 60, "en", "s")]), none).first()["base_failed"]
