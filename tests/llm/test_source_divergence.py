import random
import re
from collections import Counter

import pytest

from annolytics.llm import source_divergence as D


def brute(rows, min_docs, top):
    langs = {}
    for _, text, lang, source in rows:
        fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", fold)
        langs.setdefault(lang or "", []).append((source or "", Counter(terms)))
    out = set()
    for lang, docs in langs.items():
        df = Counter(t for _, c in docs for t in c)
        kept = [t for t, n in df.items() if n >= min_docs]
        v = len(kept)

        def p_of(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 1000000000 * (counts[t] + 5) // (total + 5 * v) for t in kept}

        groups = {}
        for source, c in docs:
            groups.setdefault(source, Counter()).update(c)
        q = p_of(sum((c for _, c in docs), Counter()))
        p = {s: p_of(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s]
            over = [(p[s][t] - q[t], t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", over, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out |= {(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)}
    return out


def check(docs_of, rows, min_docs=3, top=5):
    got = D.audit(docs_of(rows).withColumnRenamed("kept", "term").withColumnRenamed("size", "peer"), min_docs, top).collect()
    got = [(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in got]
    want = brute(rows, min_docs, top)
    assert len(got) == len(want) and set(got) == want


def corpus(seed, n=120):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abAéß漢") for _ in range(rnd.randint(1, 4))) for _ in range(40)]
    return [
        (
            i,
            rnd.choice([" ", "-", "\n1"]).join(rnd.choice(words) for _ in range(rnd.randint(0, 30))),
            rnd.choice(["en", "en", "en", "de", None]),
            rnd.choice(["s0", "s0", "s0", "s1", "é", "~", None, ""]),
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(docs_of, seed):
    check(docs_of, corpus(seed))


def test_many_blocks_and_flushes(docs_of, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_POSTINGS", 7)
    monkeypatch.setattr(D, "TASK_ENTRIES", 20)
    check(docs_of, corpus(3), top=50)


def test_odd_rows(docs_of):
    rows = [(i, "x Y z" * 3, "en", f"s{i % 2}") for i in range(6)]
    # a group without terms, a language without kept terms, a very long text, ties, repeated rows
    rows += [(7, None, "en", "none"), (8, "", "en", "none"), (9, "a b", "fr", "s0"), (10, "b c", "fr", "s1"), (11, "1 2 !", "fr", None)]
    rows += [(12, "x " * 200000, "en", "s0")] + [(13, "w q", "en", "s3")] * 4
    check(docs_of, rows)
    check(docs_of, [])


def test_probabilities_are_exact(spark):
    from pyspark.sql import functions as F

    n = 5 * 10**12
    df = spark.range(1).select(F.lit(n).alias("c"), F.lit(3 * n + 1).alias("t"), F.lit(77).cast("long").alias("v"))
    got = df.select(D.probability(F.col("c"), F.col("t"), F.col("v")).alias("p")).first()["p"]
    assert got == 1 + 1000000000 * (n + 5) // (3 * n + 1 + 5 * 77)
