import random

import numpy as np
import pytest

from annolytics.llm import hyperminhash as H


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, k, percent):
    """Smallest reachable id per row, by all pairs."""
    sets = {i: shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    top = {i: i for i in ids}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(rnd.randint(1, 4)))
    rows = []
    base = [word() for _ in range(120)]
    for _ in range(150):  # one large group at all similarities
        w = list(base)
        for _ in range(rnd.randint(0, 9)):
            w[rnd.randrange(len(w))] = word()
        rows.append(" ".join(w))
    for _ in range(40):
        w = [word() for _ in range(rnd.randint(1, 60))]
        rows.append(" ".join(w))
        for _ in range(rnd.randint(0, 3)):
            v = list(w)
            v[rnd.randrange(len(v))] = word()
            rows.append(" ".join(v).upper())
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_against_all_pairs(spark, docs_of, monkeypatch, k, percent):
    monkeypatch.setattr(H, "TILE", 32)
    rows = corpus(k)
    want, n = brute(rows, k, percent)
    got = H.near_duplicates(docs_of([(i, t, "en", "s") for i, t in rows]), k, percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == n
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_edges(docs_of):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "one two"), (7, "a b c d"), (7, "a b c d"), (None, "a b c d"), (8, long), (9, long + " end"), (10, "one two")]
    got = [tuple(r) for r in H.near_duplicates(docs_of([(i, t, "en", "s") for i, t in rows]), 3, 85).collect()]
    assert sorted(got, key=str) == sorted(
        [
            (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (7, 2, 7, True), (7, 2, 7, True),
            (None, 2, None, True), (8, 29_998, 8, True), (9, 29_999, 8, False), (10, 1, 10, True),
        ],
        key=str,
    )
    assert H.near_duplicates(docs_of([]), 3, 85).count() == 0


def test_estimate_is_close():
    rnd = np.random.default_rng(1)
    for size, j in ((100, 0.85), (2000, 0.85), (2000, 0.5), (40, 0.9)):
        miss = 0
        for _ in range(200):
            same = int(2 * size * j / (1 + j))
            pool = rnd.integers(0, 2**63, 2 * size, dtype=np.uint64) * np.uint64(2)
            a, b = np.sort(pool[:size]), np.sort(np.r_[pool[:same], pool[size : 2 * size - same]])
            cls = H.size_class(size)
            ra, rb = (H.unfold([H.fold(H.registers_of(x, cls), 352)], 352) for x in (a, b))
            real = same / (2 * size - same)
            ok = H.may_link(ra, rb, np.array([size]), np.array([size]), 0.85)[0]
            miss += (real >= 0.85 and not ok) or (real < 0.6 and ok)
        assert miss == 0, (size, j)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(500, i) for i in range(501, 560)]
    edges = spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")
    got = {r[0]: r[1] for r in H.components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 500 for i in range(500, 560)}


def test_one_id_with_several_texts(docs_of):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (4, "alone here with five words"), (4, None), (5, a), (5, a), (None, b), (3, "")]
    got = H.near_duplicates(docs_of([(i, t, "en", "s") for i, t in rows])).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got} == {
        (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 1, False), (None, None, True)
    }
    assert sorted(r["n_shingles"] for r in got if r["doc_id"] == 4) == [0, 1]


def test_texts_of_candidates_only_leave_the_scan(spark, docs_of):
    docs = docs_of([(i, f"text number {i} with some words", "en", "s") for i in range(50)])
    pairs = spark.createDataFrame([(1, 2)], "a long, b long")
    seen = []
    original = H.materialize

    def watch(df, name):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return original(df, name)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(H, "materialize", watch)
        H._confirmed(pairs, docs, 5, 80).collect()
    plan = dict(seen)["dup-texts"]
    assert "BroadcastHashJoin" in plan and "SortAggregate" not in plan and "hashpartitioning" not in plan
