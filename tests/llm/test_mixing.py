import random
import re

from annolytics.llm import mixing as M


def targets(sizes, weights=(5, 2, 1), epochs=3):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = sum(sizes.values()), set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > epochs * sizes[s]]
        if not over:
            return out | {s: left * w[s] / total for s in open_}
        for s in over:
            out[s] = epochs * sizes[s]
            open_.discard(s)
        left = sum(sizes.values()) - sum(out.values())
    return out


def plan(docs):
    d = M.with_copies(docs, M.mix_plan(docs, slices=16))
    return [(r["doc_id"], r["source"], r["mix_size"], r["mix_target"], r["mix_copies"]) for r in d.collect()]


def test_targets_and_taken_words(docs_of):
    rnd = random.Random(5)
    rows, i = [], 0
    for source, n in (("a", 12), ("b", 700), ("c", 60), (None, 90), ("B", 200)):
        for _ in range(n):
            rows.append((i, " ".join("w" * rnd.randint(1, 3) for _ in range(rnd.randint(0, 20))), "en", source))
            i += 1
    out = plan(docs_of(rows))
    assert len(out) == len(rows)
    sizes = {}
    for i, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t))
    want = targets(sizes)
    for s in sizes:
        mine = [o for o in out if o[1] == s]
        assert abs(mine[0][3] - want[s]) < 1e-6 * max(1, want[s])
        assert abs(sum(o[2] * o[4] for o in mine) - want[s]) <= 45
        assert all(0 <= o[4] <= 3 for o in mine)
        assert len({o[4] for o in mine if o[2]}) <= 2  # a prefix of the queue
    assert sum(o[2] * o[4] for o in out) <= sum(sizes.values())
    assert sorted(plan(docs_of(rows)), key=str) == sorted(out, key=str)


def test_mix_returns_the_copies(docs_of):
    docs = docs_of([(1, "a b", "en", "x"), (2, "c d e", "en", "y"), (3, None, "en", "y"), (4, "", "en", None)])
    got = M.mix(docs)
    assert got.columns == docs.columns
    by_id = {r["doc_id"]: r["mix_copies"] for r in M.with_copies(docs, M.mix_plan(docs)).collect()}
    assert by_id[3] == 0 and by_id[4] == 0
    assert got.count() == sum(by_id.values())


def test_null_and_repeated_ids(docs_of):
    rows = [(None, "a b c", "en", "x"), (None, "d", "en", "x"), (7, "e f", "en", "x"), (7, "e f", "en", "x")]
    out = plan(docs_of(rows))
    assert len(out) == 4 and all(o[4] == 1 for o in out)


def test_empty(docs_of):
    assert plan(docs_of([])) == []
    assert [o[4] for o in plan(docs_of([(1, None, "en", None)]))] == [0]


def test_sources_without_words_keep_their_place(docs_of):
    """A, B (no words), C, D weigh 5, 2, 1, 5."""
    rows = [(1, "w " * 100, "en", "A"), (2, None, "en", "B"), (3, "w " * 100, "en", "C"), (4, "w " * 100, "en", "D")]
    got = {r["source"]: (r["weight"], r["target"]) for r in M.mix_plan(docs_of(rows)).collect()}
    assert {s: w for s, (w, _) in got.items()} == {"A": 5.0, "B": 2.0, "C": 1.0, "D": 5.0}
    assert got["B"][1] == 0 and abs(got["A"][1] - 1500 / 11) < 1e-9 and abs(got["C"][1] - 300 / 11) < 1e-9 and got["D"] == got["A"]
