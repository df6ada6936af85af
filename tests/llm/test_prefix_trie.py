import hashlib
import random
import zlib

import pytest

from annolytics.llm import prefix_trie as T


def rebuilt(rows):
    """conv_id -> list of (role, text), by the contract."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    return {c: own.get(c - c % 100, [])[: zlib.crc32(str(c).encode()) % 6] + ts[zlib.crc32(str(c).encode()) % 6 :] for c, ts in own.items()}


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out, totals = {}, {}
    for p in sorted(members, key=len, reverse=True):
        kids = children.get(p, [])
        leaves = sum(totals[k][0] for k in kids) if kids else 1
        saved = sum(totals[k][1] for k in kids) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        totals[p] = leaves, saved
        ends = ",".join(str(c) for c in sorted(members[p]) if len(convs[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out[min(members[p]), len(p)] = (parent, len(members[p]), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def check(spark, rows, height=T.HEIGHT):
    df = spark.createDataFrame(
        [(*r, 1, 2, 3, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, rep int, place int, chars string"
    )
    got = T.build_trie(T.rebuilt(T.ordered_turns(df)), height).collect()
    want = brute(rebuilt(rows))
    assert len(got) == len(want)
    for r in got:
        assert (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) == want[r["conv_id"], r["depth"]]


def corpus(seed, convs=150, longest=9):
    rnd = random.Random(seed)
    texts = ["", "hi", "é hello", "hi there", None]
    rows = []
    for c in rnd.sample(range(40, 320), convs):
        n = rnd.randint(1, longest)
        rows += [(c, None if rnd.random() < 0.05 else t, rnd.choice(["user", "user", "bot", None]), texts[0 if rnd.random() < 0.7 else rnd.randrange(5)]) for t in range(n)]
    return rows + rows[:9]


@pytest.mark.parametrize("height", [2, 3, 16])
def test_against_brute_force(spark, height):
    check(spark, corpus(height), height)


def test_deep_conversations_cross_several_bands(spark):
    rnd = random.Random(1)
    stem = [(t, "user", rnd.choice("abc")) for t in range(40)]
    rows = [(100 + c, *turn) for c in range(12) for turn in stem[: 40 - 3 * c]] + [(100 + c, 40 + t, "bot", f"{c % 3}") for c in range(12) for t in range(c)]
    check(spark, rows, 3)


def test_copies_and_many_ends(spark, monkeypatch):
    monkeypatch.setattr(T, "ENDS", 16)
    check(spark, [(c, t, "user", "same") for c in range(200, 300) for t in range(3)] + [(7, 1, "user", "x")])


def test_odd_rows(spark):
    check(spark, [(None, 1, "user", "no conversation"), (5, None, None, None), (5, None, None, None), (100, 1, "a", "b" * 100000), (101, 1, "ab", ""), (102, 1, "a", "b")])
    check(spark, [])
    with pytest.raises(ValueError):
        T.rollup(spark.range(0), spark.range(0), [], height=1)
