"""Approximate nearest neighbours (largest inner product) by a pruned graph
per shard.

Distinct vectors are dealt by hash to shards of about ``shard_rows`` rows.
Each shard is one directed graph, built in batches: a greedy beam search on
the graph so far proposes neighbours for a new point; robust pruning keeps a
candidate only if no kept neighbour is ``alpha`` times closer to it than the
point is; reverse edges are added and pruned the same way.  Queries, in
blocks, run a beam search on every shard, and the shards' best are merged
with scores in double precision on the original vectors.

Inner products become distances by one extra coordinate,
sqrt(max norm^2 - norm^2), which is 0 for queries; the largest inner product
is then the nearest point.

Copies: equal vectors are indexed once.  A class of copies can contribute at
most k + 1 members to an answer (its smallest ids, one of which may be the
query itself), so that many are kept beside the index, and results are still
those over all rows.

Scale: a task holds one shard, or one shard and one block of queries, both of
bounded size.  A row of the index is a whole shard in binary form (vectors in
the width they came in, graph, entry points; what follows from them is
computed on loading).  Rows of the index and blocks of queries are dealt by
shard and sorted, the shard first: each shard moves and is loaded once, and
the query blocks stream past it.

Defined cases: vectors that are null, empty, all zero, or hold null or
non-finite components take no part; only vectors of one length are compared;
rows with a null id are candidates of nobody and no query; a repeated id
counts as one copy per row; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolytics.session import checked_broadcast, materialize

DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA, STRICT, ENTRIES = 32, 64, 112, 1.2, 0.8, 256
SHARD_ROWS, BLOCK_ROWS = 8192, 1024


# --- one shard, in numpy ---------------------------------------------------------


def beam_search(x, graph, entries, q, beam, trail=None):
    """Best ``beam`` (ids, squared distances) on a graph for each row of
    ``q``, all rows in step, from the best of the entry points; ``trail``
    collects the expanded ids."""
    n = len(q)
    ids = np.full((n, beam), -1, np.int32)
    dist = np.full((n, beam), np.inf, np.float32)
    done = np.zeros((n, beam), bool)
    seen = np.zeros((n, len(x)), bool)
    e = x[entries]
    first = (q * q).sum(axis=1)[:, None] + (e * e).sum(axis=1) - 2 * q @ e.T
    order = np.argsort(first, axis=1, kind="stable")[:, :beam]
    wide = order.shape[1]
    ids[:, :wide] = entries[order]
    gap = x[ids[:, :wide]] - q[:, None, :]
    dist[:, :wide] = np.einsum("ijk,ijk->ij", gap, gap)
    seen[:, entries] = True
    while True:
        open_ = ~done & (ids >= 0)
        act = np.flatnonzero(open_.any(axis=1))
        if not len(act):
            return ids, dist
        pos = open_[act].argmax(axis=1)
        done[act, pos] = True
        node = ids[act, pos]
        if trail is not None:
            col = np.full(n, -1, np.int32)
            col[act] = node
            trail.append(col)
        near = graph[node]
        fresh = (near >= 0) & ~seen[act[:, None], near]
        near_ = np.where(fresh, near, 0)
        r, c = np.nonzero(fresh)
        seen[act[r], near[r, c]] = True
        gap = x[near_] - q[act][:, None, :]  # differences keep close points apart
        d = np.einsum("ijk,ijk->ij", gap, gap)
        d[~fresh] = np.inf
        all_d = np.concatenate([dist[act], d], axis=1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        rows = np.arange(len(act))[:, None]
        dist[act] = all_d[rows, order]
        kept = np.concatenate([ids[act], np.where(fresh, near, -1)], axis=1)[rows, order]
        kept[np.isinf(dist[act])] = -1
        ids[act] = kept
        done[act] = np.concatenate([done[act], np.zeros(near.shape, bool)], axis=1)[rows, order]


def robust_prune(x, points, cand, degree, alpha):
    """At most ``degree`` neighbours per point out of the candidate ids
    (-1: none), nearest first, dropping what a kept one covers.

    A first round at STRICT keeps a few edges that differ much in direction
    or distance (so that a dense cluster is not an island); the relaxed round
    at ``alpha`` fills the rest."""
    cand = np.sort(cand, axis=1)
    valid = (cand >= 0) & (cand != points[:, None])
    valid[:, 1:] &= cand[:, 1:] != cand[:, :-1]
    v = x[np.where(valid, cand, 0)] - x[points][:, None, :]
    vn = np.einsum("ijk,ijk->ij", v, v)
    d = vn.copy()
    d[~valid] = np.inf
    between = vn[:, :, None] + vn[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
    out = np.full((len(points), degree), -1, np.int32)
    rows = np.arange(len(points))
    used = np.zeros(len(points), np.int64)
    taken = np.zeros(d.shape, bool)
    for factor, most in ((STRICT, degree // 4), (alpha, degree)):
        left = np.where(taken, np.inf, d)
        if factor == alpha:  # what the first round kept covers others too
            covered = ((alpha * alpha) * between <= d[:, None, :]) & taken[:, :, None]
            left[covered.any(axis=1)] = np.inf
        for _ in range(most):
            best = left.argmin(axis=1)
            some = np.isfinite(left[rows, best]) & (used < most)
            if not some.any():
                break
            out[rows[some], used[some]] = cand[rows, best][some]
            taken[rows[some], best[some]] = True
            used += some
            left[(factor * factor) * between[rows, best] <= d] = np.inf
            left[rows, best] = np.inf
    return out


def build_graph(x: np.ndarray, degree=DEGREE, beam=BUILD_BEAM, alpha=ALPHA, seed=5) -> tuple[np.ndarray, np.ndarray]:
    """(neighbours, entry points) of the pruned graph over the rows of ``x``."""
    n = len(x)
    graph = np.full((n, degree), -1, np.int32)
    order = np.random.default_rng(seed).permutation(n).astype(np.int32)
    entries = order[:ENTRIES]
    at, size = 1, 1
    while at < n:
        new = order[at : at + size]
        known = entries[: at]
        at, size = at + size, min(2 * size, 512, max(1, at // 8 + 1))
        trail: list[np.ndarray] = []
        found, _ = beam_search(x, graph, known, x[new], beam, trail)
        cand = np.concatenate([found, np.stack(trail, axis=1)], axis=1)
        graph[new] = robust_prune(x, new, cand, degree, alpha)
        # reverse edges, pruned where a point has too many
        src = np.repeat(new, degree)
        dst = graph[new].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        target, first, count = np.unique(dst, return_index=True, return_counts=True)
        place = np.arange(len(dst)) - np.repeat(first, count)
        # targets in groups of similar numbers of newcomers bound the padding
        for lo, hi in ((1, 8), (8, 64), (64, 1 << 30)):
            some = np.flatnonzero((count >= lo) & (count < hi))
            if not len(some):
                continue
            for part in np.array_split(some, -(-len(some) // 512)):
                extra = np.full((len(part), int(count[part].max())), -1, np.int32)
                for i, t in enumerate(part):
                    extra[i, : count[t]] = src[first[t] : first[t] + count[t]]
                cand = np.concatenate([graph[target[part]], extra], axis=1)
                fits = (cand >= 0).sum(axis=1) <= degree
                merged = -np.sort(-cand[fits], axis=1)[:, :degree]
                graph[target[part[fits]]] = merged
                if not fits.all():
                    graph[target[part[~fits]]] = robust_prune(x, target[part[~fits]], cand[~fits], degree, alpha)
    return graph, entries


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, summed in order."""
    s = np.zeros(len(a))
    for j in range(a.shape[1]):
        s += a[:, j] * b[:, j]
    return s


# --- the distributed steps ------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)) & ~F.isnan(v))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _pack(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return pdf["id"].to_numpy(np.int64), np.vstack(pdf["v"]).astype(np.float64)


def _narrow(vectors: np.ndarray) -> bytes:
    """The vectors in single precision if that holds them exactly."""
    single = vectors.astype(np.float32)
    return (single if (single == vectors).all() else vectors).tobytes()


def _wide(raw: bytes, rows: int, dim: int) -> np.ndarray:
    """What ``_narrow`` stored, in double precision."""
    kind = np.float32 if len(raw) == 4 * rows * dim else np.float64
    return np.frombuffer(raw, kind).reshape(rows, dim).astype(np.float64)


def _points(vectors: np.ndarray, top: float) -> np.ndarray:
    """The vectors with the coordinate that turns products into distances."""
    extra = np.sqrt(np.maximum(top - (vectors * vectors).sum(axis=1), 0))
    return np.hstack([vectors, extra[:, None]]).astype(np.float32)


def build_index(classes: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard (ids, vectors, graph, entry points in binary form),
    from distinct vectors (id, v)."""
    sizes = classes.groupBy(F.size("v").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, t: s + t.cast("double") * t.cast("double"))).alias("top")
    )
    sizes = sizes.select("d", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards"), "top")
    dealt = classes.join(checked_broadcast(sizes, "ann-sizes"), F.size("v") == F.col("d"))  # one row per vector length
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards")).cast("int"))

    def build(key, pdf):
        ids, vectors = _pack(pdf)
        top = float(pdf["top"].iloc[0])
        graph, entries = build_graph(_points(vectors, top))
        return pd.DataFrame(
            {
                "dim": [vectors.shape[1]],
                "shard": [key[1]],
                "shards": [int(pdf["shards"].iloc[0])],
                "top": [top],
                "ids": [ids.tobytes()],
                "vectors": [_narrow(vectors)],
                "graph": [graph.tobytes()],
                "entries": [entries.tobytes()],
            }
        )

    return dealt.groupBy("d", "shard").applyInPandas(build, INDEX)


#: Columns of the index.
INDEX = "dim int, shard int, shards int, top double, ids binary, vectors binary, graph binary, entries binary"


class _Shard:
    """A loaded row of the index."""

    def __init__(self, r):
        self.ids = np.frombuffer(r.ids, np.int64)
        self.vectors = _wide(r.vectors, len(self.ids), r.dim)
        self.points = _points(self.vectors, r.top)
        self.graph = np.frombuffer(r.graph, np.int32).reshape(len(self.ids), -1)
        self.entries = np.frombuffer(r.entries, np.int32)

    def best(self, ids: np.ndarray, queries: np.ndarray, k: int, beam: int):
        """Frames of the best ``k`` rows for each query."""
        for at in range(0, len(ids), 256):
            part = queries[at : at + 256]
            q = np.hstack([part, np.zeros((len(part), 1))]).astype(np.float32)
            found, _ = beam_search(self.points, self.graph, self.entries, q, max(beam, k))
            row, col = np.nonzero(found >= 0)
            hit = found[row, col]
            score = inner_products(part[row], self.vectors[hit])
            out = pd.DataFrame({"query_id": ids[at + row], "id": self.ids[hit], "score": score})
            yield out.sort_values(["query_id", "score", "id"], ascending=[True, False, True]).groupby("query_id", sort=False).head(k)


def search(index: DataFrame, queries: DataFrame, k: int, block_rows: int = BLOCK_ROWS, beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, id, score): the best ``k`` indexed vectors of every shard
    for every query (id, v)."""
    sizes = index.groupBy("dim").agg(F.max("shards").alias("shards"))
    n = queries.count()
    block = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // block_rows)))).cast("int")

    def pack(key, pdf):
        ids, vectors = _pack(pdf)
        return pd.DataFrame({"dim": [key[0]], "ids": [ids.tobytes()], "vectors": [_narrow(vectors)]})

    blocks = queries.select(F.size("v").alias("d"), block.alias("block"), "id", "v").groupBy("d", "block").applyInPandas(
        pack, "dim int, ids binary, vectors binary"
    )
    # the stated query set, in blocks, against every shard
    asked = blocks.join(checked_broadcast(sizes, "ann-lengths"), "dim").select(
        "dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(1).alias("kind"), "ids", "vectors"
    )
    rows = index.drop("shards").withColumn("kind", F.lit(0)).unionByName(asked, allowMissingColumns=True)
    dealt = rows.repartition("dim", "shard").sortWithinPartitions("dim", "shard", "kind")

    def run(frames):
        shard = None
        for pdf in frames:
            for r in pdf.itertuples():
                if r.kind == 0:
                    shard = _Shard(r)
                else:
                    ids = np.frombuffer(r.ids, np.int64)
                    yield from shard.best(ids, _wide(r.vectors, len(ids), r.dim), k, beam)

    return dealt.mapInPandas(run, "query_id long, id long, score double")


#: Parts into which the copies of one vector are dealt.
SALTS = 64


def smallest_ids(rows: DataFrame, n: int) -> DataFrame:
    """(id, v, class, place): the ``n`` smallest ids of every vector, numbered,
    and the smallest as its class.  Each of ``SALTS`` parts of a class is cut
    first, by a limit that also holds before the shuffle, so that no task sees
    more of a class than one part, or the survivors of all."""
    part = Window.partitionBy("v", "salt").orderBy("id")
    cut = rows.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))
    cut = cut.withColumn("nth", F.row_number().over(part)).filter(F.col("nth") <= n).select("id", "v")
    w = Window.partitionBy("v").orderBy("id")
    members = cut.select("id", "v", F.first("id").over(w).alias("class"), F.row_number().over(w).alias("place"))
    return members.filter(F.col("place") <= n)


def nearest(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows found for
    each row of ``df`` that ``is_query`` selects."""
    # single precision stays so on the way; all arithmetic is in double
    width = "array<float>" if df.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(width).alias("v"), is_query.alias("q"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v")))
    # the k + 1 smallest ids of every class of equal vectors
    members = materialize(smallest_ids(rows, k + 1), "ann-members")
    index = materialize(build_index(members.filter("place = 1").select("id", "v")), "ann-index")
    found = materialize(search(index, rows.filter(F.coalesce("q", F.lit(False))).select("id", "v").distinct(), k + 1), "ann-found")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    copies = members.filter("place > 1").select("class", F.col("id").alias("copy"))
    others = found.join(copies, found["id"] == copies["class"]).select("query_id", F.col("copy").alias("vec_id"), "score")
    all_ = found.select("query_id", F.col("id").alias("vec_id"), "score").union(others).filter("vec_id <> query_id")
    ranked = all_.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
