"""Source divergence audit by Gustavson row accumulation.

Terms are runs of ASCII letters and bytes above 127, with A-Z lower-cased.
Each language keeps the V terms that occur in at least ``min_docs`` of its
documents.  A (language, source) group gives a kept term with ``count``
occurrences there p = 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V)),
where N is the group's number of occurrences of kept terms; a whole language
gives every term q in the same way.

The distance of two groups of a language is the sum of abs(p - p') over all
kept terms.  Written as one row of groups times the terms-by-groups matrix it
is a sparse row product (Gustavson): a group scatters its own terms through
the term-major index into an accumulator with one place per peer.  A term
that a group lacks is not zero there but the group's baseline p0, so

    distance(g, h) = V |g0 - h0|
                   + sum over g's terms of (|pg - h0| - |g0 - h0|)
                   + sum over h's terms of (|ph - g0| - |g0 - h0|)
                   + sum over shared terms of
                     (|pg - ph| - |pg - h0| - |ph - g0| + |g0 - h0|).

The first two sums come for all peers at once from a group's sorted p values
and their prefix sums, the last one from the scatter.

Scale: occurrences are counted inside the tasks that read the texts, so the
shuffle carries (language, source, term, count, documents) and never single
occurrences or posting pairs.  The index is cut by hashed term into blocks of
about ``BLOCK_POSTINGS`` postings, so a language or a source with a third of
all rows is spread like any other; a block needs one accumulator row at a
time, one number per peer, and its dense rows are summed by (group, peer) with
map-side combination.

Defined cases: null text, lang or source reads as ''; a text without terms
still makes its group occur; a language without kept terms gives pair values
of 0 and no term rows; repeated rows are documents of their own; ties go to
the smaller item in UTF-8 order; an empty table gives no rows.  Columns of the
input beyond text, lang and source are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolytics.llm.common import small_batches
from annolytics.session import materialize

#: Fixed values of the measure.
SCALE = 1_000_000_000
PRIOR = 5

#: Postings that one block of the term-major index holds, about.
BLOCK_POSTINGS = 250_000
#: Distinct (group, term) entries a task counts before it hands them on.
TASK_ENTRIES = 400_000

#: Groups up to which their table is broadcast.
BROADCAST_GROUPS = 100_000

_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) counted over a task's texts; a row with
    an empty term says that the group occurs."""
    counts: dict[tuple[bytes, bytes], Counter] = {}
    docs: dict[tuple[bytes, bytes], Counter] = {}

    def flush():
        for group, c in counts.items():
            terms = list(c)
            d = docs[group]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([group[0]] * len(terms), pa.binary()),
                    pa.array([group[1]] * len(terms), pa.binary()),
                    pa.array(terms, pa.binary()),
                    pa.array([c[t] for t in terms], pa.int64()),
                    pa.array([d[t] for t in terms], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    for batch in batches:
        for text, lang, source in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            group = lang, source
            if group not in counts:
                counts[group], docs[group] = Counter({b"": 0}), Counter()
            words = text.translate(_FOLD).split()
            c = Counter(words)
            counts[group].update(c)
            docs[group].update(c.keys())
        if sum(map(len, counts.values())) > TASK_ENTRIES:
            yield from flush()
            counts, docs = {}, {}
    yield from flush()


def term_counts(documents: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of every term in a group
    and the group's documents that hold it."""
    small_batches(documents.sparkSession)
    bare = documents.select(*[F.coalesce(F.col(c), F.lit("")).cast("binary").alias(c) for c in ("text", "lang", "source")])
    counted = bare.mapInArrow(_count, "lang binary, source binary, term binary, n long, docs long")
    summed = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return summed.select(*[F.decode(c, "utf-8").alias(c) for c in ("lang", "source", "term")], "n", "docs")


def probability(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * kept)), exact."""
    top = (count + PRIOR).cast("decimal(28,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", top, (total + PRIOR * kept).cast("decimal(20,0)")).cast("long") + 1


def _accumulate(table: pa.Table) -> pa.Table:
    """One block of the index: for every group of the block a dense row over
    its peers, of twice the sum over its terms plus the sum over shared terms
    (the halves of both directions give the distance)."""
    term, peer, p, p0 = (table.column(c).to_numpy(zero_copy_only=False) for c in ("term", "peer", "p", "p0"))
    head = term < 0
    base = np.zeros(int(head.sum()), dtype=np.int64)
    base[peer[head]] = p0[head]
    order = np.lexsort((peer[~head], term[~head]))
    term, peer, p = term[~head][order], peer[~head][order].astype(np.int64), p[~head][order]
    # term-major index: postings of term j lie in start[j]:start[j + 1]
    _, place = np.unique(term, return_inverse=True)
    start = np.concatenate([[0], np.cumsum(np.bincount(place))]).astype(np.int64)
    rows = np.argsort(peer, kind="stable")  # the same postings, group-major
    first = np.searchsorted(peer[rows], np.arange(len(base) + 1))
    by_base = np.sort(base)
    of_base = np.argsort(base, kind="stable")
    groups, sums = [], []
    for g in range(len(base)):
        own = rows[first[g] : first[g + 1]]
        if not len(own):
            continue
        mine, j = p[own], place[own]
        # dense part: sum over own terms of |pg - h0| - |g0 - h0|, every h
        values = np.sort(mine)
        before = np.concatenate([[0], np.cumsum(values)])
        below = np.searchsorted(values, by_base, side="right")
        spread = by_base * below - before[below] + (before[-1] - before[below]) - by_base * (len(values) - below)
        acc = np.empty(len(base), dtype=np.int64)
        acc[of_base] = 2 * (spread - len(values) * np.abs(by_base - base[g]))
        # scatter through the index: postings of all own terms, one after another
        width = start[j + 1] - start[j]
        at = np.repeat(start[j] - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(width.sum())
        h, x = peer[at], np.repeat(mine, width)
        shared = np.abs(x - p[at]) - np.abs(x - base[h]) - np.abs(p[at] - base[g]) + np.abs(base[h] - base[g])
        np.add.at(acc, h, shared)
        groups.append(g)
        sums.append(acc)
    lang = table.column("lang")[0].as_py()
    return pa.table(
        {
            "lang": pa.array([lang] * len(groups), pa.string()),
            "peer": pa.array(groups, pa.int32()),
            "sums": pa.array([s.tolist() for s in sums], pa.list_(pa.int64())),
        }
    )


def audit(documents: DataFrame, min_docs: int = 30, top_terms: int = 50) -> DataFrame:
    """Per (lang, source) group all other sources of its language by distance
    (part ``pair``), and the ``top_terms`` terms it overuses most (``term``):
    lang, source, part, item, value, rank."""
    counted = materialize(term_counts(documents), "divergence-counts")
    by_term = counted.filter("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    kept = materialize(by_term.filter(F.col("docs") >= min_docs).select("lang", "term", "lang_n"), "divergence-kept")
    own = counted.filter("term <> ''").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n")
    own = materialize(own, "divergence-postings")

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"))
    groups = counted.groupBy("lang", "source").agg(F.lit(True).alias("occurs")).drop("occurs")
    blocks = own.groupBy("lang").agg((F.count(F.lit(1)) / BLOCK_POSTINGS).cast("int").alias("more"))
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(blocks, "lang", "left").na.fill(0)
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    baseline = F.when(F.col("v") > 0, probability(F.lit(0).cast("long"), F.col("total"), F.col("v"))).otherwise(F.lit(0))
    groups = materialize(groups.withColumn("peer", number.cast("int")).withColumn("p0", baseline.cast("long")), "divergence-groups")

    p = probability(F.col("n"), F.col("total"), F.col("v"))
    of_group = groups.select("lang", "source", "total", "v", "lang_total", "peer", "p0", "more")
    # one row a group; beyond the bound the join goes by (lang, source)
    of_group = F.broadcast(of_group) if groups.count() <= BROADCAST_GROUPS else of_group
    postings = own.join(of_group, ["lang", "source"]).withColumn("p", p)

    # part pair
    block = F.pmod(F.xxhash64("term"), F.col("more") + 1).cast("int").alias("block")
    index = postings.select("lang", block, "term", "peer", "p", "p0")
    # terms of a block are numbered by place after sorting, so the text itself travels once
    numbered = index.withColumn("term", F.dense_rank().over(Window.partitionBy("lang", "block").orderBy("term")).cast("long"))
    heads = groups.filter("v > 0").select(
        "lang", F.explode(F.sequence(F.lit(0), "more")).alias("block"), F.lit(-1).cast("long").alias("term"), "peer", F.lit(0).cast("long").alias("p"), "p0"
    )
    dense = numbered.unionByName(heads).groupBy("lang", "block").applyInArrow(_accumulate, "lang string, peer int, sums array<long>")
    cells = dense.select("lang", "peer", F.posexplode("sums").alias("other", "x"))
    low, high = F.least("peer", "other").alias("a"), F.greatest("peer", "other").alias("b")
    twice = cells.filter("peer <> other").groupBy("lang", low, high).agg(F.sum("x").alias("x"))

    peers = groups.groupBy("lang").agg((F.count(F.lit(1)) - 1).cast("int").alias("last"))
    left = groups.join(peers, "lang").filter("peer < last").select(
        "lang", F.col("peer").alias("a"), F.col("source").alias("source_a"), F.col("p0").alias("p0_a"), "v", F.explode(F.sequence(F.col("peer") + 1, "last")).alias("b")
    )
    right = groups.select("lang", F.col("peer").alias("b"), F.col("source").alias("source_b"), F.col("p0").alias("p0_b"))
    pairs = left.join(right, ["lang", "b"]).join(twice, ["lang", "a", "b"], "left")
    value = F.col("v") * F.abs(F.col("p0_a") - F.col("p0_b")) + F.coalesce(F.expr("x div 2"), F.lit(0))
    sides = F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")), F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")))
    pairs = pairs.select("lang", value.alias("value"), F.explode(sides).alias("s")).select("lang", "s.source", "s.item", "value")
    nearest = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair_rows = pairs.withColumn("rank", F.row_number().over(nearest)).withColumn("part", F.lit("pair"))

    # part term
    q = probability(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    over = postings.filter("n > 0").withColumn("value", F.col("p") - q).filter("value > 0")
    over = over.select("lang", "source", F.col("term").alias("item"), "value")
    term_rows = over.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= top_terms).withColumn("part", F.lit("term"))
    return pair_rows.unionByName(term_rows).select("lang", "source", "part", "item", F.col("value").cast("long"), F.col("rank").cast("int"))
