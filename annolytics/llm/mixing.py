"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a keyed pseudo-random order,
repeated for at most ``max_epochs`` passes.  A queued copy finishes at the
virtual time (words of its source up to and including it) / (weight of the
source).  All copies are sorted by virtual finish time and the prefix whose
words fit the budget (all words of the input) is taken.  A source whose
queue runs dry leaves its share to the others, which is exactly the
water-filling of the stated targets.

Scale: only (source, document id, words) move.  Each source is cut into
``slices`` equal ranges of the shuffle hash, so a source with a third of all
rows is spread over as many tasks; running sums combine a window inside a
slice with a window over the slice sums.  The global sort is ranged the same
way: words are summed per range of virtual time (a table of at most
``slices`` rows), only the range that holds the budget is sorted row by row.
A source's taken copies are a prefix of its queue, so the decision about a
document needs one row per source: whole passes, and the place in the queue
where the last pass stops.

Defined cases: a null text or one without words has size 0 and is not taken;
a source without words has its place in the order of the sources and the
target 0;
rows with one (source, document id) are a single entry of the queue with the
sum of their words and share its fate; the null source is a source of its
own, ordered last; null document ids are one entry per source; an empty
table, or one without any word, takes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolytics.llm.common import prefixed, restored, words
from annolytics.session import materialize

WEIGHTS = (5, 2, 1)


def queue_place(seed: int, doc_id: Column) -> Column:
    """Place in the shuffled queue: 60 bits of a digest of seed and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """(source, weight, source_size, target) from (source, source_size).

    One row per source in and out; the windows see nothing else.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(by_name) - 1) % len(weights))
    s = sizes.select("source", "source_size", w.alias("weight"))
    # level at which a source is full; below it a source gets weight * level
    full = (F.lit(float(max_epochs)) * F.col("source_size") / F.col("weight")).alias("full")
    s = s.select("*", full)
    in_order = Window.orderBy("full", F.col("source").isNull(), "source")
    upto = in_order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = s.select(
        "*",
        F.coalesce(F.sum("source_size").over(upto), F.lit(0)).alias("_less"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))).alias("_open"),
        F.sum("source_size").over(everything).alias("_total"),
        F.row_number().over(in_order).alias("_at"),
    )
    # the level if this source and all fuller ones stay open
    s = s.select("*", ((F.col("_total") - max_epochs * F.col("_less")) / F.col("_open")).alias("_level"))
    first = F.min(F.when(F.col("_level") <= F.col("full"), F.struct("_at", "_level"))).over(everything)
    level = first["_level"]
    target = F.least(F.lit(float(max_epochs)) * F.col("source_size"), F.col("weight") * F.coalesce(level, F.lit(0.0)))
    return s.select("source", "weight", "source_size", target.alias("target"))


def _running(df: DataFrame, by: list[str], slice_col: str, order: list[str], value: str, out: str) -> DataFrame:
    """Running sum of ``value`` in slice order, then ``order``, per ``by``."""
    sums = df.groupBy(*by, slice_col).agg(F.sum(value).alias("_v"))
    before = Window.partitionBy(*by).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(c).alias("_" + c) for c in [*by, slice_col]], F.coalesce(F.sum("_v").over(before), F.lit(0)).alias("_before"))
    same = [F.col(c).eqNullSafe(F.col("_" + c)) for c in [*by, slice_col]]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    inside = Window.partitionBy(*by, slice_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    x = df.withColumn(out, F.sum(value).over(inside)).join(sums, cond, "left")
    return x.withColumn(out, F.col(out) + F.col("_before")).drop("_before", *["_" + c for c in [*by, slice_col]])


def mix_plan(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_epochs: int = 3,
    seed: int = 17,
    slices: int = 1024,
) -> DataFrame:
    """One row per source: weight, source_size, target, and the cut of its
    queue: ``passes`` whole passes are taken, and of one pass more the
    entries up to (``cut_place``, ``cut_id``)."""
    sized = docs.select("source", "doc_id", F.size(words(F.col("text"))).cast("long").alias("size"))
    sized = materialize(sized, "mix-sizes")
    queue = sized.filter("size > 0").groupBy("source", "doc_id").agg(F.sum("size").alias("size"))
    queue = queue.select(
        "*",
        queue_place(seed, F.col("doc_id")).alias("place"),
    ).withColumn("slice", F.shiftright("place", 60 - (slices - 1).bit_length()))
    queue = materialize(queue, "mix-queue")
    # every source is numbered, also one without any word
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = materialize(source_targets(sizes, weights, max_epochs), "mix-targets")
    entries = _running(queue, ["source"], "slice", ["place", "doc_id"], "size", "words")
    p = plan.select(F.col("source").alias("_s"), "weight", "source_size")
    entries = entries.join(p, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    copies = entries.select(
        "source",
        "doc_id",
        "place",
        "size",
        "weight",
        "source_size",
        F.posexplode(F.array(*[F.lit(float(k)) for k in range(max_epochs)])).alias("epoch", "_k"),
        "words",
    ).withColumn("finish", (F.col("words") + F.col("_k") * F.col("source_size")) / F.col("weight"))
    copies = materialize(copies.select("source", "doc_id", "place", "size", "epoch", "finish"), "mix-copies")
    # global order: ranges of virtual time first, rows only in the last range
    stats = plan.agg(F.sum("source_size").alias("budget"), F.max(max_epochs * F.col("source_size") / F.col("weight")).alias("end")).first()
    budget, end = stats["budget"] or 0, stats["end"] or 1.0
    at = F.least(F.floor(F.col("finish") / F.lit(end) * slices), F.lit(slices - 1)).cast("int")
    ranges = copies.groupBy(at.alias("range")).agg(F.sum("size").alias("n"))
    ranges = ranges.withColumn("upto", F.sum("n").over(Window.orderBy("range")))
    over = ranges.filter(F.col("upto") > budget).agg(F.min("range").alias("range")).first()["range"]
    if over is None:
        taken = copies
    else:
        before = ranges.filter(F.col("range") < over).agg(F.sum("n").alias("n")).first()["n"] or 0
        inside = copies.filter(at == over)
        # the boundary range once more in equal parts, each with its own window
        lo, width = over * end / slices, end / slices
        inside = inside.withColumn("part", F.floor((F.col("finish") - F.lit(lo)) / F.lit(width) * slices))
        inside = inside.withColumn("all", F.lit(0))
        inside = _running(inside, ["all"], "part", ["finish", "source", "place", "doc_id"], "size", "upto")
        inside = inside.filter(F.col("upto") + before <= budget)
        taken = copies.filter(at < over).unionByName(inside.select(*copies.columns))
    last = taken.groupBy("source").agg(F.max(F.struct("epoch", "place", "doc_id")).alias("last"))
    last = last.select(F.col("source").alias("_s"), "last")
    out = plan.join(last, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        "source",
        "weight",
        "source_size",
        "target",
        F.coalesce("last.epoch", F.lit(0)).alias("passes"),
        F.col("last.place").alias("cut_place"),
        F.col("last.doc_id").alias("cut_id"),
    )
    return materialize(out, "mix-plan")


#: Columns that ``with_copies`` adds.
ADDED = ("mix_size", "mix_source_size", "mix_target", "mix_copies")


def _with_copies(docs: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``docs`` with all columns renamed to doc_..., and the added ones."""
    p = prefixed(plan, "plan_")
    d = prefixed(docs, "doc_").withColumn("mix_size", F.size(words(F.col("doc_text"))).cast("long"))
    d = d.join(p, F.col("doc_source").eqNullSafe(F.col("plan_source")), "left")
    place, cut = queue_place(seed, F.col("doc_doc_id")), F.col("plan_cut_place")
    first_ids = F.col("doc_doc_id").isNull() | F.coalesce(F.col("doc_doc_id") <= F.col("plan_cut_id"), F.lit(False))
    in_last = F.coalesce((place < cut) | ((place == cut) & first_ids), F.lit(False))
    copies = F.when(F.col("mix_size") > 0, F.coalesce(F.col("plan_passes"), F.lit(0)) + in_last.cast("int")).otherwise(0)
    return d.select(
        *prefixed(docs, "doc_").columns,
        "mix_size",
        F.coalesce("plan_source_size", F.lit(0)).cast("long").alias("mix_source_size"),
        F.coalesce("plan_target", F.lit(0.0)).alias("mix_target"),
        copies.alias("mix_copies"),
    )


def with_copies(docs: DataFrame, plan: DataFrame, seed: int = 17) -> DataFrame:
    """``docs`` with mix_size, mix_source_size, mix_target and mix_copies, the
    number of times that the mix takes the document; columns of these names
    that ``docs`` has are replaced."""
    own = [c for c in docs.columns if c not in ADDED]
    return _with_copies(docs, plan, seed).select(*restored(own, "doc_"), *ADDED)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: every taken copy as a row with the columns of
    ``docs``.  A consumer that wants the interleaved order sorts by
    (words before it in its source) / weight, as the plan does."""
    d = _with_copies(docs, mix_plan(docs, **options), options.get("seed", 17))
    copies = F.explode(F.array_repeat(F.lit(0), F.col("mix_copies"))).alias("mix_copy")
    return d.select("*", copies).select(*restored(docs.columns, "doc_"))
