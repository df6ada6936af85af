"""Conversation prefix trie with a depth-band rollup.

Every distinct sequence of first d turns (role, text) is a node of depth d;
the textless root has depth 0.  A node is named by its smallest member and
its depth.

Node identity.  A conversation's prefix is known by the running sums of four
32-bit lanes of md5(depth, role, text): one pass over a conversation, no row
grows with depth.  Rows of one prefix are reduced first per (prefix, salt),
so a first turn shared by a third of all conversations is spread over
``SALTS`` groups on the way up and on the way back.

Rollup.  Depths are cut into bands of ``height``.  A node explodes to its
ancestors inside its own band only (at most ``height`` rows).  The sums at
the band roots make a tree of their own, ``height`` times flatter, on which
the same rollup completes them; then every completed band root passes its
total to its parent's ancestors inside the band above.  So rounds grow with
the logarithm of the depth to base ``height`` and no node explodes beyond its
band.

The windows over a conversation (turn order, running sums) stream through a
sort that spills; they hold no conversation in memory.  The ids that end at a
node are joined to text in slices of ``ENDS`` ids and hashed slice by slice.

Defined cases: null role or text is empty; null turns come first, equal turns
are ordered by role and text, repeated rows are turns of their own; rows
without a conversation id belong to none and are ignored; a conversation
rebuilt without turns is a member of the root only; an empty table has no
root.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annolytics.session import materialize

#: Groups that the rows of one prefix are reduced in first.
SALTS = 32
#: Ids of one slice of a node's ended conversations.
ENDS = 4096
#: Depths of a band.
HEIGHT = 16

LANES = ["lane0", "lane1", "lane2", "lane3"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, role, text), places from 1 in turn order."""
    bare = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return bare.select("conv_id", F.row_number().over(order).cast("long").alias("place"), "role", "text")


def rebuilt(turns: DataFrame, modulus: int = 6, block: int = 100) -> DataFrame:
    """Conversations whose first h turns come from the first conversation of
    their block, h = crc32(decimal id) % modulus: (conv_id, depth, role, text),
    and a row of depth 0 for every conversation."""
    convs = turns.filter("place = 1").select("conv_id")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus
    convs = convs.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % block).alias("base"))
    heads = turns.filter((F.col("place") < modulus) & (F.col("conv_id") % block == 0)).groupBy("conv_id")
    heads = heads.agg(F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("heads")).withColumnRenamed("conv_id", "base")
    convs = convs.join(heads, "base", "left").withColumn("heads", F.slice(F.coalesce("heads", F.array().cast("array<struct<place:bigint,role:string,text:string>>")), F.lit(1), F.col("h").cast("int")))
    convs = materialize(convs.select("conv_id", "h", F.size("heads").cast("long").alias("taken"), "heads"), "trie-heads")
    first = convs.select("conv_id", F.posexplode("heads").alias("i", "t")).select("conv_id", (F.col("i") + 1).cast("long").alias("depth"), "t.role", "t.text")
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").filter("place > h")
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "role", "text")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").alias("role"), F.lit("").alias("text"))
    return first.unionByName(own).unionByName(root)


def prefix_paths(sequences: DataFrame) -> DataFrame:
    """(conv_id, depth, rep, n_convs, chars, last): the node of every prefix of
    every conversation, by its smallest member; ``last`` marks a conversation's
    whole sequence."""
    whole = F.md5(F.concat_ws(":", F.col("depth").cast("string"), F.length("role").cast("string"), F.concat("role", "text")).cast("binary"))
    lanes = [F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long").alias(c) for i, c in enumerate(LANES)]
    hashed = sequences.withColumn("digest", whole).select("conv_id", "depth", F.length("text").cast("long").alias("chars"), *lanes)
    along = Window.partitionBy("conv_id").orderBy("depth")
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = [F.sum(c).over(upto).alias(c) for c in LANES]
    last = F.lead("depth").over(along).isNull().alias("last")
    prefixes = hashed.select("conv_id", "depth", "chars", last, *sums, F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int").alias("salt"))
    prefixes = materialize(prefixes, "trie-prefixes")
    key = ["depth", *LANES]
    part = prefixes.groupBy(*key, "salt").agg(F.min("conv_id").alias("low"), F.count(F.lit(1)).alias("n"))
    part = materialize(part, "trie-salted")
    node = part.groupBy(*key).agg(F.min("low").alias("rep"), F.sum("n").alias("n_convs"))
    salted = part.select(*key, "salt").join(node, key)
    paths = prefixes.join(salted, [*key, "salt"]).select("conv_id", "depth", "rep", "n_convs", "chars", "last")
    return materialize(paths, "trie-paths")


def rollup(paths: DataFrame, own: DataFrame, values: list[str], height: int = HEIGHT) -> DataFrame:
    """Sums of ``values`` over every node's subtree: (rep, depth, values...).

    ``paths`` (conv_id, depth, rep) has every prefix of every conversation from
    depth 0 on, ``own`` (rep, depth, values...) each node's own values."""
    if height < 2:
        raise ValueError("a band has at least two depths")
    band = F.floor(F.col("depth") / height).cast("long")
    above = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chains = paths.select("conv_id", "depth", "rep").withColumn("band", band).withColumn("chain", F.collect_list("rep").over(above))
    chains = materialize(chains, "trie-chains")

    def ancestors(rows: DataFrame) -> DataFrame:
        each = rows.select("band", F.posexplode("chain").alias("i", "rep"), *values)
        return each.select("rep", (F.col("band") * height + F.col("i")).alias("depth"), *values)

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("rep", "depth").agg(*[F.sum(v).alias(v) for v in values])

    nodes = chains.filter("conv_id = rep").join(own.select("rep", "depth", *values), ["rep", "depth"])
    inside = materialize(summed(ancestors(nodes)), "trie-inside")
    deepest = inside.agg(F.max("depth")).first()[0]
    if deepest is None or deepest < height:
        return inside
    at_root = F.col("depth") % height == 0
    up = (F.col("depth") / height).cast("long").alias("depth")
    roots = rollup(
        chains.filter(at_root).select("conv_id", up, "rep"), inside.filter(at_root).select("rep", up, *values), values, height
    )
    below = roots.filter("depth > 0").select(F.col("rep").alias("conv_id"), (F.col("depth") * height - 1).alias("depth"), *values)
    passed = ancestors(below.join(chains.drop("rep"), ["conv_id", "depth"]))
    return materialize(summed(inside.unionByName(passed)), "trie-totals")


def _digest_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 over the slices of a node, which come one after another."""
    node, state = None, None

    def row():
        return pa.RecordBatch.from_arrays(
            [pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([state.hexdigest()], pa.string())],
            names=["rep", "depth", "ends_sha256"],
        )

    for batch in batches:
        for rep, depth, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (rep, depth) != node:
                if node is not None:
                    yield row()
                node, state = (rep, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if node is not None:
        yield row()


def ends_digest(paths: DataFrame) -> DataFrame:
    """(rep, depth, ends_sha256) of the nodes at which conversations end."""
    ends = paths.filter("last").select("rep", "depth", "conv_id", F.floor(F.col("conv_id") / ENDS).alias("slice"))
    slices = ends.groupBy("rep", "depth", "slice").agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    slices = materialize(slices, "trie-ends")
    counts = slices.groupBy("rep", "depth").agg(F.count(F.lit(1)).alias("slices"))
    one = slices.join(counts.filter("slices = 1"), ["rep", "depth"]).select("rep", "depth", F.sha2("ids", 256).alias("ends_sha256"))
    more = slices.join(counts.filter("slices > 1"), ["rep", "depth"], "left_semi").select("rep", "depth", "ids", "slice")
    more = more.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "slice").drop("slice")
    return one.unionByName(more.mapInArrow(_digest_slices, "rep long, depth long, ends_sha256 string"))


def build_trie(sequences: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The trie's nodes with their subtree totals.

    ``sequences`` holds (conv_id, depth, role, text): depths from 1 without
    gaps, and a row of depth 0 for every conversation."""
    paths = prefix_paths(sequences)
    parent = F.lag("rep").over(Window.partitionBy("conv_id").orderBy("depth"))
    nodes = paths.withColumn("parent_conv_id", parent).filter("conv_id = rep").drop("conv_id", "last")
    nodes = materialize(nodes, "trie-nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("parent_conv_id").alias("rep"), (F.col("depth") - 1).alias("depth"))
    nodes = nodes.join(children.agg(F.count(F.lit(1)).alias("n_children")), ["rep", "depth"], "left").na.fill(0, ["n_children"])
    nodes = materialize(nodes, "trie-children")
    own = nodes.select(
        "rep",
        "depth",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    totals = rollup(paths, own, ["n_leaves", "saved_tokens"], height)
    out = nodes.drop("chars").join(totals, ["rep", "depth"]).join(ends_digest(paths), ["rep", "depth"], "left")
    return out.select(
        F.col("rep").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
