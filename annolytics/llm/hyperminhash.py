"""Near-duplicate groups by HyperMinHash.

A document's word shingles are hashed to 64 bits and dealt to buckets by
hash; every bucket keeps its smallest hash under each of several further
hash functions, in compressed form: leading-zero count and four mantissa bits
(0 for an empty bucket), folded to four bits in the registers that make
bands and to two bits in the rest.  Buckets times functions are always
``REGISTERS``; the split depends on the size class of the set, so that
buckets are well filled and a register stands for several shingles even in a
short text.  Both documents of a pair must use one split, so a document near
the lower end of a class also has registers for the class below.

Bands of registers are the buckets of the candidate search; so many bands
are used that a pair at the threshold shares none with a probability below
``MISS``.  A candidate's Jaccard similarity is estimated from the registers,
corrected for equal registers by chance; pairs whose estimate is ``SIGMAS``
deviations below the threshold are dropped, the others are confirmed on the
full shingle sets.

Groups of copies, however large, are never expanded into all pairs:

1. Documents with one and the same shingle set are one class, represented by
   its smallest id.
2. In every band bucket each class is compared with one leader, drawn by
   hash; confirmed links give first components.
3. Only buckets that still hold several components are searched fully, for
   pairs of different components.  Large buckets are cut into tiles of
   ``TILE`` classes; a pair is taken up in its first common band only.

Links inside a component change nothing, so the components are those of all
links.  Each step is written to the shared folder before the next.

Defined cases: a null or empty text, or one without words, has no shingles
and is linked with nothing; fewer words than a shingle give the whole
sequence as one shingle; rows of one doc_id are one document, which is linked
by each of its texts (``n_shingles`` is that of the row's own text, and a text
without words links its document with nothing); rows with a null doc_id are not linked and have themselves as
(null) component; only doc_id and text are read, so other columns cannot
clash; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolytics.llm.common import small_batches
from annolytics.session import checked_broadcast, materialize

REGISTERS, MISS, SIGMAS, TILE = 1024, 1e-6, 4.5, 1024
#: Buckets by size class (base-4 logarithm of the number of shingles).
BUCKETS = (1, 1, 1, 4, 16, 64, 512)
#: Values of a folded register that is not empty: in bands, and in the rest.
#: Unrelated registers are equal by chance once in so many cases.
BAND_VALUES, REST_VALUES = 15, 3
WORDS_REMEMBERED = 100_000
#: Candidate ids up to which they are broadcast to the scan of the texts.
BROADCAST_IDS = 4_000_000
U64 = np.uint64


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= WORDS_REMEMBERED:
            self.clear()
        self[word] = h
        return h


@lru_cache(maxsize=1)
def _word_hashes() -> _WordHashes:
    return _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's k-word shingles (words are
    lower-cased in A-Z and split at ASCII white space)."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, U64)
    h = np.fromiter(map(_word_hashes().__getitem__, words), U64, len(words))
    n = max(1, len(words) - k + 1)
    x = np.full(n, len(words) if len(words) < k else k, U64)
    for i in range(min(k, len(words))):
        x = x * U64(0x9E3779B97F4A7C15) + h[i : i + n]
    return np.unique(_mix(x))


def size_class(n: int) -> int:
    return min(len(BUCKETS) - 1, (n.bit_length() - 1) // 2)


@lru_cache(maxsize=16)
def _layout(cls: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Buckets, the multipliers of the hash functions, and the fixed order
    that spreads a bucket's registers over the bands."""
    draw = np.random.default_rng(1000 + cls)
    functions = REGISTERS // BUCKETS[cls]
    factors = draw.integers(0, 2**63, functions, dtype=U64) * U64(2) + U64(1)
    return BUCKETS[cls], factors, draw.permutation(REGISTERS)


def registers_of(hashes: np.ndarray, cls: int) -> np.ndarray:
    """HyperMinHash registers (uint8) of a sorted hash set, as the size class
    ``cls`` splits them."""
    buckets, factors, order = _layout(cls)
    out = np.zeros((len(factors), buckets), np.uint8)
    if len(hashes):
        bucket = (((hashes >> U64(32)) * U64(buckets)) >> U64(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        least = np.minimum.reduceat(_mix(hashes[None, :] * factors[:, None]), first, axis=1)
        mantissa, exponent = np.frexp((least >> U64(32)).astype(np.float64) + 1.0)  # mantissa in [0.5, 1)
        zeros = np.clip(33 - exponent, 0, 15)
        out[:, bucket[first]] = 1 + np.minimum(254, zeros * 16 + ((mantissa * 2 - 1) * 16).astype(np.int64))
    return out.ravel()[order]


def banding(threshold: float) -> tuple[int, int]:
    """(bands, registers per band): as many registers per band, up to eight,
    as half of the registers allow."""
    for rows in range(8, 0, -1):
        bands = math.ceil(math.log(MISS) / math.log(1 - threshold**rows))
        if bands * rows <= REGISTERS // 2:
            break
    return bands, rows


def fold(registers: np.ndarray, banded: int) -> bytes:
    """Registers of one document in transport form: the first ``banded`` in
    four bits each, the rest in two."""
    r = registers.astype(np.int64)
    band = np.where(r[:banded] > 0, 1 + (r[:banded] - 1) % BAND_VALUES, 0)
    rest = np.where(r[banded:] > 0, 1 + (r[banded:] - 1) % REST_VALUES, 0)
    band = np.append(band, 0) if banded % 2 else band
    rest = np.append(rest, np.zeros(-len(rest) % 4, np.int64))
    packed = [band[0::2] * 16 + band[1::2], rest[0::4] * 64 + rest[1::4] * 16 + rest[2::4] * 4 + rest[3::4]]
    return np.concatenate(packed).astype(np.uint8).tobytes()


def unfold(sketches: list[bytes], banded: int) -> tuple[np.ndarray, np.ndarray]:
    """(band registers, other registers) of many documents, a row each."""
    raw = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
    cut = (banded + 1) // 2
    band = np.stack([raw[:, :cut] >> 4, raw[:, :cut] & 15], axis=2).reshape(len(raw), -1)[:, :banded]
    rest = np.stack([raw[:, cut:] >> s & 3 for s in (6, 4, 2, 0)], axis=2).reshape(len(raw), -1)
    return band, rest[:, : REGISTERS - banded]


def may_link(a: tuple, b: tuple, na: np.ndarray, nb: np.ndarray, threshold: float) -> np.ndarray:
    """Whether pairs of unfolded rows can reach the threshold, by size and by
    the collision-corrected estimate.

    The two kinds of registers give an estimate each; they are weighed by
    their precision.  An estimate varies by the number of registers and, as
    buckets count alike but hold different numbers of shingles, by about
    buckets / n^2."""
    weights, estimate = 0.0, 0.0
    for x, y, values in ((a[0], b[0], BAND_VALUES), (a[1], b[1], REST_VALUES)):
        some = np.maximum(((x > 0) | (y > 0)).sum(axis=1), 1)
        same = ((x == y) & (x > 0)).sum(axis=1)
        chance = 1 / values
        expected = threshold + (1 - threshold) * chance
        weight = some * (1 - chance) ** 2 / (expected * (1 - expected))
        estimate = estimate + weight * (same / some - chance) / (1 - chance)
        weights = weights + weight
    least = np.maximum(np.minimum(na, nb), 1)
    buckets = np.array(BUCKETS)[np.clip(np.log2(least) // 2, 0, len(BUCKETS) - 1).astype(int)]
    sigma = np.sqrt(1 / weights + threshold * (1 - threshold) * buckets / least.astype(float) ** 2)
    sizes = np.minimum(na, nb) >= threshold * np.maximum(na, nb) - 1e-9
    return sizes & (estimate / weights >= threshold - SIGMAS * sigma)


def _batches(batches, rows: int):
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def signatures(docs: DataFrame, k: int, threshold: float, banded: int) -> DataFrame:
    """(doc_id, n, digest, sketches) of every row; sketches are the (class,
    registers) that the document needs."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    sketch = pa.list_(pa.struct([("class", pa.int32()), ("registers", pa.binary())]))

    def run(batches):
        for b in _batches(batches, 256):
            n, digest, sketches = [], [], []
            for text in b.column(1).to_pylist():
                s = shingle_set(text, k)
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                # classes of the smaller set of any pair that could link
                least = max(1, math.ceil(threshold * len(s) - 1e-9))
                classes = range(size_class(least), size_class(len(s)) + 1) if len(s) else ()
                sketches.append([{"class": c, "registers": fold(registers_of(s, c), banded)} for c in classes])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sketches, sketch)],
                names=["doc_id", "n", "digest", "sketches"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n long, digest binary, sketches array<struct<class:int,registers:binary>>"
    )


def band_rows(reps: DataFrame, bands: int, rows: int) -> DataFrame:
    """(key, rep) for every band that is not empty.  The low bits of a key
    are the size class (three) and the band (six)."""

    def run(batches):
        for b in _batches(batches, 4096):
            lanes = unfold(b.column(2).to_pylist(), bands * rows)[0].reshape(b.num_rows, bands, rows)
            place = (b.column(1).to_numpy().astype(U64)[:, None] << U64(6)) + np.arange(bands, dtype=U64)
            keys = place + U64(1)
            for i in range(rows):
                keys = keys * U64(0x9E3779B97F4A7C15) + lanes[:, :, i]
            keys = (_mix(keys) & ~U64(511)) | place
            row, band = np.nonzero(lanes.any(axis=2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[row, band].view(np.int64)), b.column(0).take(pa.array(row))], names=["key", "rep"]
            )

    kind = reps.schema["rep"].dataType.simpleString()
    return reps.select("rep", "class", "registers").mapInArrow(run, f"key long, rep {kind}")


def class_of(key: str = "key"):
    return F.shiftright(F.col(key), 6).bitwiseAND(F.lit(7)).cast("int").alias("class")


def _estimated(pairs: DataFrame, reps: DataFrame, threshold: float, banded: int) -> DataFrame:
    """Pairs (a, b) out of (a, b, class) whose estimate allows a link."""

    @F.pandas_udf("boolean")
    def possible(ra: pd.Series, rb: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        if not len(ra):
            return pd.Series([], dtype=bool)
        parts = []
        for at in range(0, len(ra), 4096):
            cut = slice(at, at + 4096)
            a, b = unfold(list(ra[cut]), banded), unfold(list(rb[cut]), banded)
            parts.append(may_link(a, b, na[cut].to_numpy(), nb[cut].to_numpy(), threshold))
        return pd.Series(np.concatenate(parts))

    side = lambda x: reps.select(F.col("rep").alias(x), "class", F.col("n").alias("n" + x), F.col("registers").alias("r" + x))
    j = pairs.join(side("a"), ["a", "class"]).join(side("b"), ["b", "class"])
    return j.filter(possible("ra", "rb", "na", "nb")).select("a", "b").distinct()


def _confirmed(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold."""

    def run(batches):
        # few texts at a time, as pairs of long texts fill memory
        known: dict[str, np.ndarray] = {}

        def shingles(t):
            s = known.get(t)
            if s is None:
                if len(known) >= 64:
                    known.clear()
                s = known[t] = shingle_set(t, k)
            return s

        for b in _batches(batches, 128):
            ok = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x, y = shingles(x), shingles(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    # ids are unique here, so only candidates' texts leave the scan: their ids
    # are broadcast behind a check of their number
    ids = pairs.select(F.col("a").alias("doc_id")).distinct().union(pairs.select("b").distinct()).distinct()
    ids = checked_broadcast(ids, "dup-candidates", max_rows=BROADCAST_IDS)
    texts = materialize(docs.select("doc_id", "text").join(ids, "doc_id", "left_semi"), "dup-texts")
    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias("t" + x))
    j = pairs.join(side("b"), "b").join(side("a"), "a")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return j.select("a", "b", "ta", "tb").mapInArrow(run, f"a {kind}, b {kind}")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges`` (a, b): the smallest id it
    reaches.  Alternating large-star and small-star steps until nothing
    changes; each step is one aggregation and one join on the node."""

    def star(e: DataFrame, large: bool) -> DataFrame:
        # both directions for the large star, towards smaller ids for the small
        if large:
            near = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        else:
            near = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        j = near.join(least, F.col("u") == F.col("w"))
        out = j.filter("v > u") if large else j
        pairs = out.select(F.col("v").alias("a"), F.col("m").alias("b"))
        if not large:
            pairs = pairs.union(least.select(F.col("w").alias("a"), F.col("m").alias("b")))
        return pairs.filter("a <> b").distinct()

    def state(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    current = materialize(edges.filter("a <> b").distinct(), "dup-graph")
    before = None
    while (now := state(current)) != before:
        before = now
        current = materialize(star(star(current, True), False), "dup-graph")
    ids = current.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    return ids.union(current.select("b", "b").distinct())


def _cross_pairs(rows: DataFrame, reps: DataFrame, bands: int, per_band: int, threshold: float) -> DataFrame:
    """Pairs of classes with different labels that share a bucket and may
    link; ``rows`` has key, rep, label."""
    size = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("label").alias("l1"), F.max("label").alias("l2"))
    mixed = materialize(size.filter("l1 <> l2").select("key", F.ceil(F.col("c") / TILE).cast("int").alias("parts")), "dup-mixed")
    r = rows.join(mixed, "key").withColumn("class", class_of()).join(reps.select("rep", "class", "n", "registers"), ["rep", "class"])
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    r = r.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    r = r.select(
        "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "rep", "label", "n", "registers"
    )
    kind = reps.schema["rep"].dataType.simpleString()
    order = ["key", "i", "j"]

    def pairs_in(t: pa.Table):
        key = np.stack([t.column(c).to_numpy().astype(np.int64) for c in order], axis=1)
        part, label, n = (t.column(c).to_numpy() for c in ("part", "label", "n"))
        band = key[:, 0] & 63
        rep = t.column("rep").to_numpy()
        banded, rest = unfold(t.column("registers").to_pylist(), bands * per_band)
        lanes = banded.reshape(len(rep), bands, per_band)
        found = []
        for step in range(1, len(rep)):
            x = np.flatnonzero((key[step:] == key[:-step]).all(axis=1))
            if not len(x):
                break
            y = x + step
            keep = (label[x] != label[y]) & ((key[x, 1] == key[x, 2]) | (part[x] != part[y]))
            for at in range(0, int(keep.sum()), 4096):
                p, q = x[keep][at : at + 4096], y[keep][at : at + 4096]
                ok = may_link((banded[p], rest[p]), (banded[q], rest[q]), n[p], n[q], threshold)
                p, q = p[ok], q[ok]
                common = (lanes[p] == lanes[q]).all(axis=2) & (lanes[p] > 0).any(axis=2)
                first = common.argmax(axis=1) == band[p] if len(p) else np.zeros(0, bool)
                found += [(np.minimum(rep[p][first], rep[q][first]), np.maximum(rep[p][first], rep[q][first]))]
        a = np.concatenate([f[0] for f in found]) if found else np.empty(0, rep.dtype)
        b = np.concatenate([f[1] for f in found]) if found else np.empty(0, rep.dtype)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches):
        # rows are sorted by tile; the last tile of a batch may go on in the next
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            if not t.num_rows:
                continue
            keys = np.stack([t.column(c).to_numpy().astype(np.int64) for c in order], axis=1)
            cut = int(np.flatnonzero((keys != keys[-1]).any(axis=1)).max(initial=-1)) + 1
            if cut:
                yield pairs_in(t.slice(0, cut).combine_chunks())
            held = t.slice(cut)
        if held is not None and held.num_rows:
            yield pairs_in(held.combine_chunks())

    tiles = r.repartition(*order).sortWithinPartitions(*order)
    return tiles.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``:
    documents are linked whose ``k``-word shingle sets have a Jaccard
    similarity of at least ``percent`` / 100."""
    small_batches(docs.sparkSession)
    again = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if materialize(again.select("doc_id"), "dup-repeated").isEmpty():
        return _near_duplicates(docs.select("doc_id", "text"), k, percent)
    # Some ids repeat: the distinct (id, text) rows are numbered in the order
    # of (id, checksum of the text), and rows of one id are linked.
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("sum"))
    numbers = rows.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), F.col("sum").alias("of")).distinct().sort("id", "of")
    numbers = materialize(numbers.withColumn("row", F.monotonically_increasing_id()), "dup-numbers")
    same = (F.col("doc_id") == F.col("id")) & (F.col("sum") == F.col("of"))
    numbered = materialize(rows.join(numbers, same, "left").select("doc_id", "text", "row"), "dup-numbered")
    unique = numbered.filter("row IS NOT NULL").groupBy("row").agg(F.min("text").alias("text")).withColumnRenamed("row", "doc_id")
    unique = materialize(unique, "dup-unique")
    first = numbers.groupBy("id").agg(F.min("row").alias("low"))
    one_id = numbers.join(first, "id").filter("row <> low").select(F.col("low").alias("a"), F.col("row").alias("b"))
    judged = materialize(_near_duplicates(unique, k, percent, one_id), "dup-judged")
    names = numbers.select(F.col("row").alias("component_id"), F.col("id").alias("component"))
    judged = judged.join(names, "component_id").select(F.col("doc_id").alias("row"), "n_shingles", "component")
    of_id = numbers.join(judged, "row").groupBy(F.col("id").alias("doc_id")).agg(F.min("component").alias("component_id"))
    known = numbered.filter("row IS NOT NULL").select("doc_id", "row").join(judged.drop("component"), "row").join(of_id, "doc_id")
    known = known.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    nameless = _near_duplicates(numbered.filter("doc_id IS NULL").select("doc_id", "text"), k, percent)
    return known.unionByName(nameless)


def _near_duplicates(docs: DataFrame, k: int, percent: int, linked: DataFrame | None = None) -> DataFrame:
    """``near_duplicates`` of documents whose ids are unique or null;
    ``linked`` (a, b) are links that hold beside those of the texts."""
    threshold = percent / 100
    bands, per_band = banding(threshold)
    banded = bands * per_band
    sig = materialize(signatures(docs, k, threshold, banded), "dup-signatures")
    known = sig.filter("doc_id IS NOT NULL AND n > 0")
    classes = materialize(known.groupBy("digest").agg(F.min("doc_id").alias("rep")), "dup-classes")
    reps = known.join(classes, (known["doc_id"] == classes["rep"]) & (known["digest"] == classes["digest"]))
    reps = materialize(reps.select("rep", "n", F.inline("sketches")), "dup-reps")
    rows = band_rows(reps, bands, per_band)
    leaders = rows.groupBy("key").agg(F.min_by("rep", F.xxhash64("rep", "key")).alias("leader"), F.count(F.lit(1)).alias("c"))
    leaders = materialize(leaders.filter("c > 1").select("key", "leader"), "dup-leaders")
    rows = materialize(rows.join(leaders, "key"), "dup-buckets")
    star = rows.filter("rep <> leader").select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b"), class_of()).distinct()
    star = materialize(star, "dup-star")
    edges = materialize(_confirmed(materialize(_estimated(star, reps, threshold, banded), "dup-likely"), docs, k, percent), "dup-edges")
    first = materialize(components(edges), "dup-first")
    labelled = rows.join(first, rows["rep"] == first["id"], "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("label")
    )
    cross = _cross_pairs(labelled, reps, bands, per_band, threshold).join(star, ["a", "b"], "left_anti")
    more = materialize(_confirmed(materialize(cross, "dup-cross"), docs, k, percent), "dup-edges")
    found = edges.union(more)
    if linked is not None:
        # a class stands for its smallest id
        of = known.select(F.col("doc_id").alias("id"), "digest").join(classes, "digest").select("id", "rep")
        ends = linked.join(of.select(F.col("id").alias("a"), F.col("rep").alias("ra")), "a").join(of.select(F.col("id").alias("b"), F.col("rep").alias("rb")), "b")
        found = found.union(ends.select(F.least("ra", "rb"), F.greatest("ra", "rb")).distinct())
    final = components(found)
    groups = classes.join(final, classes["rep"] == final["id"], "left").select(
        F.col("digest").alias("_digest"), F.coalesce("component", "rep").alias("component_id")
    )
    groups = materialize(groups, "dup-groups")
    out = sig.select("doc_id", F.col("n").alias("n_shingles"), "digest")
    out = out.join(groups, out["digest"] == groups["_digest"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )
