"""Statistical building blocks shared by the profiling, bias and evaluation
operators: exact quantiles at scale, hashed ranks inside skewed groups,
safe ratios and the chi-square tail.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolytics.session import materialize


def ratio(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (never an ANSI error)."""
    return F.try_divide(num, den)


def ratio0(num, den) -> Column:
    """num / den with 0 for an empty denominator (feature ratios)."""
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


# --- exact quantiles -------------------------------------------------------------

#: Slices that the values of a group are cut into for sorting.
SLICES = 64


def _sliced(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Adds ``_slice``: the number of the group's cut points that are <= the
    value.  The cut points (approximate quantiles, ``SLICES`` - 1 numbers per
    group) are written once, so every reader cuts alike."""
    cuts = df.groupBy(*by).agg(
        F.percentile_approx(F.col(value).cast("double"), [i / SLICES for i in range(1, SLICES)], 1000).alias("_cuts")
    )
    cuts = materialize(cuts.select(*[F.col(c).alias(f"_by_{c}") for c in by], "_cuts"), "quantile-cuts")
    if by:
        cond = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
        j = df.join(cuts, reduce(and_, cond), "left").drop(*cuts.columns[:-1])
    else:
        j = df.join(F.broadcast(cuts), F.lit(True), "left")  # one row
    v = F.col(value).cast("double")
    return j.withColumn("_slice", F.size(F.filter("_cuts", lambda c: c <= v))).drop("_cuts")


def _with_running(df: DataFrame, value: str, weight: str, by: Sequence[str], out: str, total: str) -> DataFrame:
    """Running sum of ``weight`` in ascending order of the group's distinct
    values, and the group's total.  Sums per (group, slice) give what lies
    before a slice; a window runs only inside a slice."""
    s = _sliced(df, value, by)
    sums = s.groupBy(*by, "_slice").agg(F.sum(weight).alias("_s"))
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col("_slice").alias("_by_slice"),
        F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_off"),
        F.sum("_s").over(Window.partitionBy(*by)).alias(total),
    )
    inside = Window.partitionBy(*by, "_slice").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    cond = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by] + [F.col("_slice") == F.col("_by_slice")]
    r = s.withColumn("_run", F.sum(weight).over(inside)).join(sums, reduce(and_, cond))
    return r.withColumn(out, F.col("_off") + F.col("_run")).drop("_off", "_run", "_slice", "_by_slice", *[f"_by_{c}" for c in by])


def quantiles_sorted(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Exact linearly interpolated quantiles (numpy/pandas default, DuckDB
    ``quantile_cont``) of ``value`` per group (null groups included), without
    holding a group in one task.

    Plan: rows become (group, distinct value, count) before the shuffle; the
    running count over slices of the values tells which value holds a rank.
    Every step depends on the data alone, never on partition numbers or the
    order of rows, so re-evaluated stages agree.  With ``weight`` a row
    stands for that many equal ones (a table of distinct values and counts).
    Returns (by..., q, p, value) with q the index into ``probs``.
    """
    by = list(by)
    probs = [float(p) for p in probs]
    v = F.col(value).cast("double")
    times = F.lit(1) if weight is None else F.col(weight)
    base = df.select(*by, v.alias("_v"), times.cast("long").alias("_w")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    counts = base.groupBy(*by, "_v").agg(F.sum("_w").alias("_c")).filter("_c > 0")
    r = _with_running(counts, "_v", "_c", by, "_upto", "_n")
    parr = F.array(*[F.lit(p) for p in probs])
    # ranks from 0; a value with count c holds the ranks upto - c .. upto - 1
    lo = lambda i: F.floor((F.col("_n") - 1) * F.element_at(parr, i + 1))
    holds = lambda k: (F.col("_upto") - F.col("_c") <= k) & (k < F.col("_upto"))
    hits = F.filter(F.sequence(F.lit(0), F.lit(len(probs) - 1)), lambda i: holds(lo(i)) | holds(lo(i) + 1))
    sel = r.select(*by, "_v", "_n", F.explode(hits).alias("q"))
    g = sel.groupBy(*by, "q").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.max("_n").alias("_n"))
    p = F.element_at(parr, F.col("q") + 1)
    h = (F.col("_n") - 1) * p
    frac = h - F.floor(h)
    return g.select(*by, "q", p.alias("p"), (F.col("_lo") + frac * (F.col("_hi") - F.col("_lo"))).alias("value"))


def running_sum_sorted(df: DataFrame, order: str, weight: str, out: str = "cum", total: str = "total") -> DataFrame:
    """Running sum of ``weight`` in ascending ``order`` (unique, non-NULL
    values), plus the grand total, without a single-partition window."""
    return _with_running(df, order, weight, [], out, total)


def grouped_stats(
    df: DataFrame,
    by: Sequence[str],
    aggs: Sequence[Column],
    quantile_specs: Sequence[tuple[str, float, str]] = (),
) -> DataFrame:
    """Plain aggregates plus exact quantiles in one result per group.

    ``quantile_specs`` = [(column, p, alias)]; the quantiles of a column come
    from ``quantiles_sorted`` and are joined back on the group, null group
    included.
    """
    by = list(by)
    key = by if by else ["_k"]
    src = df if by else df.withColumn("_k", F.lit(1))
    out = src.groupBy(*key).agg(*aggs)
    specs: dict[str, list[tuple[float, str]]] = {}
    for col, p, alias in quantile_specs:
        specs.setdefault(col, []).append((p, alias))
    for col, wanted in specs.items():
        q = quantiles_sorted(src, col, [p for p, _ in wanted], key)
        wide = q.groupBy(*[F.col(c).alias(f"_q_{c}") for c in key]).agg(
            *[F.max(F.when(F.col("q") == i, F.col("value"))).alias(a) for i, (_, a) in enumerate(wanted)]
        )
        cond = [F.col(c).eqNullSafe(F.col(f"_q_{c}")) for c in key]
        out = out.join(wide, reduce(and_, cond), "left").drop(*[f"_q_{c}" for c in key])
    return out.drop("_k") if not by else out


# --- semi-joins of wide rows -------------------------------------------------------

#: Bits of a hash filter for each key; one bitmap of Spark holds 2^15.
FILTER_BITS = 16


def hash_filter(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose ``on`` columns may occur in ``keys``: all that
    do, and at most one in ``FILTER_BITS`` of the others.  Before a semi-join
    it keeps wide rows from being shuffled only to be dropped.  What is
    broadcast is two bytes a key; ``keys`` should be a written table."""
    size = max(1, -(-keys.count() * FILTER_BITS // 32768)) * 32768
    h = F.pmod(F.xxhash64(*on), F.lit(size).cast("long"))
    bucket, place = F.shiftright(h, 15), h.bitwiseAND(F.lit(32767))
    bits = keys.select(bucket.alias("_bucket"), place.alias("_place")).groupBy("_bucket").agg(F.bitmap_construct_agg("_place").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright("_place", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.pmod(F.floor(byte / F.pow(F.lit(2), F.col("_place").bitwiseAND(F.lit(7)))), F.lit(2)) == 1
    rows = df.select("*", bucket.alias("_bucket"), place.alias("_place"))
    return rows.join(F.broadcast(bits), "_bucket").filter(hit).select(*df.columns)


# --- ranks inside skewed groups ---------------------------------------------------------


def hash_order(seed: int, key: Column) -> Column:
    """Deterministic pseudo-random order: md5 of ``seed|key`` as hex.  The
    same value in DuckDB (``md5(concat(...))``)."""
    return F.md5(F.concat(F.lit(str(seed)), F.lit("|"), key.cast("string")))


def hashed_rank(df: DataFrame, group: Sequence[str], order_hex: str, bucket_bits: int = 20) -> DataFrame:
    """``row_number()`` over (partition by group order by order_hex) without
    putting a group in one task.

    ``order_hex`` is a uniform hex digest, so its leading ``bucket_bits`` bits
    cut every group into equally sized, order-preserving slices.  The rank is
    (#rows of the group in earlier slices) + (row_number inside the slice);
    the first term comes from a small (group, slice) count table.  Adds
    ``rank`` (1-based) and ``group_size``.
    """
    group = list(group)
    nhex = max(1, (bucket_bits + 3) // 4)
    b = F.conv(F.substring(F.col(order_hex), 1, nhex), 16, 10).cast("long")
    x = df.withColumn("_b", b)
    counts = x.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w_prev = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *group,
        "_b",
        F.coalesce(F.sum("_c").over(w_prev), F.lit(0)).alias("_off"),
        F.sum("_c").over(Window.partitionBy(*group)).alias("group_size"),
    )
    w = Window.partitionBy(*group, "_b").orderBy(order_hex)
    y = x.join(counts, [*group, "_b"]).withColumn("rank", F.col("_off") + F.row_number().over(w))
    return y.drop("_b", "_off")


# --- chi-square upper tail -----------------------------------------------------------


def chi2_sf(x: Column, dof: Column) -> Column:
    """P(X > x) for chi-square, as an expression.

    Even degrees of freedom have a closed form, exp(-h) * sum of h^i / i! for
    i < dof / 2 with h = x / 2.  Odd ones use the power series of the lower
    tail, whose terms shrink from about h on; beyond h = 600 the tail is 0.
    """
    h = F.greatest(x.cast("double"), F.lit(0.0)) / 2.0
    k = dof.cast("int")

    def series(first: Column, last: Column, step) -> Column:
        """1 + t1 + t2 + ... with t_i = t_(i-1) * step(i)."""
        start = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))
        more = lambda acc, i: F.struct((acc["t"] * step(i)).alias("t"), (acc["s"] + acc["t"] * step(i)).alias("s"))
        index = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(index, start, more, lambda acc: acc["s"])

    half = F.floor(k / 2).cast("int")
    even = F.exp(-h) * series(F.lit(1), half - 1, lambda i: h / i)
    # Gamma(k/2 + 1) = sqrt(pi) * product of (j + 1/2) for j = 0 .. (k - 1)/2
    gamma = F.aggregate(F.sequence(F.lit(0), half), F.lit(math.sqrt(math.pi)), lambda acc, j: acc * (j + F.lit(0.5)))
    a = k / F.lit(2.0)
    lower = F.pow(h, a) * F.exp(-h) / gamma * series(F.lit(1), (F.ceil(h * 2) + 120).cast("int"), lambda i: h / (a + i))
    odd = F.when(h > 600, F.lit(0.0)).otherwise(F.greatest(F.lit(1.0) - lower, F.lit(0.0)))
    return F.when(k <= 0, F.lit(None).cast("double")).when(h == 0, F.lit(1.0)).when(k % 2 == 0, even).otherwise(odd)
