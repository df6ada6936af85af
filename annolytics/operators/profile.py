"""Profiling aggregations: statistics, distributions,
percentiles, histograms, box statistics, ECDF, correlation.

All are grouped or global aggregates with partial (map-side) combining.
Windows only run over already-aggregated rows (a handful of labels or
distinct values), never over raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annolytics.functions.stats import grouped_stats, quantiles_sorted, ratio, running_sum_sorted
from annolytics.operators.clean import ANNOTATOR, LABEL, LEAD, SOURCE, TEXT, add_text_length, text_key
from annolytics.session import checked_broadcast, materialize

LENGTH_PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 95, 99)
LEAD_PERCENTILES = (5, 10, 25, 50, 75, 90, 95, 99)


def _text_length(df: DataFrame) -> DataFrame:
    return df if "text_length" in df.columns else add_text_length(df)


def _written(df: DataFrame, *columns) -> DataFrame:
    """The columns of a profile, written once: its statistics read a narrow
    table several times, not the plan behind it."""
    return materialize(df.select(*columns), "profile-rows")


def dataset_stats(df: DataFrame, split: str | None = None) -> DataFrame:
    """G1: rows, unique texts and annotators, mean/median length and lead."""
    d = _written(_text_length(df), text_key(df), ANNOTATOR, "text_length", LEAD)
    out = grouped_stats(
        d,
        [],
        [
            F.count(F.lit(1)).alias("n_rows"),
            F.countDistinct("_text").alias("n_unique_texts"),
            F.countDistinct(ANNOTATOR).alias("n_annotators"),
            F.avg("text_length").alias("mean_text_length"),
            F.avg(LEAD).alias("mean_lead_time"),
        ],
        [("text_length", 0.5, "median_text_length"), (LEAD, 0.5, "median_lead_time")],
    )
    cols = ["n_rows", "n_unique_texts", "n_annotators", "mean_text_length", "median_text_length", "mean_lead_time", "median_lead_time"]
    out = out.select(*[F.round(c, 6).alias(c) if c.startswith(("mean", "median")) else F.col(c) for c in cols])
    if split is not None:
        out = out.select(F.lit(split).alias("split"), *cols)
    return out


def label_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Count and % per label (non-NULL labels are the denominator)."""
    g = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return g.select(label, "n", F.round(F.col("n") * 100.0 / total, 6).alias("pct")).orderBy(label)


def label_text_distribution(df: DataFrame, label_text: str = "label_text") -> DataFrame:
    """Count and % per raw label string, most frequent first."""
    g = df.filter(F.col(label_text).isNotNull()).groupBy(label_text).agg(F.count(F.lit(1)).alias("n"))
    # raw strings are not bounded: the total is one row, joined to all
    total = df.agg(F.count(label_text).alias("_total"))
    pct = F.round(F.col("n") * 100.0 / F.col("_total"), 6).alias("pct")
    return g.join(F.broadcast(total), F.lit(True)).select(label_text, "n", pct).orderBy(F.desc("n"), label_text)


def cumulative_label_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Running count and % by ascending label (window over <= #labels rows)."""
    g = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    run = Window.orderBy(label).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("n").over(Window.partitionBy())
    return g.select(
        label,
        "n",
        F.sum("n").over(run).alias("cum_n"),
        F.round(F.sum("n").over(run) * 100.0 / total, 6).alias("cum_pct"),
    )


def dataset_overview(df: DataFrame) -> DataFrame:
    """One row of headline numbers, easy = labels 4-5, hard = 1-2."""
    d = _written(_text_length(df), text_key(df), ANNOTATOR, SOURCE, LABEL, "text_length", LEAD)
    out = grouped_stats(
        d,
        [],
        [
            F.count(F.lit(1)).alias("n_rows"),
            F.countDistinct("_text").alias("n_unique_texts"),
            F.countDistinct(ANNOTATOR).alias("n_annotators"),
            F.countDistinct(SOURCE).alias("n_source_files"),
            F.avg("text_length").alias("mean_text_length"),
            F.min("text_length").alias("min_text_length"),
            F.max("text_length").alias("max_text_length"),
            F.avg(LEAD).alias("mean_lead_time"),
            F.count_if(F.col(LABEL) >= 4).alias("_easy"),
            F.count_if(F.col(LABEL) <= 2).alias("_hard"),
        ],
        [("text_length", 0.5, "median_text_length"), (LEAD, 0.5, "median_lead_time")],
    )
    return out.select(
        "n_rows",
        "n_unique_texts",
        "n_annotators",
        "n_source_files",
        F.round("mean_text_length", 6).alias("mean_text_length"),
        F.round("median_text_length", 6).alias("median_text_length"),
        "min_text_length",
        "max_text_length",
        F.round("mean_lead_time", 6).alias("mean_lead_time"),
        F.round("median_lead_time", 6).alias("median_lead_time"),
        F.round(ratio(F.col("n_rows"), F.col("n_annotators")), 6).alias("mean_rows_per_annotator"),
        F.round(ratio(F.col("_easy") * 100.0, F.col("n_rows")), 6).alias("pct_easy"),
        F.round(ratio(F.col("_hard") * 100.0, F.col("n_rows")), 6).alias("pct_hard"),
    )


def records_per_annotator(df: DataFrame) -> DataFrame:
    """Rows per annotator, most first."""
    return df.groupBy(ANNOTATOR).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), ANNOTATOR)


def records_per_annotator_summary(df: DataFrame) -> DataFrame:
    """Mean / median / min / max / sample std of rows per annotator."""
    per = _written(df.groupBy(ANNOTATOR).agg(F.count(F.lit(1)).alias("n_rows")), "n_rows")
    aggs = [
        F.round(F.avg("n_rows"), 6).alias("mean_rows"),
        F.min("n_rows").alias("min_rows"),
        F.max("n_rows").alias("max_rows"),
        F.round(F.stddev_samp("n_rows"), 6).alias("std_rows"),
    ]
    s = grouped_stats(per, [], aggs, [("n_rows", 0.5, "median_rows")])
    return s.select("mean_rows", F.round("median_rows", 6).alias("median_rows"), "min_rows", "max_rows", "std_rows")


def describe_numeric(df: DataFrame, columns: Sequence[str] = ("text_length", LEAD)) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max per column — exact,
    unlike ``DataFrame.summary`` (approximate percentiles)."""
    d = _written(_text_length(df), *columns)
    parts = []
    for c in columns:
        s = grouped_stats(
            d,
            [],
            [
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ],
            [(c, 0.25, "p25"), (c, 0.5, "p50"), (c, 0.75, "p75")],
        )
        parts.append(
            s.select(
                F.lit(c).alias("column"),
                "count",
                *[F.round(x, 6).alias(x) for x in ("mean", "std", "min", "p25", "p50", "p75", "max")],
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def percentile_table(
    df: DataFrame,
    specs: Sequence[tuple[str, Sequence[int]]] = (("text_length", LENGTH_PERCENTILES), (LEAD, LEAD_PERCENTILES)),
) -> DataFrame:
    """Exact interpolated percentiles per column, long form; lead time
    also in minutes."""
    d = _written(_text_length(df), *[col for col, _ in specs])
    parts = []
    for col, pcts in specs:
        q = quantiles_sorted(d, col, [p / 100.0 for p in pcts])
        parts.append(
            q.select(
                F.lit(col).alias("column"),
                F.round(F.col("p") * 100).cast("int").alias("percentile"),
                F.round("value", 6).alias("value"),
                F.round(F.col("value") / 60.0, 6).alias("value_minutes"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def lead_time_units(df: DataFrame, lead: str = LEAD) -> DataFrame:
    """Mean / median / min / max lead time in seconds and minutes."""
    s = grouped_stats(
        _written(df, lead),
        [],
        [F.avg(lead).alias("mean"), F.min(lead).alias("min"), F.max(lead).alias("max")],
        [(lead, 0.5, "median")],
    )
    cols = []
    for k in ("mean", "median", "min", "max"):
        cols += [F.round(k, 6).alias(f"{k}_seconds"), F.round(F.col(k) / 60.0, 6).alias(f"{k}_minutes")]
    return s.select(*cols)


def lead_time_by_label(df: DataFrame, lead: str = LEAD, label: str = LABEL) -> DataFrame:
    """Mean, median, sample std of lead time per label."""
    s = grouped_stats(
        _written(df.filter(F.col(label).isNotNull()), label, lead),
        [label],
        [F.avg(lead).alias("mean_lead_time"), F.stddev_samp(lead).alias("std_lead_time"), F.count(F.lit(1)).alias("n")],
        [(lead, 0.5, "median_lead_time")],
    )
    return s.select(
        label,
        "n",
        F.round("mean_lead_time", 6).alias("mean_lead_time"),
        F.round("median_lead_time", 6).alias("median_lead_time"),
        F.round("std_lead_time", 6).alias("std_lead_time"),
    )


def annotator_lead_times(df: DataFrame, lead: str = LEAD) -> DataFrame:
    """G12 with the scalable median (see ``annolytics.operators.clean`` for the
    listing used inside the cleaning job)."""
    s = grouped_stats(
        _written(df, ANNOTATOR, lead),
        [ANNOTATOR],
        [F.avg(lead).alias("mean_lead_time"), F.count(lead).alias("n_lead_times"), F.count(F.lit(1)).alias("n_rows")],
        [(lead, 0.5, "median_lead_time")],
    )
    return s.select(
        ANNOTATOR,
        F.round("mean_lead_time", 6).alias("mean_lead_time"),
        F.round("median_lead_time", 6).alias("median_lead_time"),
        "n_lead_times",
        "n_rows",
    )


def missing_values(df: DataFrame) -> DataFrame:
    """NULL (and NaN) count per column, one aggregate then unpivot."""
    aggs = []
    for f in df.schema.fields:
        c = F.col(f.name).isNull()
        if f.dataType.typeName() in ("double", "float"):
            c = c | F.isnan(f.name)
        aggs.append(F.count_if(c).alias(f.name))
    one = df.agg(*aggs)
    return one.unpivot([], [f.name for f in df.schema.fields], "column", "n_missing")


def annotator_vs_overall(df: DataFrame, annotator: str, label: str = LABEL, lead: str = LEAD, k: int = 5) -> DataFrame:
    """One annotator next to the whole data set: lead mean/median and
    label shares (%, non-NULL labels).

    One scan: rows become distinct lead times, each with a vector of counts
    (rows, labelled rows and rows per label, of everybody and of the
    annotator).  Means, shares and medians of both scopes follow from that
    table.  An annotator without rows has no row in the result."""
    scopes = [("overall", F.lit(True)), (annotator, F.coalesce(F.col(ANNOTATOR) == annotator, F.lit(False)))]
    measures = ["n", "nl", *[f"n{c}" for c in range(1, k + 1)]]
    tests = [F.lit(True), F.col(label).isNotNull(), *[F.coalesce(F.col(label) == c, F.lit(False)) for c in range(1, k + 1)]]
    counted = [F.count_if(mine & test).alias(f"_{i}_{m}") for i, (_, mine) in enumerate(scopes) for m, test in zip(measures, tests)]
    table = materialize(df.groupBy(F.col(lead).cast("double").alias("_v")).agg(*counted), "lead-counts")
    cells = [c for i, (name, _) in enumerate(scopes) for c in (F.lit(name), *[F.col(f"_{i}_{m}") for m in measures])]
    long = table.select("_v", F.stack(F.lit(len(scopes)), *cells).alias("scope", *measures)).filter("n > 0")
    timed = F.when(F.col("_v").isNotNull(), F.col("n"))
    s = long.groupBy("scope").agg(
        F.sum("n").alias("n_rows"),
        F.try_divide(F.sum(F.col("_v") * F.col("n")), F.sum(timed)).alias("mean_lead_time"),
        *[F.sum(m).alias(f"_{m}") for m in measures[1:]],
    )
    median = quantiles_sorted(long, "_v", [0.5], ["scope"], weight="n").select("scope", F.col("value").alias("median_lead_time"))
    return s.join(median, "scope", "left").select(
        "scope",
        "n_rows",
        F.round("mean_lead_time", 6).alias("mean_lead_time"),
        F.round("median_lead_time", 6).alias("median_lead_time"),
        *[F.round(ratio(F.col(f"_n{c}") * 100.0, F.col("_nl")), 6).alias(f"pct_label_{c}") for c in range(1, k + 1)],
    )


def histogram(
    df: DataFrame,
    value: str,
    bins: int,
    upper: float | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """``bins`` equal-width bins over [min, max] of the (optionally
    upper-cut) values, last bin closed, empty bins present; min = max widens
    the range by +-0.5 (numpy).  Per group when ``by`` is given, each group on
    its own range.  Returns (by..., bin, bin_lo, bin_hi, n)."""
    by = list(by)
    v = F.col(value).cast("double")
    d = df.select(*by, v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if upper is not None:
        d = d.filter(F.col("_v") <= upper)
    key = by if by else ["_k"]
    if not by:
        d = d.withColumn("_k", F.lit(1))
    # One scan of the input: reduce to (group, distinct value, count) with a
    # partial aggregate; ranges and bins are then computed on that table.
    d = materialize(d.groupBy(*key, "_v").agg(F.count(F.lit(1)).alias("_c")), "value-counts")
    rng = d.groupBy(*key).agg(F.min("_v").alias("_mn"), F.max("_v").alias("_mx"))
    rng = rng.select(
        *key,
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"),
    )
    # one row a group: broadcast behind a check of its size, so that a few
    # groups do not become as many tasks
    rng = checked_broadcast(rng, "value-ranges")
    w = (F.col("_hi") - F.col("_lo")) / bins
    b = F.least(F.lit(bins - 1), F.floor((F.col("_v") - F.col("_lo")) / w).cast("int"))
    counts = d.join(rng, key).groupBy(*key, b.alias("bin")).agg(F.sum("_c").alias("n"))
    grid = rng.select(*key, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(counts, [*key, "bin"], "left").select(
        *key,
        "bin",
        F.round(F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins, 6).alias("bin_lo"),
        F.round(F.col("_lo") + (F.col("bin") + 1) * (F.col("_hi") - F.col("_lo")) / bins, 6).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
    )
    return out.drop("_k") if not by else out


def box_stats(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """q1, median, q3, whiskers (furthest data within 1.5 IQR) and the
    number of outliers, overall or per group.

    One scan: rows become (group, distinct value, count); quartiles, whiskers
    and outliers all come from that table, raw rows are never joined."""
    by = list(by)
    key = by if by else ["_k"]
    d = df.filter(F.col(value).isNotNull())
    if not by:
        d = d.withColumn("_k", F.lit(1))
    d = materialize(d.groupBy(*key, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c")), "value-counts")
    names = ["q1", "median", "q3"]
    q = quantiles_sorted(d, "_v", [0.25, 0.5, 0.75], key, weight="_c")
    q = q.groupBy(*key).agg(*[F.max(F.when(F.col("q") == i, F.col("value"))).alias(a) for i, a in enumerate(names)])
    iqr = F.col("q3") - F.col("q1")
    q = q.select(*[F.col(c).alias(f"_q_{c}") for c in key], *names, (F.col("q1") - 1.5 * iqr).alias("_lf"), (F.col("q3") + 1.5 * iqr).alias("_uf"))
    v = F.col("_v")
    inside = (v >= F.col("_lf")) & (v <= F.col("_uf"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_q_{c}")) for c in key])
    w = d.join(checked_broadcast(q, "quartiles"), same).groupBy(*key, *names).agg(
        F.sum("_c").alias("n"),
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("_c"))), F.lit(0)).alias("n_outliers"),
    )
    out = w.select(
        *key,
        "n",
        *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")],
        F.round(F.col("whisker_low").cast("double"), 6).alias("whisker_low"),
        F.round(F.col("whisker_high").cast("double"), 6).alias("whisker_high"),
        "n_outliers",
    )
    return out.drop("_k") if not by else out


def ecdf(df: DataFrame, value: str = "text_length") -> DataFrame:
    """Cumulative % at each distinct value.  Aggregates to distinct
    values first (map-side combine); the running sum over them is range
    partitioned, so a continuous column with many distinct values is never
    ordered in one task."""
    g = materialize(df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n")), "value-counts")
    r = running_sum_sorted(g, value, "n", out="cum_n", total="_total")
    return r.select(value, "n", "cum_n", F.round(F.col("cum_n") * 100.0 / F.col("_total"), 6).alias("cum_pct"))


def correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson r over pairwise non-NULL rows from sums; a constant column
    gives NULL instead of an ANSI division error."""
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    X, Y = F.col(x).cast("double"), F.col(y).cast("double")
    s = d.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(X).alias("mx"),
        F.avg(Y).alias("my"),
    )
    # Two-pass (centred) sums for accuracy; the means are a one-row broadcast.
    c = d.withColumn("_k", F.lit(1)).join(F.broadcast(s.withColumn("_k", F.lit(1))), "_k").agg(
        F.sum((X - F.col("mx")) * (Y - F.col("my"))).alias("sxy"),
        F.sum((X - F.col("mx")) ** 2).alias("sxx"),
        F.sum((Y - F.col("my")) ** 2).alias("syy"),
        F.max("n").alias("n"),
    )
    return c.select("n", F.round(ratio(F.col("sxy"), F.sqrt(F.col("sxx") * F.col("syy"))), 6).alias("pearson_r"))


def post_filter_stats(df: DataFrame, label: str = LABEL, k: int = 5) -> DataFrame:
    """After a filter: length min/max/mean/median, annotators, mean rows
    per annotator and label shares."""
    d = _written(_text_length(df), ANNOTATOR, label, "text_length")
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.min("text_length").alias("min_text_length"),
        F.max("text_length").alias("max_text_length"),
        F.avg("text_length").alias("mean_text_length"),
        F.countDistinct(ANNOTATOR).alias("n_annotators"),
        F.count(label).alias("_nl"),
    ] + [F.count_if(F.col(label) == c).alias(f"_n{c}") for c in range(1, k + 1)]
    s = grouped_stats(d, [], aggs, [("text_length", 0.5, "median_text_length")])
    return s.select(
        "n_rows",
        "min_text_length",
        "max_text_length",
        F.round("mean_text_length", 6).alias("mean_text_length"),
        F.round("median_text_length", 6).alias("median_text_length"),
        "n_annotators",
        F.round(ratio(F.col("n_rows"), F.col("n_annotators")), 6).alias("mean_rows_per_annotator"),
        *[F.round(ratio(F.col(f"_n{c}") * 100.0, F.col("_nl")), 6).alias(f"pct_label_{c}") for c in range(1, k + 1)],
    )
