"""Annotator bias: label shares, per-annotator chi-square
against the overall distribution, label matrix and bias bands.

The chi-square statistic uses
    sum_l (o_al - e_al)^2 / e_al  =  (1/n_a) * sum_l o_al^2 / s_l  -  n_a
(e_al = s_l * n_a, sum_l s_l = 1, sum_l o_al = n_a), so only the labels an
annotator actually used enter: an equi-join of (annotator, label) counts with
the per-label shares, no annotator x label grid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolytics.functions.stats import chi2_sf, ratio
from annolytics.operators.clean import ANNOTATOR, LABEL

# --- fixed values: bands on an annotator's mean label -------------------------
BIAS_BANDS = (
    ("< 3.0", None, 3.0),
    ("3.0-3.5", 3.0, 3.5),
    ("3.5-4.0", 3.5, 4.0),
    ("4.0-4.5", 4.0, 4.5),
    (">= 4.5", 4.5, None),
)
SIGNIFICANCE = 0.05
# ------------------------------------------------------------------------------


def overall_label_share(df: DataFrame, label: str = LABEL) -> DataFrame:
    """B1: share of each label among non-NULL labels."""
    g = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # over the per-label rows only
    return g.select(
        label, "n", (F.col("n") / F.sum("n").over(everything)).alias("share"),
        (F.count(F.lit(1)).over(everything) - 1).alias("dof"),
    )


def annotator_chi_square(df: DataFrame, label: str = LABEL, alpha: float = SIGNIFICANCE) -> DataFrame:
    """B2: per annotator: n, mean and sample std of the label, chi-square
    against the overall label shares, p-value (dof = #labels - 1) and
    ``significant`` (p < alpha).  Rows without a label are excluded."""
    d = df.filter(F.col(label).isNotNull())
    shares = overall_label_share(d, label).select(label, "share", "dof")
    # One aggregate gives the per-annotator label counts; everything after
    # runs on (annotator, label) cells.
    cells = d.groupBy(ANNOTATOR, label).agg(
        F.count(F.lit(1)).alias("o"), F.sum(F.col(label).cast("double")).alias("_s1"),
        F.sum(F.col(label).cast("double") ** 2).alias("_s2"),
    )
    per = cells.join(shares, label).groupBy(ANNOTATOR).agg(
        F.sum("o").alias("n"),
        F.sum("_s1").alias("_s1"),
        F.sum("_s2").alias("_s2"),
        F.sum(F.col("o") * F.col("o") / F.col("share")).alias("_q"),
        F.max("dof").alias("dof"),
    )
    n = F.col("n")
    mean = F.col("_s1") / n
    var = F.try_divide(F.col("_s2") - n * mean * mean, n - 1)
    chi = per.select(
        ANNOTATOR, "n", "dof", mean.alias("mean_label"),
        # one row -> NULL sample std (greatest() would turn NULL into 0)
        F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0)))).alias("std_label"),
        F.greatest(F.col("_q") / n - n, F.lit(0.0)).alias("chi2"),
    )
    p = chi2_sf(F.col("chi2"), F.col("dof"))
    out = chi.select(
        ANNOTATOR,
        "n",
        F.round("mean_label", 6).alias("mean_label"),
        F.round("std_label", 6).alias("std_label"),
        F.round("chi2", 6).alias("chi2"),
        F.round(p, 6).alias("p_value"),
        (p < alpha).alias("significant"),
    )
    return out.orderBy("p_value", ANNOTATOR)


def biased_annotator_count(chi: DataFrame) -> DataFrame:
    """How many annotators are significant, out of how many."""
    return chi.agg(
        F.count_if(F.col("significant")).alias("n_significant"),
        F.count(F.lit(1)).alias("n_annotators"),
    ).select("n_significant", "n_annotators", F.round(ratio(F.col("n_significant") * 100.0, F.col("n_annotators")), 6).alias("pct_significant"))


def annotator_label_matrix(df: DataFrame, label: str = LABEL, k: int = 5) -> DataFrame:
    """% of each label 1..k per annotator (0-filled) and the mean label,
    highest mean first; five conditional counts in one aggregate."""
    d = df.filter(F.col(label).isNotNull())
    g = d.groupBy(ANNOTATOR).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(label).alias("mean_label"),
        *[F.count_if(F.col(label) == c).alias(f"_n{c}") for c in range(1, k + 1)],
    )
    return g.select(
        ANNOTATOR,
        *[F.round(F.col(f"_n{c}") * 100.0 / F.col("n"), 6).alias(f"pct_label_{c}") for c in range(1, k + 1)],
        F.round("mean_label", 6).alias("mean_label"),
    ).orderBy(F.desc("mean_label"), ANNOTATOR)


def band_of(mean: Column, bands=BIAS_BANDS) -> Column:
    """Name of the band that a mean label falls into."""
    out = F.lit(None).cast("string")
    for name, lo, hi in reversed(bands):
        inside = F.lit(True)
        if lo is not None:
            inside = inside & (mean >= lo)
        if hi is not None:
            inside = inside & (mean < hi)
        out = F.when(inside, F.lit(name)).otherwise(out)
    return out


def bias_bands(df: DataFrame, label: str = LABEL, bands=BIAS_BANDS) -> DataFrame:
    """Bands on each annotator's mean label: count and sorted member list
    per band, empty bands included.  Annotators are grouped by band; the list
    of a band's members is the report itself."""
    per = df.filter(F.col(label).isNotNull()).groupBy(ANNOTATOR).agg(F.avg(label).alias("m"))
    g = per.groupBy(band_of(F.col("m"), bands).alias("_band")).agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list(ANNOTATOR)), ", ").alias("m")
    )
    rows = F.array(*[F.struct(F.lit(i).alias("band_order"), F.lit(b[0]).alias("band")) for i, b in enumerate(bands)])
    every = df.sparkSession.range(1).select(F.inline(rows))
    return every.join(g, F.col("band") == F.col("_band"), "left").select(
        "band_order", "band", F.coalesce("n", F.lit(0).cast("long")).alias("n_annotators"), F.coalesce("m", F.lit("")).alias("members")
    )
