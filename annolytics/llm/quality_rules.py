"""Quality rules with risk-controlled cutoffs.

Each rule rejects a document whose statistic exceeds a cutoff.  The cutoff is
picked per stratum from a fixed grid, with a guarantee: with confidence
``1 - delta`` over all strata, rules and grid points together, no chosen rule
rejects more than ``alpha`` / (number of rules) of the good documents of its
stratum, so all rules together reject at most ``alpha`` of them.

The guarantee is an exact binomial test per (stratum, rule, cutoff) on the
labelled holdout: with n good documents of which k exceed the cutoff, the
hypothesis "the true rate is above a" is rejected when
P(Binomial(n, a) <= k) is small enough, which is the same as an exact
(Clopper-Pearson) upper bound below a.  Holm's step-down procedure corrects
for all tests at once.  Among certified cutoffs the one that rejects the most
bad labelled documents wins, the largest of equals.  Where none is certified
(too few labels) or none rejects a bad document, the rule is off.

All labelled documents are used; their counts per grid point are aggregated
before the shuffle, and the tests run on (strata x rules x grid) rows.
Statistics come from whole texts by array expressions of one row, so nothing
is exploded or grouped by text.

Defined cases: a null text has no words and fails the base rule; a null
stratum is a stratum of its own; labels without a document, documents without
a label and null labels do not enter the tests; contradicting labels of one
document count as one each; documents of a stratum without certified cutoff
pass; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolytics.llm.common import words
from annolytics.session import materialize

SYMBOLS = "#*$%&|<>"
#: Cutoffs tried for every rule; part of the design, fixed before any label is seen.
GRID = (0.01, 0.02, 0.03, 0.05, 0.07, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.75, 1.0)
RULES = ("symbol_ratio", "dup_line_ratio", "repeat_ratio")


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines (lines with a word),
    n_dup_lines and n_repeat_words, all long.

    A window is one long: the high bits of the hash of its three words, and
    its place in as many low bits as the text's number of words needs.  Equal
    windows are neighbours after a primitive sort; neighbours that agree in
    the hash bits are compared word by word.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.withColumn("_w", words(F.col(text)))
    d = d.withColumn("_lines", F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.withColumn("_low", F.expr("shiftleft(1L, length(bin(size(_w)))) - 1"))  # place bits

    def word(i):
        return F.get(F.col("_w"), i)

    windows = F.when(F.size("_w") < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.greatest(F.size("_w") - 3, F.lit(0))),
            lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)).bitwiseAND(F.bitwise_not("_low")).bitwiseOR(i.cast("long")),
        )
    )
    d = d.withColumn("_s", F.sort_array(windows))
    low = F.col("_low")

    def twins(x, y):
        i, j = x.bitwiseAND(low).cast("int"), y.bitwiseAND(low).cast("int")
        same_hash = F.bitwise_not(low).bitwiseAND(x.bitwiseXOR(y)) == 0
        return F.coalesce(same_hash & (word(i) == word(j)) & (word(i + 1) == word(j + 1)) & (word(i + 2) == word(j + 2)), F.lit(False))

    repeated = F.filter(
        F.col("_s"), lambda x, k: twins(x, F.get(F.col("_s"), k - 1)) | twins(x, F.get(F.col("_s"), k + 1))
    )
    d = d.withColumn("_p", F.sort_array(F.transform(repeated, lambda x: x.bitwiseAND(low))))
    # a window covers three words, or fewer up to the next one's start
    covered = F.aggregate(
        F.zip_with("_p", F.slice("_p", 2, F.greatest(F.size("_p"), F.lit(1))), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3))),
        F.lit(0).cast("long"),
        lambda acc, x: acc + x,
    )
    return d.select(
        *docs.columns,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "_w")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.regexp_replace(t, "[" + SYMBOLS + "]", ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
    )


def statistics() -> dict[str, Column]:
    """The rules' statistics from the counts, each 0 where undefined."""

    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))

    return {
        "symbol_ratio": share("n_symbols", "word_chars"),
        "dup_line_ratio": share("n_dup_lines", "n_lines"),
        "repeat_ratio": share("n_repeat_words", "n_words"),
    }


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1: Stirling's series at x + 10, stepped back."""
    y = x + 10.0
    steps = F.lit(0.0)
    for i in range(10):
        steps = steps + F.log(x + float(i))
    series = 1.0 / (12.0 * y) - 1.0 / (360.0 * y * y * y) + 1.0 / (1260.0 * y * y * y * y * y)
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - steps


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k) as an expression.

    Sums the point masses from k downwards by their exact ratio, starting
    from the mass at k, or at 12 standard deviations above the mean where k
    lies higher.  Masses 40 deviations and 60 steps below the mean, and those
    above the start, are too small to change a double."""
    k, n = k.cast("double"), n.cast("double")
    spread = F.sqrt(n * p)
    k = F.least(k, F.floor(n * p + 12.0 * spread + 20.0))
    log_mass = _log_gamma(n + 1.0) - _log_gamma(k + 1.0) - _log_gamma(n - k + 1.0) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1.0 - p))
    reach = F.least(k, F.ceil(52.0 * spread) + 80.0).cast("int")
    down = F.aggregate(
        F.sequence(F.lit(0), reach),
        F.struct(F.lit(1.0).alias("mass"), F.lit(0.0).alias("sum")),
        lambda acc, i: F.struct(
            (acc["mass"] * (k - i) * (1.0 - p) / ((n - k + i + 1.0) * p)).alias("mass"),
            (acc["sum"] + acc["mass"]).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    return F.least(F.lit(1.0), F.exp(log_mass) * down)


def certify_cutoffs(
    labelled: DataFrame,
    stratum: str,
    good: str,
    rules: Sequence[str] = RULES,
    grid: Sequence[float] = GRID,
    alpha: float = 0.05,
    delta: float = 0.05,
) -> DataFrame:
    """(stratum, rule, cutoff) for every certified choice.

    ``labelled`` has the stratum, the rules' statistics and ``good``, 1 for a
    document to keep and 0 for one to reject.
    """
    rate = alpha / len(rules)
    per_rule = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("x")) for r in rules])
    cuts = F.array(*[F.lit(float(c)) for c in grid])
    # counts per (stratum, rule, number of cutoffs exceeded); grid rows after
    level = F.size(F.filter(cuts, lambda c: c < F.col("r.x")))
    x = labelled.filter(F.col(good).isin(0, 1)).select(stratum, good, F.explode(per_rule).alias("r"))
    cells = x.groupBy(stratum, F.col("r.rule").alias("rule"), level.alias("level")).agg(
        F.sum(good).alias("good"), F.sum(1 - F.col(good)).alias("bad")
    )
    above = F.sequence(F.lit(0), F.lit(len(grid) - 1))
    tests = cells.select(stratum, "rule", "level", "good", "bad", F.explode(above).alias("c")).groupBy(stratum, "rule", "c").agg(
        F.sum("good").alias("n"),
        F.sum(F.when(F.col("level") > F.col("c"), F.col("good")).otherwise(0)).alias("k"),
        F.sum(F.when(F.col("level") > F.col("c"), F.col("bad")).otherwise(0)).alias("hits"),
    )
    tests = tests.withColumn("p", F.when(F.col("n") > 0, binomial_cdf(F.col("k"), F.col("n"), rate)).otherwise(F.lit(1.0)))
    # Holm: the i-th smallest of m p-values against delta / (m - i + 1), up to
    # the first that fails
    by_p = Window.orderBy("p", F.col(stratum).isNull(), stratum, "rule", "c")
    holm = tests.withColumn("i", F.row_number().over(by_p)).withColumn("m", F.count(F.lit(1)).over(Window.partitionBy()))
    passes = (F.col("p") <= F.lit(delta) / (F.col("m") - F.col("i") + 1)).cast("int")
    holm = holm.withColumn("ok", F.min(passes).over(by_p.rowsBetween(Window.unboundedPreceding, 0)))
    best = holm.filter("ok = 1 AND hits > 0").groupBy(stratum, "rule").agg(F.max(F.struct("hits", "c")).alias("b"))
    return best.select(stratum, "rule", F.get(cuts, F.col("b.c")).alias("cutoff"))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    min_words: int = 50,
    max_repeat_pct: int = 50,
    **options,
) -> DataFrame:
    """``docs`` with the counts, base_failed, failed_rules (array) and kept.

    ``labels`` has doc_id and quality (1 good, 0 bad).  Base rule: fewer than
    ``min_words`` words, or more than ``max_repeat_pct`` percent of the words
    in repeated three-word windows.  Only documents that pass the base rule
    take part in the tests.
    """
    clash = {"n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", *RULES}
    keep = [c for c in docs.columns if c not in clash]
    d = with_counts(docs.select(*keep)).drop("text")
    d = d.withColumns(statistics())
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct)
    # counted once: the tests and the verdicts read the same narrow table
    d = materialize(d.withColumn("base_failed", failed), "quality-counts")
    lab = labels.select(F.col("doc_id").alias("_labelled_doc"), F.col("quality").alias("_good"))
    holdout = d.filter(~F.col("base_failed")).join(lab, F.col("doc_id") == F.col("_labelled_doc")).select(stratum, "_good", *RULES)
    cutoffs = certify_cutoffs(holdout, stratum, "_good", **options)
    per_stratum = cutoffs.groupBy(stratum).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cut"))
    per_stratum = materialize(per_stratum.withColumnRenamed(stratum, "_stratum"), "quality-cutoffs")
    d = d.join(per_stratum, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    broken = F.array_compact(
        F.array(*[F.when(F.col(r) > F.try_element_at("_cut", F.lit(r)), F.lit(r)) for r in RULES])
    )
    return d.withColumn("failed_rules", broken).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("_cut", "_stratum")
