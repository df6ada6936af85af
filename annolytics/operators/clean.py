"""Cleaning: hold-out split, column selection, duplicate resolution, length
and annotator-quality filters, and the cleaning funnel (SURVEY §2.2-2.4).

Every function maps DataFrames to DataFrames and stays lazy.

Scale notes
-----------
* Everything per text is keyed by a fixed-width digest, and its aggregates
  hold fixed-width numbers only, so Spark uses hash aggregates that combine
  map-side: a boilerplate text that makes up a third of the table is reduced
  to its distinct lead times before the shuffle, and no text is a sort or
  shuffle key.
* The functions that count texts or choose among them take a reference (length
  and digest, ``text_reference``) in the place of the text.  What is written
  or read as a text gets it back for the rows that are left
  (``attach_texts``), so texts are moved once, not once for every annotation.
* Annotator filters aggregate first (partial + final) and anti-join the small
  result.  No broadcast hint: AQE broadcasts the annotator table when its
  materialised size is under the threshold and otherwise keeps a sort-merge
  join whose skewed partitions it splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolytics.session import materialize

# Column names of the aggregated annotation table (FIXTURES A2).
ANNOTATOR = "student_code"
SOURCE = "source_file"
TEXT = "text"
LABEL = "label_numeric"
LEAD = "lead_time_seconds"
ORDER_KEY = ("annotation_id",)

# --- fixed values (the source project's cleaning configuration) -------------
# Columns kept for training, with annotation_created_at renamed to labeled_at.
TRAINING_COLUMNS = (
    "student_code",
    "json_filename",
    "text",
    "label_text",
    "label_numeric",
    "annotation_created_at",
    "lead_time_seconds",
)
MIN_TEXT_LENGTH = 50
MIN_MEAN_LEAD_TIME = 10.0
# Lead-time buckets in seconds: (name, lower bound inclusive, upper exclusive).
LEAD_TIME_BUCKETS = (
    ("< 2s", None, 2.0),
    ("2-5s", 2.0, 5.0),
    ("5s-2min", 5.0, 120.0),
    ("2-5min", 120.0, 300.0),
    ("> 5min", 300.0, None),
)
# -----------------------------------------------------------------------------


def holdout_flag(rules: Sequence[tuple[str, str | None]]) -> Column:
    """True for hold-out rows.  A rule is (annotator, optional source regex);
    a NULL source never matches a pattern."""
    cond = F.lit(False)
    for annotator, pattern in rules:
        c = F.col(ANNOTATOR) == F.lit(annotator)
        if pattern is not None:
            c = c & F.coalesce(F.col(SOURCE).rlike("(?i)" + pattern), F.lit(False))
        cond = cond | F.coalesce(c, F.lit(False))
    return cond


def holdout_split(df: DataFrame, rules) -> tuple[DataFrame, DataFrame]:
    """(working, test) — P3.  Runs before any cleaning; test rows are untouched."""
    flagged = df.withColumn("_is_test", holdout_flag(rules))
    working = flagged.filter(~F.col("_is_test")).drop("_is_test")
    test = flagged.filter(F.col("_is_test")).drop("_is_test")
    return working, test


def holdout_rule_counts(df: DataFrame, rules) -> DataFrame:
    """Rows taken by each hold-out rule, plus the total, in one pass (P3 report)."""
    aggs = []
    for i, (annotator, pattern) in enumerate(rules):
        c = holdout_flag([(annotator, pattern)])
        aggs.append(F.count_if(c).alias(f"r{i}"))
    aggs.append(F.count_if(holdout_flag(rules)).alias("total"))
    one = df.agg(*aggs)
    names = [f"{a}" if p is None else f"{a} ~ {p}" for a, p in rules] + ["total"]
    stack = F.stack(
        F.lit(len(names)),
        *[x for i, n in enumerate(names) for x in (F.lit(n), F.col(f"r{i}") if n != "total" else F.col("total"))],
    )
    return one.select(stack.alias("rule", "records"))


def select_training_columns(df: DataFrame, columns: Sequence[str] = TRAINING_COLUMNS) -> DataFrame:
    """Project the training columns; annotation_created_at -> labeled_at.
    Columns missing from the input are skipped (the driver view has no
    json_filename; its order key annotation_id is kept when present)."""
    keep = [c for c in ORDER_KEY if c in df.columns and c not in columns] + [c for c in columns if c in df.columns]
    return df.select(*[F.col(c).alias("labeled_at") if c == "annotation_created_at" else F.col(c) for c in keep])


def add_text_length(df: DataFrame, text: str = TEXT) -> DataFrame:
    """Length in code points (same as Python ``len``)."""
    return df.withColumn("text_length", F.col(f"{text}.length") if is_reference(df, text) else F.length(text))


def filter_short_texts(df: DataFrame, min_len: int = MIN_TEXT_LENGTH) -> DataFrame:
    """P5: keep rows with text_length >= min_len (NULL length is dropped)."""
    if "text_length" not in df.columns:
        df = add_text_length(df)
    return df.filter(F.col("text_length") >= min_len)


def short_text_listing(df: DataFrame, threshold: int = MIN_TEXT_LENGTH) -> DataFrame:
    """Rows under the threshold, longest first."""
    if "text_length" not in df.columns:
        df = add_text_length(df)
    cols = [c for c in ("annotation_id", "text_length", ANNOTATOR, LABEL, LEAD, SOURCE, TEXT) if c in df.columns]
    return df.filter(F.col("text_length") < threshold).select(*cols).orderBy(F.desc("text_length"), *ORDER_KEY)


def short_length_counts(df: DataFrame, threshold: int = MIN_TEXT_LENGTH) -> DataFrame:
    """Number of rows per exact length among short texts."""
    if "text_length" not in df.columns:
        df = add_text_length(df)
    return (
        df.filter(F.col("text_length") < threshold)
        .groupBy("text_length")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("text_length"))
    )


def lead_time_buckets(df: DataFrame, buckets=LEAD_TIME_BUCKETS, lead: str = LEAD) -> DataFrame:
    """Zero-filled bucket counts and % of *all* rows, one aggregate pass."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, (_, lo, hi) in enumerate(buckets):
        c = F.lit(True)
        if lo is not None:
            c = c & (F.col(lead) >= lo)
        if hi is not None:
            c = c & (F.col(lead) < hi)
        aggs.append(F.count_if(F.coalesce(c, F.lit(False))).alias(f"b{i}"))
    one = df.agg(*aggs)
    stack = F.stack(
        F.lit(len(buckets)),
        *[x for i, (name, _, _) in enumerate(buckets) for x in (F.lit(i), F.lit(name), F.col(f"b{i}"))],
    ).alias("bucket_order", "bucket", "n")
    return one.select(stack, "_total").select(
        "bucket_order",
        "bucket",
        "n",
        F.round(F.try_divide(F.col("n") * 100.0, F.col("_total")), 6).alias("pct"),
    )


def fastest_rows(df: DataFrame, below: float = 2.0, k: int = 10, lead: str = LEAD) -> DataFrame:
    """K smallest lead times among those under ``below`` (ties by key)."""
    return df.filter(F.col(lead) < below).orderBy(F.asc(lead), *ORDER_KEY).limit(k)


def slowest_rows(df: DataFrame, at_least: float = 300.0, k: int = 10, lead: str = LEAD) -> DataFrame:
    """K largest lead times among those >= ``at_least`` (ties by key)."""
    return df.filter(F.col(lead) >= at_least).orderBy(F.desc(lead), *ORDER_KEY).limit(k)


# --- duplicates ---------------------------------------------------------------


def duplicate_groups(df: DataFrame, text: str = TEXT) -> DataFrame:
    """(text, n) for every text; partial aggregation on the map side."""
    return df.filter(F.col(text).isNotNull()).groupBy(text).agg(F.count(F.lit(1)).alias("n"))


def duplicate_summary(df: DataFrame, text: str = TEXT) -> DataFrame:
    """Total rows, unique texts, surplus rows, rows inside duplicate groups."""
    g = duplicate_groups(df, text)
    return g.agg(
        F.sum("n").cast("long").alias("total_records"),
        F.count(F.lit(1)).alias("unique_texts"),
        (F.sum("n") - F.count(F.lit(1))).cast("long").alias("surplus_records"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("rows_in_duplicate_groups"),
    )


def top_duplicates(df: DataFrame, k: int = 10, text: str = TEXT) -> DataFrame:
    """The k most repeated texts (ties by text)."""
    return duplicate_groups(df, text).filter(F.col("n") > 1).orderBy(F.desc("n"), F.asc(text)).limit(k)


def _digest(text: Column) -> list[Column]:
    h = F.md5(text.cast("binary"))
    return [F.conv(F.substring(h, 15 * i + 1, 15), 16, 10).cast("long") for i in range(2)]


def text_reference(text: str | Column = TEXT) -> Column:
    """Length and digest of a text, NULL for a NULL text."""
    t = F.col(text) if isinstance(text, str) else text
    return F.when(t.isNotNull(), F.struct(F.length(t).alias("length"), *[d.alias(f"d{i}") for i, d in enumerate(_digest(t))]))


def is_reference(df: DataFrame, text: str = TEXT) -> bool:
    return isinstance(df.schema[text].dataType, T.StructType)


def text_digest(df: DataFrame, text: str = TEXT) -> list[Column]:
    """A text as two fixed-width numbers (120 bits of its MD5): the key of
    everything that is counted per text, so that no text is shuffled, sorted
    or compared."""
    d = [F.col(f"{text}.d{i}") for i in range(2)] if is_reference(df, text) else _digest(F.col(text))
    return [x.alias(f"_d{i}") for i, x in enumerate(d)]


def text_key(df: DataFrame, text: str = TEXT):
    """Digest used to count distinct texts: shuffles 16 bytes per row instead
    of the text (collision odds ~n^2 / 2^121); NULL for a NULL text."""
    return F.when(F.col(text).isNotNull(), F.struct(*text_digest(df, text))).alias("_text")


def attach_texts(df: DataFrame, texts: DataFrame, text: str = TEXT) -> DataFrame:
    """``df`` with the texts in the place of their references; ``texts`` holds
    every one of them in its column ``text``, equal ones any number of times."""
    known = texts.filter(F.col(text).isNotNull()).select(text, *text_digest(texts, text))
    known = known.groupBy("_d0", "_d1").agg(F.min(text).alias("_text"))
    j = df.select("*", *text_digest(df, text)).join(known, ["_d0", "_d1"], "left")
    return j.select(*[F.col("_text").alias(c) if c == text else F.col(c) for c in df.columns])


def duplicate_label_variation(df: DataFrame, k: int | None = 10, text: str = TEXT) -> DataFrame:
    """Per repeated text: label count/mean/std/min/max and annotators.

    Counted per (digest, annotator), then per digest; only texts that repeat
    are read again for the report."""
    d = ["_d0", "_d1"]
    known = df.filter(F.col(text).isNotNull())
    x = F.col(LABEL).cast("double")
    by_annotator = (
        known.select(*text_digest(df, text), F.xxhash64(ANNOTATOR).alias("_a"), F.col(ANNOTATOR).isNotNull().alias("_known"), LABEL)
        .groupBy(*d, "_a", "_known")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count(LABEL).alias("_nl"),
            F.sum(x).alias("_s"),
            F.sum(x * x).alias("_ss"),
            F.min(LABEL).alias("_mn"),
            F.max(LABEL).alias("_mx"),
        )
    )
    g = by_annotator.groupBy(*d).agg(
        F.sum("_n").alias("n_rows"),
        F.sum("_nl").alias("n_labels"),
        F.sum("_s").alias("_s"),
        F.sum("_ss").alias("_ss"),
        F.min("_mn").alias("min_label"),
        F.max("_mx").alias("max_label"),
        F.count_if("_known").alias("n_annotators"),
    )
    g = g.filter(F.col("n_rows") > 1)
    n = F.col("n_labels")
    # labels are small whole numbers, so both sums are exact
    var = F.try_divide(F.col("_ss") - F.try_divide(F.col("_s") * F.col("_s"), n), F.when(n > 1, n - 1))
    texts = known.select(*text_digest(df, text), text).join(g.select(*d), d, "left_semi").groupBy(*d).agg(F.min(text).alias(text))
    out = g.join(texts, d).select(
        text,
        "n_rows",
        "n_labels",
        F.round(F.try_divide(F.col("_s"), n), 6).alias("mean_label"),
        F.round(F.sqrt(F.when(var < 0, 0.0).otherwise(var)), 6).alias("std_label"),
        "min_label",
        "max_label",
        "n_annotators",
    )
    out = out.orderBy(F.desc("n_labels"), F.asc(text))
    return out.limit(k) if k else out


def resolve_duplicates(
    df: DataFrame,
    text: str = TEXT,
    label: str = LABEL,
    lead: str = LEAD,
    order_key: Sequence[str] = ORDER_KEY,
) -> DataFrame:
    """U4: one row per text.

    * group of 1 -> that row;
    * group of 2 with equal (non-NULL) labels -> the first row;
    * otherwise -> the row with the largest lead time (NULL lowest), ties to
      the first row.
    "First" is the smallest ``order_key``.  NULL texts are dropped; rows that
    agree in text and order key count as two, and the one with the smaller
    checksum of its columns stays.

    The choice is made on fixed-width numbers: (digest, lead time) with the
    smallest order key first, where every lead time is then unique for its
    text, so the row with the largest one is a plain ``max_by``.  With one
    numeric key both aggregates are hash aggregates that combine before each
    shuffle, and a text repeated millions of times is spread by lead time.
    Whole rows move once, to the join with the chosen (digest, key)."""
    d = ["_d0", "_d1"]
    key = F.col(order_key[0]) if len(order_key) == 1 else F.struct(*order_key)
    known = df.filter(F.col(text).isNotNull())
    x = F.col(lead).cast("double")
    low = F.lit(-1.0e308)
    by_lead = (
        known.select(*text_digest(df, text), F.coalesce(F.when(~F.isnan(x), x), low).alias("_lead"), F.col(label).alias("_label"), key.alias("_key"))
        .groupBy(*d, "_lead")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count("_label").alias("_nl"),
            F.min("_label").alias("_mn"),
            F.max("_label").alias("_mx"),
            F.min("_key").alias("_key"),
        )
    )
    chosen = by_lead.groupBy(*d).agg(
        F.sum("_n").alias("_n"),
        F.sum("_nl").alias("_nl"),
        F.min("_mn").alias("_mn"),
        F.max("_mx").alias("_mx"),
        F.min("_key").alias("_first"),
        F.max_by("_key", "_lead").alias("_best"),
    )
    agree = (F.col("_n") == 2) & (F.col("_nl") == 2) & (F.col("_mn") == F.col("_mx"))
    chosen = chosen.select(*d, F.when(agree, F.col("_first")).otherwise(F.col("_best")).alias("_key"))
    rows = known.select("*", *text_digest(df, text), key.alias("_key")).join(chosen, [*d, "_key"], "left_semi")
    # rows that share text and key; groups of one otherwise
    one = Window.partitionBy(*d, "_key").orderBy(F.xxhash64(*df.columns))
    return rows.withColumn("_one", F.row_number().over(one)).filter("_one = 1").select(*df.columns)


# --- annotator quality --------------------------------------------------------


def annotator_lead_times(df: DataFrame, lead: str = LEAD) -> DataFrame:
    """Mean, median and count of (non-NULL) lead times per annotator,
    lowest mean first.  The median is the distributed exact one, so an
    annotator with a third of all rows is not held in one task."""
    from annolytics.operators.profile import annotator_lead_times as per_annotator

    return per_annotator(df, lead).orderBy("mean_lead_time", ANNOTATOR)


def removed_annotators(df: DataFrame, threshold: float = MIN_MEAN_LEAD_TIME, lead: str = LEAD) -> DataFrame:
    """Annotators whose mean lead time is below the threshold.
    A NULL mean (no lead times at all) is not below anything: kept."""
    return (
        df.groupBy(ANNOTATOR)
        .agg(F.avg(lead).alias("mean_lead_time"), F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("mean_lead_time") < threshold)
    )


def remove_rushed_annotators(df: DataFrame, threshold: float = MIN_MEAN_LEAD_TIME, lead: str = LEAD) -> DataFrame:
    """Drop every row of a rushed annotator (left-anti join)."""
    bad = removed_annotators(df, threshold, lead).select(ANNOTATOR)
    return df.join(bad, ANNOTATOR, "left_anti")


# --- whole cleaning pipeline + funnel ----------------------------------------


class Cleaned:
    """Frames produced by the cleaning pipeline, all lazy (J2 order:
    hold-out -> select -> duplicates -> length -> short filter -> annotators)."""

    def __init__(self, raw, working, test, selected, deduped, long_enough, train, rules,
                 min_len=MIN_TEXT_LENGTH, min_mean_lead=MIN_MEAN_LEAD_TIME):
        self.rules = rules
        self.min_len = min_len
        self.min_mean_lead = min_mean_lead
        self.raw = raw
        self.working = working
        self.test = test
        self.selected = selected
        self.deduped = deduped
        self.long_enough = long_enough
        self.train = train


def clean(
    df: DataFrame,
    rules: Sequence[tuple[str, str | None]],
    min_len: int = MIN_TEXT_LENGTH,
    min_mean_lead: float = MIN_MEAN_LEAD_TIME,
    columns: Sequence[str] = TRAINING_COLUMNS,
) -> Cleaned:
    working, test = holdout_split(df, rules)
    selected = select_training_columns(working, columns)
    deduped = add_text_length(resolve_duplicates(selected))
    long_enough = filter_short_texts(deduped, min_len)
    train = remove_rushed_annotators(long_enough, min_mean_lead)
    return Cleaned(df, working, test, selected, deduped, long_enough, train, rules, min_len, min_mean_lead)


def cleaning_funnel(c: Cleaned) -> DataFrame:
    """Per step the rows before/after, removed and % removed, then the
    final train/test/total counts.

    Two passes over the input: a flagged one over the raw rows (initial,
    hold-out, test) and the duplicate resolution, whose result is written
    once without the texts; the later steps are counted on that table.
    """
    flag = holdout_flag(c.rules)
    a = c.raw.agg(
        F.count(F.lit(1)).alias("initial"), F.count_if(~flag).alias("holdout"), F.count_if(flag).alias("test")
    )
    narrow = materialize(c.deduped.select(ANNOTATOR, LEAD, "text_length"), "funnel-rows")
    b = narrow.agg(
        F.count(F.lit(1)).alias("duplicates"), F.count_if(F.col("text_length") >= c.min_len).alias("short_texts")
    )
    final = remove_rushed_annotators(narrow.filter(F.col("text_length") >= c.min_len), c.min_mean_lead)
    t = final.agg(F.count(F.lit(1)).alias("rushed_annotators"))
    # three one-row results side by side
    one = F.lit(1)
    wide = a.withColumn("_k", one).join(b.withColumn("_k", one), "_k").join(t.withColumn("_k", one), "_k")
    steps = [("holdout", "initial"), ("duplicates", "holdout"), ("short_texts", "duplicates"),
             ("rushed_annotators", "short_texts")]
    parts = []
    for i, (after, before) in enumerate(steps, start=1):
        parts += [F.lit(i), F.lit(after), F.col(before), F.col(after)]
    parts += [F.lit(5), F.lit("final_train"), F.col("initial"), F.col("rushed_annotators")]
    parts += [F.lit(6), F.lit("final_test"), F.col("initial"), F.col("test")]
    parts += [F.lit(7), F.lit("final_total"), F.col("initial"), F.col("rushed_annotators") + F.col("test")]
    rows = wide.select(F.stack(F.lit(7), *parts).alias("step_no", "step", "records_before", "records_after"))
    removed = F.col("records_before") - F.col("records_after")
    return rows.select(
        F.col("step_no").cast("int").alias("step_no"),
        "step",
        F.col("records_before").cast("long").alias("records_before"),
        F.col("records_after").cast("long").alias("records_after"),
        F.when(F.col("step_no") <= 4, removed).cast("long").alias("removed"),
        F.when(F.col("step_no") <= 4, F.round(F.try_divide(removed * 100.0, F.col("records_before")), 6)).alias(
            "pct_removed"
        ),
    )
