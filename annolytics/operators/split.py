"""Splits, class weights and sampling.

Order inside a class is a seeded md5 digest of the row key, identical in
Spark and DuckDB.  Ranks inside a class come from ``hashed_rank``, which
slices each class by the digest's leading bits, so a class holding a third of
the table is still ranked by many tasks.  Quotas are computed on the
per-class count table (one row per class).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annolytics.functions.stats import hash_order, hashed_rank

SEED = 42
VAL_FRACTION = 0.2
N_FOLDS = 5


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))


def class_weights(df: DataFrame, label: str = "label_numeric") -> DataFrame:
    """Balanced weights n / (k * n_c) over the classes present."""
    c = class_counts(df, label)
    w = Window.partitionBy()
    return c.select(
        F.col(label).alias("label"),
        "n_c",
        (F.sum("n_c").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_c"))).alias("weight"),
    )


def inverse_frequency_weights(df: DataFrame, key: str, label: str = "label_numeric") -> DataFrame:
    """Per-row sampling weight 1 / n_c."""
    c = class_counts(df, label)
    return df.filter(F.col(label).isNotNull()).join(F.broadcast(c), label).select(key, label, (F.lit(1.0) / F.col("n_c")).alias("weight"))


def _ranked(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    d = df.filter(F.col(label).isNotNull()).withColumn("_h", hash_order(seed, F.col(key)))
    return hashed_rank(d, [label], "_h")


def split_quotas(df: DataFrame, label: str, val_fraction: float = VAL_FRACTION) -> DataFrame:
    """Validation rows per class: V = ceil(f*n) in total, class c gets
    floor(n_c*V/n) plus one of the leftover rows if its fractional part is
    among the largest (ties to the lower class).  Runs on the class table."""
    c = class_counts(df, label)
    w = Window.partitionBy()
    n = F.sum("n_c").over(w)
    v = F.ceil(n * F.lit(val_fraction))
    c = c.select(label, "n_c", (F.col("n_c") * v / n).alias("_q"), v.alias("_v"))
    c = c.withColumn("_fl", F.floor("_q")).withColumn("_fr", F.col("_q") - F.col("_fl"))
    c = c.withColumn("_left", F.col("_v") - F.sum("_fl").over(w))
    order = Window.orderBy(F.desc("_fr"), F.asc(label))
    c = c.withColumn("_pos", F.row_number().over(order))
    return c.select(label, "n_c", (F.col("_fl") + (F.col("_pos") <= F.col("_left")).cast("long")).alias("n_val"))


def stratified_split(
    df: DataFrame, key: str, label: str = "label_numeric", val_fraction: float = VAL_FRACTION, seed: int = SEED
) -> DataFrame:
    """Adds ``split`` in {train, validation}: the n_val rows of each class
    with the smallest seeded digest go to validation."""
    q = split_quotas(df, label, val_fraction)
    r = _ranked(df, key, label, seed).join(F.broadcast(q.select(label, "n_val")), label)
    out = r.withColumn("split", F.when(F.col("rank") <= F.col("n_val"), "validation").otherwise("train"))
    return out.drop("_h", "rank", "group_size", "n_val")


def split_report(split_df: DataFrame, label: str = "label_numeric", split: str = "split") -> DataFrame:
    """Per split and class: count, % within the split, and the split's
    size and % of all rows."""
    g = split_df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    per_split = F.sum("n").over(Window.partitionBy(split))
    total = F.sum("n").over(Window.partitionBy())
    return g.select(
        split,
        label,
        "n",
        F.round(F.col("n") * 100.0 / per_split, 6).alias("pct_in_split"),
        per_split.alias("split_size"),
        F.round(per_split * 100.0 / total, 6).alias("split_pct"),
    )


def stratified_folds(
    df: DataFrame, key: str, label: str = "label_numeric", n_folds: int = N_FOLDS, seed: int = SEED
) -> DataFrame:
    """fold = (rank inside the class by seeded digest - 1) mod n_folds;
    usable as ``CrossValidator(foldCol=...)``."""
    r = _ranked(df, key, label, seed)
    return r.withColumn("fold", ((F.col("rank") - 1) % n_folds).cast("int")).drop("_h", "rank", "group_size")


def capped_class_sample(
    df: DataFrame, key: str, label: str = "label_numeric", batch_size: int = 32, seed: int = SEED
) -> DataFrame:
    """``batch_size // 5 + 1`` seeded rows per class in class order, cut
    to ``batch_size`` rows; a frame of at most ``batch_size`` rows is taken
    whole.  The limit is the feature (a fixed-size batch)."""
    cap = batch_size // 5 + 1
    r = _ranked(df, key, label, seed)
    # the total of all rows, unlabelled ones included, from one row
    total = df.agg(F.count(F.lit(1)).alias("_total")).withColumn("_one", F.lit(1))
    picked = r.filter(F.col("rank") <= cap).orderBy(label, "rank").limit(batch_size).select(key)
    picked = picked.distinct().withColumn("_picked", F.lit(True))
    d = df.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one").join(F.broadcast(picked), key, "left")
    return d.filter((F.col("_total") <= batch_size) | F.col("_picked")).select(*df.columns)


def balanced_resample(
    df: DataFrame, key: str, label: str = "label_numeric", n: int | None = None, seed: int = SEED
) -> DataFrame:
    """Exactly ``n`` draws with replacement (default: as many as there are
    labelled rows), a row's probability proportional to 1/n_c.

    Row weights sum to 1 in every class, so the prefix sums of the weights
    cut [0, k) into one unit interval a class, and inside it into n_c equal
    steps, one a row in the seeded order of W1.  Draw i is a seeded uniform
    number on [0, k): its whole part picks the class, the rest the rank, and
    an equi-join on (class, rank) finds the row.  The sample depends on seed,
    n and keys alone, never on partitions."""
    counts = class_counts(df, label).orderBy(label).collect()  # one row a class
    draws = n if n is not None else sum(r["n_c"] for r in counts)
    if not counts:
        return df.limit(0)
    spark = df.sparkSession
    digits = hash_order(seed, F.concat(F.lit("draw|"), F.col("id").cast("string")))
    u = F.conv(F.substring(digits, 1, 13), 16, 10).cast("double") / F.lit(float(16**13)) * len(counts)
    number = spark.range(draws).select(u.alias("_u")).withColumn("_class", F.floor("_u").cast("int"))
    sizes = F.array(*[F.lit(r["n_c"]).cast("long") for r in counts])
    place = F.floor((F.col("_u") - F.col("_class")) * F.get(sizes, F.col("_class"))).cast("long") + 1
    names = F.array(*[F.lit(r[label]) for r in counts])
    drawn = number.select(F.get(names, F.col("_class")).alias("_label"), place.alias("_rank"))
    ranked = _ranked(df, key, label, seed)
    return ranked.join(drawn, (ranked[label] == F.col("_label")) & (ranked["rank"] == F.col("_rank"))).select(*[ranked[c] for c in df.columns])
