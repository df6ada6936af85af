"""Scoring: logits -> probabilities, scored records, prediction summary,
batch scoring with a fitted model (SURVEY §2.10) and P13 pairing.

Everything but external-model scoring is a projection or a global aggregate
of JVM expressions; no row leaves the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolytics.functions import labels as L

LOGITS = ("z1", "z2", "z3", "z4", "z5")


def softmax_scores(df: DataFrame, logits: Sequence[str] = LOGITS, keep: bool = True) -> DataFrame:
    """Probabilities p1..pK (numerically stable softmax), the arg-max
    class (first on ties, classes 1..K) and its probability as confidence.

    The exponentials are projected once, then normalised in a second
    projection, so no lambda is evaluated twice per row.
    """
    z = F.array(*[F.col(c).cast("double") for c in logits])
    m = F.array_max(z)
    step = df.select(
        "*",
        F.array_position(z, m).cast("int").alias("predicted_label"),
        *[F.exp(F.col(c) - m).alias(f"_e{i}") for i, c in enumerate(logits)],
    )
    total = sum((F.col(f"_e{i}") for i in range(1, len(logits))), F.col("_e0"))
    step = step.withColumn("_s", total)
    probs = [(F.col(f"_e{i}") / F.col("_s")).alias(f"p{i + 1}") for i in range(len(logits))]
    out = step.select(*[c for c in df.columns if keep], "predicted_label", *probs, (F.lit(1.0) / F.col("_s")).alias("confidence"))
    return out


def probability_map(k: int = 5) -> Column:
    """map<int,double> keyed 1..k from the p1..pk columns (I2 record shape)."""
    return F.map_from_arrays(
        F.array(*[F.lit(i) for i in range(1, k + 1)]), F.array(*[F.col(f"p{i}") for i in range(1, k + 1)])
    )


def score_records(scored: DataFrame, index: str, text: str = "text", k: int = 5, as_map: bool = True) -> DataFrame:
    """Index, preview, text_length, predicted label, description,
    confidence and the class probabilities."""
    cols = [
        F.col(index).alias("index"),
        L.text_preview(text).alias("text"),
        F.length(text).alias("text_length"),
        F.col("predicted_label"),
        L.label_description("predicted_label").alias("label_description"),
        F.col("confidence"),
    ]
    if as_map:
        cols.append(probability_map(k).alias("probabilities"))
    else:
        cols += [F.col(f"p{i}") for i in range(1, k + 1)]
    return scored.select(*cols)


def prediction_summary(scored: DataFrame, k: int = 5, label: str = "predicted_label") -> DataFrame:
    """I4: total, average confidence, count and % per class 1..k (zero-filled),
    one aggregate pass."""
    aggs = [F.count(F.lit(1)).alias("total"), F.avg("confidence").alias("avg_confidence")]
    for c in range(1, k + 1):
        aggs.append(F.count_if(F.col(label) == c).alias(f"n_label_{c}"))
    one = scored.agg(*aggs)
    pct = [F.round(F.try_divide(F.col(f"n_label_{c}") * 100.0, F.col("total")), 6).alias(f"pct_label_{c}") for c in range(1, k + 1)]
    return one.select("total", F.round("avg_confidence", 6).alias("avg_confidence"), *[f"n_label_{c}" for c in range(1, k + 1)], *pct)


def expected_vs_predicted(samples: DataFrame, predictions: DataFrame, index: str = "index") -> DataFrame:
    """Pair each sample's expected difficulty with its prediction by an
    explicit index (equi-join), with the class range and a match flag."""
    lo, hi = L.expected_range("expected_difficulty")
    j = samples.join(predictions, index)
    return j.select(
        index,
        "expected_difficulty",
        "predicted_label",
        lo.alias("expected_low"),
        hi.alias("expected_high"),
        F.col("predicted_label").between(lo, hi).alias("matches"),
    )


def score_texts(model, df: DataFrame, k: int = 5) -> DataFrame:
    """I3 for Spark ML models: ``PipelineModel``/``Model.transform`` runs on
    the executors, batch by batch; the probability vector becomes p1..pK and
    the 0-based prediction a 1-based class."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df)
    probs = vector_to_array(F.col("probability"))
    return out.withColumn("_p", probs).select(
        *df.columns,
        (F.col("prediction").cast("int") + 1).alias("predicted_label"),
        *[F.get(F.col("_p"), i).alias(f"p{i + 1}") for i in range(k)],
        F.array_max("_p").alias("confidence"),
    )


def score_with_external_model(df: DataFrame, text: str, make_predict_fn, batch_size: int = 8, k: int = 5) -> DataFrame:
    """I3 for an external model: ``predict_batch_udf`` loads the model once per
    Python worker and feeds it Arrow batches of ``batch_size`` texts.
    ``make_predict_fn()`` must return ``f(np.ndarray[str]) -> np.ndarray[n, k]``
    of logits.  A null text is scored as an empty one.  Rows stay where they
    are read: scoring adds no shuffle."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, DoubleType

    udf = predict_batch_udf(make_predict_fn, return_type=ArrayType(DoubleType()), batch_size=batch_size)
    names = [f"_z{i}" for i in range(k)]
    z = df.withColumn("_z", udf(F.coalesce(F.col(text), F.lit(""))))
    z = z.select(*df.columns, *[F.get(F.col("_z"), i).alias(c) for i, c in enumerate(names)])
    return softmax_scores(z, names).drop(*names)
