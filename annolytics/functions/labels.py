"""Column expressions for labels, previews and class mapping (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the source annotation scheme) -----------------
# Readability classes 1..5 and their descriptions, in class order.
LABEL_DESCRIPTIONS = {
    1: "Nagyon nehezen érthető (Very difficult)",
    2: "Nehezen érthető (Difficult)",
    3: "Többé-kevésbé érthető (Somewhat understandable)",
    4: "Érthető (Understandable)",
    5: "Könnyen érthető (Easily understandable)",
}
# Expected difficulty of a sample text -> the classes that count as a match.
EXPECTED_DIFFICULTY = {
    "easy": (4, 5),
    "medium": (3,),
    "hard": (2,),
    "very_hard": (1,),
}
NUM_CLASSES = 5
PREVIEW_CHARS = 100
# -----------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_label(label_text) -> Column:
    """Leading decimal digits of the label text as int; no digits -> NULL.

    No range check, like the source.  ``try_cast`` keeps absurdly long digit
    runs NULL instead of failing the job under ANSI mode.
    """
    digits = F.regexp_extract(_c(label_text), r"^([0-9]+)", 1)
    return F.nullif(digits, F.lit("")).try_cast("int")


def text_preview(text, n: int = PREVIEW_CHARS) -> Column:
    """First ``n`` code points, with ``...`` only when the text is longer (P10)."""
    t = _c(text)
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n), F.lit("..."))).otherwise(t)


def label_description(label) -> Column:
    """Class -> description via a literal map (P11); unknown class -> NULL."""
    kv = []
    for k, v in LABEL_DESCRIPTIONS.items():
        kv += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*kv), _c(label).cast("int"))


def score_to_class(score, lo: int = 1, hi: int = NUM_CLASSES) -> Column:
    """Continuous score -> class: round half to even, clip to [lo, hi]."""
    return F.least(F.lit(hi), F.greatest(F.lit(lo), F.rint(_c(score)))).cast("int")


def expected_range(difficulty) -> tuple[Column, Column]:
    """(low, high) class bounds of an expected difficulty."""
    d = _c(difficulty)
    lo = F.lit(None).cast("int")
    hi = F.lit(None).cast("int")
    for name, classes in EXPECTED_DIFFICULTY.items():
        lo = F.when(d == name, F.lit(min(classes))).otherwise(lo)
        hi = F.when(d == name, F.lit(max(classes))).otherwise(hi)
    return lo, hi
