"""Text features and word tokens as Column expressions.

No Python UDF: every feature is a JVM expression over the text.  Arrays that
several features share (words, word lengths, sentences, sentence lengths)
are projected once per stage; Catalyst does not collapse a projection when
that would duplicate an expensive expression, so each regex runs once per
row.

Character classes mirror Python's ``str`` semantics:
* white space = what ``str.split()`` / ``\\s`` split on (``str.isspace``);
* a word character = letter, number or underscore (``\\w``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------
# White space as Python defines it (str.isspace), as a regex class body.
WS = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORD_CHAR = r"\p{L}\p{N}_"
# Hungarian suffixes counted at the end of a word (legal_suffix_count).
LEGAL_SUFFIXES = ("ség", "ság", "ként", "ról", "ről", "ban", "ben", "nak", "nek",
                  "val", "vel", "hoz", "hez", "höz", "tól", "től", "ig", "ért")
# Reference words counted anywhere (reference_count), and the words that may
# follow a numbered reference ("3. pont").
REFERENCE_WORDS = ("fenti", "lenti", "előző", "következő", "jelen", "említett", "hivatkozott")
REFERENCE_UNITS = ("pont", "bekezdés", "§", "cikk")
# Characters counted by the punctuation features.
QUOTE_DOUBLE = '"'  # counted twice: the source adds the ASCII quote two times
QUOTE_LOW = "„"
DASHES = ("-", "–", "—")
# Weights of the complexity score.
COMPLEXITY_WEIGHTS = {
    "avg_sentence_length": 0.3,
    "avg_word_length": 2.0,
    "long_word_ratio": 10.0,
    "comma_ratio": 5.0,
    "paren_ratio": 10.0,
}
# -----------------------------------------------------------------------------------

# Patterns ask the cheapest question first: most characters are settled by one
# table look-up, before any look-behind or list of words is tried.
TOKEN = f"[\\x21-\\x7E[^{WS}]]+"
# White space but blank and newline.  Where a blank stands for it, tokens are
# found by a split at one character, which needs no regex.
OTHER_SPACE = "(?![ -~])[" + WS.replace(r"\t\n", r"\t").replace(r"-\x1F ", r"-\x1F") + "]"
SENTENCE_SPLIT = "[.!?][ \\n]+|\\n+"
NOT_WORD_BEFORE = f"(?<![{WORD_CHAR}])"
NOT_WORD_AFTER = f"(?![{WORD_CHAR}])"
NUMBERING = f"(?=\\p{{Nd}}){NOT_WORD_BEFORE}\\p{{Nd}}+\\.[{WS}]|(?=[a-z]\\)){NOT_WORD_BEFORE}[a-z]\\)[{WS}]"
DIGIT = r"\p{Nd}"
DIGITS = DIGIT + "+"
UPPER = r"\p{Lu}"
VOCAB_TOKEN = f"[{WORD_CHAR}]+"

LENGTH_FEATURES = (
    "char_count", "word_count", "sentence_count", "avg_sentence_length", "max_sentence_length",
    "std_sentence_length", "avg_word_length", "max_word_length", "std_word_length",
    "long_word_ratio", "very_long_word_ratio",
)
PUNCTUATION_FEATURES = (
    "comma_count", "comma_ratio", "semicolon_count", "colon_count", "paren_count", "paren_ratio",
    "bracket_count", "quote_count", "slash_count", "dash_count", "percent_count",
)
PATTERN_FEATURES = ("numbering_count", "number_ratio", "legal_suffix_count", "reference_count", "uppercase_ratio")
ALL_FEATURES = (
    "char_count", "word_count", "sentence_count", "avg_sentence_length", "max_sentence_length",
    "std_sentence_length", "avg_word_length", "max_word_length", "std_word_length", "long_word_ratio",
    "very_long_word_ratio", "comma_count", "comma_ratio", "semicolon_count", "colon_count", "paren_count",
    "paren_ratio", "bracket_count", "quote_count", "slash_count", "dash_count", "numbering_count",
    "percent_count", "number_ratio", "legal_suffix_count", "reference_count", "uppercase_ratio",
    "complexity_score",
)
KEY_FEATURES = (
    "avg_sentence_length", "avg_word_length", "long_word_ratio", "comma_ratio", "paren_ratio",
    "reference_count", "complexity_score",
)
PLOT_FEATURES = ("avg_sentence_length", "avg_word_length", "long_word_ratio", "comma_ratio", "paren_ratio", "complexity_score")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def count_char(text, ch: str) -> Column:
    """Occurrences of one character."""
    t = _c(text)
    return (F.length(t) - F.length(F.replace(t, F.lit(ch), F.lit("")))).cast("int")


def _tokens(blanks) -> Column:
    """``TOKEN`` in a text whose only white space is blanks."""
    return F.array_remove(F.split(blanks, " ", -1), "")


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x.cast("double"))


def _ratio0(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


def _any_of(words: Sequence[str]) -> str:
    """Pattern of the words, taken literally; no words match nothing."""
    return "|".join(re.escape(w) for w in words) or "(?!)"


def _beginning(words: Sequence[str], others: str = "") -> str:
    """Look-ahead for the first character of any of the words."""
    if not all(words):
        return ""
    first = "".join(sorted({re.escape(w[0]) for w in words})) + others
    return f"(?=[{first}])" if first else ""


def suffix_pattern(suffixes: Sequence[str] = LEGAL_SUFFIXES) -> str:
    """one of the suffixes at the end of a word."""
    return f"{_beginning(suffixes)}(?:{_any_of(suffixes)}){NOT_WORD_AFTER}"


def reference_pattern(words: Sequence[str] = REFERENCE_WORDS, units: Sequence[str] = REFERENCE_UNITS) -> str:
    """one of the words, or a numbered unit ("3. pont")."""
    return f"{_beginning(words, DIGIT)}(?:{_any_of(words)}|\\p{{Nd}}+\\.[{WS}]*(?:{_any_of(units)}))"


def text_features(
    df: DataFrame,
    text: str = "text",
    keep_text: bool = False,
    legal_suffixes: Sequence[str] = LEGAL_SUFFIXES,
    reference_words: Sequence[str] = REFERENCE_WORDS,
    reference_units: Sequence[str] = REFERENCE_UNITS,
) -> DataFrame:
    """Adds the 28 features of the source's ``extract_features`` (F1-F28) to
    every column of ``df``; the text itself is dropped unless ``keep_text``.
    The word lists of F25 and F26 are compared with the lower-cased text."""
    keep_cols = list(df.columns)
    t = F.col(text)
    s0 = df.select(*keep_cols, F.regexp_replace(t, OTHER_SPACE, " ").alias("_blanks"))
    s1 = s0.select(
        *keep_cols,
        _tokens(F.replace(F.col("_blanks"), F.lit("\n"), F.lit(" "))).alias("_words"),
        # no sentence holds a newline
        F.transform(F.split("_blanks", SENTENCE_SPLIT, -1), lambda s: F.size(_tokens(s))).alias("_counts"),
        F.lower(t).alias("_lower"),
    )
    s2 = s1.select(
        *keep_cols,
        "_lower",
        F.size("_words").alias("word_count"),
        F.transform("_words", lambda w: F.length(w)).alias("_wl"),
        F.filter("_counts", lambda n: n > 0).alias("_sl"),
    )
    s3 = s2.select(
        *keep_cols,
        "_lower",
        "word_count",
        "_wl",
        "_sl",
        F.size("_sl").alias("_ns"),
        _ratio0(_sum(F.col("_sl")), F.size("_sl")).alias("avg_sentence_length"),
        _ratio0(_sum(F.col("_wl")), F.size("_wl")).alias("avg_word_length"),
    )

    def pop_std(arr: str, mean: str) -> Column:
        n = F.size(arr)
        ss = F.aggregate(F.col(arr), F.lit(0.0), lambda a, x: a + (x - F.col(mean)) * (x - F.col(mean)))
        return F.when(n > 1, F.sqrt(ss / n)).otherwise(F.lit(0.0))

    wc = F.col("word_count")
    paren = count_char(t, "(") + count_char(t, ")")
    s4 = s3.select(
        *keep_cols,
        F.length(t).alias("char_count"),
        "word_count",
        F.greatest(F.lit(1), F.col("_ns")).alias("sentence_count"),
        "avg_sentence_length",
        F.coalesce(F.array_max("_sl"), F.lit(0)).cast("int").alias("max_sentence_length"),
        pop_std("_sl", "avg_sentence_length").alias("std_sentence_length"),
        "avg_word_length",
        F.coalesce(F.array_max("_wl"), F.lit(0)).cast("int").alias("max_word_length"),
        pop_std("_wl", "avg_word_length").alias("std_word_length"),
        _ratio0(F.size(F.filter("_wl", lambda x: x > 10)), wc).alias("long_word_ratio"),
        _ratio0(F.size(F.filter("_wl", lambda x: x > 15)), wc).alias("very_long_word_ratio"),
        count_char(t, ",").alias("comma_count"),
        _ratio0(count_char(t, ","), wc).alias("comma_ratio"),
        count_char(t, ";").alias("semicolon_count"),
        count_char(t, ":").alias("colon_count"),
        paren.cast("int").alias("paren_count"),
        _ratio0(paren, wc).alias("paren_ratio"),
        (count_char(t, "[") + count_char(t, "]")).cast("int").alias("bracket_count"),
        (2 * count_char(t, QUOTE_DOUBLE) + count_char(t, QUOTE_LOW)).cast("int").alias("quote_count"),
        count_char(t, "/").alias("slash_count"),
        sum((count_char(t, d) for d in DASHES[1:]), count_char(t, DASHES[0])).cast("int").alias("dash_count"),
        F.regexp_count(t, F.lit(NUMBERING)).alias("numbering_count"),
        count_char(t, "%").alias("percent_count"),
        _ratio0(F.regexp_count(t, F.lit(DIGITS)), wc).alias("number_ratio"),
        F.regexp_count("_lower", F.lit(suffix_pattern(legal_suffixes))).alias("legal_suffix_count"),
        F.regexp_count("_lower", F.lit(reference_pattern(reference_words, reference_units))).alias("reference_count"),
        _ratio0(F.regexp_count(t, F.lit(UPPER)), F.length(t)).alias("uppercase_ratio"),
    )
    score = sum((F.col(k) * w for k, w in COMPLEXITY_WEIGHTS.items()), F.lit(0.0))
    out = s4.withColumn("complexity_score", score)
    return out if keep_text else out.drop(text)


def word_tokens(text) -> Column:
    """V1: lower-case, runs of word characters, tokens longer than one
    character (equivalent to blanking non-word characters and splitting)."""
    toks = F.regexp_extract_all(F.lower(_c(text)), F.lit(VOCAB_TOKEN), 0)
    return F.filter(toks, lambda x: F.length(x) > 1)
