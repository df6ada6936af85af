"""Text features against an independent pure-Python reading of the spec."""

import math
import re
import statistics

import pytest

from annolytics.functions import text as T

HU_TEXTS = [
    "A Szolgáltató a jelen ÁSZF 3. pontjában említett díjat havonta számlázza. Az előfizetőnek (ügyfélnek) fizetnie kell!",
    "1. Általános rendelkezések\n2. A szerződés tárgya\na) első pont b) második pont\n\n§ 5. bekezdés szerint, a fenti feltételekkel.",
    'Idézet: "szó" és „másik” valamint "harmadik". Díj: 15% / hó – vagy — kedvezmény [1] (lásd: 4. cikk).',
    "Nem törő szóköz itt. A következő hivatkozott szabályzatként működik; továbbá a felhasználóval, partnerhez és kérésért.",
    "",
    "   \n  ",
    "Egyetlen",
    "Hosszúszóösszetételekkelteli jogszabályszövegértelmezésiszabályzatokról szól ez a mondat igazán.",
]

WS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def expected(text):
    words = text.split()
    parts = [p for p in re.split(r"[.!?]\s+|\n+", text) if p.strip()]
    sl = [len(p.split()) for p in parts] or [0]
    wl = [len(w) for w in words] or [0]
    nw = len(words)

    def per_word(x):
        return x / nw if nw else 0.0

    out = {
        "char_count": len(text),
        "word_count": nw,
        "sentence_count": len(parts) if parts else 1,
        "avg_sentence_length": statistics.fmean(sl),
        "max_sentence_length": max(sl),
        "std_sentence_length": statistics.pstdev(sl) if len(sl) > 1 else 0.0,
        "avg_word_length": statistics.fmean(wl),
        "max_word_length": max(wl),
        "std_word_length": statistics.pstdev(wl) if len(wl) > 1 else 0.0,
        "long_word_ratio": per_word(sum(1 for w in words if len(w) > 10)),
        "very_long_word_ratio": per_word(sum(1 for w in words if len(w) > 15)),
        "comma_count": text.count(","),
        "comma_ratio": per_word(text.count(",")),
        "semicolon_count": text.count(";"),
        "colon_count": text.count(":"),
        "paren_count": text.count("(") + text.count(")"),
        "paren_ratio": per_word(text.count("(") + text.count(")")),
        "bracket_count": text.count("[") + text.count("]"),
        "quote_count": 2 * text.count('"') + text.count("„"),
        "slash_count": text.count("/"),
        "dash_count": sum(text.count(d) for d in "-–—"),
        "numbering_count": len(re.findall(r"\b\d+\.\s|\b[a-z]\)\s", text)),
        "percent_count": text.count("%"),
        "number_ratio": per_word(len(re.findall(r"\d+", text))),
        "legal_suffix_count": len(re.findall("(" + "|".join(T.LEGAL_SUFFIXES) + r")\b", text.lower())),
        "reference_count": len(
            re.findall("(" + "|".join(T.REFERENCE_WORDS) + r"|\d+\.\s*(" + "|".join(T.REFERENCE_UNITS) + "))", text.lower())
        ),
        "uppercase_ratio": (sum(1 for ch in text if ch.isupper()) / len(text)) if text else 0.0,
    }
    out["complexity_score"] = (
        0.3 * out["avg_sentence_length"] + 2 * out["avg_word_length"] + 10 * out["long_word_ratio"]
        + 5 * out["comma_ratio"] + 10 * out["paren_ratio"]
    )
    return out


def test_whitespace_class_matches_python(spark):
    assert {c for c in map(chr, range(0x3001)) if c.isspace()} == set(WS)
    # the Spark token regex splits on exactly Python's white space
    from pyspark.sql import functions as F

    chars = [chr(c) for c in range(1, 0x3001) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, "a" + c + "b") for c in chars], "c string, t string")
    got = df.select("c", F.size(F.regexp_extract_all("t", F.lit(T.TOKEN), 0)).alias("n")).collect()
    bad = [hex(ord(r.c)) for r in got if r.n != len(("a" + r.c + "b").split())]
    assert bad == []


@pytest.fixture(scope="module")
def features(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(HU_TEXTS)], "id int, text string")
    return {r["id"]: r.asDict() for r in T.text_features(df).collect()}


@pytest.mark.parametrize("i", range(len(HU_TEXTS)))
def test_features_match_python(features, i):
    exp = expected(HU_TEXTS[i])
    got = features[i]
    for k in T.ALL_FEATURES:
        assert math.isclose(got[k], exp[k], rel_tol=1e-9, abs_tol=1e-9), (k, got[k], exp[k])


def test_suffixes_and_numbering_hit(features):
    assert features[3]["legal_suffix_count"] >= 3
    assert features[1]["numbering_count"] == 5  # "1." "2." "a)" "b)" "5."
    assert features[2]["quote_count"] == 9  # 4 ASCII quotes counted twice + one low quote


def test_word_tokens(spark):
    df = spark.createDataFrame([("Az ÁSZF-ben: a 12. pont_x és é!",)], "t string")
    got = df.select(T.word_tokens("t").alias("x")).first()["x"]
    exp = [t for t in re.sub(r"[^\w\s]", " ", "Az ÁSZF-ben: a 12. pont_x és é!".lower()).split() if len(t) > 1]
    assert got == exp


def test_words_and_sentence_lengths_are_split_without_a_regex_per_word(spark):
    """Words as ``str.split`` finds them, around every white space; the plan
    matches no token by regex."""
    spaces = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isspace()]
    texts = [f"Ab,{s}{s}c{s}\nd. {s}Efg!{s}hi{s}" for s in spaces] + ["", " ", "\n\n", ".\n.", "a​b"]
    got = T.text_features(spark.createDataFrame([(t,) for t in texts], "text string"), keep_text=True)
    assert "regexp_extract_all(text" not in got.drop("number_ratio", "uppercase_ratio")._jdf.queryExecution().analyzed().toString().split("AS _words")[0]
    for r in got.collect():
        words = r["text"].split()
        parts = [len(p.split()) for p in re.split(r"[.!?]\s+|\n+", r["text"]) if p.strip()]
        assert r["word_count"] == len(words) and r["max_word_length"] == max(map(len, words), default=0)
        assert r["sentence_count"] == max(1, len(parts)) and r["max_sentence_length"] == max(parts, default=0)


def test_features_are_computed_once_a_text(spark, monkeypatch):
    from annolytics.operators import clean as C
    from annolytics.plans import textual as X

    docs = spark.createDataFrame([("one two. Three",), ("one two. Three",), ("four, five",), ("not asked for",), (None,)], "text string")
    rows = spark.createDataFrame([(1, "one two. Three"), (2, "one two. Three"), (3, "four, five"), (4, "one two. Three"), (5, None)], "id long, text string")
    given, features = [], T.text_features
    monkeypatch.setattr(X, "read_table", lambda *a: docs)
    monkeypatch.setattr(X.T, "text_features", lambda df: given.append(df.filter("text is not null").count()) or features(df))
    got = {r["id"]: r for r in X._with_features(spark, "", rows.withColumn("text", C.text_reference())).collect()}
    assert sum(given) == 2
    want = {r["id"]: r for r in features(rows).collect()}
    assert {k: r.asDict() for k, r in got.items()} == {k: r.asDict() for k, r in want.items()}
