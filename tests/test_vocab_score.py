from annolytics.operators import score as S
from annolytics.operators import vocab as V


def test_encoding_without_a_shuffle(spark):
    texts = ["the cat and the dog", "", None, "unknown words here", "the " * 300, "dog"]
    df = spark.createDataFrame([(i, t, f"k{i}") for i, t in enumerate(texts)] + [(5, "cat cat", "again")], "id long, text string, keep string")
    vocab = spark.createDataFrame([("the", 9, 0), ("cat", 5, 1), ("dog", 2, 2)], "token string, count long, idx int")
    out = V.encode_fixed_length(df, vocab, "id", max_length=6, keep=["keep"])
    got = {r["keep"]: (r["input_ids"], sum(r["attention_mask"])) for r in out.collect()}
    assert got == {
        "k0": ([2, 3, 1, 2, 4, 0], 5), "k1": ([0] * 6, 0), "k2": ([0] * 6, 0), "k3": ([1, 1, 1, 0, 0, 0], 3), "k4": ([2] * 6, 6),
        "k5": ([4, 0, 0, 0, 0, 0], 1), "again": ([3, 3, 0, 0, 0, 0], 2),
    }
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    empty = V.encode_fixed_length(df, vocab.filter("false"), "id", max_length=3)
    assert {tuple(r["input_ids"]) for r in empty.filter("id = 0").collect()} == {(1, 1, 1)}


def test_external_model(spark):
    def load_model():
        import numpy as np

        def predict(texts):
            assert len(texts) <= 8
            first = np.array([ord(t[0]) % 5 if t else 0 for t in texts])
            out = np.zeros((len(texts), 5))
            out[np.arange(len(texts)), first] = 3.0
            return out

        return predict

    df = spark.createDataFrame([(i, chr(97 + i % 26) + "x" if i % 7 else None, "kept") for i in range(100)], "id long, text string, z1 string")
    out = S.score_with_external_model(df, "text", load_model, batch_size=8)
    rows = {r["id"]: r for r in out.collect()}
    assert len(rows) == 100 and rows[1]["z1"] == "kept"
    for i, r in rows.items():
        want = (97 + i % 26) % 5 if i % 7 else 0
        assert r["predicted_label"] == want + 1 and abs(sum(r[f"p{k}"] for k in range(1, 6)) - 1) < 1e-12
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_word_lists_are_parameters(spark):
    from annolytics.functions.text import text_features

    df = spark.createDataFrame([(1, "Foo-ban a.b see 3. unit xfoo (x) foo")], "id long, text string")
    r = text_features(df, legal_suffixes=["oo"], reference_words=["see", "a.b"], reference_units=["unit"]).first()
    assert (r["legal_suffix_count"], r["reference_count"]) == (3, 3)
    none = text_features(df, legal_suffixes=[], reference_words=[], reference_units=[]).first()
    assert (none["legal_suffix_count"], none["reference_count"]) == (0, 0)
