import random
from array import array

import numpy as np
import pytest

from annolytics.llm import sentencepiece_codec as S
from annolytics.llm.queries import piece_model


@pytest.fixture(scope="module")
def both():
    import sentencepiece

    return S.codec(piece_model()), sentencepiece.SentencePieceProcessor(model_file=piece_model())


def encode(codec, text):
    out = array("i")
    codec.encode(text, out)
    return list(out)


def texts():
    rnd = random.Random(1)
    letters = list(" ▁  abthe\n\tß日本語😀\x00é") + ["  ", "      ", "the", "<s>", "<0x0A>", "ing", "ation", " ", "é", "\r\n"]
    for _ in range(1500):
        yield "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60)))
    for _ in range(500):
        yield "".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(1, 50)))
    for n in range(1, 70):
        yield " " * n
        yield "a" + " " * n + "the" + " " * n


def test_same_ids_and_text_as_the_library(both):
    codec, library = both
    sample = list(texts())
    for text, ids in zip(sample, library.encode(sample)):
        assert encode(codec, text) == ids, repr(text)
        assert codec.decode(np.array(ids, dtype=np.int64)) == library.decode(ids), repr(text)


def test_decodes_any_ids_like_the_library(both):
    codec, library = both
    rnd = random.Random(2)
    for _ in range(1500):
        ids = [rnd.randint(0, 31_999) if rnd.random() < 0.6 else rnd.randint(0, 258) for _ in range(rnd.randint(0, 12))]
        assert codec.decode(np.array(ids, dtype=np.int64)) == library.decode(ids), ids


def test_table_agrees_with_plain_merging(both):
    codec, _ = both
    for text in list(texts())[:300]:
        for part in codec.parts.findall(codec.prefix + text.replace(" ", S.SPACE)):
            plain = [codec.id_of[p] for p in codec.merge(part)] if all(c in codec.id_of for c in part) else None
            assert plain is None or list(codec.encode_part(part)) == plain


def test_frames(spark, docs_of, both):
    _, library = both
    rows = [(1, None, "en", "s"), (2, "", "en", None), (None, "a  b", "en", "s"), (3, "x\ny", "en", "s"), (3, "x\ny", "en", "s"), (4, "word " * 60_000, "en", "s")]
    docs = docs_of(rows)
    both_ways = S.encode_and_decode(docs, piece_model()).collect()
    assert all(r["ids"] == library.encode(r["text"] or "") and r["decoded"] == library.decode(r["ids"]) for r in both_ways)
    out = S.decode(S.encode(docs, piece_model(), "text", "size"), piece_model(), "size", "kept")
    assert out.columns == [c for c in docs.columns if c not in ("size", "kept")] + ["size", "kept"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        want = library.encode(r["text"] or "")
        assert r["size"] == want and r["kept"] == library.decode(want)
    assert S.encode(docs_of([]), piece_model()).count() == 0
