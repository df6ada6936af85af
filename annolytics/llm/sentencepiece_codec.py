"""SentencePiece (merge-type) encoding and decoding with a prefix table.

The last token of the encoding of a text's prefix is unique.  So one pass
over a text fills a table: for every prefix end, the automaton yields the
pieces that end there, and the one piece whose predecessor (the table's entry
at the piece's start) is compatible with it is the prefix's last token.  Two
pieces are compatible if merging their joined text gives exactly the two
again.  The ids are then read backwards from the table.  Work is linear in
the text, whatever its length.

No piece of a supported model holds a space symbol after another character,
so a text is cut before each run of space symbols and the parts are encoded
apart; recent parts are remembered per worker, in bounded memory.

Supported models: type BPE, no normalisation rules, byte fallback.  Others
are refused.  The model's path is a parameter.

Defined cases: null text gives no ids, and no ids decode to the empty text;
characters without a piece become byte pieces; invalid byte sequences decode
to U+FFFD per byte; control ids decode to nothing; other columns pass
through, and one named like the output is replaced.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolytics.llm.common import small_batches

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Parts remembered per worker, and the longest part worth remembering.
REMEMBERED, REMEMBERED_CHARS = 200_000, 48
#: Pair tests remembered per worker.
PAIRS_REMEMBERED = 250_000
ROWS_AT_ONCE = 256


class Codec:
    """Prefix-table encoder and decoder of one model file."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with byte fallback and leading space symbols are supported")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models without normalisation rules are supported")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.pieces = [p.piece for p in model.pieces]
        self.types = [p.type for p in model.pieces]
        if set(self.types) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined and unused pieces are not supported")
        normal = [i for i, t in enumerate(self.types) if t == NORMAL]
        if any(SPACE in self.pieces[i].lstrip(SPACE) for i in normal):
            raise ValueError("a piece holds a space symbol inside")
        self.score = {self.pieces[i]: model.pieces[i].score for i in normal}
        self.id_of = {self.pieces[i]: i for i in normal}
        self.length = [len(p) for p in self.pieces]
        self.byte_id = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.types[i] == BYTE}
        self.is_byte = np.array([t == BYTE for t in self.types])
        self.surface = [
            p.replace(SPACE, " ") if t == NORMAL else " ⁇ " if t == UNKNOWN else "" for p, t in zip(self.pieces, self.types)
        ]
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.automaton = ahocorasick.Automaton()
        for i in normal:
            self.automaton.add_word(self.pieces[i], i)
        self.automaton.make_automaton()
        # a line break that no piece holds is a part by itself
        alone = "" if any("\n" in p for p in self.score) else "\n"
        self.parts = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|{alone}" if alone else ""))
        self.pair_ok: dict[int, bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}

    def merge(self, text: str) -> list[str]:
        """Plain merging, best score first, leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best = max(
                ((self.score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score), default=None
            )
            if best is None:
                break
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two pieces stay as they are side by side; ``left`` is
        -1 where the right one starts a text or follows unknown text."""
        key = left * len(self.pieces) + right
        ok = self.pair_ok.get(key)
        if ok is None:
            if len(self.pair_ok) >= PAIRS_REMEMBERED:
                self.pair_ok.clear()
            want = [self.pieces[right]] if left < 0 else [self.pieces[left], self.pieces[right]]
            ok = self.pair_ok[key] = self.merge("".join(want)) == want
        return ok

    def encode_part(self, part: str) -> tuple[int, ...]:
        last = [-2] * (len(part) + 1)  # -2: no piece ends here, -1: start
        last[0] = -1
        length, pair_ok, n_pieces = self.length, self.pair_ok, len(self.pieces)
        for end, piece in self.automaton.iter(part):
            end += 1
            if last[end] == -2:
                before = last[end - length[piece]]
                if before < 0:
                    before = -1
                ok = pair_ok.get(before * n_pieces + piece)
                if ok if ok is not None else self.compatible(before, piece):
                    last[end] = piece
        ids, end = [], len(part)
        while end:
            piece = last[end]
            if piece >= 0:
                ids.append(piece)
                end -= length[piece]
            else:  # a character without a piece
                ids.extend(self.byte_id[b] for b in reversed(part[end - 1].encode("utf-8", "surrogatepass")))
                end -= 1
        ids.reverse()
        return tuple(ids)

    def encode(self, text: str | None, out: array) -> int:
        """Appends the ids of a text; returns their number."""
        if not text:
            return 0
        known, n = self.known, len(out)
        for part in self.parts.findall(self.prefix + text.replace(" ", SPACE)):
            ids = known.get(part)
            if ids is None:
                ids = self.encode_part(part)
                if len(part) <= REMEMBERED_CHARS:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[part] = ids
            out.extend(ids)
        return len(out) - n

    def decode(self, ids: np.ndarray) -> str:
        """Text of an id sequence."""
        if not len(ids):
            return ""
        where = np.flatnonzero(self.is_byte[ids])
        surface, values = self.surface, ids.tolist()
        if not len(where):
            text = "".join([surface[i] for i in values])
        else:
            # runs of byte ids are decoded together
            cuts = np.flatnonzero(np.diff(where) > 1) + 1
            out, at = [], 0
            for run in np.split(where, cuts):
                a, b = int(run[0]), int(run[-1]) + 1
                out.extend(surface[i] for i in values[at:a])
                out.append(bytes(self.byte_of[i] for i in values[a:b]).decode("utf-8", "sp_each_byte"))
                at = b
            out.extend(surface[i] for i in values[at:])
            text = "".join(out)
        if self.prefix:
            # one leading space symbol belongs to the prefix
            first = next((i for i in values if self.types[i] != CONTROL), None)
            if first is not None and self.pieces[first].startswith(SPACE):
                text = text[1:]
        return text


def _each_byte(error):
    return "�", error.start + 1


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    import codecs

    codecs.register_error("sp_each_byte", _each_byte)
    return Codec(path)


def _slices(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def _ids_of(texts: pa.Array, model: str) -> pa.ListArray:
    c, flat, offsets = codec(model), array("i"), [0]
    for text in texts.to_pylist():
        c.encode(text, flat)
        offsets.append(len(flat))
    values = pa.array(np.frombuffer(flat, dtype=np.int32)) if len(flat) else pa.array([], pa.int32())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _text_of(ids: pa.ListArray, model: str) -> pa.Array:
    c = codec(model)
    values, offsets = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    null = ids.is_null().to_numpy(zero_copy_only=False)
    return pa.array(
        ["" if null[i] else c.decode(values[offsets[i] : offsets[i + 1]].astype(np.int64)) for i in range(len(ids))], pa.string()
    )


def _map(df: DataFrame, column: str, new: list[tuple[str, T.DataType]], convert) -> DataFrame:
    """``df`` with the ``new`` columns, made from ``column`` in one pass."""
    small_batches(df.sparkSession)
    names = [n for n, _ in new]
    kept = [f for f in df.schema.fields if f.name not in names]
    order = [f.name for f in kept]

    def run(batches):
        for b in _slices(batches):
            made = convert(b.column(len(order)))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(order)], *made], names=[*order, *names])

    schema = T.StructType(kept + [T.StructField(n, t) for n, t in new])
    source = F.col(f"`{column}`").alias("_codec_input")
    return df.select(*[f"`{c}`" for c in order], source).mapInArrow(run, schema)


IDS = T.ArrayType(T.IntegerType())


def encode(df: DataFrame, model: str, column: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with ``out`` (array<int>): the ids of ``column``."""
    return _map(df, column, [(out, IDS)], lambda texts: [_ids_of(texts, model)])


def decode(df: DataFrame, model: str, column: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out`` (string): the text of the ids in ``column``."""
    return _map(df, column, [(out, T.StringType())], lambda ids: [_text_of(ids, model)])


def encode_and_decode(df: DataFrame, model: str, column: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Both in one pass: the ids of ``column`` and the text decoded from
    them.  One worker per task then holds the model and its memory of parts."""

    def convert(texts):
        coded = _ids_of(texts, model)
        return [coded, _text_of(coded, model)]

    return _map(df, column, [(ids, IDS), (decoded, T.StringType())], convert)
