"""Large JSON arrays read by byte ranges.

Spark's multi-line JSON source reads a file as one task.  Here a file that
holds one array of objects (or one object) is read by ranges: the text source
cuts it at every ``}``, so its splits end where an object may end.  What a
range begins with (inside a string or not, and at which depth) follows from
the ranges before it, so the text is read twice:

1. Every range tells how it changes the state for both possible beginnings;
   it is one row.  The rows of a file, one a range, are put in order and give
   each range its true beginning.
2. Every range cuts its records.  A record that goes on in the next range is
   put together from its pieces, of which a range has at most two.

A file is judged as the multi-line source does: a record that does not parse,
an unfinished array or anything but commas between records makes the whole
file unreadable.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annolytics.session import checked_broadcast, materialize

_TOKEN = re.compile(r'\\.|["{}\[\]]', re.S)
#: What may stand where no record is open, by place and whether one follows.
_PERMITTED = {
    ("array", "start", True): re.compile(r"\s*\[\s*\Z"),
    ("array", "start", False): re.compile(r"\s*\[\s*\]\s*\Z"),
    ("array", "between", True): re.compile(r"\s*,\s*\Z"),
    ("array", "between", False): re.compile(r"\s*\]\s*\Z"),
    ("array", "end", False): re.compile(r"\s*\Z"),
    ("object", "start", True): re.compile(r"\s*\Z"),
    ("object", "start", False): re.compile(r"\s*\Z"),
    ("object", "between", False): re.compile(r"\s*\Z"),
    ("object", "end", False): re.compile(r"\s*\Z"),
}

WHOLE, CLOSING, MIDDLE, OPEN, BAD = range(5)

_SUMMARY = pa.schema(
    [("path", pa.string()), *((c, pa.int64()) for c in ("block", "size", "bytes", "odd", "outside", "inside", "last_odd", "array"))]
)
_BEGINNING = pa.schema([("path", pa.string()), *((c, pa.int64()) for c in ("block", "odd", "depth", "outer", "open_end", "ends_well"))])
_RECORD = pa.schema([("path", pa.string()), ("block", pa.int64()), ("pos", pa.int64()), ("kind", pa.int64()), ("text", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in schema)


def _pieces(spark: SparkSession, glob: str, at_least: int, base_path: str) -> DataFrame:
    """(path, block, size, id, value): the text between two ``}``."""
    text = spark.read.option("lineSep", "}").option("basePath", base_path).text(glob)
    meta = F.col("_metadata")
    return text.filter(meta["file_size"] >= at_least).select(
        meta["file_path"].alias("path"),
        meta["file_block_start"].alias("block"),
        meta["file_size"].alias("size"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a range: bytes, quotes (parity), change of depth if it begins
    outside or inside a string, the parity before its last ``}``, and whether
    its first character opens an array."""
    key, state = None, None

    def row():
        return pa.RecordBatch.from_pylist([dict(zip(_SUMMARY.names, (*key, *state), strict=True))], schema=_SUMMARY)

    for batch in batches:
        for path, block, size, value in zip(*(batch.column(c).to_pylist() for c in ("path", "block", "size", "value")), strict=True):
            if key != (path, block, size):
                if key:
                    yield row()
                key, state = (path, block, size), [0, 0, 0, 0, 0, int(value.lstrip()[:1] == "[")]
            state[0] += len(value.encode()) + 1
            for token in _TOKEN.findall(value):
                if token == '"':
                    state[1] ^= 1
                elif token in "{[":
                    state[2 + state[1]] += 1
                elif token in "]}":
                    state[2 + state[1]] -= 1
            state[4] = state[1]
            state[2 + state[1]] -= 1
    if key:
        yield row()


def _beginnings(table: pa.Table) -> pa.Table:
    """The true beginning of every range of one file."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    # no "}" follows the last piece if the bytes are one too many
    open_end = sum(r["bytes"] for r in rows) == rows[0]["size"] + 1
    odd, depth, out = 0, 0, []
    for r in rows:
        last = open_end and r is rows[-1]
        out.append({"path": r["path"], "block": r["block"], "odd": odd, "depth": depth, "outer": rows[0]["array"], "open_end": int(last)})
        depth += r["inside"] if odd else r["outside"]
        if last and r["last_odd"] == odd:
            depth += 1
        odd ^= r["odd"]
    return pa.Table.from_pylist([r | {"ends_well": int(odd == 0 and depth == 0)} for r in out], schema=_BEGINNING)


class _Range:
    """Cuts the records of one range, piece by piece."""

    def __init__(self, block: int, odd: int, depth: int, outer: int):
        self.pos, self.odd, self.depth, self.outer = block, odd, depth, outer
        self.open = odd == 1 or depth > outer
        self.own: int | None = None  # where the open record began, if here
        self.text: list[str] = []
        self.place = "start" if block == 0 else "end" if depth < outer else "between"

    def rows(self, piece: str):
        """(pos, kind, text) of the record that ends with this piece."""
        begin = 0
        if not self.open:
            begin = piece.find("{")
            head = piece if begin < 0 else piece[:begin]
            fine = _PERMITTED.get(("array" if self.outer else "object", self.place, begin >= 0))
            if fine is None or not fine.match(head):
                yield self.pos, BAD, head[:100]
            self.depth += head.count("[") - head.count("]")
            self.place = "between" if begin >= 0 else "end"
            if begin < 0:
                return
            self.own, self.open = self.pos + len(head.encode()), True
        self.pos += len(piece.encode())
        self.text.append(piece[begin:])
        for token in _TOKEN.findall(piece, begin):
            if token == '"':
                self.odd ^= 1
            elif not self.odd and token in "{[":
                self.depth += 1
            elif not self.odd and token in "]}":
                self.depth -= 1
        if not self.odd and self.depth <= self.outer:
            yield self.own, CLOSING if self.own is None else WHOLE, "".join(self.text)
            self.text, self.own, self.open = [], None, False

    def rest(self):
        """The record that goes on in the next range."""
        if self.text:
            yield self.own, MIDDLE if self.own is None else OPEN, "".join(self.text)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, cut, waiting = None, None, None
    out: list[dict] = []

    def add(rows):
        out.extend({"path": key[0], "block": key[1], "pos": p, "kind": k, "text": t} for p, k, t in rows)

    def finish():
        if key is not None:
            add(cut.rows(waiting if key[2] else waiting + "}"))
            add(cut.rest())

    columns = ("path", "block", "open_end", "odd", "depth", "outer", "value")
    for batch in batches:
        for path, block, open_end, odd, depth, outer, value in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            if key is None or key[:2] != (path, block):
                finish()
                key, cut = (path, block, open_end), _Range(block, odd, depth, outer)
            else:
                add(cut.rows(waiting + "}"))
            waiting = value
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_RECORD)
            out = []
    finish()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_RECORD)


def json_records(spark: SparkSession, glob: str, at_least: int, base_path: str) -> tuple[DataFrame, DataFrame]:
    """Records of the files of ``at_least`` bytes that match ``glob``:
    (path, pos, text), with positions that grow along a file, and the paths of
    the files whose structure is broken."""
    pieces = _pieces(spark, glob, at_least, base_path)
    ranges = pieces.mapInArrow(_summaries, _ddl(_SUMMARY))
    begins = checked_broadcast(ranges.groupBy("path").applyInArrow(_beginnings, _ddl(_BEGINNING)), "json-ranges", max_rows=200_000)
    # either join leaves the pieces of a range in one partition
    joined = pieces.join(begins, ["path", "block"]).sortWithinPartitions("path", "block", "id")
    cut = materialize(joined.mapInArrow(_records, _ddl(_RECORD)), "json-records")
    whole = cut.filter(F.col("kind") == WHOLE).select("path", "pos", "text")
    along = Window.partitionBy("path").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = cut.filter(F.col("kind").isin(CLOSING, MIDDLE, OPEN)).withColumn("pos", F.last("pos", ignorenulls=True).over(along))
    joined_parts = parts.groupBy("path", "pos").agg(F.array_sort(F.collect_list(F.struct("block", "kind", "text"))).alias("p"))
    joined_parts = joined_parts.select("path", "pos", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"))
    broken = begins.filter("ends_well = 0").select("path").unionByName(cut.filter(F.col("kind") == BAD).select("path")).distinct()
    return whole.unionByName(joined_parts), broken
