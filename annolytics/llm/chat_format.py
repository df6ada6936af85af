"""Chat formatting with a grammar round trip.

Template (all of it parameters of :class:`Template`):

    conversation := BOS turn*
    turn         := HEAD role BODY text END

A deterministic lexer cuts a rendered conversation at every control string;
the grammar then demands BOS followed by (HEAD, BODY, END) triples with
nothing after END.  Rendering starts unescaped.  A turn whose own parse does
not give back its role and text is escaped; the whole conversation is parsed
once more, and if any turn still differs, all its turns are escaped.  An
escaped text holds no first character of any control string, so the last
form always parses; ``exact`` says that the returned form did.

Everything is DataFrame expressions: one grouping by conversation, whose
partial aggregation happens before the shuffle.

Defined cases: null text or role counts as empty; a null ``conv_id`` is one
conversation of its own; rows of a conversation are ordered by (turn, role,
text) with null turns first, so ties and repeated rows have one fixed order;
other columns of the input are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Control strings; each must begin with ``<`` or ``[``, the characters
    that escaping removes."""

    bos: str = "<s>"
    head: str = "[INST]"
    body: str = "[/INST]"
    end: str = "</s>"

    def __post_init__(self):
        if not all(x[:1] in ("<", "[") for x in self.controls):
            raise ValueError("a control string must begin with < or [")
        if len(set(self.controls)) < 4 or any(a != b and a in b for a in self.controls for b in self.controls):
            raise ValueError("no control string may be part of another")

    @property
    def controls(self) -> tuple[str, str, str, str]:
        return (self.bos, self.head, self.body, self.end)

    @property
    def lexer(self) -> str:
        """One match per control string, with the content that follows it."""
        any_control = "|".join(re.escape(c) for c in self.controls)
        return rf"(?s)(?:{any_control}).*?(?={any_control}|\z)"


#: Escapes, applied in this order and undone in the reverse order.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))


def escape(text: Column) -> Column:
    for raw, safe in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def _after(segment: Column, control: str) -> Column:
    return F.substring(segment, len(control) + 1, 2**31 - 1)


def render_turn(role: Column, text: Column, t: Template) -> Column:
    return F.concat(F.lit(t.head), role, F.lit(t.body), text, F.lit(t.end))


def with_parse(df: DataFrame, source: str, out: str, t: Template) -> DataFrame:
    """Adds ``out``: the turns of the rendered text in ``source`` as
    array<struct<role, text>> with the escapes undone, or null where the
    grammar does not hold."""
    # The segments are a column of their own: an expression inside a lambda
    # would be evaluated again for every element.
    df = df.withColumn("_seg", F.regexp_extract_all(source, F.lit(t.lexer), F.lit(0)))
    n = F.floor((F.size("_seg") - 1) / 3).cast("int")

    def at(i, k):
        return F.get(F.col("_seg"), i * 3 + k)

    index = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    well_formed = (
        (F.size("_seg") == n * 3 + 1)
        & (F.get(F.col("_seg"), F.lit(0)) == t.bos)
        & (F.concat_ws("", "_seg") == F.col(source))
        & F.forall(
            index,
            lambda i: F.startswith(at(i, 1), F.lit(t.head))
            & F.startswith(at(i, 2), F.lit(t.body))
            & (at(i, 3) == t.end),
        )
    )
    turns = F.transform(
        index,
        lambda i: F.struct(
            unescape(_after(at(i, 1), t.head)).alias("role"),
            unescape(_after(at(i, 2), t.body)).alias("text"),
        ),
    )
    return df.withColumn(out, F.when(well_formed, turns)).drop("_seg")


def format_conversations(df: DataFrame, template: Template = Template(), loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, turns (as parsed
    back), escaped (whether anything was), exact, loss_spans.

    ``loss_spans`` are [start, end) code-point spans of ``formatted`` that
    carry loss: the text of every turn whose role is ``loss_role``.
    """
    t = template
    rows = df.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # round 1, turn by turn: escape where the bare form does not come back
    rows = rows.withColumn("_bare", F.concat(F.lit(t.bos), render_turn(F.col("role"), F.col("text"), t)))
    rows = with_parse(rows, "_bare", "_back", t)
    same = F.coalesce(F.col("_back") == F.array(F.struct("role", "text")), F.lit(False))
    rows = rows.select("conv_id", F.struct("turn", "role", "text", (~same).alias("esc")).alias("t"))
    conv = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))

    def rendered(all_escaped: bool) -> Column:
        def one(x):
            hit = F.lit(True) if all_escaped else x["esc"]
            return render_turn(
                F.when(hit, escape(x["role"])).otherwise(x["role"]),
                F.when(hit, escape(x["text"])).otherwise(x["text"]),
                t,
            )

        return F.concat(F.lit(t.bos), F.concat_ws("", F.transform("t", one)))

    conv = conv.withColumn("_source", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))))
    # round 2, the whole conversation; round 3 only where that differs
    conv = with_parse(conv.withColumn("_f1", rendered(False)), "_f1", "_p1", t)
    conv = conv.withColumn("_ok1", F.coalesce(F.col("_p1") == F.col("_source"), F.lit(False)))
    conv = conv.withColumn("formatted", F.when(F.col("_ok1"), F.col("_f1")).otherwise(rendered(True)))
    conv = with_parse(conv, "formatted", "turns", t)
    conv = conv.withColumn("exact", F.coalesce(F.col("turns") == F.col("_source"), F.lit(False)))
    # the mask: spans from the lengths of the segments that were written
    conv = conv.withColumn("_seg", F.regexp_extract_all("formatted", F.lit(t.lexer), F.lit(0)))
    conv = conv.withColumn(
        "_ends",
        F.aggregate(
            "_seg",
            F.array().cast("array<long>"),
            lambda acc, s: F.concat(acc, F.array((F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + F.length(s)).cast("long"))),
        ),
    )
    spans = F.filter(
        F.transform(
            "turns",
            lambda x, i: F.struct(
                (x["role"] == loss_role).alias("on"),
                (F.get(F.col("_ends"), i * 3 + 1) + len(t.body)).alias("start"),
                F.get(F.col("_ends"), i * 3 + 2).alias("end"),
            ),
        ),
        lambda s: s["on"],
    )
    return conv.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        "formatted",
        "turns",
        (F.exists("t", lambda x: x["esc"]) | ~F.col("_ok1")).alias("escaped"),
        "exact",
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """What a trainer reads from formatted rows: adds loss_text (all text
    under the mask, escapes undone, nothing between)."""
    pieces = F.transform(
        "loss_spans",
        lambda s: unescape(F.col("formatted").substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
    )
    return formatted.withColumn("loss_text", F.concat_ws("", pieces))
