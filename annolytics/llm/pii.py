"""Surrogates for personal data.

Entities (e-mail addresses, phone numbers, IPv4 and IPv6 addresses, bank
account numbers (IBAN) and payment cards with valid check digits, social
security numbers, access keys, passwords after a keyword, and names) are found
by patterns.  A name is found after a title, or as a listed given name before
a capitalised word; every further mention of its parts in the same document
is the same entity.  Each entity is replaced by a keyed surrogate of its own
type:

* The letters and digits that identify an entity go through a keyed
  permutation of all strings of the same shape (a Feistel network over their
  mixed-radix halves, rounds from HMAC-SHA256).  Digits stay digits, letters
  keep their case and script, separators, prefixes, domains of documentation
  and the check digits of cards and accounts stay valid, address parts stay in
  range.  A permutation gives different entities of one shape different
  surrogates.
* Given names become names of their script and gender (the list that holds
  the name decides, else the title): one of the list first, and where another
  name has claimed it, one put together from keyed syllables.  Surnames are
  permuted letter by letter.  Each name part is one entity whatever its place,
  so a surname alone and in a full name get the same surrogate; a part that is
  a given name in some mention of the corpus is one in all.
* Coreference: the key is a canonical form (lower case for e-mail, digits
  only for numbers), so every mention in every document agrees.

The collision check covers the whole corpus.  Distinct entities form a table;
a surrogate that equals any real entity of its type, or that two entities
share (lists are small, permutations of different shapes may meet), sends
all but one of its claimants to their next attempt, until none is left; a
round looks only at the new claims, against those settled before.  Only
entities beyond attempt 0, or of another kind than the mention shows, are
exceptions; documents that mention one carry it, the others need nothing but
the key.

Defined cases: null text stays null and empty text empty; a document without
entities is returned unchanged; rows with one doc_id share its exceptions; a
null doc_id is matched to exceptions by null-safe equality; all other columns
pass through; n_chars, where present, is the length of the new text.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolytics.llm.common import prefixed, restored, small_batches
from annolytics.session import materialize

#: Given names by script and gender (fixed values).
GIVEN = {
    ("LATIN", "f"): "Ada Alice Anna Carla Clara Diana Elena Emma Eva Flora Greta Hanna Ida Irene Julia Laura Lea Lina Lucia Maria Marta Nora Olga Paula Rosa Sara Sofia Tina Vera Zoe".split(),
    ("LATIN", "m"): "Adam Alan Anton Bruno Carl David Emil Erik Felix Frank Georg Hans Hugo Ivan Jakob Jan Karl Leo Louis Lukas Marco Martin Max Oscar Pablo Paul Peter Simon Thomas Victor".split(),
    ("CYRILLIC", "f"): "Анна Вера Галина Дарья Елена Ирина Лидия Мария Нина Ольга Раиса Софья Тамара Юлия".split(),
    ("CYRILLIC", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Олег Павел Роман Юрий".split(),
}
GENDER = {n.lower(): g for (_, g), names in GIVEN.items() for n in names}
TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra|Господин|Госпожа"
_NAMES = "|".join(n for names in GIVEN.values() for n in names)

#: Patterns by type, tried together, the first of the list at each place.
#: The group named v is what is replaced; the rest is context.
PATTERNS = (
    ("email", r"(?P<email>[A-Za-z0-9][A-Za-z0-9._%+\-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9\-]{0,62}\.)+[A-Za-z]{2,24})"),
    ("key", r"(?<![A-Za-z0-9])(?P<key>(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    (
        "secret",
        # any case, bare or quoted; a closed quotation may hold commas
        r"(?=[PpSsTtAa])(?i:password|passwd|pwd|secret|token|api_key|apikey)[\"']?\s?[=:]\s?(?P<quote>[\"'])?"
        r"(?P<secret>(?(quote)[^\s\"']{6,}(?=(?P=quote))|(?!))|[^\s,;\"']{6,})",
    ),
    ("iban", r"(?<![A-Za-z0-9])(?P<iban>[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?))(?![A-Za-z0-9])"),
    ("ipv6", r"(?<![\w:.])(?P<ipv6>(?=[0-9A-Fa-f:]*\d)(?:[0-9A-Fa-f]{1,4}:){1,7}(?:(?::[0-9A-Fa-f]{1,4}){1,6}|[0-9A-Fa-f]{1,4}|:))(?![\w:]|\.\d)"),
    ("ip", r"(?<![\d.])(?P<ip>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?![\d]|\.\d)"),
    ("ssn", r"(?<![\d\-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\d\-])"),
    ("phone", r"(?<![\w+])(?P<phone>\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}|\(\d{3}\)[ .\-]?\d{3}[ .\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4})(?![\w\-])"),
    ("card", r"(?<![\d\-])(?P<card>\d(?:[ \-]?\d){12,18})(?![\d\-])"),
    (
        "name",
        rf"(?<!\w)(?=[A-ZА-Я])(?:(?P<title>{TITLES})\.?[ \t]|(?=(?:{_NAMES})[ \t]))"
        r"(?P<name>[^\W\d_][\w'’\-]*(?:[ \t][^\W\d_][\w'’\-]*)?)",
    ),
)
ENTITY = re.compile("|".join(p for _, p in PATTERNS))
#: Digits of an international phone number (E.164).
MAX_PHONE = 15
#: Numbers that do not continue a phone number: addresses, phones and social
#: security numbers; and years.
NUMBER = re.compile(
    r"(?:\d{1,3}\.){3}\d{1,3}(?!\d)|\d{3}[.\-]\d{3}[.\-]\d{4}(?!\d)|\d{3}-\d{2}-\d{4}(?!\d)"
)
YEAR = re.compile(r"(?:19|20)\d\d(?!\d)")
#: Usual groupings of cards, tried where the longest run of digits is no card
#: because another number stands before or after it.
CARDS = [
    re.compile(rf"(?P<card>{p})(?![\d\-])")
    for p in (r"\d{4}(?:[ \-]\d{4}){3}[ \-]\d{3}", r"\d{4}(?:[ \-]\d{4}){3}", r"\d{4}(?:[ \-]\d{4}){2}[ \-]\d{1,7}", r"\d{4}[ \-]\d{6}[ \-]\d{4,5}", r"\d{8}[ \-]\d{8}", r"\d{13,19}")
]
#: JVM-side test that a text may hold any entity at all: every text with an
#: entity passes.  Unassigned characters may be digits of a later Unicode.
MAYBE = rf"[\p{{Nd}}\p{{Cn}}@=:]|gh[pousr]_|(?=[A-ZА-Я])(?:AKIA|ASIA|(?:{TITLES})\.?[ \t]|(?:{_NAMES})[ \t])"
FEMALE = {"Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа"}

#: Attempt from which surrogates may be longer than the entity.
WIDEN_AT = 8
#: Letters and digits that one permutation takes at most: a round's 256 bits
#: must reach every symbol of a half.
PIECE = 64
#: Syllables and endings of made-up given names, by script and gender.
SYLLABLES = {
    "LATIN": [c + v for c in "b d f g k l m n p r s t v z".split() for v in "aeio"],
    "CYRILLIC": [c + v for c in "б в г д з к л м н п р с т ф".split() for v in "аеио"],
}
ENDINGS = {("LATIN", "f"): "na", ("LATIN", "m"): "n", ("CYRILLIC", "f"): "на", ("CYRILLIC", "m"): "н"}


def luhn(digits: str) -> int:
    """Check digit that makes ``digits`` + it valid."""
    total = sum(d if i % 2 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
    return -total % 10


def canonical(kind: str, value: str) -> str:
    """One form for all spellings of an entity, digits of any script as 0-9."""
    if kind in ("card", "phone", "ssn", "ip"):
        value = re.sub(r"\d", lambda m: str(int(m.group())), value)
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "ipv6":
        return str(ipaddress.IPv6Address(value))
    if kind in ("card", "phone", "ssn"):
        digits = re.sub(r"\D", "", value)
        return digits[-10:] if kind == "phone" and len(digits) > 10 else digits
    return value.lower() if kind in ("email", "ip") or kind.startswith("name") else value


def iban_check(country: str, account: str) -> str:
    """The two check digits that make country + check + account valid."""
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def is_ipv6(value: str) -> bool:
    """Whether it is an address with at least three written groups."""
    if len([g for g in value.split(":") if g]) < 3:
        return False
    try:
        ipaddress.IPv6Address(value)
    except ValueError:
        return False
    return True


def card_at(text: str, start: int, run: re.Match | None = None) -> re.Match | None:
    """The card that starts there: the whole ``run`` of 13 to 19 digits,
    unless it ends inside an address or decimal, or else a usual grouping."""
    tries = [c for p in CARDS if (c := p.match(text, start))]
    if run:
        tries.insert(len(tries) if re.match(r"\.\d", text[run.end() : run.end() + 2]) else 0, run)
    for c in tries:
        digits = re.sub(r"\D", "", c.group())
        if luhn(digits[:-1]) == int(digits[-1]):
            return c
    return None


def phone_end(text: str, start: int, end: int) -> int | None:
    """Where the international number found there ends: after 15 digits at
    most, and before a number of its own; None if it is no phone number."""
    n, to = 0, start
    for run in re.finditer(r"\d+", text[start:end]):
        at = start + run.start()
        if n >= 7 and text[at - 1] == " ":
            whole = n == 11 and text[start + 1] == "1"
            if whole or NUMBER.match(text, at) or (n >= 10 and (YEAR.match(text, at) or card_at(text, at))):
                return to
        n += len(run.group())
        if n > MAX_PHONE:
            return to if n - len(run.group()) >= 7 else None
        to = start + run.end()
    return end


def _by_pattern(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Entities that show themselves by their form or by what stands before."""
    to = run = 0
    while m := ENTITY.search(text, to):
        kind = m.lastgroup if m.lastgroup != "title" else "name"
        if kind == "card":
            card = card_at(text, m.start(), m if m.start() >= run else None)
            if card is None:
                # a card may begin at a later number of the same run
                to, run = m.start() + 1, max(run, m.end())
                continue
            m = card
        elif kind == "iban":
            end = next((e for e in range(m.end(), m.start() + 14, -1) if _iban_ends(text, m.start(), e, m.end())), None)
            if end is None:
                to = m.start() + 1
                continue
            to = end
            yield m.start(), end, kind, text[m.start() : end]
            continue
        elif kind == "ipv6" and not is_ipv6(m.group()):
            to = m.start() + 1
            continue
        elif kind == "phone" and m.group()[0] == "+":
            end = phone_end(text, m.start(), m.end())
            if end is None:
                to = m.start() + 1
                continue
            to = end
            yield m.start(), end, kind, text[m.start() : end]
            continue
        to = m.end()
        value, at = m.group(kind), m.start(kind)
        if kind != "name":
            yield at, at + len(value), kind, value
            continue
        title = m.group("title")
        parts = [p for p in re.finditer(r"\S+", value) if p.group()[0].isupper()]
        if not parts or parts[0].start() or (title is None and len(parts) < 2):
            # a title before a word in lower case, or a listed name alone
            to = m.start() + len(value.split()[0]) if title is None else to
            continue
        if len(parts) < 2 or parts[1].start() == 0:
            to = at + parts[-1].end()
        for i, p in enumerate(parts):
            gender = GENDER.get(p.group().lower())
            if gender is None and len(parts) > 1 and i == 0:
                gender = {None: "n", "Dr": "n", "Prof": "n"}.get(title, "f" if title in FEMALE else "m")
            listed = gender is not None and (i == 0 or len(parts) == 1)
            yield at + p.start(), at + p.end(), f"name-{gender}" if listed else "name-s", p.group()


def _iban_ends(text: str, start: int, end: int, longest: int) -> bool:
    """Whether a valid account number ends at ``end``: at the whole match, or
    before a blank in it."""
    if end != longest and text[end] != " ":
        return False
    value = text[start:end].replace(" ", "")
    return 15 <= len(value) <= 34 and iban_check(value[:2], value[4:]) == value[2:4]


def entities(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, type, value) of every entity of a text, in order.  Names
    found by title or list are found wherever they stand in the text; a part
    that is a given name once is one everywhere."""
    found = list(_by_pattern(text))
    names: dict[str, str] = {}
    for _, _, kind, value in found:
        if kind.startswith("name"):
            names[value] = min(names.get(value, kind), kind)  # name-f, -m, -n before name-s
    if not names:
        yield from found
        return
    # a mention may be written in capitals
    spelled_out = names | {v.upper(): k for v, k in names.items() if len(v) > 2}
    mention = re.compile(r"(?<![\w'’])(?:" + "|".join(map(re.escape, sorted(spelled_out, key=len, reverse=True))) + r")(?!\w)")
    at = 0
    for start, end, kind, value in [*found, (len(text), len(text), "", "")]:
        for m in mention.finditer(text, at, start):
            yield m.start(), m.end(), spelled_out[m.group()], m.group()
        if kind:
            yield start, end, names.get(value, kind), value
        at = end


# --- the keyed permutation ---------------------------------------------------

_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_CYR_LOWER = "абвгдежзийклмнопрстуфхцчшщъыьэюя"
_ALPHABETS = (_DIGIT, _LOWER, _UPPER, _CYR_LOWER, _CYR_LOWER.upper())
_CLASS = {c: a for a in _ALPHABETS for c in a}


def _number(key: bytes, *what: object) -> int:
    return int.from_bytes(hmac.new(key, "\x1f".join(map(str, what)).encode(), hashlib.sha256).digest(), "big")


def permute(symbols: list[int], radices: list[int], key: bytes, tweak: str, rounds: int = 8) -> list[int]:
    """Keyed permutation of all symbol strings with these radices."""
    if len(symbols) < 2:
        return [(s + _number(key, tweak, "one")) % r for s, r in zip(symbols, radices)]
    half = len(symbols) // 2
    sizes, values = [1, 1], [0, 0]
    for i, (s, r) in enumerate(zip(symbols, radices)):
        side = i >= half
        sizes[side] *= r
        values[side] = values[side] * r + s
    for k in range(rounds):
        side = k % 2
        values[side] = (values[side] + _number(key, tweak, k, sizes, values[1 - side])) % sizes[side]
    out = []
    for side, part in ((1, radices[half:]), (0, radices[:half])):
        v = values[side]
        for r in reversed(part):
            v, s = divmod(v, r)
            out.append(s)
    return out[::-1]


def permute_text(text: str, key: bytes, tweak: str) -> str:
    """Letters and digits permuted within their class, the rest in place.
    Letters of other scripts move by a keyed offset inside their block of
    cased letters.  A long text goes in pieces, each keyed by those before it."""
    out, chain = list(text), tweak
    everything = [i for i, c in enumerate(text) if c in _CLASS]
    for first in range(0, len(everything), PIECE):
        places = everything[first : first + PIECE]
        moved = permute([_CLASS[text[i]].index(text[i]) for i in places], [len(_CLASS[text[i]]) for i in places], key, chain)
        for i, s in zip(places, moved):
            out[i] = _CLASS[text[i]][s]
        chain = f"{tweak}/{_number(key, chain, *(text[i] for i in places)):x}"
    return "".join(out)


def surrogate(kind: str, entity: str, key: bytes, attempt: int = 0) -> str:
    """Surrogate of a canonical entity, in canonical form."""
    tweak = f"{kind}/{attempt}"
    if attempt >= WIDEN_AT:
        # so many claimants that the shape may be used up: a larger one
        if kind == "ip":
            entity = ".".join("1" if x in ("0", "255") else x for x in entity.split("."))
        elif kind in ("email", "secret", "key") or kind.startswith("name"):
            at = entity.rfind("@") if kind == "email" else len(entity)
            entity = entity[:at] + "a" * (attempt - WIDEN_AT + 4) + entity[at:]
    if kind == "email":
        local, _, domain = entity.rpartition("@")
        return permute_text(local, key, tweak + "/" + domain) + "@" + domain
    if kind == "ip":
        octets = [int(x) for x in entity.split(".")]
        # 1..254 are permuted; 0 and 255 have a meaning of their own
        inner = [i for i, o in enumerate(octets) if 0 < o < 255]
        for i, s in zip(inner, permute([octets[i] - 1 for i in inner], [254] * len(inner), key, tweak)):
            octets[i] = s + 1
        return ".".join(map(str, octets))
    if kind == "ipv6":
        groups = [int(g, 16) for g in ipaddress.IPv6Address(entity).exploded.split(":")]
        # zero groups stay, so that the address keeps its short form
        inner = [i for i, g in enumerate(groups) if g]
        for i, s in zip(inner, permute([groups[i] - 1 for i in inner], [65535] * len(inner), key, tweak)):
            groups[i] = s + 1
        return str(ipaddress.IPv6Address(":".join(f"{g:x}" for g in groups)))
    if kind == "iban":
        account = permute_text(entity[4:], key, tweak)
        return entity[:2] + iban_check(entity[:2], account) + account
    if kind == "card":
        # the issuer's first digit stays, the last digit checks the rest
        body = entity[0] + permute_text(entity[1:-1], key, tweak)
        return body + str(luhn(body))
    if kind == "key":
        head = 4
        return entity[:head] + permute_text(entity[head:], key, tweak)
    if kind in ("name-f", "name-m"):
        script = unicodedata.name(entity[0], "LATIN").split()[0]
        gender = GENDER.get(entity, kind[-1])
        names = GIVEN.get((script, gender))
        if names and attempt == 0:
            return names[_number(key, kind, entity) % len(names)].lower()
        if names and attempt < WIDEN_AT:
            number, made = _number(key, kind, entity, attempt), ""
            for _ in range(2 + attempt):
                number, i = divmod(number, len(SYLLABLES[script]))
                made += SYLLABLES[script][i]
            return made + ENDINGS[script, gender]
    return permute_text(entity, key, tweak)


def spelled(kind: str, value: str, new: str) -> str:
    """The canonical surrogate in the spelling of one mention."""
    if kind == "iban" and len(value.replace(" ", "")) == len(new):
        chars = iter(new)
        return "".join(c if c == " " else next(chars) for c in value)
    if kind == "ipv6":
        return new.upper() if value.upper() == value and re.search("[A-F]", value) else new
    if kind in ("card", "phone", "ssn"):
        digits = iter(new)
        skip = max(0, sum(c.isdecimal() for c in value) - len(new))
        out, seen = [], 0
        for c in value:
            if c.isdecimal():
                seen += 1
                out.append(c if seen <= skip else chr(ord(c) - int(c) + int(next(digits))))
            else:
                out.append(c)
        return "".join(out)
    if kind.startswith("name"):
        return new.upper() if len(value) > 1 and value.isupper() else new[:1].upper() + new[1:]
    if kind == "email":
        if len(new) == len(value):
            return "".join(n.upper() if v.isupper() else n for n, v in zip(new, value))
    return new


def rewrite(text: str, key: bytes, exceptions: dict[tuple[str, str], tuple[str, int]], known: dict) -> str:
    """``text`` with every entity replaced; ``exceptions`` gives kind and
    attempt of entities (by the kind of the mention) that are not as shown."""
    out, at = [], 0
    for start, end, kind, value in entities(text):
        entity = canonical(kind, value)
        as_kind, attempt = exceptions.get((kind, entity), (kind, 0))
        k = (as_kind, entity, attempt)
        new = known.get(k)
        if new is None:
            new = surrogate(as_kind, entity, key, attempt)
            if len(known) < 100_000:
                known[k] = new
        out += [text[at:start], spelled(kind, value, new)]
        at = end
    return "".join([*out, text[at:]]) if out else text


# --- the corpus-wide steps -------------------------------------------------------


def find_entities(docs: DataFrame) -> DataFrame:
    """(doc_id, kind, entity) of every mention, canonical."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("kind", T.StringType()), T.StructField("entity", T.StringType())])

    def run(frames):
        for pdf in frames:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                rows += {(doc_id, kind, canonical(kind, value)) for _, _, kind, value in entities(text)}
            yield pd.DataFrame(rows, columns=["doc_id", "kind", "entity"])

    return docs.select("doc_id", "text").filter(F.col("text").rlike(MAYBE)).mapInPandas(run, schema)


def exceptions_table(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, as_kind, attempt) of the mentions' entities that are not
    simply attempt 0 of the kind shown."""
    shown = materialize(found.select("kind", "entity").distinct(), "pii-shown")
    # one kind a name in the whole corpus: name-f, name-m, name-n, name-s
    kinds = shown.filter("kind LIKE 'name-%'").groupBy("entity").agg(F.min("kind").alias("as_kind"))
    as_kind = F.when(F.col("kind").startswith("name-"), F.col("as_kind")).otherwise(F.col("kind"))
    shown = shown.join(kinds, "entity", "left").select("kind", "entity", as_kind.alias("as_kind"))
    shown = materialize(shown, "pii-kinds")
    space = F.substring_index("as_kind", "-", 1).alias("space")

    @F.pandas_udf("string")
    def candidate(kind: pd.Series, entity: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, e, key, int(a)) for k, e, a in zip(kind, entity, attempt)], dtype="object")

    # every round settles claims: of those for one surrogate the first by
    # checksum, if it is neither an entity of the corpus nor settled before
    claims = shown.select("as_kind", "entity", F.lit(0).alias("attempt")).distinct()
    settled = shown.select(space, F.col("entity").alias("new")).distinct()
    rounds = []
    while True:
        claims = materialize(claims.withColumn("new", candidate("as_kind", "entity", "attempt")).withColumn("space", space), "pii-claims")
        if claims.isEmpty():
            break
        free = claims.join(settled, ["space", "new"], "left_anti")
        winner = free.groupBy("space", "new").agg(F.min_by(F.struct("as_kind", "entity"), F.xxhash64("as_kind", "entity")).alias("w"))
        winner = materialize(winner.select("space", "new", "w.as_kind", "w.entity"), "pii-settled")
        rounds.append(claims.join(winner, ["space", "new", "as_kind", "entity"], "left_semi").select("as_kind", "entity", "attempt"))
        settled = settled.unionByName(winner.select("space", "new"))
        claims = claims.join(winner, ["space", "new", "as_kind", "entity"], "left_anti").select("as_kind", "entity", (F.col("attempt") + 1).alias("attempt"))
    late = shown.filter("false").select("as_kind", "entity", F.lit(0).alias("attempt"))
    for r in rounds[1:]:
        late = late.unionByName(r)
    out = shown.join(late, ["as_kind", "entity"], "left").withColumn("attempt", F.coalesce("attempt", F.lit(0)))
    return out.filter("attempt > 0 OR kind <> as_kind").select("kind", "entity", "as_kind", "attempt")


def replace_pii(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with every entity in ``text`` replaced by its surrogate, and
    ``n_chars`` brought up to date where the table has it."""
    small_batches(docs.sparkSession)
    secret = key.encode()
    found = materialize(find_entities(docs), "pii-found")
    late = materialize(exceptions_table(found, secret), "pii-late")
    per_doc = found.join(late, ["kind", "entity"]).groupBy("doc_id").agg(
        F.collect_set(F.struct("kind", "entity", "as_kind", "attempt")).alias("exceptions")
    )
    per_doc = materialize(prefixed(per_doc, "pii_"), "pii-exceptions")

    @F.pandas_udf("string")
    def rewritten(text: pd.Series, exceptions: pd.Series) -> pd.Series:
        known: dict = {}
        out = []
        for t, a in zip(text, exceptions):
            late_ones = {(x["kind"], x["entity"]): (x["as_kind"], x["attempt"]) for x in a} if a is not None else {}
            out.append(rewrite(t, secret, late_ones, known) if t else t)
        return pd.Series(out, dtype="object")

    d = prefixed(docs, "doc_").join(per_doc, F.col("doc_doc_id").eqNullSafe(F.col("pii_doc_id")), "left")
    # a Python function sees every row, so texts that need none go in as null
    d = d.withColumn("given", F.when(F.col("doc_text").rlike(MAYBE), F.col("doc_text")))
    d = d.withColumn("doc_text", F.coalesce(rewritten("given", "pii_exceptions"), "doc_text"))
    if "n_chars" in docs.columns:
        d = d.withColumn("doc_n_chars", F.length("doc_text").cast(docs.schema["n_chars"].dataType))
    return d.select(*restored(docs.columns, "doc_"))
