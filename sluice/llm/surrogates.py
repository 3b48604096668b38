"""Personal data replaced by surrogates of the same type and format.

An entity has a kind and a canonical value (digits of a number, lower-cased address). Its surrogate
is drawn from a keyed hash, so it is the same wherever the entity occurs, in whatever format. All
distinct entities are checked against each other in Spark: a surrogate that two entities share, or
that is an entity itself, is drawn again until all differ. Each text gets the surrogates of its own
entities only, by a join on the hash of the text.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sluice.session import cut_lineage

KEY = "surrogates"  # production jobs pass a secret

# Titles and given names that tell the gender of a person.
TITLES = {
    "f": "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Señorita|Sra|Srta|Госпожа|г-жа|Κυρία",
    "m": "Mr|Herr|Monsieur|Señor|Sr|Господин|г-н|Κύριος",
    "n": "Dr|Prof",
}
GIVEN = {
    ("f", "latin"): "Anna Maria Julia Laura Clara Elena Sofia Emma Alice Nora Irene Marta".split(),
    ("m", "latin"): "Peter Thomas Daniel Martin Paul Simon Victor Robert Hugo Felix Oscar Leon".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Ирина Татьяна Наталья Светлана".split(),
    ("m", "cyrillic"): "Иван Пётр Сергей Алексей Дмитрий Николай Андрей Павел".split(),
    ("f", "greek"): "Μαρία Ελένη Άννα Σοφία".split(),
    ("m", "greek"): "Γιώργος Νίκος Πέτρος Ανδρέας".split(),
}
ALPHABETS = {
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "cyrillic": "абвгдежзиклмнопрстуфхцчшщэюя",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga ka ke ko la le lo ma me mo na ne no ra re ro sa se ta te to va".split(),
    "cyrillic": "ба бе бо да де до ка ко ла ле ло ма ме мо на не но ра ре ро са се та те".split(),
    "greek": "βα βε δα δε δο κα κο λα λε λο μα με μο να νε νο ρα ρε σα σε τα τε".split(),
}

_TITLE = "|".join(TITLES.values())
PATTERNS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}\b",
    "password": r"(?i:\b(?:password|passwd|pwd))\s?[=:]\s?\"?(?P<password_value>[^\s\"]{6,})",
    "token": r"(?i:\b(?:token|api[_-]?key|secret|access[_-]?key))\s?[=:]\s?\"?(?P<token_value>[A-Za-z0-9_\-]{16,})",
    "access_key": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "card": r"(?<![\d+-])\d{4}(?P<gap>[ -]?)\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\d])",
    "person": rf"\b(?P<title>{_TITLE})\.? (?P<person_value>[^\W\d_a-zа-яα-ω][\w'-]+(?: [^\W\d_a-zа-яα-ω][\w'-]+)?)",
}
ENTITY = re.compile("|".join(f"(?P<{kind}>{p})" for kind, p in PATTERNS.items()))
# What every entity contains; texts without it are not looked at again.
TRACE_CHARS = "[0-9@=:]"
TRACE_TEXTS = ("AKIA", "ASIA", *_TITLE.split("|"))
DIGITS = {"card", "phone", "ssn"}


def find(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(begin, end, kind, value) of the entities of a text, from left to right."""
    for m in ENTITY.finditer(text):
        kind = m.lastgroup if m.lastgroup in PATTERNS else next(k for k in PATTERNS if m[k] is not None)
        part = f"{kind}_value" if kind in ("password", "token", "person") else kind
        yield m.start(part), m.end(part), kind, m[part]


def script(value: str) -> str:
    for letter in value.lower():
        for name, alphabet in ALPHABETS.items():
            if letter in alphabet:
                return name
    return "latin"


def gender(text: str, begin: int) -> str:
    before = text[max(0, begin - 12) : begin].rstrip(" .").rsplit(" ", 1)[-1].rsplit("\n", 1)[-1]
    return next((g for g, t in TITLES.items() if before in t.split("|")), "n")


def canonical(kind: str, value: str, sex: str = "") -> str:
    """One text for all formats of an entity. For persons the gender and script come first."""
    if kind in DIGITS:
        return re.sub(r"\D", "", value)
    if kind == "email":
        return value.lower()
    if kind == "iban":
        return value.replace(" ", "").upper()
    if kind == "person":
        return f"{sex}:{script(value)}:" + " ".join(value.lower().split())
    return value


class _Stream:
    """Numbers drawn from a keyed hash."""

    def __init__(self, key: str, *what: str):
        self.state, self.pool = hmac.new(key.encode(), "\0".join(what).encode(), hashlib.sha256), 0
        self.turn, self.left = 0, 0

    def below(self, n: int) -> int:
        if self.left < n << 32:
            self.turn += 1
            part = self.state.copy()
            part.update(self.turn.to_bytes(4, "big"))
            self.pool, self.left = int.from_bytes(part.digest(), "big"), 1 << 256
        self.pool, out = divmod(self.pool, n)
        self.left //= n
        return out


def _like(value: str, draw: _Stream) -> str:
    """Each digit another digit, each letter one of its script and case; the rest as it is. Hex
    letters stay hex in values that are hex throughout."""
    hexadecimal = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) and len(value) >= 8 and not value.isdigit()
    out = []
    for c in value:
        if hexadecimal:
            d = "0123456789abcdef"[draw.below(16)]
            out.append(d.upper() if value.isupper() else d)
        elif c.isdigit():
            out.append(str(draw.below(10)))
        elif c.isalpha():
            letters = ALPHABETS[script(c)]
            new = letters[draw.below(len(letters))]
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def _luhn(digits: str) -> int:
    """What the digits lack for a valid check digit of 0."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10


def draw_surrogate(key: str, kind: str, value: str, attempt: int) -> str:
    """Surrogate of a canonical value, in canonical form. Names and mailboxes grow with the attempt, so
    that there are always enough; the other kinds have a fixed format."""
    longer = attempt // 3
    draw = _Stream(key, kind, value, str(attempt))
    if kind == "email":
        local, _, domain = value.partition("@")
        labels = domain.split(".")
        more = "".join(ALPHABETS["latin"][draw.below(26)] for _ in range(longer))
        return f"{_like(local, draw)}{more}@{'.'.join(_like(x, draw) for x in labels[:-1])}.{labels[-1]}"
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "phone":
        return str(1 + draw.below(9)) + _like(value[1:], draw) if value else value
    if kind == "card":
        made = value[0] + _like(value[1:], draw)
        if _luhn(value) == 0:
            made = made[:-1] + "0"
            made = made[:-1] + str(-_luhn(made) % 10)
        return made
    if kind == "access_key":
        return value[:4] + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[draw.below(32)] for _ in value[4:])
    if kind == "iban":
        return value[:2] + _like(value[2:], draw)
    if kind == "person":
        sex, kind_, name = value.split(":", 2)
        if sex == "n":
            sex = "fm"[draw.below(2)]
        words = name.split()
        given = GIVEN[sex, kind_]
        last = "".join(SYLLABLES[kind_][draw.below(len(SYLLABLES[kind_]))] for _ in range(2 + longer + draw.below(3)))
        return " ".join(([given[draw.below(len(given))].lower()] if len(words) > 1 else []) + [last])
    return _like(value, draw)


def render(kind: str, value: str, surrogate: str) -> str:
    """A canonical surrogate in the format of an occurrence."""
    if kind in DIGITS or kind == "iban":
        rest = iter(surrogate)
        out = "".join(c if c in " -.()+" else next(rest, "") for c in value)
        return out.lower() if value.islower() else out
    if kind == "email":
        return surrogate.upper() if value.isupper() else surrogate
    if kind == "person":
        return surrogate.upper() if value.isupper() else surrogate.title()
    return surrogate


def may_hold(text: Column) -> Column:
    """False only for texts without an entity, and for null."""
    out = text.rlike(TRACE_CHARS)
    for t in TRACE_TEXTS:
        out = out | F.contains(text, F.lit(t))
    return F.coalesce(out, F.lit(False))


def entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(text_hash, kind, value): the canonical entities of each text, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, kinds, values = [], [], []
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = {
                    (kind, canonical(kind, value, gender(text, begin) if kind == "person" else ""))
                    for begin, _, kind, value in find(text)
                }
                for kind, value in sorted(found):
                    hashes.append(h), kinds.append(kind), values.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.int64()), pa.array(kinds, pa.string()), pa.array(values, pa.string())],
                names=["text_hash", "kind", "value"],
            )

    text = F.col(text_col)
    return docs.where(may_hold(text)).select(F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(
        run, "text_hash long, kind string, value string"
    )


ATTEMPTS = 64  # with half of a format free, one in 2**64 entities is not placed by then


def surrogate_table(found: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, value, surrogate) of the distinct entities of `found` (kind, value): no surrogate
    twice for a kind, and none that is an entity of the kind. Ties go to the earlier attempt, then the
    smaller value; repeated rows are one entity; an empty table gives none. A fixed format without room
    for all its entities is a ValueError."""

    @F.pandas_udf(StringType())
    def drawn(kind: pd.Series, value: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([draw_surrogate(key, k, v, n) for k, v, n in zip(kind, value, attempt)])

    known = cut_lineage(found.select("kind", "value").distinct())
    originals = known.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("taken"))
    # persons are compared by the name alone
    name = F.when(F.col("kind") == "person", F.substring_index("surrogate", ":", -1)).otherwise(F.col("surrogate"))
    originals = originals.withColumn("surrogate", name).distinct()
    table = cut_lineage(
        known.withColumn("attempt", F.lit(0)).withColumn("surrogate", drawn("kind", "value", "attempt"))
    )
    attempts = 0
    while True:
        first = table.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "value")).alias("first"))
        judged = table.join(first, ["kind", "surrogate"]).join(originals, ["kind", "surrogate"], "left")
        again = (F.col("first.value") != F.col("value")) | F.col("taken").isNotNull()
        judged = cut_lineage(judged.select("kind", "value", "attempt", "surrogate", again.alias("again")))
        if judged.where("again").isEmpty():
            return judged.select("kind", "value", "surrogate")
        # those that stay keep their attempt, so they come before the new draws of a later one
        later = F.col("attempt") + 1
        attempts += 1
        if attempts > ATTEMPTS:
            full = sorted(r.kind for r in judged.where("again").select("kind").distinct().collect())
            raise ValueError(f"no room for surrogates of kind {', '.join(full)} that are free and distinct")
        table = cut_lineage(
            judged.where(~F.col("again")).select("kind", "value", "attempt", "surrogate").unionByName(
                judged.where("again").select("kind", "value", later.alias("attempt")).withColumn(
                    "surrogate", drawn("kind", "value", "attempt")
                )
            )
        )


def replaced(text: str, known: dict[tuple[str, str], str]) -> tuple[str, int]:
    """A text with the surrogates of its entities, and their number."""
    out, at, n = [], 0, 0
    for begin, end, kind, value in find(text):
        new = known.get((kind, canonical(kind, value, gender(text, begin) if kind == "person" else "")))
        if new is not None:
            out += [text[at:begin], render(kind, value, new)]
            at, n = end, n + 1
    return "".join([*out, text[at:]]), n


def _with_surrogates(docs: DataFrame, text_col: str, key: str) -> DataFrame:
    """(_row, text, n): every row of `docs` as a struct, its new text and the number of entities."""
    found = cut_lineage(entities(docs, text_col))
    table = surrogate_table(found, key)
    by_text = found.join(table, ["kind", "value"]).groupBy("text_hash").agg(
        F.collect_set(F.struct("kind", "value", "surrogate")).alias("known")
    )
    by_text = cut_lineage(by_text)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("_row"), F.col(text_col).alias("text"))
    touched = rows.where(may_hold(F.col("text"))).withColumn("text_hash", F.xxhash64("text"))
    touched = touched.join(by_text, "text_hash", "left").select("text", "known", "_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, numbers = [], []
            for text, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text, n = replaced(text, {(k["kind"], k["value"]): k["surrogate"] for k in known}) if known else (text, 0)
                texts.append(text), numbers.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(texts, pa.string()), pa.array(numbers, pa.int64())], names=["_row", "text", "n"]
            )

    kind = rows.schema["_row"].dataType.simpleString()
    done = touched.mapInArrow(run, f"_row {kind}, text string, n long")
    rest = rows.where(~may_hold(F.col("text")))
    return done.unionByName(rest.select("_row", "text", F.lit(0).cast("long").alias("n")))


def replace_entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = KEY) -> DataFrame:
    """(id, text, n_entities) for every row of `docs`; a null text stays null, an empty one empty."""
    done = _with_surrogates(docs.select(id_col, text_col), text_col, key)
    return done.select(F.col("_row")[id_col].alias(id_col), F.col("text").alias(text_col), F.col("n").alias("n_entities"))


def replace_texts(docs: DataFrame, text_col: str = "text", key: str = KEY) -> DataFrame:
    """`docs` with surrogates in its text column; its other columns as they are."""
    done = _with_surrogates(docs, text_col, key)
    return done.select(
        *[F.col("text").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns]
    )
