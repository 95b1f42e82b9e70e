"""Surrogates for personal data: keyed replacements that keep type, format, script and gender."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import ship, sized
from tabwright.session import materialize

# Titles that come before a name, and the gender they tell (m, f or none).
TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Herrn": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Don": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mlle": "f", "Señora": "f",
    "Sra": "f", "Doña": "f", "Dr": "", "Prof": "", "Professor": "", "господин": "m", "госпожа": "f", "Господин": "m",
    "Госпожа": "f", "κύριος": "m", "κυρία": "f", "Κύριος": "m", "Κυρία": "f",
}
# Consonants, vowels and the ending of female given names, by script.
LETTERS = {
    "latin": ("bdfgklmnprstvz", "aeiou", "a"),
    "cyrillic": ("бвгдзклмнпрстф", "аеиоу", "а"),
    "greek": ("βγδζκλμνπρστφ", "αεηιου", "α"),
}
# Names of secrets before an assigned value.
_SECRET = r"(?i:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|private[_-]?key|auth)"

# Seven to fifteen digits in any groups after an international prefix.
_ABROAD = r"(?<![0-9A-Za-z])(?:\+|00(?=[1-9])) ?\(?[0-9](?:[ .\-/()\u00a0\u202f\u2011\u2013]{0,3}[0-9]){6,14}"

PATTERNS = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}"), "@"),
    ("secret", re.compile(_SECRET + r"""["']?\s*[=:]\s*["']?(?P<value>[A-Za-z0-9+/_\-.~]{8,})"""), "=:"),
    ("secret", re.compile(r"(?<![0-9A-Za-z])(?P<value>(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{32,128})(?![0-9A-Za-z])"), "0"),
    ("iban", re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"), "0"),
    ("ip", re.compile(r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])"), "0"),
    # Ahead of the patterns of digits only, unless more digits follow.
    ("phone", re.compile(_ABROAD + r"(?![ -]?[0-9])"), "0"),
    ("ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), "0"),
    ("card", re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"), "0"),
    ("phone", re.compile(_ABROAD + r"(?![0-9])"), "0"),
    # An area code in brackets or with its leading zero, then any groups.
    ("phone", re.compile(r"(?<![0-9A-Za-z])(?:\(0[0-9]{1,5}\)[ .-]?[0-9](?:[ .\-/]?[0-9]){3,9}|\([1-9][0-9]{1,4}\)[ .-]?[0-9](?:[ .\-/]?[0-9]){6,9})(?![0-9])"), "0"),
    ("phone", re.compile(r"(?<![0-9A-Za-z.,/-])0[1-9][0-9]{0,4}(?:[ /.-]| / | - )?[0-9]{3,10}(?:[ .-][0-9]{2,4}){0,3}(?![0-9])"), "0"),
    ("phone", re.compile(r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,4}(?![0-9])"), "0"),
]
_TITLE = "|".join(sorted(TITLES, key=len, reverse=True))
_NAME = r"[A-ZÀ-ÖØ-ÞΑ-ΩА-Я][A-Za-zÀ-ÖØ-öø-ÿά-ώΑ-Ωа-яА-Я'’-]+"
NAMES = re.compile(rf"(?<!\w)(?P<title>{_TITLE})\.? (?P<names>{_NAME}(?: {_NAME})*)")
_DIGIT = re.compile("[0-9]")


@dataclass(frozen=True)
class Mention:
    start: int
    end: int
    kind: str
    value: str


def script_of(text: str) -> str:
    for c in text:
        if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿":
            return "greek"
        if "Ѐ" <= c <= "ӿ":
            return "cyrillic"
    return "latin"


def hidden(text: str, found: list[Mention]) -> str:
    """The text without what was found, so that numbers don't reach into it; places stay."""
    out, at = [], 0
    for a, b in sorted((m.start, m.end) for m in found):
        if b > at:
            out += [text[at:a], "\0" * (b - max(a, at))]
            at = b
    return "".join(out) + text[at:]


def mentions(text: str) -> list[Mention]:
    """Entities of a text in order, without overlaps; earlier patterns go first.

    A name after a title is told part by part, the given name with the title's gender if
    there are several parts. The same parts elsewhere in the text are mentions too.
    """
    found: list[Mention] = []
    signs = {"@": "@" in text, "0": _DIGIT.search(text) is not None, "=:": "=" in text or ":" in text}
    for kind, pattern, needs in PATTERNS:
        if not signs[needs]:
            continue
        for m in pattern.finditer(hidden(text, found) if kind in ("card", "phone") else text):
            if kind == "phone" and not (7 if m.group()[0] in "+(0" else 9) <= sum(map(str.isdigit, m.group())) <= (17 if m.group().startswith("00") else 15):
                continue
            group = "value" if "value" in pattern.groupindex else 0
            found.append(Mention(m.start(group), m.end(group), kind, m.group(group)))
    parts: dict[str, str] = {}
    for m in NAMES.finditer(text):
        at, names = m.start("names"), m.group("names").split(" ")
        gender = TITLES[m.group("title")]
        for i, name in enumerate(names):
            kind = f"name:{gender}" if i == 0 and len(names) > 1 else "name:"
            kind = parts.setdefault(name, kind)
            found.append(Mention(at, at + len(name), kind, name))
            at += len(name) + 1
    if parts:
        again = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(parts, key=len, reverse=True))) + r")(?!\w)")
        found += [Mention(m.start(), m.end(), parts[m.group()], m.group()) for m in again.finditer(text)]
    out: list[Mention] = []
    # Starts and ends of what is taken, in order; taken stretches don't overlap.
    starts: list[int] = []
    ends: list[int] = []
    for m in found:
        k = bisect_right(starts, m.start)
        if (k == 0 or ends[k - 1] <= m.start) and (k == len(starts) or m.end <= starts[k]):
            starts.insert(k, m.start)
            ends.insert(k, m.end)
            out.append(m)
    return sorted(out, key=lambda m: m.start)


def canonical(kind: str, value: str) -> str:
    """What tells an entity: its letters and digits, without the way they are written."""
    if kind in ("card", "phone", "ssn"):
        return re.sub("[^0-9]", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    return value.lower() if kind == "email" or kind.startswith("name") else value


class Source:
    """A stream of keyed random numbers."""

    def __init__(self, key: bytes, *parts: str):
        self.state = hashlib.blake2b("\x1f".join(parts).encode("utf-8", "surrogatepass"), key=key, digest_size=64)
        self.block, self.n = b"", 0

    def below(self, n: int) -> int:
        if len(self.block) < 8:
            more = self.state.copy()
            more.update(self.n.to_bytes(4, "big"))
            self.block, self.n = self.block + more.digest(), self.n + 1
        value, self.block = int.from_bytes(self.block[:8], "big"), self.block[8:]
        return value % n

    def of(self, letters: str) -> str:
        return letters[self.below(len(letters))]


def luhn(digits: str) -> int:
    """Sum modulo 10 that is 0 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def shaped(source: Source, value: str, hexadecimal: bool = False) -> str:
    """Letters for letters and digits for digits."""
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    if hexadecimal:
        return "".join([source.of("0123456789abcdef") for _ in value])
    return "".join(
        [source.of("0123456789") if c.isdigit() else source.of(upper) if c.isupper() else source.of(lower) if c.isalpha() else c for c in value]
    )


def surrogate(kind: str, entity: str, attempt: int, key: bytes) -> str:
    """Canonical form of the entity's replacement; each attempt gives another one.

    Replacements grow with the attempts where a short format has few values.
    """
    source = Source(key, kind, entity, str(attempt))
    longer = attempt // 8
    if kind == "email":
        local, _, domain = entity.rpartition("@")
        host, _, top = domain.rpartition(".")
        # A domain has one replacement, whoever writes from it.
        return shaped(source, local + "x" * longer) + "@" + shaped(Source(key, "domain", domain), host) + "." + top
    if kind == "ip":
        return ".".join([str(1 + source.below(254)) for _ in range(4)])
    if kind == "iban":
        body = shaped(source, entity[4:] + "0" * longer)
        number = int("".join(str(int(c, 36)) for c in body + entity[:2] + "00"))
        return entity[:2] + f"{98 - number % 97:02d}" + body
    if kind in ("card", "phone", "ssn"):
        digits = "".join([source.of("123456789" if c != "0" and i == 0 else "0123456789") for i, c in enumerate(entity)])
        digits += "".join([source.of("0123456789") for _ in range(longer)])
        if kind == "card" and luhn(entity) == 0:
            digits = next(d for d in (digits[:-1] + str(x) for x in range(10)) if luhn(d) == 0)
        return digits
    if kind.startswith("name"):
        consonants, vowels, female = LETTERS[script_of(entity)]
        size = max(2, min(4, (len(entity) + 1) // 2)) + longer
        name = "".join([source.of(consonants) + source.of(vowels) for _ in range(size)])
        ending = kind.partition(":")[2]
        return name[:-1] + female if ending == "f" else name + source.of(consonants) if ending == "m" else name
    return shaped(source, entity + "0" * longer, re.fullmatch("[0-9a-f]+", entity) is not None)


def written(kind: str, value: str, replacement: str) -> str:
    """The replacement in the way the mention was written: case, spaces and signs."""
    if kind in ("card", "phone", "ssn", "iban"):
        kept = [c for c in value if c.isalnum()]
        out, i = [], 0
        for c in value:
            out.append(replacement[i] if c.isalnum() else c)
            i += c.isalnum()
        return "".join(out) + replacement[len(kept) :]
    if kind == "email":
        return "".join([c.upper() if value[i : i + 1].isupper() else c for i, c in enumerate(replacement)])
    if kind.startswith("name"):
        return replacement.upper() if value.isupper() and len(value) > 1 else replacement[:1].upper() + replacement[1:]
    return replacement


def rewritten(text: str, attempts: dict[tuple[str, str], int], key: bytes) -> tuple[str, list[tuple[int, int, str]]]:
    """A text with its mentions replaced, and the replacements' spans (start, end, kind)."""
    out, spans, at, size = [], [], 0, 0
    for m in mentions(text):
        entity = canonical(m.kind, m.value)
        new = written(m.kind, m.value, surrogate(m.kind, entity, attempts.get((m.kind, entity), 0), key))
        out += [text[at : m.start], new]
        size += m.start - at
        spans.append((size, size + len(new), m.kind.partition(":")[0]))
        size += len(new)
        at = m.end
    return "".join(out) + text[at:], spans


def domain_of(kind: Column) -> Column:
    """Kinds whose replacements must differ from each other: all parts of names are one domain."""
    return F.substring_index(kind, ":", 1)


def assigned(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, attempt) such that no two entities of a domain have the same replacement,
    and none is an entity of the corpus. Entities that collide, all but the least of them, try again."""

    @F.pandas_udf("string")
    def make(kind: pd.Series, entity: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, e, a, key) for k, e, a in zip(kind, entity, attempt)])

    known = entities.select(domain_of(F.col("kind")).alias("domain"), F.col("entity").alias("made")).distinct()
    open_ = entities.withColumn("attempt", F.lit(0))
    settled = None
    while True:
        tried = open_.withColumn("made", make("kind", "entity", "attempt")).withColumn("domain", domain_of(F.col("kind")))
        tried = materialize(tried.join(known.withColumn("real", F.lit(True)), ["domain", "made"], "left"), "surrogates-tried")
        used = tried.filter("real is null").groupBy("domain", "made").agg(F.min(F.struct("kind", "entity")).alias("first"))
        if settled is not None:
            used = used.join(settled.select("domain", "made"), ["domain", "made"], "left_anti")
        used = used.select("domain", "made", F.col("first.kind").alias("kind"), F.col("first.entity").alias("entity"), F.lit(True).alias("wins"))
        judged = materialize(tried.drop("real").join(used, ["domain", "made", "kind", "entity"], "left"), "surrogates-judged")
        won = judged.filter("wins").drop("wins")
        settled = won if settled is None else materialize(settled.unionByName(won), "surrogates-settled")
        open_ = judged.filter("wins is null").select("kind", "entity", (F.col("attempt") + 1).alias("attempt"))
        if open_.isEmpty():
            return settled.select("kind", "entity", "attempt")


def text_key(text: Column) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("th"), F.length(text).alias("size"), text.alias("text")]


def with_surrogates(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with surrogates, n_entities and spans (start, end, kind in the new text) of every row.

    The key decides the replacements; the same entity has the same one in all documents, and
    different entities of a type never share one. Null text becomes empty. Rows are
    rewritten one by one, so repeated rows agree. An empty table gives no rows. A wrong or
    unknown format is left alone.
    """
    ship(docs.sparkSession)
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *text_key(F.col(text_col)))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for th, size, text in zip(batch["th"], batch["size"], batch["text"]):
                found = {(m.kind, canonical(m.kind, m.value)) for m in mentions(text)}
                out += [(th, size, *f) for f in found]
            yield pd.DataFrame(out, columns=["th", "size", "kind", "entity"])

    seen = materialize(rows.select("th", "size", "text").mapInPandas(find, "th long, size int, kind string, entity string"), "surrogates-seen")
    attempts = assigned(materialize(seen.select("kind", "entity").distinct(), "surrogates-entities"), secret)
    again = materialize(attempts.filter("attempt > 0"), "surrogates-again")
    special = seen.join(sized(again), ["kind", "entity"]).groupBy("th", "size").agg(
        F.collect_set(F.struct("kind", "entity", "attempt")).alias("attempts")
    )
    special = materialize(special, "surrogates-special")

    @F.pandas_udf("text string, n_entities int, spans array<struct<start:int,end:int,kind:string>>")
    def rewrite(text: pd.Series, attempts: pd.Series) -> pd.DataFrame:
        out = []
        for t, found in zip(text, attempts):
            known = {(a["kind"], a["entity"]): a["attempt"] for a in found} if found is not None else {}
            new, spans = rewritten(t, known, secret)
            out.append((new, len(spans), [{"start": a, "end": b, "kind": k} for a, b, k in spans]))
        return pd.DataFrame(out, columns=["text", "n_entities", "spans"])

    made = rows.join(sized(special, "attempts"), ["th", "size"], "left").select("doc_id", rewrite("text", "attempts").alias("r"))
    return made.select("doc_id", "r.text", "r.n_entities", "r.spans")
