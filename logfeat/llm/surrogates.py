"""Personal data replaced by keyed surrogates of the same type, form, gender and script."""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .common import whole

KEY = b"replace this key"  # production passes its own

# fixed values: given names by script and gender, and forms of address
GIVEN = {
    ("latin", "f"): "Alice Amelia Andrea Barbara Carmen Caroline Catherine Charlotte Claudia "
                    "Elizabeth Emily Emma Hannah Helena Isabella Jennifer Jessica Julia Laura "
                    "Linda Lucia Margaret Maria Martina Monica Nancy Olivia Patricia Petra Sarah "
                    "Sofia Sophie Susan Teresa Ursula Victoria",
    ("latin", "m"): "Alexander Andrew Anthony Antonio Carlos Charles Christopher Daniel David "
                    "Dieter Edward Francisco Frank George Henry Jack James Jean John Jorge Joseph "
                    "Juergen Klaus Manuel Matthew Michael Miguel Paul Peter Philippe Pierre "
                    "Richard Robert Stefan Thomas William Wolfgang",
    ("cyrillic", "f"): "Анна Екатерина Елена Ирина Мария Наталья Ольга Светлана Татьяна",
    ("cyrillic", "m"): "Александр Алексей Андрей Дмитрий Иван Михаил Николай Сергей Юрий",
    ("greek", "f"): "Αικατερίνη Βασιλική Ελένη Μαρία Σοφία",
    ("greek", "m"): "Γεώργιος Δημήτριος Ιωάννης Κωνσταντίνος Νικόλαος",
}
TITLES = {"Mr": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Mrs": "f",
          "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f",
          "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f",
          "Dr": "x", "Doctor": "x", "Prof": "x", "Professor": "x"}  # x: not told
# fixed values: parts of invented names
_PARTS = {
    "latin": ("bel cor dan fen gal hol jar kel lor mer nor pel quin ros sel tan vel wen yar zel",
              {"f": "ina ela ora issa", "m": "on ard us eth", "s": "well ford berg mont"}),
    "cyrillic": ("бел вар гор дан жар зор кол лар мир нов пол рад сел тар яр",
                 {"f": "ина ела ана ия", "m": "ан ор ей ил", "s": "енко ский ович ин"}),
    "greek": ("βελ γαρ δαν ζορ καλ λαρ μιρ νεφ παλ ροδ σελ ταρ φιλ",
              {"f": "ινα ελη ωρα ια", "m": "ων ιος ης ας", "s": "ιδης ακης πουλος ατος"}),
}
_GENDER = {name.casefold(): g for (_, g), names in GIVEN.items() for name in names.split()}
_LISTED = frozenset(n for names in GIVEN.values() for n in names.split())
_NAME_KEYS = _LISTED | {n.upper() for n in _LISTED} | frozenset(TITLES)

_LETTERS = re.compile(r"[^\W\d_]+")
_FULL = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_DIGITS = re.compile(  # the first line asks what all forms need, so most places take one look
    r"(?=[\d+(])(?<!\w)(?:"
    rf"(?P<ip>(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\w))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<!\w)(?:[2-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{3,4}|3[47]\d\d[ -]\d{6}[ -]\d{5})(?!\w))"
    r"|(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]?\d{4}(?!\w)"
    r"|(?<![\w.-])0\d{2,4}[ -]\d{3,4}[ -]\d{3,4}(?![\w-])"
    r"|(?<!\w)\+\d{1,3}(?:[ -]\d{2,5}){2,4}(?![\w-])"
    r"|(?<!\w)\+\d{10,14}(?!\w)))")
_SECRET = re.compile(
    r"\bAKIA[0-9A-Z]{16}\b|(?<=password=)[^\s\"']+|(?<=token = \")[^\s\"]+"
    r"|(?:[Pp]assword|PASSWORD|[Pp]asswd|[Ss]ecret|SECRET|[Tt]oken|TOKEN|[Aa]pi[_-]?[Kk]ey|API_KEY"
    r"|[Aa]ccess[_-]?[Kk]ey|ACCESS_KEY)(?:=[\"']?|[\"']?: ?[\"']?)(?P<value>[^\s\"',;&<>]+)")
_SECRET_HINTS = ("AKIA", "assw", "ASSW", "ecret", "SECRET", "oken", "TOKEN", "ey=", "ey:", "EY=", "EY:",
                 'ey"', "ey'")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_IPV6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){2,7}(?![\w:])")


class Span(NamedTuple):
    start: int
    end: int
    kind: str
    value: str  # what is the same for all mentions of one entity


def script(word: str) -> str:
    first = ord(word[0])
    return "greek" if 0x370 <= first < 0x400 else "cyrillic" if 0x400 <= first < 0x530 else "latin"


def _names(text: str) -> list[Span]:
    """Given names that are known, what follows a form of address, and surnames beside them.

    A name that is not known by itself is the same person's wherever the text has it again, in
    capitals too; a given name only if the text nowhere has the word in small letters.
    """
    spans, again = [], {}
    taken: set[int] = set()
    tokens = list(_FULL.finditer(text))
    words = {m.group() for m in tokens}

    def near(i: int) -> bool:  # one space between a word and the next capitalised one
        return (i + 1 < len(tokens) and text[tokens[i].end():tokens[i + 1].start()] in (" ", ". ")
                and tokens[i + 1].group()[0].isupper())

    for i, m in enumerate(tokens):
        word, at = m.group(), i
        if i in taken or word not in _NAME_KEYS:
            continue
        gender = _GENDER.get(word.casefold())
        if gender is None:
            if not near(i):
                continue
            at, title = i + 1, TITLES[word]
            name = tokens[at].group()
            gender = _GENDER.get(name.casefold())
            if gender is None:
                if not (near(at) and text[tokens[at].end()] == " "):
                    again[name.casefold()] = "surname"
                    continue
                gender = title
                if name.lower() not in words:
                    again.setdefault(name.casefold(), f"given_{gender}")
        given = tokens[at]
        spans.append(Span(given.start(), given.end(), f"given_{gender}", given.group().casefold()))
        taken.add(at)
        if near(at) and text[given.end()] == " ":
            again[tokens[at + 1].group().casefold()] = "surname"
    if again:
        for i, m in enumerate(tokens):
            if i not in taken and m.group()[0].isupper() and m.group().casefold() in again:
                value = m.group().casefold()
                spans.append(Span(m.start(), m.end(), again[value], value))
    return spans


def _is_iban(value: str) -> bool:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _secrets(text: str) -> Iterator[Span]:
    """Values of settings; after a colon only those that no word is: with a digit, from six on."""
    for m in _SECRET.finditer(text):
        group = "value" if m["value"] else 0
        value = m[group]
        if group and ":" in text[m.start():m.start("value")] and (
                len(value) < 6 or not any(c.isdigit() for c in value)):
            continue
        yield Span(m.start(group), m.end(group), "secret", value)


def find(text: str) -> list[Span]:
    """All mentions in a text, in order, none overlapping another."""
    spans = []
    if "@" in text:
        spans += [Span(m.start(), m.end(), "email", m.group().lower())
                  for m in _EMAIL.finditer(text)]
    if any(hint in text for hint in _SECRET_HINTS):
        spans += _secrets(text)
    for m in _DIGITS.finditer(text):
        kind = m.lastgroup
        value = m.group() if kind == "ip" else re.sub(r"\D", "", m.group())
        if kind != "phone" or 9 <= len(value) <= 15:
            spans.append(Span(m.start(), m.end(), kind, value))
    for m in _IBAN.finditer(text):
        value = m.group().replace(" ", "")
        if _is_iban(value):
            spans.append(Span(m.start(), m.end(), "iban", value))
    if ":" in text:
        for m in _IPV6.finditer(text):
            groups = m.group().split(":")
            if ("::" in m.group() and m.group().count("::") == 1 and len(groups) > 4
                    or len(groups) == 8 and "" not in groups):
                spans.append(Span(m.start(), m.end(), "ipv6", m.group().lower()))
    if not _NAME_KEYS.isdisjoint(_LETTERS.findall(text)):
        spans += _names(text)
    spans.sort(key=lambda s: (s.start, -s.end))
    out: list[Span] = []
    for s in spans:
        if not out or s.start >= out[-1].end:
            out.append(s)
    return out


def entity(span: Span) -> tuple[str, str]:
    """What has one surrogate: a name is one entity, given name or surname, of whatever gender."""
    return ("name" if span.kind.startswith(("given", "surname")) else span.kind), span.value


def told_gender(span: Span) -> str | None:
    """The gender that a form of address tells of a name that is not listed."""
    told = span.kind in ("given_f", "given_m") and span.value not in _GENDER
    return span.kind[-1] if told else None


class _Stream:
    """Numbers that depend on the key and on what they stand for alone."""

    def __init__(self, key: bytes, *what: object):
        self.key, self.what, self.count, self.pool = key, "\0".join(map(str, what)), 0, 0

    def below(self, n: int) -> int:
        if self.pool < 1 << 64:
            block = hmac.new(self.key, f"{self.what}\0{self.count}".encode(), hashlib.sha256)
            self.pool, self.count = int.from_bytes(block.digest(), "big") | 1 << 256, self.count + 1
        self.pool, r = divmod(self.pool, n)
        return r


def _like(value: str, s: _Stream) -> str:
    """Letters for letters, digits for digits, of the same case; hex digits for hex digits."""
    if len(value) > 8 and not value.strip("0123456789abcdef"):
        return "".join("0123456789abcdef"[s.below(16)] for _ in value)

    def one(c: str) -> str:
        if c.isdigit():
            return str(s.below(10))
        if "a" <= c <= "z":
            return chr(97 + s.below(26))
        return chr(65 + s.below(26)) if "A" <= c <= "Z" else c

    return "".join(map(one, value))


def _luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def surrogate(
    kind: str, value: str, attempt: int, key: bytes = KEY, gender: str | None = None,
) -> str:
    """What replaces an entity, in the form of ``value``; further attempts give other values.

    A listed name has its own gender, any other the one given, or the form of a surname.
    """
    s = _Stream(key, kind, value, attempt)
    if kind == "email":
        local, domain = value.split("@")
        labels = domain.split(".")
        d = _Stream(key, "domain", domain)  # the same for all addresses of a domain
        return (_like(local, s) + _like("x" * (attempt // 4), s) + "@"
                + ".".join([_like(x, d) for x in labels[:-1]] + labels[-1:]))
    if kind == "ip":
        if value.startswith("192.168.") and attempt >= 8:  # so many that these are used up
            return ".".join(["10"] + [str(s.below(256)) for _ in range(3)])
        if value.startswith(("10.", "192.168.", "127.")):
            head = 2 if value.startswith("192.168.") else 1
            kept = value.split(".")[:head]
            return ".".join(kept + [str(s.below(256)) for _ in range(4 - head)])
        first = [x for x in range(11, 224) if x not in (127, 169, 172, 192, 198, 203)]
        return ".".join([str(first[s.below(len(first))])] + [str(s.below(256)) for _ in range(3)])
    if kind == "card":
        body = value[0] + "".join(str(s.below(10)) for _ in value[1:-1])
        good = next(c for c in "0123456789" if _luhn(body + c))
        if _luhn(value):
            return body + good
        return body + [c for c in "0123456789" if c != good][s.below(9)]
    if kind == "phone":
        head, rest = ("0", value[1:]) if value[0] == "0" else (value[:-10], value[-10:])
        return head + str(2 + s.below(8)) + "".join(str(s.below(10)) for _ in rest[1:])
    if kind == "ssn":
        return (f"{1 + s.below(665):03d}" + f"{1 + s.below(99):02d}" + f"{1 + s.below(9999):04d}")
    if kind == "secret":
        head = 4 if value.startswith("AKIA") else 0
        return value[:head] + _like(value[head:], s) + _like("x" * (attempt // 4), s)
    if kind == "iban":
        body = "".join(str(s.below(10)) if c.isdigit() else chr(65 + s.below(26)) for c in value[4:])
        rest = int("".join(str(int(c, 36)) for c in body + value[:2] + "00")) % 97
        return f"{value[:2]}{98 - rest:02d}{body}"
    if kind == "ipv6":  # a group for a group of as many digits
        return ":".join("".join("0123456789abcdef"[s.below(15) + 1 if i == 0 else s.below(16)]
                                for i in range(len(group))) for group in value.split(":"))
    parts, ends = _PARTS[script(value)]
    parts, ends = parts.split(), ends[_GENDER.get(value, gender) or "s"].split()
    return ("".join(parts[s.below(len(parts))] for _ in range(2 + attempt // 4))
            + ends[s.below(len(ends))])


def _write(mention: str, kind: str, new: str) -> str:
    """The surrogate in the layout of the mention."""
    if kind == "iban":
        signs = iter(new)
        return "".join(c if c == " " else next(signs) for c in mention)
    if kind in ("phone", "card", "ssn"):
        digits = iter(new)
        return "".join(next(digits) if c.isdigit() else c for c in mention)
    if kind.startswith(("given", "surname")):
        return new.upper() if mention.isupper() and len(mention) > 1 else new[:1].upper() + new[1:]
    if kind in ("email", "ipv6"):
        return new.upper() if mention.isupper() else new
    return new


def replace(
    text: str, attempts: dict[tuple[str, str], int], key: bytes = KEY,
    genders: dict[str, str] | None = None,
) -> tuple[str, list]:
    """The text with surrogates, and the kind of each mention.

    ``attempts`` is by entity(); ``genders`` of names that are not listed come from the whole
    corpus, or from this text if none are given.
    """
    spans = find(text)
    if genders is None:
        genders = {s.value: told_gender(s) for s in spans if told_gender(s)}
    out, at, kinds = [], 0, []
    for s in spans:
        who = entity(s)
        new = surrogate(*who, attempts.get(who, 0), key, genders.get(s.value))
        out += [text[at:s.start], _write(text[s.start:s.end], s.kind, new)]
        at = s.end
        kinds.append(s.kind)
    return "".join(out) + text[at:], kinds


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """(digest, kind, value, gender): the entities of each text, once per text and told gender."""
    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = [(d, *who, gender) for d, t in zip(pdf["digest"], pdf["text"])
                    for who, gender in {(entity(x), told_gender(x)) for x in find(t)}]
            yield pd.DataFrame(rows, columns=["digest", "kind", "value", "gender"])

    body = whole(text)
    return docs.select(F.xxhash64(body).alias("digest"), body.alias("text")).mapInPandas(
        batches, "digest long, kind string, value string, gender string")


def settled_genders(mentions: DataFrame) -> DataFrame:
    """(kind, value, gender): every entity once, with the gender that more texts tell, if any."""
    told = F.count_if(F.col("gender") == "f") - F.count_if(F.col("gender") == "m")
    return mentions.groupBy("kind", "value").agg(told.alias("d")).select(
        "kind", "value", F.when(F.col("d") > 0, "f").when(F.col("d") < 0, "m").alias("gender"))


def further_attempts(known: DataFrame, key: bytes = KEY) -> DataFrame:
    """(kind, value, attempt): entities whose first surrogate cannot be used.

    ``known`` has one row per entity, with its gender if one was settled.  A surrogate must not be an entity of the corpus itself and
    not one that another entity has.  Of entities that meet in one, the smallest value keeps it
    and the others go on to their next attempt, until none is left.
    """
    @F.pandas_udf("string")
    def named(kind: pd.Series, value: pd.Series, gender: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, v, a, key, g if isinstance(g, str) else None)
                          for k, v, g, a in zip(kind, value, gender, attempt)])

    if "gender" not in known.columns:
        known = known.withColumn("gender", F.lit(None).cast("string"))
    real = known.select(F.col("kind").alias("k"), F.lower("value").alias("s"))
    left, attempt, used = known, 0, None
    moved = None
    while True:
        tried = settle(left.select("kind", "value", "gender", named(
            "kind", "value", "gender", F.lit(attempt)).alias("name")), "tried")
        fits = tried.join(real, (F.col("kind") == F.col("k")) & (F.lower("name") == F.col("s")),
                          "left_anti")
        if used is not None:
            fits = fits.join(used, ["kind", "name"], "left_anti")
        won = settle(fits.groupBy("kind", "name").agg(F.min("value").alias("value")), "won")
        if attempt:
            rows = won.select("kind", "value", F.lit(attempt).alias("attempt"))
            moved = rows if moved is None else moved.unionByName(rows)
        used = won.select("kind", "name") if used is None else used.unionByName(
            won.select("kind", "name"))
        left = settle(tried.join(won, ["kind", "value"], "left_anti").select(
            "kind", "value", "gender"), "left")
        attempt += 1
        if left.isEmpty():
            return moved if moved is not None else known.limit(0).select(
                "kind", "value", F.lit(0).alias("attempt"))
        if attempt > 200:
            raise ValueError("no free surrogates are left for some kind of entity")


def replace_entities(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", key: bytes = KEY,
) -> DataFrame:
    """(doc_id, text, kinds) for every row of ``docs``: the text with surrogates, and the kinds
    of its mentions in order.

    An entity has one surrogate in the whole corpus, and no two entities share one; which it is
    depends on the key, the kind and the value alone, except where ``further_attempts`` says
    otherwise.  A name is one entity, as given name, surname or in capitals; if it is not listed, the
    forms of address of the whole corpus settle its gender.  Texts are not shuffled unless some
    entities need further attempts or such a gender: then those, by text digest, are joined to
    the documents.  No rows give no rows, a text of any length is searched whole.  A null text stays null; ids may be null or
    repeat; other columns do not matter.
    """
    mentions = settle(entities(docs, text), "mentions")
    known = settle(settled_genders(mentions), "entities")
    moved = settle(further_attempts(known, key).join(
        known.where("gender IS NOT NULL"), ["kind", "value"], "full").select(
        "kind", "value", F.coalesce("attempt", F.lit(0)).alias("attempt"), "gender"), "moved")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    if moved.isEmpty():
        rows = rows.withColumn("moved", F.lit(None).cast(
            "array<struct<kind:string,value:string,attempt:int,gender:string>>"))
    else:
        by_text = mentions.drop("gender").join(moved, ["kind", "value"]).groupBy(
            F.col("digest").alias("_d")).agg(
            F.collect_set(F.struct("kind", "value", "attempt", "gender")).alias("moved"))
        rows = rows.join(by_text, F.xxhash64(whole("text")) == F.col("_d"), "left").select(
            "doc_id", "text", "moved")
    kind = docs.schema[id_col].dataType.simpleString()

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            texts, kinds = [], []
            for t, moves in zip(pdf["text"], pdf["moved"]):
                moves = [] if moves is None else moves
                attempts = {(m["kind"], m["value"]): m["attempt"] for m in moves}
                genders = {m["value"]: m["gender"] for m in moves if m["gender"]}
                new, found = (None, []) if t is None else replace(t, attempts, key, genders)
                texts.append(new)
                kinds.append(found)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": texts, "kinds": kinds})

    return rows.mapInPandas(batches, f"doc_id {kind}, text string, kinds array<string>")
