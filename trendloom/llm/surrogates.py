"""Personal data, replaced by keyed surrogates of the same type and form.

Detected entities are brought to a canonical form. Each distinct one gets a surrogate made from a keyed hash: letters become
letters of the same script and case, digits become digits, card numbers keep their check digit, addresses stay addresses, and
a name becomes a name of the same gender and script (a Latin one where the script is neither Latin nor Cyrillic). An entity is
taken whole: a secret up to the end of its run, a name with all its words. The same entity gets the same surrogate in every document, and different
entities get different ones: where two would share one, or a surrogate is itself an entity of the corpus, all but the
smallest are made again with the next counter, until none is left.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm.frames import arrow_map, carried, column, released, settled

# Titles, names and their gender.
MALE_TITLES = ("Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Sr", "господин", "г-н")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Sra", "Señorita", "госпожа", "г-жа")
FIRST_NAMES = {
    ("latin", "m"): ("Adrian", "Bruno", "Colin", "Damian", "Edgar", "Felix", "Gavin", "Hugo", "Ivan", "Jonas", "Konrad", "Leon", "Marcus", "Nolan", "Oscar", "Pablo", "Quentin", "Ruben", "Simon", "Tobias"),
    ("latin", "f"): ("Alma", "Bianca", "Clara", "Diana", "Elena", "Flora", "Greta", "Helena", "Irene", "Julia", "Karla", "Lucia", "Marta", "Nadia", "Olivia", "Paula", "Rosa", "Silvia", "Teresa", "Vera"),
    ("greek", "m"): ("Άγγελος", "Γιώργος", "Δημήτρης", "Θωμάς", "Κώστας", "Λεωνίδας", "Νίκος", "Πέτρος", "Σπύρος", "Χρήστος"),
    ("greek", "f"): ("Άννα", "Βασιλική", "Γεωργία", "Δήμητρα", "Ειρήνη", "Ζωή", "Κατερίνα", "Μαρία", "Σοφία", "Χριστίνα"),
    ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Игорь", "Кирилл", "Максим", "Роман"),
    ("cyrillic", "f"): ("Алина", "Вера", "Галина", "Дарья", "Елена", "Инна", "Лидия", "Марина", "Нина", "Ольга"),
}
FAMILY_PARTS = {
    "latin": (("Bel", "Cor", "Dal", "Fen", "Gar", "Hol", "Lam", "Mar", "Nor", "Pel", "Ros", "Sel", "Tor", "Val", "Wen"), ("ba", "de", "ga", "le", "mo", "na", "pe", "ri", "so", "ta"), ("ler", "man", "nik", "ton", "rand", "sen", "well", "ford", "berg", "mont")),
    "greek": (("Αλεξ", "Βασ", "Γαλ", "Δημ", "Καρ", "Λαμπ", "Μαν", "Νικ", "Παπ", "Σταμ"), ("α", "ε", "ι", "ο"), ("ρας", "κης", "νος", "δης", "λος")),
    "cyrillic": (("Бел", "Вор", "Гор", "Дан", "Зай", "Кор", "Лаз", "Мар", "Ник", "Пет"), ("а", "е", "и", "о", "у"), ("нов", "лев", "рин", "сов", "тов")),
}

_TITLE = "|".join(sorted(map(re.escape, MALE_TITLES + FEMALE_TITLES), key=len, reverse=True))


def _class(*kinds: str) -> str:
    """All characters of some Unicode categories, as the inside of a character class."""
    ranges: list[list[int]] = []
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c)).startswith(kinds):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


_UPPER, _LETTER = _class("Lu", "Lt"), _class("L", "M")
#: A word of a name: inner apostrophes and capitals belong to it, a possessive s doesn't. Between words: spaces, hyphens, initials.
_NAME = rf"[{_UPPER}](?:(?:['’](?!s(?![{_LETTER}])))?[{_LETTER}]++)+"
_GAP = "[ \u00a0\u2010\u2011-]"
_PART = rf"(?!(?:{_TITLE})\b\.?[ \t][{_UPPER}])(?:[{_UPPER}]\.{_GAP}?)*{_NAME}"
_EMAIL = r"(?<![\w.+-])[\w+-]+(?:\.[\w+-]+)*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,24}(?![\w@])"
#: Types in the order in which they are looked for; a span belongs to the first that takes it.
PATTERNS = {
    "email": _EMAIL,
    "secret": rf"(?i:\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b[\"']?\s{{0,3}}[:=]\s{{0,3}}[\"']?)(?!{_EMAIL})(?P<secret>[A-Za-z0-9_\-+/=]{{12,}}[\w\-+/=]*(?:[.~:%@!$*^]+[\w\-+/=]+)*)",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w.-])\d{4}(?P<gap>[ -]?)\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}(?![\w]|[.-]\d)",
    "phone": r"(?<![\w+.-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]\d{3,4}(?![\w]|[.-]\d)|(?<![\w+])\+\d{8,15}(?!\w)",
    "person": rf"\b(?P<title>{_TITLE})\b\.?[ \t](?P<person>{_PART}(?:{_GAP}{_PART})*)",
}
_ALL = re.compile("|".join(f"(?P<{kind}_>{pattern})" for kind, pattern in PATTERNS.items()))
#: No text without one of these has an entity. Spark checks it before a text goes to Python. It is at least as wide as Python's
#: patterns: any decimal digit, and characters that Java's Unicode doesn't know yet; keys by Unicode case; titles without ``\b``.
HINT = rf"[\p{{Nd}}\p{{Cn}}@]|(?iu:token|secret|passw|key)|{_TITLE}"

LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GREEK, CYRILLIC = "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщыэюя"
DIGITS = "0123456789"
#: Rounds after which a surrogate may grow longer than its entity: its form has hardly room left.
ROUNDS = 12


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, canonical form)`` of all entities, in order, without overlap."""
    found = []
    for match in _ALL.finditer(text):
        kind = match.lastgroup[:-1] if match.lastgroup.endswith("_") else next(k for k in PATTERNS if match.group(k + "_") is not None)
        group = kind if kind in ("secret", "person") else kind + "_"
        start, end = match.span(group)
        value = match.group(group)
        if kind == "person":
            gender = "m" if match.group("title") in MALE_TITLES else "f"
            value = f"{gender}|{value}"
        found.append((start, end, kind, canonical(kind, value)))
    return found


def canonical(kind: str, value: str) -> str:
    """One form for all ways to write an entity: digits for numbers, lower case for mail addresses."""
    if kind in ("card", "phone", "ssn"):
        return re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    return unicodedata.normalize("NFC", value) if kind == "person" else value.lower() if kind == "email" else value


class _Stream:
    """Numbers below given limits, from a keyed hash of the entity and a counter."""

    def __init__(self, key: bytes, kind: str, value: str, counter: int):
        self.key, self.seed, self.n, self.left, self.state = key, f"{counter}|{kind}|{value}".encode("utf-8", "surrogatepass"), 0, 0, 0

    def below(self, limit: int) -> int:
        if self.left < 1 << 40:
            digest = hmac.new(self.key, self.n.to_bytes(4, "big") + self.seed, hashlib.sha256).digest()
            self.state, self.left, self.n = int.from_bytes(digest, "big"), 1 << 256, self.n + 1
        self.state, value = divmod(self.state, limit)
        self.left //= limit
        return value

    def of(self, choices: str | tuple) -> str:
        return choices[self.below(len(choices))]


def _alike(stream: _Stream, text: str) -> str:
    """Each letter by one of its script and case, each digit by a digit; anything else stays."""
    out = []
    for c in text:
        low = c.lower()
        pool = DIGITS if c.isdigit() else GREEK if low in GREEK else CYRILLIC if low in CYRILLIC else LOWER if c.isalpha() else ""
        new = stream.of(pool) if pool else c
        out.append(new.upper() if c.isupper() and pool != DIGITS else new)
    return "".join(out)


def _check_digit(digits: str) -> str:
    """The digit that makes the sum over doubled digits a multiple of ten."""
    total = sum(sum(divmod(int(d) * (2 - i % 2), 10)) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def _iban_check(country: str, body: str) -> str:
    """The two digits that make the number, its country behind it, 1 modulo 97."""
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}"


def _kept_of_address(value: str) -> list[str]:
    """The parts of an address that make it a private or a local one: a surrogate has them too."""
    parts = value.split(".")
    if parts[0] in ("10", "127"):
        return parts[:1]
    private = parts[:2] in (["192", "168"], ["169", "254"]) or (parts[0] == "172" and 16 <= int(parts[1]) < 32)
    return parts[:2] if private else []


def _script(word: str) -> str:
    return "cyrillic" if re.search("[\u0400-\u052f]", word) else "greek" if re.search("[\u0370-\u03ff\u1f00-\u1fff]", word) else "latin"


def _words(value: str) -> tuple[str, list[str]]:
    """Gender, and the words of a name at even places with what is between them."""
    gender, _, name = value.partition("|")
    return gender, re.split(rf"({_GAP}|(?<=\.))", name)


def _initial(word: str) -> bool:
    return len(word) < 3 and word[-1:] in ("", ".") and all(c.lower() in LOWER + GREEK + CYRILLIC for c in word[:-1])


def name_parts(value: str) -> list[tuple[str, str]]:
    """``(kind, part)`` of the words of a canonical name but its initials: the last one is the family's, the others are given.

    A part has a surrogate of its own, so that ``John Smith`` and ``Smith`` share one. Its gender goes with it where names show it.
    """
    gender, words = _words(value)
    last = len(words) - 1
    shown = gender if _script(words[last]) == "cyrillic" and gender == "f" else ""
    return [("family", f"{shown}|{w}") if i == last else ("given", f"{gender}|{w}") for i, w in enumerate(words) if i == last or not (i % 2 or _initial(w))]


def composed(key: bytes, value: str, parts: list[str]) -> str:
    """A name's surrogate from those of its parts. Initials go by a keyed order of their alphabet, so different ones stay so."""
    gender, words = _words(value)
    rest = iter(parts)

    def turned(word: str) -> str:
        if not word[:-1]:
            return word
        low = word[0].lower()
        pool = next(p for p in (LOWER, GREEK, CYRILLIC) if low in p)
        order = sorted(pool, key=lambda c: hmac.new(key, f"initial|{c}".encode(), hashlib.sha256).digest())
        return order[pool.index(low)].upper() + word[1:]

    last = len(words) - 1
    return f"{gender}|" + "".join(w if i % 2 else turned(w) if i < last and _initial(w) else next(rest).partition("|")[2] for i, w in enumerate(words))


def surrogate(key: bytes, kind: str, value: str, counter: int = 0) -> str:
    """The surrogate of a canonical form, as a canonical form itself."""
    stream = _Stream(key, kind, value, counter)
    grown = "".join(stream.of(DIGITS) for _ in range(max(0, counter - ROUNDS)))
    if kind == "email":
        local, _, host = value.partition("@")
        *labels, top = host.split(".")
        return f"{_alike(stream, local)}{grown}@{'.'.join(_alike(stream, x) for x in labels)}.{top}"
    if kind == "ip":
        kept = _kept_of_address(value)
        return ".".join(kept + [str(stream.below(256)) for _ in range(4 - len(kept))])
    if kind == "card":
        valid = len(value) > 1 and _check_digit(value[:-1]) == value[-1]
        body = "".join(stream.of(DIGITS) for _ in value[:-1]) + grown
        check = _check_digit(body)
        return body + (check if valid else str((int(check) + 1 + stream.below(9)) % 10))
    if kind == "secret" and re.fullmatch(r"[0-9a-f]+", value):
        return "".join(stream.of("0123456789abcdef") for _ in value) + grown
    if kind == "iban":
        body = _alike(stream, value[4:]) + grown
        check = _iban_check(value[:2], body)
        return value[:2] + (check if _iban_check(value[:2], value[4:]) == value[2:4] else f"{(int(check) + 1 + stream.below(96)) % 100:02d}") + body
    if kind == "given":
        gender, _, word = value.partition("|")
        names = FIRST_NAMES[_script(word), gender]
        return f"{gender}|{stream.of(names)}{''.join(stream.of(names).lower() for _ in range(counter))}"
    if kind == "family":
        gender, _, word = value.partition("|")
        heads, middles, tails = FAMILY_PARTS[_script(word)]
        return f"{gender}|{stream.of(heads)}{''.join(stream.of(middles) for _ in range(1 + counter))}{stream.of(tails)}{'а' if gender == 'f' else ''}"
    if kind == "person":
        return composed(key, value, [surrogate(key, *part, counter) for part in name_parts(value)])
    return _alike(stream, value) + grown


def in_form(kind: str, written: str, new: str) -> str:
    """The surrogate in the way the entity was written: separators and cases as there."""
    if kind == "person":
        return new.partition("|")[2]
    if kind in ("card", "phone", "ssn", "iban"):
        rest = iter(new)
        formed = "".join(next(rest, "") if c.isalnum() else c for c in written)
        return formed + "".join(rest)
    if kind == "email":
        return "".join(n.upper() if w.isupper() else n for w, n in zip(written, new)) + new[len(written) :]
    return new


# On Spark


def _made(rows: Iterator[tuple], key: bytes, counter: int) -> Iterable[tuple]:
    for kind, value in rows:
        yield kind, value, surrogate(key, kind, value, counter)


def surrogates_of(found: DataFrame, key: bytes, first: int = 0, limit: int = 64) -> DataFrame:
    """``kind, value, new`` for distinct entities (``kind, value``). Different entities of a kind get different surrogates,
    and none that is itself an entity."""
    waiting, counter, done = found, first, None
    while True:
        made = settled(arrow_map(waiting.select("kind", "value"), _made, "kind string, value string, new string", key, counter), "made")
        taken = found.select("kind", F.col("value").alias("new"))
        if done is not None:
            taken = taken.union(done.select("kind", "new"))
        free = made.join(taken, ["kind", "new"], "left_anti")
        winners = free.groupBy("kind", "new").agg(F.min("value").alias("value")).select("kind", "value", "new")
        done = settled(winners if done is None else done.union(winners), "surrogates")
        waiting = settled(waiting.join(done, ["kind", "value"], "left_anti"), "waiting")
        if not waiting.limit(1).count():
            return done
        counter += 1
        if counter - first > limit:
            raise ValueError("no free surrogates are left for some entities")


def _taken_apart(rows: Iterator[tuple]) -> Iterable[tuple]:
    for (value,) in rows:
        for place, (kind, part) in enumerate(name_parts(value)):
            yield value, place, kind, part


def _put_together(rows: Iterator[tuple], key: bytes) -> Iterable[tuple]:
    for value, parts in rows:
        yield "person", value, composed(key, value, [p["new"] for p in parts])


def coreferent(found: DataFrame, key: bytes) -> DataFrame:
    """``kind, value, new`` for distinct entities, names part by part: who shares a part of a name shares its surrogate.

    Different parts get different surrogates, so different names do, too.
    """
    names = found.where("kind = 'person'").select("value")
    parts = settled(arrow_map(names, _taken_apart, "name string, place int, kind string, value string"), "name-parts")
    others = found.where("kind <> 'person'").select("kind", "value")
    made = surrogates_of(settled(others.union(parts.select("kind", "value").distinct()), "distinct"), key)
    whole = parts.join(made, ["kind", "value"]).groupBy("name").agg(F.sort_array(F.collect_list(F.struct("place", "new"))).alias("parts"))
    whole = arrow_map(whole, _put_together, "kind string, value string, new string", key)
    return made.where("kind NOT IN ('given', 'family')").select("kind", "value", "new").union(whole)


SPANS = T.ArrayType(
    T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType()).add("kind", T.StringType()).add("value", T.StringType())
)


@F.udf(returnType=SPANS, useArrow=True)
def _spans(text):
    return entities(text) if text else []


@F.udf(returnType=T.StringType(), useArrow=True)
def _rewritten(text, spans):
    parts, at = [], 0
    for start, end, kind, new in sorted((s["start"], s["end"], s["kind"], s["new"]) for s in spans):
        parts += [text[at:start], in_form(kind, text[start:end], new)]
        at = end
    return "".join([*parts, text[at:]])


def pseudonymised(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), ``new_text`` and ``n_entities``.

    Only documents with an entity are written aside and joined with their surrogates; all others pass by without a shuffle.
    Null and empty texts, and texts without entities, stay as they are. Repeated rows are each rewritten, alike. An empty
    table gives an empty table. ``docs`` should be a table, as it is read twice. The same key gives the same surrogates for
    the same table; keep it secret, as whoever has it can test guesses.
    """
    if not key:
        raise ValueError("a key is needed")
    body = column(text).cast("string")
    marked = carried(docs, text=body, spans=_spans(F.when(body.rlike(HINT), body)))
    clean = marked.where(F.size("spans") <= 0).select("row", F.col("text").alias("new_text"), F.lit(0).cast("long").alias("n_entities"))
    touched = marked.where(F.size("spans") > 0).withColumn("uid", F.monotonically_increasing_id())
    touched = settled(touched, "touched", compression="zstd")  # from here on the numbers are fixed
    places = touched.select("uid", F.explode("spans").alias("s")).select("uid", "s.*")
    names = coreferent(settled(places.select("kind", "value").distinct(), "entities"), key)
    new = places.join(names, ["kind", "value"]).groupBy("uid").agg(F.collect_list(F.struct("start", "end", "kind", "new")).alias("new_spans"))
    changed = touched.join(new, "uid").select("row", _rewritten("text", "new_spans").alias("new_text"), F.size("new_spans").cast("long").alias("n_entities"))
    return clean.union(changed)


def without_personal_data(docs: DataFrame, key: bytes, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with surrogates in ``text``, and its number of characters in ``length`` where there is such a column."""
    found = pseudonymised(docs, key, text)
    changed = F.col("n_entities") > 0
    new = {text: F.when(changed, F.col("new_text")).otherwise(F.col("row").getField(text))}
    if length in docs.columns:
        new[length] = F.when(changed, F.length("new_text").cast(docs.schema[length].dataType)).otherwise(F.col("row").getField(length))
    return released(found, docs.columns, **new)
