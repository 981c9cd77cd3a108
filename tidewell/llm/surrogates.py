"""Personal data replaced by surrogates that stay consistent over the whole corpus.

Detected entities are normalised, so that all spellings of one are the same. Every distinct entity gets a
surrogate of its own kind and format, drawn with a secret key: the same key gives the same surrogates in any order
of work. A candidate that equals a real entity, or another entity's surrogate, is drawn again with
the next number, until none collides; so distinct entities stay distinct and no surrogate is anybody's real data.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.storage import write_once

# After so many draws a surrogate may leave the narrower format (the number of digits of an IP address's parts).
STRICT_DRAWS = 12
# After so many draws, and again after as many, surrogates of fixed length get one more sign.
LONGER_DRAWS = 36
# The same for mail domains, of which short ones are soon used up.
LONGER_DOMAIN_DRAWS = 4

# Forms of address and what they say about gender; fixed values.
TITLES = {
    "f": "Mrs Ms Miss Madam Mme Mlle Madame Frau Señora Señorita Sra Srta Signora Госпожа Κυρία",
    "m": "Mr Sir Monsieur Herr Señor Sr Signor Господин Κύριος",
    "n": "Dr Prof Doctor Professor",
}
# Given names by script and gender: known ones, and surrogates to draw from; fixed values.
GIVEN = {
    "latin": {
        "f": "Anna Maria Laura Julia Sarah Emma Sofia Clara Elena Martha Alice Helen Irene Nina Paula Ruth Carmen Lucia Camille"
        " Chloe Ingrid Greta Heidi Ursula Mary Jane Linda Susan Karen Lisa",
        "m": "John Peter Paul Thomas Michael David Daniel Martin Robert James William Carlos Luis Pedro Jean Pierre Louis Hans"
        " Klaus Stefan Andreas Mark George Henry Frank Walter Oscar Victor Hugo Simon",
        "n": "Robin Alex Kim Sasha Charlie Jamie Jordan Taylor",
    },
    "cyrillic": {
        "f": "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Вера Нина Юлия Дарья",
        "m": "Иван Пётр Алексей Дмитрий Сергей Андрей Николай Михаил Павел Юрий Виктор Олег",
        "n": "Саша Женя Валя Слава",
    },
    "greek": {
        "f": "Μαρία Ελένη Σοφία Αννα Κατερίνα Ειρήνη Δήμητρα Ζωή",
        "m": "Γιώργος Δημήτρης Νίκος Γιάννης Κώστας Πέτρος Παύλος Ανδρέας",
        "n": "Άγγελος Αλέξης",
    },
}
# Syllables of surrogate names by script.
SYLLABLES = {
    "latin": "bar ben cor dal den fal gar hol kel lan mar mor nor pel ran sal tan tor val wen".split(),
    "cyrillic": "бор вал гор дан кол лад мар нов пол рад сол тур вер зор".split(),
    "greek": "βαλ γερ δαν καλ λαμ μαρ νικ παλ ρον σαλ τερ φιλ".split(),
}

# Letters to draw from by script.
LETTERS = {
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
}

def _any_of(words: Iterable[str]) -> str:
    """A pattern of words, tried by their first letter."""
    by: dict[str, list[str]] = {}
    for word in sorted(set(words)):
        by.setdefault(word[0], []).append(word[1:])
    return "(?:" + "|".join(f"{c}(?:{'|'.join(rests)})" for c, rests in by.items()) + ")"


_KNOWN = {n.lower(): g for by in GIVEN.values() for g, names in by.items() for n in names.split()}
_TITLE_OF = {t: g for g, titles in TITLES.items() for t in titles.split()}
_CAPITAL = r"[A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΩА-ЯЁ][^\W\d_]+(?:[-'’][^\W\d_]+)*"
_PATTERNS = {
    "secret": re.compile(
        r"(?i)\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|auth)\b\s*[=:]\s*"
        r"(?:(?P<q>[\"'])(?P<value>[^\"'\s]{8,})(?P=q)|(?P<bare>(?=[^\s\"']*\d)[^\s\"',;]{7,}[^\s\"',;.)\]}]))|\b(?P<access>(?-i:AKIA)[A-Z0-9]{16})\b"
    ),
    "email": re.compile(r"[\w.!#$%&'*+/=?^`{|}~-]*[\w+-]@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]*[A-Za-z0-9])+"),
    "iban": re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "card": re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])"),
    "ip": re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)(?!\w)"),
    "ip6": re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "phone": re.compile(
        r"(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}"
        r"|\d{3}[.-]\d{3}[.-]\d{4}|0\d{2,4}[ /]\d{3,4}[ -]?\d{3,4})(?!\w)"
    ),
    "name": re.compile(
        rf"\b(?P<title>{_any_of(_TITLE_OF)})\.? (?P<titled>{_CAPITAL}(?: {_CAPITAL}){{0,2}})"
        rf"|\b(?P<first>{_any_of(w for by in GIVEN.values() for names in by.values() for n in names.split() for w in (n, n.upper()))})"
        rf" (?P<rest>{_CAPITAL}(?: {_CAPITAL})?)"
    ),
}


def luhn_digit(digits: str) -> str:
    """The check digit that follows `digits`."""
    doubled = [int(d) * (2 if i % 2 == 0 else 1) for i, d in enumerate(reversed(digits))]
    return str(-sum(d - 9 if d > 9 else d for d in doubled) % 10)


def iban_digits(country: str, account: str) -> str:
    """The two check digits of an account number."""
    number = int("".join(str(int(c, 36)) for c in account + country + "00"))
    return f"{98 - number % 97:02d}"


def detect(text: str | None) -> list[tuple[int, int, str, str]]:
    """Entities as start and end (code points), kind and normal form, in order, none inside another.

    Once a name is found, its parts are looked for in the whole text: a capitalised word that equals one, in any
    case, is another mention of it.
    """
    found: list[tuple[int, int, str, str]] = []
    taken: list[tuple[int, int]] = []

    def add(start: int, end: int, kind: str, normal: str) -> None:
        if normal and all(end <= a or start >= b for a, b in taken):
            taken.append((start, end))
            found.append((start, end, kind, unicodedata.normalize("NFC", normal)))

    for kind, pattern in _PATTERNS.items():
        if kind == "ip6" and (text or "").count(":") < 2 or kind == "email" and "@" not in (text or ""):
            continue
        for match in pattern.finditer(text or ""):
            start, end, surface = match.start(), match.end(), match.group()
            digits = re.sub(r"\D", "", surface)
            if kind == "secret":
                part = next(p for p in ("value", "bare", "access") if match[p] is not None)
                add(match.start(part), match.end(part), kind, match[part])
            elif kind == "ip6":
                if _is_ip6(surface):
                    add(start, end, kind, surface.lower())
            elif kind == "name":
                _add_name(match, add)
            elif kind == "email":
                lead = len(surface) - len(surface.lstrip(".!#$%&'*/=?^`{|}~"))
                add(start + lead, end, kind, surface[lead:].lower())
            elif kind == "iban":
                plain = surface.replace(" ", "")
                if iban_digits(plain[:2], plain[4:]) == plain[2:4]:
                    add(start, end, kind, plain)
            elif kind == "card":
                if luhn_digit(digits[:-1]) == digits[-1]:
                    add(start, end, kind, digits)
            elif kind == "phone":
                if 8 <= len(digits) <= 15:
                    add(start, end, kind, digits)
            else:
                add(start, end, kind, digits if kind == "ssn" else surface)
    parts = {normal: kind for _, _, kind, normal in found if kind == "surname" or kind.startswith("given_")}
    if parts:
        again = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(parts)))})(?!\w)", re.IGNORECASE)
        for match in again.finditer(text):
            normal = match.group().lower()
            if match.group()[0].isupper() and normal in parts:
                add(match.start(), match.end(), parts[normal], normal)
    return sorted(found)


def _is_ip6(surface: str) -> bool:
    try:
        return len(surface) > 5 and any(c.isdigit() for c in surface) and bool(ipaddress.IPv6Address(surface))
    except ValueError:
        return False


def _add_name(match: re.Match, add) -> None:
    """Each word of a name is an entity of its own, so that parts of a name keep referring to it."""
    if match["title"]:
        at, words, gender = match.start("titled"), match["titled"].split(" "), _TITLE_OF[match["title"]]
        if len(words) == 1 and words[0].lower() not in _KNOWN:
            gender = None
    else:
        at, words, gender = match.start("first"), [match["first"], *match["rest"].split(" ")], "n"
    for i, word in enumerate(words):
        kind = "surname"
        if i == 0 and gender is not None:
            kind = "given_" + _KNOWN.get(word.lower(), gender)
        add(at, at + len(word), kind, word.lower())
        at += len(word) + 1


def script_of(word: str) -> str:
    first = unicodedata.name(word[0], "")
    return "cyrillic" if first.startswith("CYRILLIC") else "greek" if first.startswith("GREEK") else "latin"


class _Draw:
    """Numbers that follow from the key, the entity and the number of the draw."""

    def __init__(self, key: bytes, kind: str, normal: str, draw: int):
        self.seed = hmac.new(key, f"{kind}\0{normal}\0{draw}".encode(), hashlib.sha256).digest()
        self.bits, self.used = int.from_bytes(self.seed), 0

    def below(self, bound: int) -> int:
        if self.bits < bound << 64:
            self.used += 1
            self.bits = int.from_bytes(hashlib.sha512(self.seed + self.used.to_bytes(4)).digest())
        self.bits, out = divmod(self.bits, bound)
        return out

    def pick(self, options):
        return options[self.below(len(options))]

    def like(self, text: str) -> str:
        """The same text with every digit and letter replaced by one of its class and script."""
        hexadecimal = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text)
        out = []
        for c in text:
            if c.isdigit():
                out.append(self.pick("0123456789"))
            elif c.isalpha():
                small = self.pick("abcdef" if hexadecimal else LETTERS[script_of(c)])
                out.append(small.upper() if c.isupper() else small)
            else:
                out.append(c)
        return "".join(out)


def surrogate(key: bytes, kind: str, normal: str, draw: int = 0) -> str:
    """The `draw`-th candidate for an entity, in normal form."""
    own = _Draw(key, kind, normal, draw)
    longer = draw // LONGER_DRAWS
    if kind == "email":
        local, _, domain = normal.rpartition("@")
        # The domain is an entity of its own, replaced alike in all addresses.
        return own.like(local + "x" * longer) + "@" + surrogate(key, "domain", domain)
    if kind == "domain":
        rest, _, top = normal.rpartition(".")
        return own.like(rest + "x" * (draw // LONGER_DOMAIN_DRAWS)) + "." + top
    if kind == "ip6":
        return "".join(own.pick("0123456789abcdef") if c.isalnum() else c for c in normal)
    if kind == "card":
        body = normal[0] + own.like(normal[1:-1] + "0" * longer)
        return body + luhn_digit(body)
    if kind == "iban":
        account = own.like(normal[4:] + "0" * longer)
        return normal[:2] + iban_digits(normal[:2], account) + account
    if kind == "ip":
        if draw >= STRICT_DRAWS:
            return ".".join(str(own.below(254) + 1) for _ in range(4))
        bounds = {1: (1, 10), 2: (10, 100), 3: (100, 255)}
        return ".".join(str(a + own.below(b - a)) for a, b in (bounds[len(p)] for p in normal.split(".")))
    if kind == "phone":
        return normal[:1] + own.pick("23456789") + own.like(normal[2:] + "0" * longer)
    if kind.startswith("given_"):
        script = script_of(normal)
        names = GIVEN[script][kind[-1]].lower().split()
        more = "".join(own.pick(SYLLABLES[script]) for _ in range(draw // STRICT_DRAWS))
        return own.pick(names) + "-" * bool(more) + more
    if kind == "surname":
        parts = SYLLABLES[script_of(normal)]
        return "".join(own.pick(parts) for _ in range(2 + draw // STRICT_DRAWS + own.below(2)))
    if not any(c.isdigit() or c.isalpha() for c in normal):
        # Signs alone would be their own surrogate.
        normal = "x" * len(normal)
    return own.like(normal + ("0" if kind == "ssn" or normal.isdigit() else "a") * longer)


def shown(surface: str, core: str, kind: str) -> str:
    """A surrogate in the format of the surface it replaces."""
    if kind in ("phone", "card", "ssn", "iban"):
        signs = iter(core)
        return "".join(next(signs) if c.isalnum() else c for c in surface) + "".join(signs)
    if kind == "surname" or kind.startswith("given_"):
        if surface.isupper():
            return core.upper()
        return core.title() if surface[:1].isupper() else core
    if kind == "email":
        if surface.isupper():
            return core.upper()
        if len(surface) == len(core):
            return "".join(n.upper() if s.isupper() else n for s, n in zip(surface, core))
    return core


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("key", F.xxhash64("text"))


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, key (hash of the text), start, end, kind and normal of every entity in every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                (number, key, *entity)
                for number, key, text in zip(batch["id"], batch["key"], batch["text"])
                for entity in detect(text)
            ]
            yield pd.DataFrame(out, columns=["id", "key", "start", "end", "kind", "normal"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, key bigint, start int, end int, kind string, normal string"
    return _rows(docs, id_col, text_col).filter("text IS NOT NULL").mapInPandas(run, schema)


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, normal and core, a surrogate no other entity has and that is no entity itself, of distinct (kind, normal).

    Given names of all genders, and surnames, count as one kind for this. Mail domains are entities too, given or not;
    an address takes its domain's surrogate and a local part that no other address of the domain has. Of entities
    that draw the same candidate the first by kind and normal form keeps it; the others draw again.
    """

    @F.pandas_udf("string")
    def candidate(kind: pd.Series, normal: pd.Series, draw: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, k, n, d) for k, n, d in zip(kind, normal, draw)], dtype=object)

    is_mail, domain = F.col("kind") == "email", F.substring_index("normal", "@", -1)
    local = F.expr("substring(normal, 1, length(normal) - length(substring_index(normal, '@', -1)) - 1)")
    domains = entities.filter(is_mail).select(F.lit("domain").alias("kind"), domain.alias("normal"))
    named = F.when(F.col("kind").startswith("given_"), F.lit("given")).otherwise(F.col("kind"))
    every = entities.select("kind", "normal").unionByName(domains).distinct()
    real = write_once(
        every.withColumns({
            "space": F.when(is_mail, F.concat(F.lit("email:"), domain)).otherwise(named),
            "own": F.when(is_mail, local).otherwise(F.col("normal")),
        }),
        "surrogate-entities",
    )
    waiting = real.drop("own").withColumn("draw", F.lit(0))
    done = None
    draw = 0
    while True:
        drawn = candidate("kind", "normal", "draw")
        tried = waiting.withColumn("core", drawn)
        tried = tried.withColumn("core", F.when(is_mail, F.substring_index("core", "@", 1)).otherwise(F.col("core")))
        tried = write_once(tried, "surrogate-draw")
        free = tried.join(real.select("space", F.col("own").alias("core")).distinct(), ["space", "core"], "left_anti")
        if done is not None:
            free = free.join(done.select("space", "core"), ["space", "core"], "left_anti")
        first = free.groupBy("space", "core").agg(F.min(F.struct("kind", "normal")).alias("one"))
        won = write_once(first.select("space", "core", "one.kind", "one.normal"), "surrogate-done")
        done = won if done is None else done.unionByName(won)
        waiting = tried.join(won.select("kind", "normal"), ["kind", "normal"], "left_anti")
        waiting = write_once(waiting.withColumn("draw", F.lit(draw + 1)).drop("core"), "surrogate-waiting")
        if waiting.isEmpty():
            break
        draw += 1
    done = done.withColumn("domain", F.when(is_mail, domain))
    of_domain = done.filter("kind = 'domain'").select(F.col("normal").alias("domain"), F.col("core").alias("at"))
    whole = F.when(is_mail, F.concat("core", F.lit("@"), F.col("at"))).otherwise(F.col("core"))
    mails = done.filter(is_mail).join(of_domain, "domain").select("kind", "normal", whole.alias("core"))
    return done.filter(~is_mail).select("kind", "normal", "core").unionByName(mails)


def replace(
    docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, text with surrogates, replaced (number of entities) and kinds (sorted, distinct) of every row.

    A null text stays null, a text without entities is unchanged. Repeated rows get equal results.
    """
    found = write_once(mentions(docs, id_col, text_col), "surrogate-mentions")
    cores = assign(found.select("kind", "normal").distinct(), key)
    spans = (
        found.join(cores, ["kind", "normal"])
        .groupBy("id", "key")
        .agg(F.sort_array(F.collect_set(F.struct("start", "end", "kind", "core"))).alias("spans"))
    )

    @F.pandas_udf("string")
    def rewritten(texts: pd.Series, starts: pd.Series, ends: pd.Series, kinds: pd.Series, news: pd.Series) -> pd.Series:
        out = []
        for text, some in zip(texts, zip(starts, ends, kinds, news)):
            if text is not None and some[0] is not None:
                parts, at = [], 0
                for start, end, kind, core in zip(*some):
                    parts += [text[at:start], shown(text[start:end], core, kind)]
                    at = end
                text = "".join([*parts, text[at:]])
            out.append(text)
        return pd.Series(out, dtype=object)

    rows = _rows(docs, id_col, text_col).alias("r")
    same = F.col("r.id").eqNullSafe(F.col("s.id")) & (F.col("r.key") == F.col("s.key"))
    joined = rows.join(spans.alias("s"), same, "left")
    fields = [F.col(f"s.spans.{f}") for f in ("start", "end", "kind", "core")]
    return joined.select(
        F.col("r.id").alias(id_col),
        rewritten(F.col("r.text"), *fields).alias("text"),
        F.coalesce(F.size("s.spans"), F.lit(0)).cast("bigint").alias("replaced"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct("s.spans.kind")), ","), F.lit("")).alias("kinds"),
    )
