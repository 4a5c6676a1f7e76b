"""Personal data replaced by keyed surrogates of the same kind, gender, script and format.

Kinds: email, phone, ip (version 4), card (13 to 19 digits that pass the Luhn test), iban
(passing its check), ssn, and the parts of personal names: given names (female, male or of
unknown gender) and surnames, each of Latin, Cyrillic or Greek script. A name is what follows
an honorific or a cue such as "Dear" or "my name is", a listed given name and the capitalised
word after it, or a listed given name alone.

An entity is a kind and a canonical form (a phone number's digits, a lower-cased name), so
all ways to write it get one surrogate, written in the form found, capitals included:
coreference holds over the whole corpus.

Entities of one format (a kind with all that a surrogate keeps: the places of letters and digits,
a country, a network) are numbered, and a keyed permutation of the numbers, a Feistel network
that walks its cycles until it is back in range, deals the surrogates: attempt ``a`` of number x is
the number ``a + 1`` steps after x in the permuted order, so no entity is its own surrogate. Where
a format has few entities for its size, the candidates of all are checked together: one that two
entities share stays with the smaller and one that is itself an entity of the corpus goes to
nobody; who has none takes the next step, until all have one of their own. A format of which the
corpus holds over ``1 / CROWDED`` takes the first step for all: that is one to one even if every
value is taken, though a surrogate may then equal another entity. Names have no end of forms
and are drawn from BLAKE2, longer with each attempt. Attempts above 0 are few; up to
``MAX_BROADCAST`` of them are broadcast, more are joined to the texts that need them.

Null texts stay null; empty texts and texts without entities stay as they are. Repeated rows
and null ids are rows like any other; further columns are passed on only if asked for.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.session import materialize, spread_join, table
from quirework.llm.textvec import text_slices

MAX_BROADCAST = 50_000
#: A format of which the corpus holds more than one in so many values is dealt by the permutation alone.
CROWDED = 8
MAX_ATTEMPTS = 64
#: For the registered query over synthetic tables, where the session's setting ``quirework.surrogate.key`` is unset; the operator itself has no key of its own.
SAMPLE_KEY = "surrogates"

# Honorifics and given names.
HONORIFICS = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Sir": "m", "Madam": "f", "Dr": "u", "Prof": "u", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Señor": "m", "Señora": "f", "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f"}
GIVEN = {
    "f": "Anna Barbara Carmen Charlotte Christine Claire Elena Elizabeth Emily Emma Hannah Ingrid Isabel Jennifer Julia Karen Laura Linda Lucia Margaret Maria Marie Mary Monika Nancy Patricia Petra Sandra Sarah Sofia Susan Ursula Анна Елена Ирина Мария Наталья Ольга Светлана Татьяна Άννα Ελένη Κατερίνα Μαρία Σοφία".split(),
    "m": "Alexander Andreas Antonio Carlos Charles Christian Daniel David Francisco George Hans James Jean John Jorge Joseph Klaus Laurent Louis Manuel Martin Michael Miguel Nicolas Paul Peter Pierre Richard Robert Stefan Thomas William Александр Алексей Андрей Борис Дмитрий Иван Михаил Сергей Γιάννης Γιώργος Δημήτρης Κώστας Νίκος".split(),
}
#: Words after which capitalised words are a name.
CUES = ("my name is", "name is", "name:", "named", "signed", "Signed,", "Sincerely,", "Regards,", "Dear", "contact", "Contact:", "Liebe", "Lieber", "namens", "ich heiße", "Cher", "Chère", "je m'appelle", "Estimado", "Estimada", "me llamo")
SCRIPTS = {
    "latin": {"start": "ba be bo da do ga ha ja ka la le lo ma mi na no pa ra re ro sa se ta te to va vi wa".split(), "mid": "bel den gar kan lim mon ner pol ran sel tam ver win zor".split(), "f": "a ia ina elle".split(), "m": "o us an ert".split(), "u": "is in en el".split(), "s": "son berg ley er mann ez ier ton".split()},
    "cyrillic": {"start": "ба бе бо ва ве го да де за ка ко ла ле ма ми на но па ра ро са се та те".split(), "mid": "бел вен гор дан кол лин мар нер пол рам сел тон".split(), "f": "а ия ина ея".split(), "m": "ан ий ор ей".split(), "u": "ин ен ом ар".split(), "s": "ов ев ин".split()},
    "greek": {"start": "αλ βα γε δα ζη θε κα λε μα νι πα ρο σα τα φι χα".split(), "mid": "βελ γαρ δημ καλ λιν μαν νερ πολ ραν σελ".split(), "f": "α η ία ούλα".split(), "m": "ος ης ας ιος".split(), "u": "ις ον ιν ας".split(), "s": "ίδης άκης όπουλος άς".split()},
}

_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])")
_PHONE = re.compile(r"(?<![\w+.-])(?:\+(?P<cc>[1-9][0-9]{0,2})[ .-]?(?:\([0-9]{1,5}\)[ .-]?|(?=[0-9]))[0-9]{2,5}(?:[ .-][0-9]{2,5}){1,4}|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4})(?![\w-])")
#: Numbers that _PHONE leaves out: + and digits in one run or in long groups, ten digits as 3-3-4 with dots or blanks, and groups behind a leading zero.
_PHONE_MORE = re.compile(r"(?<![\w+.-])(?<![0-9][ .])(?:\+(?P<run>[1-9][0-9]{7,14})(?![0-9])|\+(?P<cc>[1-9][0-9]{0,2})[ .-](?:\(0\)[ .-]?)?(?:[0-9]{2,5}[ .-])?[0-9]{6,12}(?![0-9])|(?P<ten>\(?[2-9][0-9]{2}(?:\) ?|[ .-])[2-9][0-9]{2}[ .-][0-9]{4})(?![ .-]?[0-9])|(?P<zero>(?:\(0[0-9]{1,4}\) ?|0[0-9]{1,4}[ .-])[0-9]{2,8}(?:[ .-][0-9]{2,8}){0,4})(?![ .-]?[0-9]))(?![\w-])")
#: Country codes of one and two digits; all others have three.
_SHORT_CODES = {"1", "7", *"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()}
#: Digits alone, where a word before them says that they are a number to call.
_PHONE_CUED = re.compile(r"(?i:\b(?:tel|telephone|phone|call|mobile|cell|fax|telefon|teléfono|téléphone))[.:]?(?: (?:me|us|is|at|no\.?|number))?[ :]{1,2}(?P<n>[0-9]{7,12})(?![\w-])")
_IP = re.compile(r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\w]|\.[0-9])")
_CARD = re.compile(r"(?<![\w.-])[0-9](?:[ -]?[0-9]){12,18}(?![\w]|[ -]?[0-9])")
_SSN = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_NAME_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_DIGIT_PAIR = re.compile(r"[0-9][ .-]?[0-9]")
_LETTERS, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"


def _luhn(digits: str) -> bool:
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def _iban_rest(compact: str) -> int:
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97


def script_of(word: str) -> str:
    c = word[0]
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "greek" if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿" else "latin"


@lru_cache(maxsize=1)
def _lexicon():
    import ahocorasick

    a = ahocorasick.Automaton()
    for cue in CUES:
        a.add_word(cue, (len(cue), "cue", "u"))
    for word, gender in HONORIFICS.items():
        a.add_word(word, (len(word), "honorific", gender))
    for gender, words in GIVEN.items():
        for word in words:
            for form in {word, word.upper()}:
                a.add_word(form, (len(form), "given", gender))
    a.make_automaton()
    return a, {w.lower(): g for g, words in GIVEN.items() for w in words}


def _capital(word: str) -> bool:
    return word[0].isupper()


def _surname(word: str) -> tuple[str, str]:
    script, low = script_of(word), word.lower()
    if script == "cyrillic" and low.endswith(("ова", "ева", "ина")):
        low = low[:-1]
    return f"surname:{script}", low


def _names(text: str) -> list[tuple[int, int, str, str]]:
    """Spans of single words of names."""
    out = []
    automaton, listed = _lexicon()
    for end, (size, what, gender) in automaton.iter(text):
        start = end + 1 - size
        if (start and (text[start - 1].isalnum() or text[start - 1] in "_'’-")) or (end + 1 < len(text) and text[end].isalnum() and (text[end + 1].isalnum() or text[end + 1 : end + 3] in ("'s", "’s") and what != "given")):
            continue
        words, at = [], start
        if what != "given":
            at = end + 1
            if what == "honorific" and text[at : at + 1] == ".":
                at += 1
        while len(words) < 3:
            if words or what != "given":
                if text[at : at + 1] not in (" ", "\n") or words and text[at] == "\n":
                    break
                at += 1
            m = _NAME_WORD.match(text, at)
            if not m or not _capital(m.group()) or what != "given" and not words and m.group() in HONORIFICS:
                break
            word = m.group()[:-2] if m.group().endswith(("'s", "’s")) else m.group()
            words.append((at, at + len(word), word))
            at += len(word)
        if what == "given":
            words = words[:2]
            if words and words[0][1] != end + 1:  # a longer word that begins with a listed one
                continue
        for i, (a, z, word) in enumerate(words):
            if i < len(words) - 1 or len(words) == 1 and what != "honorific" and word.lower() in listed:
                g = listed.get(word.lower(), gender)
                out.append((a, z, f"given:{g}:{script_of(word)}", word.lower()))
            else:
                out.append((a, z, *_surname(word)))
    return out


def find_entities(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of all entities, in order and without overlap."""
    t = text or ""
    found = []
    if "@" in t:
        found += [(m.start(), m.end(), "email", m.group().lower()) for m in _EMAIL.finditer(t)]
    if _DIGIT_PAIR.search(t):
        for m in _IBAN.finditer(t):
            compact = m.group().replace(" ", "")
            if 15 <= len(compact) <= 34 and _iban_rest(compact) == 1:
                found.append((m.start(), m.end(), "iban", compact))
        for m in _CARD.finditer(t):
            digits = m.group().replace(" ", "").replace("-", "")
            if _luhn(digits) and digits.strip("0"):
                found.append((m.start(), m.end(), "card", digits))
        for m in _PHONE.finditer(t):
            digits = "".join(c for c in m.group() if c in _DIGITS)
            country = m["cc"] or "1"
            local = digits[len(m["cc"] or "") :]
            if 7 <= len(local) <= 14:
                found.append((m.start(), m.end(), "phone", f"{country}:{local}"))
        for m in _PHONE_MORE.finditer(t):
            digits = "".join(c for c in m.group() if c in _DIGITS)
            if m["zero"]:
                fits = 9 <= len(digits) <= (17 if digits.startswith("00") else 11) and not _IP.fullmatch(m.group())
                country, local = "", digits
            elif m["ten"]:
                fits, country, local = m.group().startswith("(") == (")" in m.group()), "1", digits
            else:
                country = m["cc"] or next((c for c in (digits[:1], digits[:2]) if c in _SHORT_CODES), digits[:3])
                fits, local = 8 <= len(digits) <= 15, digits[len(country) :]
            if fits:
                found.append((m.start(), m.end(), "phone", f"{country}:{local}"))
        for m in _PHONE_CUED.finditer(t):
            found.append((m.start("n"), m.end("n"), "phone", f"1:{m['n']}" if len(m["n"]) == 10 and m["n"][0] != "0" else f":{m['n']}"))
        for m in _IP.finditer(t):
            octets = [int(x) for x in m.group().split(".")]
            if max(octets) <= 255:
                found.append((m.start(), m.end(), "ip", ".".join(map(str, octets))))
        found += [(m.start(), m.end(), "ssn", m.group().replace("-", "")) for m in _SSN.finditer(t)]
    found += _names(t)
    # Of two readings of one span, a name with a gender comes first.
    found.sort(key=lambda s: (s[0], -s[1], ":u:" in s[2] or s[2].startswith("surname"), s[2:]))
    out, upto = [], 0
    for s in found:
        if s[0] >= upto:
            out.append(s)
            upto = s[1]
    return out


class _Draw:
    """An endless keyed stream of choices for one entity and attempt."""

    def __init__(self, key: bytes, *what):
        self._seed, self._key, self._count, self._left = "\0".join(map(str, what)).encode("utf-8", "surrogatepass"), key, 0, b""

    def number(self, n: int) -> int:
        if len(self._left) < 4:
            self._left += hashlib.blake2b(self._seed + self._count.to_bytes(4, "little"), key=self._key).digest()
            self._count += 1
        value, self._left = int.from_bytes(self._left[:4], "little"), self._left[4:]
        return value * n >> 32

    def pick(self, options):
        return options[self.number(len(options))]


_UPPER = _LETTERS.upper()
_PUBLIC = [x for x in range(1, 224) if x not in (10, 127, 172, 192)]


def _slots(text: str) -> tuple[str, list[str | None]]:
    """The format of a text, and for each place the symbols it may hold, none where it stays."""
    sets = [_DIGITS if c in _DIGITS else _LETTERS if c in _LETTERS else _UPPER if c in _UPPER else None for c in text]
    return "".join("9" if k is _DIGITS else "a" if k is _LETTERS else "A" if k is _UPPER else c for c, k in zip(text, sets)), sets


def numbered(kind: str, canonical: str) -> tuple[str, list[int], list[int]] | None:
    """An entity's format, the digits of its number and their radices; nothing for names."""
    if kind == "email":
        local, _, domain = canonical.partition("@")
        shape, sets = _slots(local)
        return f"email|{shape}@{domain}", [k.index(c) for c, k in zip(local, sets) if k], [len(k) for k in sets if k]
    if kind == "domain":
        shape, sets = _slots(canonical)
        return f"domain|{shape}", [k.index(c) for c, k in zip(canonical, sets) if k], [len(k) for k in sets if k]
    if kind == "phone":
        country, _, local = canonical.partition(":")
        zeros = len(local) - len(local.lstrip("0"))
        rest = local[zeros:]
        return f"phone|{country}:{'0' * zeros}{'9' * len(rest)}", [int(rest[0]) - 1, *map(int, rest[1:])] if rest else [], [9, *[10] * (len(rest) - 1)] if rest else []
    if kind == "ip":
        o = [int(x) for x in canonical.split(".")]
        kept = 2 if o[:2] == [192, 168] or o[0] == 172 and 16 <= o[1] <= 31 else 0 if o[0] in _PUBLIC else 1
        if not kept:
            return "ip|", [_PUBLIC.index(o[0]), *o[1:]], [len(_PUBLIC), 256, 256, 256]
        return "ip|" + ".".join(map(str, o[:kept])), o[kept:], [256] * (4 - kept)
    if kind == "card":
        return f"card|{canonical[0]}{len(canonical)}", [int(c) for c in canonical[1:-1]], [10] * (len(canonical) - 2)
    if kind == "iban":
        shape, sets = _slots(canonical[4:])
        return f"iban|{canonical[:2]}{shape}", [k.index(c) for c, k in zip(canonical[4:], sets) if k], [len(k) for k in sets if k]
    if kind == "ssn":
        return "ssn|", [int(c) for c in canonical], [10] * len(canonical)
    return None


def size_of(radices: list[int]) -> int:
    return math.prod(radices)


class Permutation:
    """A keyed permutation of the numbers below ``size``."""

    ROUNDS = 6

    def __init__(self, key: bytes, name: str, size: int):
        self._key, self._name, self.size = hashlib.blake2b(key).digest() if len(key) > 64 else key, name.encode("utf-8", "surrogatepass"), size
        self._half = max(1, ((size - 1).bit_length() + 1) // 2)

    def _mix(self, turn: int, value: int) -> int:
        width = self._half // 8 + 1
        h = hashlib.blake2b(self._name + bytes([0, turn]) + value.to_bytes(width, "little"), key=self._key, digest_size=min(64, width + 8))
        return int.from_bytes(h.digest(), "little") & ((1 << self._half) - 1)

    def _once(self, x: int, turns) -> int:
        left, right = x >> self._half, x & ((1 << self._half) - 1)
        for turn in turns:
            left, right = right, left ^ self._mix(turn, right)
        return right << self._half | left

    def forward(self, x: int) -> int:
        while True:
            x = self._once(x, range(self.ROUNDS))
            if x < self.size:
                return x

    def back(self, x: int) -> int:
        while True:
            x = self._once(x, range(self.ROUNDS - 1, -1, -1))
            if x < self.size:
                return x

    def step(self, x: int, steps: int) -> int:
        """The number ``steps`` after ``x`` in the permuted order."""
        return self.back((self.forward(x) + steps) % self.size)


def _permuted(key: bytes, kind: str, canonical: str, attempt: int) -> list[int]:
    shape, digits, radices = numbered(kind, canonical)
    x = 0
    for d, r in zip(digits, radices):
        x = x * r + d
    x = Permutation(key, shape, size_of(radices)).step(x, attempt + 1)
    out = []
    for r in reversed(radices):
        x, d = divmod(x, r)
        out.append(d)
    return out[::-1]


def _put(text: str, digits: list[int]) -> str:
    it = iter(digits)
    return "".join(k[next(it)] if k else c for c, k in zip(text, _slots(text)[1]))


@lru_cache(maxsize=50_000)
def surrogate(key: bytes, kind: str, canonical: str, attempt: int = 0) -> str:
    """The canonical form of an entity's surrogate."""
    if kind == "email":
        local, _, domain = canonical.partition("@")
        host, _, top = domain.rpartition(".")
        return f"{_put(local, _permuted(key, kind, canonical, attempt))}@{_put(host, _permuted(key, 'domain', host, 0))}.{top}"
    if kind == "phone":
        country, _, local = canonical.partition(":")
        digits = _permuted(key, kind, canonical, attempt)
        zeros = len(local) - len(digits)
        return f"{country}:{'0' * zeros}{''.join(str(d + (i == 0)) for i, d in enumerate(digits))}"
    if kind == "ip":
        digits = _permuted(key, kind, canonical, attempt)
        if len(digits) == 4:
            digits[0] = _PUBLIC[digits[0]]
        return ".".join([*canonical.split(".")[: 4 - len(digits)], *map(str, digits)])
    if kind == "card":
        body = canonical[0] + "".join(map(str, _permuted(key, kind, canonical, attempt)))
        return next(body + c for c in _DIGITS if _luhn(body + c))
    if kind == "iban":
        body = _put(canonical[4:], _permuted(key, kind, canonical, attempt))
        return f"{canonical[:2]}{98 - _iban_rest(canonical[:2] + '00' + body):02d}{body}"
    if kind == "ssn":
        return "".join(map(str, _permuted(key, kind, canonical, attempt)))
    d = _Draw(key, kind, canonical, attempt)
    parts = SCRIPTS[kind.rpartition(":")[2]]
    ending = parts["s" if kind.startswith("surname") else kind.split(":")[1]]
    middle = "".join(d.pick(parts["mid"]) for _ in range(1 + kind.startswith("surname") + attempt // 2))
    return d.pick(parts["start"]) + middle + d.pick(ending)


def written(kind: str, form: str, found: str) -> str:
    """A surrogate's canonical ``form`` in the way the original was ``found`` in a text."""
    if kind == "email":
        return "".join(f.upper() if o.isupper() else f for f, o in zip(form, found))
    if kind == "ip":
        return form
    if kind in ("phone", "card", "ssn", "iban"):
        country, _, digits = form.rpartition(":")
        if kind == "phone" and found.startswith("+"):
            head = 1 + len(country)
            return found[:head] + _filled(found[head:], digits)
        return _filled(found, digits)
    if kind == "surname:cyrillic" and found.lower().endswith(("ова", "ева", "ина")) and form.endswith(("ов", "ев", "ин")):
        form += "а"
    if len(found) > 1 and found.isupper():
        return form.upper()
    return form[:1].upper() + form[1:] if found[:1].isupper() else form


def _filled(pattern: str, symbols: str) -> str:
    it = iter(symbols)
    return "".join(next(it) if c.isalnum() else c for c in pattern)


def _entity_table(docs: DataFrame) -> DataFrame:
    """Distinct (text_key, kind, canon) of all texts; a text held by many rows counts once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "_text"):
                rows = {(k, kind, canon) for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for _, _, kind, canon in find_entities(t)}
                if rows:
                    keys, kinds, forms = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(kinds, pa.string()), pa.array(forms, pa.string())], ["text_key", "kind", "canon"])

    return docs.select("_key", "_text").mapInArrow(run, "text_key long, kind string, canon string").distinct()


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, canon, attempt, form: to every distinct (kind, canon) a form that no other has."""

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            told = [numbered(k, c) for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            size = [None if t is None else float(min(size_of(t[2]), 1 << 62)) for t in told]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([t and t[0] for t in told], pa.string()), pa.array(size, pa.float64())], ["kind", "canon", "shape", "size"])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds, canons, attempts = (b.column(c).to_pylist() for c in ("kind", "canon", "attempt"))
            forms = [surrogate(key, k, c, a) for k, c, a in zip(kinds, canons, attempts)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(forms, pa.string())], [*b.schema.names, "form"])

    step = "kind string, canon string, shape string, attempt int"
    shaped = materialize(entities.select("kind", "canon").mapInArrow(shapes, "kind string, canon string, shape string, size double"), "surrogate-formats")
    crowded = shaped.where("shape IS NOT NULL").groupBy("shape").agg(F.count("*").alias("n"), F.first("size").alias("size")).where(F.col("n") * CROWDED > F.col("size")).select("shape", F.lit(True).alias("crowded"))
    start = materialize(shaped.join(crowded, "shape", "left").select("kind", "canon", "shape", F.lit(0).alias("attempt"), F.coalesce("crowded", F.lit(False)).alias("crowded")), "surrogate-start")
    dealt = materialize(start.where("crowded").select("kind", "canon", "shape", "attempt").mapInArrow(draw, step + ", form string"), "surrogate-crowded")
    originals = start.where("NOT crowded").select("kind", F.col("canon").alias("form"))
    waiting, taken = start.where("NOT crowded").select("kind", "canon", "shape", "attempt"), None
    for _ in range(MAX_ATTEMPTS):
        drawn = materialize(waiting.mapInArrow(draw, step + ", form string"), "surrogate-draw")
        free = drawn.groupBy("kind", "form").agg(F.min("canon").alias("canon")).join(originals, ["kind", "form"], "left_anti")
        if taken is not None:
            free = free.join(taken.select("kind", "form"), ["kind", "form"], "left_anti")
        got = materialize(drawn.join(free.select("kind", "canon"), ["kind", "canon"], "left_semi"), "surrogate-taken")
        taken = got if taken is None else taken.union(got)
        if drawn.count() == got.count():
            break
        waiting = drawn.join(got, ["kind", "canon"], "left_anti").select("kind", "canon", "shape", (F.col("attempt") + 1).alias("attempt"))
    else:
        if waiting.where("shape IS NULL").limit(1).count():
            raise ValueError("no name left to draw")
        # Formats that still lack one take the first step for all, as crowded ones do.
        stuck = materialize(waiting.select("shape").distinct(), "surrogate-stuck")
        again = start.where("NOT crowded").join(stuck, "shape", "left_semi").select("kind", "canon", "shape", "attempt").mapInArrow(draw, step + ", form string")
        taken = taken.join(stuck, "shape", "left_anti").select("kind", "canon", "shape", "attempt", "form").union(again)
    return taken.union(dealt).select("kind", "canon", "attempt", "form")


def replace_entities(df: DataFrame, key: bytes, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """One row for each row of ``df``: ``keep``, n_entities, kinds (such as ``card:1,email:2``) and ``text_col`` with surrogates.

    Whoever knows ``key`` can compute the mapping; an empty one is refused.
    """
    if not key:
        raise ValueError("surrogates need a secret key")
    spark = df.sparkSession
    text = F.col(text_col)
    source = df.select(*keep, text.alias("_text"), F.xxhash64(text).alias("_key"))
    mentions = materialize(_entity_table(source), "entity-mentions")
    entities = materialize(mentions.select("kind", "canon").distinct(), "entities")
    again = materialize(assign(entities, key).where("attempt > 0").select("kind", "canon", "attempt"), "redrawn-entities")
    schema = df.select(*keep).schema.add("n_entities", "long").add("kinds", "string").add(text_col, "string")
    names = [*keep, "n_entities", "kinds", text_col]
    if again.count() <= max_broadcast:
        shipped = spark.sparkContext.broadcast({(r["kind"], r["canon"]): r["attempt"] for r in again.collect()})
        rows = source.select(*keep, "_text")
    else:
        shipped = None
        # What a text needs is bounded by its own entities; a text of very many rows is salted.
        own = mentions.join(again, ["kind", "canon"]).groupBy(F.col("text_key").alias("_key")).agg(F.collect_list(F.struct("kind", "canon", "attempt")).alias("_again"))
        stored = materialize(source, "texts-with-keys")
        held = stored.join(own.select("_key"), "_key", "left_semi").groupBy("_key").agg(F.count("*").alias("n"))
        rows = spread_join(stored, materialize(own.join(held, "_key"), "redrawn-by-text"), ["_key"], how="left").select(*keep, "_text", "_again")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        everywhere = shipped.value if shipped else {}
        for whole in batches:
            for b in text_slices(whole, "_text"):
                counts, kinds, texts = [], [], []
                local = b.column(len(keep) + 1).to_pylist() if shipped is None else [None] * b.num_rows
                for t, redrawn in zip(b.column(len(keep)).to_pylist(), local):
                    attempts = everywhere if shipped else {(r["kind"], r["canon"]): r["attempt"] for r in redrawn or []}
                    found = find_entities(t)
                    seen: dict[str, int] = {}
                    out, at = [], 0
                    for a, z, kind, canon in found:
                        out += [t[at:a], written(kind, surrogate(key, kind, canon, attempts.get((kind, canon), 0)), t[a:z])]
                        at = z
                        short = kind.partition(":")[0]
                        seen[short] = seen.get(short, 0) + 1
                    counts.append(len(found))
                    kinds.append(",".join(f"{k}:{n}" for k, n in sorted(seen.items())))
                    texts.append("".join([*out, t[at:]]) if found else t)
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(counts, pa.int64()), pa.array(kinds, pa.string()), pa.array(texts, pa.string())], names)

    return rows.mapInArrow(run, schema)


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get("quirework.surrogate.key", SAMPLE_KEY).encode()
    return replace_entities(table(spark, sf_dir, "documents"), key)
