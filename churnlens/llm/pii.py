"""Format-preserving pseudonyms for personal data.

Found and validated values are permuted within their own format by a keyed
permutation: a card number becomes another card number of the same length,
issuer prefix and valid check digit, a date another date written the same way.
The permutation of n values is a balanced Feistel network on the next even
number of bits, walked until it lands below n, and conjugated with a shift by
one, so that no value is its own pseudonym.  Equal values get equal pseudonyms
in every document and task, and the holder of the key can invert them; nothing
is shared between tasks, so there is no table of values and no shuffle.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from churnlens.llm.tables import importable

ROUNDS = 8


class Permutation:
    """A keyed permutation of range(n) without fixed points (n >= 2)."""

    def __init__(self, key: bytes, tweak: str, n: int):
        self.n = n
        self.half = max(1, ((n - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.bytes = (self.half + 7) // 8
        self.base = hashlib.blake2b(f"{tweak}|{n}".encode(), key=key[:64], digest_size=32).digest()

    def _round(self, i: int, x: int) -> int:
        h = hashlib.blake2b(x.to_bytes(self.bytes, "little"), key=self.base, salt=bytes([i]),
                            digest_size=min(64, self.bytes))
        return int.from_bytes(h.digest(), "little") & self.mask

    def _feistel(self, x: int) -> int:
        while True:
            a, b = x >> self.half, x & self.mask
            for i in range(ROUNDS):
                a, b = b, a ^ self._round(i, b)
            x = a << self.half | b
            if x < self.n:
                return x

    def _inverse(self, x: int) -> int:
        while True:
            a, b = x >> self.half, x & self.mask
            for i in reversed(range(ROUNDS)):
                a, b = b ^ self._round(i, a), a
            x = a << self.half | b
            if x < self.n:
                return x

    def __call__(self, x: int, back: bool = False) -> int:
        return x if self.n < 2 else self._inverse((self._feistel(x) + (-1 if back else 1)) % self.n)


# --- formats: each maps a value to (tweak, size, index) and an index back ----

def luhn_digit(digits: str) -> str:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _card_prefix(digits: str) -> int:
    """Length of the issuer prefix of a card number of a known issuer, else 0."""
    n, two, three, four = len(digits), int(digits[:2]), int(digits[:3]), int(digits[:4])
    if digits[0] == "4" and n in (13, 16, 19):
        return 1
    if n == 16 and (51 <= two <= 55 or two == 65):
        return 2
    if n == 15 and two in (34, 37) or n == 14 and two in (36, 38, 39):
        return 2
    if n == 16 and 644 <= three <= 649 or n == 14 and 300 <= three <= 305:
        return 3
    if n == 16 and (2221 <= four <= 2720 or four == 6011 or 3528 <= four <= 3589):
        return 4
    return 0


def _into(template: str, digits: str) -> str:
    """``template`` with its digits replaced in order."""
    own = iter(digits)
    return "".join(next(own) if c.isdigit() else c for c in template)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def card(text: str, permute) -> str | None:
    d = _digits(text)
    prefix = _card_prefix(d)
    if not prefix or luhn_digit(d[:-1]) != d[-1]:
        return None
    free = len(d) - prefix - 1
    x = permute(f"card{d[:prefix]}", 10 ** free, int(d[prefix:-1]))
    new = d[:prefix] + str(x).zfill(free)
    return _into(text, new + luhn_digit(new))


def ipv4(text: str, permute) -> str | None:
    """Octets keep their number of digits."""
    parts = text.split(".")
    if any(int(x) > 255 or x != str(int(x)) for x in parts):
        return None
    low = [(0, 10, 100)[len(x) - 1] for x in parts]
    size = [(10, 90, 156)[len(x) - 1] for x in parts]
    total, x = 1, 0
    for p, a, n in zip(parts, low, size):
        total, x = total * n, x * n + int(p) - a
    x, out = permute("ip" + "".join(str(len(p)) for p in parts), total, x), []
    for a, n in zip(reversed(low), reversed(size)):
        x, r = divmod(x, n)
        out.append(str(a + r))
    return ".".join(reversed(out))


#: Country calling codes of one and of two digits; all others have three.
CODES_1 = ("1", "7")
CODES_2 = ("20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
           "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84",
           "86", "90", "91", "92", "93", "94", "95", "98")
#: Country of numbers without a code.
HOME_CODE = "1"


def phone(text: str, permute) -> str | None:
    """The national number moves, the country code stays; a number without a code
    is one of HOME_CODE.  Equal numbers are linked however they are written."""
    digits = _digits(text)
    if text[0] == "+":
        own = 1 if digits[:1] in CODES_1 else 2 if digits[:2] in CODES_2 else 3
        code = digits[:own]
    else:
        own = 1 if re.match(r"1[ .-]", text) else 0
        code = HOME_CODE
    at = 0  # behind the code's digits
    for c in text:
        if not own:
            break
        own, at = own - c.isdigit(), at + 1
    d = _digits(text[at:])
    if not 7 <= len(d) <= 14:
        return None
    x = permute(f"phone {code}", 10 ** len(d), int(d))
    return text[:at] + _into(text[at:], str(x).zfill(len(d)))


def us_number(text: str, permute) -> str | None:
    """ddd-dd-dddd with a valid area, group and serial."""
    area, group, serial = map(int, text.split("-"))
    areas = [a for a in range(1, 900) if a != 666]
    if area not in areas or not group or not serial:
        return None
    x = permute("ssn", 898 * 99 * 9999, (areas.index(area) * 99 + group - 1) * 9999 + serial - 1)
    x, serial = divmod(x, 9999)
    area, group = divmod(x, 99)
    return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


def iban(text: str, permute) -> str | None:
    """Country and letters stay, digits move, the check digits follow."""
    bare = text.replace(" ", "")
    as_number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(bare) <= 34 or as_number(bare[4:] + bare[:4]) % 97 != 1:
        return None
    d = _digits(bare[4:])
    if not d:
        return None
    x = permute("iban" + re.sub(r"\d", "0", bare[4:]) + bare[:2], 10 ** len(d), int(d))
    body = _into(bare[4:], str(x).zfill(len(d)))
    new = bare[:2] + f"{98 - as_number(body + bare[:2] + '00') % 97:02d}" + body
    own = iter(new)
    return "".join(c if c == " " else next(own) for c in text)


@functools.cache
def _days(late: bool) -> tuple[list[datetime.date], dict[datetime.date, int]]:
    """All dates from 1900 to 2099 behind the 12th of their month, or up to it."""
    first, last = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
    days = [d for d in map(datetime.date.fromordinal, range(first, last + 1)) if (d.day > 12) == late]
    return days, {d: i for i, d in enumerate(days)}


def date(text: str, permute) -> str | None:
    """The day moves and is written as it was: equal days are linked in all ways of
    writing.  Days up to the 12th stay so, and later ones too, so that month and day
    can be told apart before and after (both up to 12: the day is first)."""
    bare = _digits(text)
    ways = ([((0, 4), (4, 6), (6, 8))] if len(re.match(r"\d+", text).group()) == 4
            else [((4, 8), (2, 4), (0, 2)), ((4, 8), (0, 2), (2, 4))])
    for way in ways:
        try:
            day = datetime.date(*(int(bare[a:b]) for a, b in way))
        except ValueError:
            continue
        days, index = _days(day.day > 12)
        if day in index:
            new = days[permute(f"date {'late' if day.day > 12 else 'early'}", len(days), index[day])]
            parts = dict(zip(way, (f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}")))
            return _into(text, "".join(parts[k] for k in sorted(parts)))
    return None


def email(text: str, permute) -> str | None:
    """The local part moves, letter for letter and digit for digit."""
    local, at, domain = text.partition("@")
    sizes = [26 if c.isalpha() else 10 if c.isdigit() else 1 for c in local]
    total, x = 1, 0
    for c, n in zip(local, sizes):
        digit = ord(c.lower()) - 97 if n == 26 else int(c) if n == 10 else 0
        total, x = total * n, x * n + digit
    if total < 2:
        return None
    shape = "".join("a" if n == 26 else "0" if n == 10 else c for c, n in zip(local, sizes))
    x, out = permute(f"email {shape}@{domain.lower()}", total, x), []
    for c, n in zip(reversed(local), reversed(sizes)):
        x, r = divmod(x, n)
        new = chr(97 + r) if n == 26 else str(r) if n == 10 else c
        out.append(new.upper() if c.isupper() else new)
    return "".join(reversed(out)) + at + domain


FORMATS = {"email": email, "card": card, "ip": ipv4, "phone": phone, "ssn": us_number, "iban": iban, "date": date}

_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])")
#: Numbers start at a digit, `+digit` or `(digits`; each has four digits at least.
_START = re.compile(r"(?<![\w.+-])(?=(?:[ ()./+-]*\d){4})[\d+(]")
_SHAPES = [(kind, re.compile(x)) for kind, x in (
    ("ip", r"\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"),
    ("date", "(?:" + "|".join(rf"\d{{4}}{c}\d\d{c}\d\d|\d\d{c}\d\d{c}\d{{4}}" for c in ("-", "/", r"\."))
     + r")(?=T\d|\W|$)(?![-/.]\d)"),
    ("ssn", r"\d{3}-\d{2}-\d{4}(?![\w-])"))]
_GROUPS = re.compile(r"\d+(?:[ -]\d+)*")
_GROUP = re.compile(r"\d+(?!\w)")
_PHONE_ENDS = [re.compile(x) for x in (
    r"(?:\+\d{1,3}[ .-]?|1[ .-])?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w]|-\d)",
    *(rf"\+\d{{1,3}}(?:[ .-]?\(\d{{1,4}}\)\d{{0,4}})?(?:[ .-]\d{{2,12}}){{{n}}}(?![\w]|-\d)" for n in range(6, 0, -1)),
    r"\+\d{8,14}(?!\w)")]
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_DIGIT = re.compile(r"\d")


class Pseudonyms:
    """Finds values in texts and replaces them under one key."""

    def __init__(self, key: bytes, back: bool = False):
        if not key:
            raise ValueError("a key is needed")
        self.key, self.back = key, back
        self.value = functools.lru_cache(1 << 16)(self._value)
        self.permutation = functools.lru_cache(1 << 12)(lambda tweak, n: Permutation(self.key, tweak, n))

    def _value(self, kind: str, text: str) -> str | None:
        return FORMATS[kind](text, lambda tweak, n, x: self.permutation(tweak, n)(x, self.back))

    def _cards(self, text: str, start: int) -> Iterator[int]:
        """Where a card number from ``start`` on can end: at the digit groups' ends, the nearest first."""
        if not text[start].isdigit():
            return
        digits = 0
        for group in _GROUP.finditer(text, start, _GROUPS.match(text, start).end()):
            digits += group.end() - group.start()
            if digits > 19:
                return
            if digits > 12:
                yield group.end()

    def _valid(self, kind: str, text: str) -> bool:
        return self.value(kind, text) is not None

    def _readings(self, text: str, start: int) -> Iterator[tuple[str, int]]:
        """(kind, end) of what can stand at ``start``.  A phone number doesn't reach into a valid card number."""
        for kind, shape in _SHAPES:
            if m := shape.match(text, start):
                yield kind, m.end()
        for end in self._cards(text, start):
            yield "card", end
        for shape in _PHONE_ENDS:
            if m := shape.match(text, start):
                inner = ((g.start(), end) for g in _START.finditer(text, start + 1, m.end() + 64)
                         if g.start() < m.end() for end in self._cards(text, g.start()))
                if not any(self._valid("card", text[a:b]) for a, b in inner):
                    yield "phone", m.end()

    def spans(self, text: str) -> Iterator[tuple[int, int, str]]:
        """(start, end, kind) of all values, in order, apart.  At each start the first
        reading whose value is valid holds; without one the search goes on right after the start."""
        found: list[tuple[int, int, str]] = []
        if "@" in text:
            found += [(m.start(), m.end(), "email") for m in _EMAIL.finditer(text)]
        if _DIGIT.search(text):
            found += [(m.start(), m.end(), "iban") for m in _IBAN.finditer(text)]
            found += [(m.start(), len(text) + 1, "number") for m in _START.finditer(text)]
        upto = 0
        for start, end, kind in sorted(found):
            if start < upto:
                continue
            for k, e in self._readings(text, start) if kind == "number" else [(kind, end)]:
                if self._valid(k, text[start:e]):
                    yield start, e, k
                    upto = e
                    break

    def replace(self, text: str, spans: list[tuple[str, int, int]] | None = None) -> tuple[str, list[tuple[str, int, int]]]:
        """``text`` with its values replaced, and (kind, start, end) of each.

        A value's pseudonym depends on the value alone, never on what is beside it.
        The way back takes the ``spans`` of the way there, as every format keeps its
        length; without them the values are found again, which can differ where
        a pseudonym and a number beside it read as another value."""
        out, at, done = [], 0, []
        for start, end, kind in self.spans(text) if spans is None else [(a, b, k) for k, a, b in spans]:
            out += [text[at:start], self.value(kind, text[start:end])]
            done.append((kind, start, end))
            at = end
        return "".join([*out, text[at:]]), done


SPANS = "array<struct<kind:string,start:int,end:int>>"


def pseudonymised(docs: DataFrame, key: bytes, text_col: str = "text", spans_col: str | None = "pii",
                  back: bool = False) -> DataFrame:
    """``docs`` with the personal data of ``text_col`` replaced and, in
    ``spans_col``, where they were (kind, start and end in code points).

    Every format keeps its length.  ``back`` inverts a replaced text under the
    same key, by the spans in its column ``spans_col`` where it has one.  Null text stays null, with no spans; an empty table gives no
    rows; the other columns pass as they are (one named ``spans_col`` is
    replaced).  Numbers that fail their validity check stay as they are.
    """
    importable(docs.sparkSession)
    kept = [c for c in docs.columns if c != spans_col]
    known = back and spans_col in docs.columns
    base = docs.select(*[docs[c] for c in kept + [spans_col] * known])
    at = kept.index(text_col)
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pseudonyms = Pseudonyms(key, back)
        for batch in batches:
            texts, spans = [], []
            given = batch.column(len(kept)).to_pylist() if known else [None] * batch.num_rows
            for text, where in zip(batch.column(at).to_pylist(), given):
                where = [(x["kind"], x["start"], x["end"]) for x in where] if where is not None else None
                new, own = (None, []) if text is None else pseudonyms.replace(text, where)
                texts.append(new)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in own])
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(kept))]
            if spans_col:
                columns.append(pa.array(spans, span_type))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *([spans_col] if spans_col else [])])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema if f.name in kept]
    return base.mapInArrow(run, ", ".join(fields + ([f"`{spans_col}` {SPANS}"] if spans_col else [])))
