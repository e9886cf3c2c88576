"""Personal data replaced by format-preserving pseudonyms.

Values are found by pattern, validated (check digits, number plans, calendar),
turned into a whole number within the set of values of their format, and moved
to another number of that set by a keyed Feistel network. The pseudonym is thus
again a valid value of the same format, equal values get equal pseudonyms in
all documents, and the key's holder can go back. Numbers that fail validation
are not personal data of that kind and stay as they are.

The permutation is E^-1(E(x) + 1) for a Feistel network E on 0..n-1 (two
moduli whose product is n or little more; results beyond n go round again). It
has no fixed point, so no value is ever left as it was.

Kinds, in order of precedence where matches overlap: email (the local part's
letters and digits, each kept in its class), iban (mod 97), card (Luhn, first
digit kept), phone (North American plan, else the digits after the country
code), ssn, ipv4, date (years 1900-2099; ISO, or day and month before the year).

What stands beside a value doesn't hide it: groups of digits before or after a
card, words or numbers after an iban, the time after an ISO date. Digits after a
digit and a point are a fraction, not a card. Where more groups stand in a row
than a card has, the first valid ones count, so there going back needs the spans.

Defined cases: a null text stays null, an empty one empty; texts of any length
are read whole, in time that grows with their length; repeated rows get the same result; an empty table gives an empty
result. Other columns are untouched and may have any name.
"""

from __future__ import annotations

import bisect
import datetime
import functools
import hashlib
import itertools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.textkit import blocks

KINDS = ("email", "iban", "card", "phone", "ssn", "ipv4", "date")
ROUNDS = 10
#: Sets whose masks are remembered, and how many masks and pseudonyms are.
SMALL_SET, HELD_MASKS, HELD_VALUES = 1 << 20, 1 << 16, 1 << 16

_PATTERNS = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]++)@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])"),
    "card": re.compile(r"(?<![0-9A-Za-z])(?<![0-9]\.)(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9A-Za-z])"),
    "phone": re.compile(r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}[-. ][0-9]{4}|[0-9]{3}([-.])[0-9]{3}\1[0-9]{4})(?![0-9A-Za-z])(?![.-][0-9])"),
    "ssn": re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
    "ipv4": re.compile(r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z])(?!\.[0-9])"),
    "date": re.compile(r"(?<![0-9A-Za-z/.-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}(?=T[0-9]{2}|Z(?![0-9A-Za-z])|(?![0-9A-Za-z]))|[0-9]{1,2}([/.-])[0-9]{1,2}\1(?:19|20)[0-9]{2}(?![0-9A-Za-z]))(?![/.-][0-9])"),
}

#: Characters of an IBAN by country (fixed values; other countries are tried at every length).
_IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


class Feistel:
    """Keyed permutations of 0..n-1, one for every n and label."""

    def __init__(self, key: bytes) -> None:
        if not 1 <= len(key) <= 64:
            raise ValueError("the key has 1 to 64 bytes")
        self.key = key
        self._held: dict[tuple[str, int, int, int], int] = {}

    def _mask(self, label: str, n: int, turn: int, value: int, modulus: int) -> int:
        """What a turn adds. Small sets have few masks (20 times their root at most), so these are remembered."""
        if n > SMALL_SET:
            return self._fresh_mask(label, n, turn, value, modulus)
        place = (label, n, turn, value)
        if place not in self._held:
            if len(self._held) >= HELD_MASKS:
                self._held.clear()
            self._held[place] = self._fresh_mask(label, n, turn, value, modulus)
        return self._held[place]

    def _fresh_mask(self, label: str, n: int, turn: int, value: int, modulus: int) -> int:
        text = f"{label}:{n}:{turn}:{value}".encode()
        size = (modulus.bit_length() + 7) // 8 + 8  # 64 bits more than the modulus: no bias to speak of
        out = b"".join(hashlib.blake2b(text, key=self.key, digest_size=64, salt=i.to_bytes(16, "big")).digest() for i in range(-(-size // 64)))
        return int.from_bytes(out[:size], "big") % modulus

    def _turns(self, label: str, n: int, x: int, back: bool) -> int:
        root = _root(n)
        other = -(-n // root)
        while True:
            left, right = x % root, x // root  # left below root, right below other
            for turn in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
                sign = -1 if back else 1
                if turn % 2:
                    left = (left + sign * self._mask(label, n, turn, right, root)) % root
                else:
                    right = (right + sign * self._mask(label, n, turn, left, other)) % other
            x = right * root + left
            if x < n:
                return x

    def encrypt(self, label: str, n: int, x: int) -> int:
        return self._turns(label, n, x, False)

    def decrypt(self, label: str, n: int, x: int) -> int:
        return self._turns(label, n, x, True)

    def moved(self, label: str, n: int, x: int, by: int = 1) -> int:
        """Another number of 0..n-1 (n of 2 or more); ``by=-1`` goes back."""
        return self.decrypt(label, n, (self.encrypt(label, n, x) + by) % n)


def _root(n: int) -> int:
    x = int(n**0.5) if n < 1 << 52 else 1 << ((n.bit_length() + 1) // 2)
    while x * x > n:
        x = (x + n // x) // 2
    while (x + 1) * (x + 1) <= n:
        x += 1
    return max(1, x)


def to_number(digits: list[int], bases: list[int]) -> tuple[int, int]:
    """(number, count of numbers) of mixed-radix digits."""
    x, n = 0, 1
    for d, b in zip(digits, bases, strict=True):
        x, n = x * b + d, n * b
    return x, n


def to_digits(x: int, bases: list[int]) -> list[int]:
    out = []
    for b in reversed(bases):
        x, d = divmod(x, b)
        out.append(d)
    return out[::-1]


def luhn_digit(payload: str) -> int:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (1 if i % 2 else 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def iban_check(country: str, body: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}"


_ALPHABETS = {**{c: "0123456789" for c in "0123456789"}, **{c: "abcdefghijklmnopqrstuvwxyz" for c in "abcdefghijklmnopqrstuvwxyz"}, **{c: "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}}


@dataclass(frozen=True)
class Pseudonyms:
    """Replaces values of every kind, under one key; ``by=-1`` takes pseudonyms back to the values."""

    key: bytes
    by: int = 1

    def _moved(self, label: str, digits: list[int], bases: list[int]) -> list[int]:
        x, n = to_number(digits, bases)
        return to_digits(self._feistel.moved(label, n, x, self.by), bases)

    @functools.cached_property
    def _feistel(self) -> Feistel:
        return Feistel(self.key)

    @functools.cached_property
    def _known(self) -> dict[tuple[str, str], str | None]:
        """What values met before became, by kind."""
        return {}

    def _made(self, kind: str, m: re.Match) -> str | None:
        place = (kind, m[0])
        if place in self._known:
            return self._known[place]
        if len(self._known) >= HELD_VALUES:
            self._known.clear()
        make: Callable[[re.Match], str | None] = getattr(self, kind)
        self._known[place] = made = make(m)
        return made

    def _classes(self, label: str, text: str) -> str:
        """Letters and digits moved within their classes; other characters stay."""
        places = [i for i, c in enumerate(text) if c in _ALPHABETS]
        alphabets = [_ALPHABETS[text[i]] for i in places]
        moved = self._moved(f"{label}:{_shape(text)}", [a.index(text[i]) for i, a in zip(places, alphabets, strict=True)], [len(a) for a in alphabets])
        out = list(text)
        for i, a, d in zip(places, alphabets, moved, strict=True):
            out[i] = a[d]
        return "".join(out)

    def email(self, m: re.Match) -> str | None:
        """The local part has a letter or a digit. The domain, lower-cased, is part of the label: one person's name at two hosts isn't linked."""
        local, host = m[1], m[0][len(m[1]) :]
        if not any(c in _ALPHABETS for c in local):
            return None
        return self._classes(f"email:{host.lower()}", local) + host

    def iban(self, m: re.Match) -> str | None:
        """The pseudonym of the match's first characters that are valid: words and numbers may follow the value."""
        text = m[0]
        ends = [i for i in range(1, len(text) + 1) if i == len(text) or text[i] == " "]
        sizes = {e: e - text.count(" ", 0, e) for e in ends}
        own = _IBAN_LENGTHS.get(text[:2])
        for end in sorted((e for e in ends if 15 <= sizes[e] <= 34), key=lambda e: (sizes[e] != own, -e)):
            plain = text[:end].replace(" ", "")
            country, check, body = plain[:2], plain[2:4], plain[4:]
            if int("".join(str(int(c, 36)) for c in body + country + check)) % 97 == 1 and check == iban_check(country, body):
                body = self._classes(f"iban:{country}", body)
                return _filled(text[:end], country + iban_check(country, body) + body)
        return None

    def card(self, m: re.Match) -> str | None:
        plain = re.sub("[ -]", "", m[0])
        if luhn_digit(plain[:-1]) != int(plain[-1]) or len(set(plain)) == 1:
            return None
        middle = [int(c) for c in plain[1:-1]]
        moved = self._moved(f"card:{len(plain)}:{plain[0]}", middle, [10] * len(middle))
        payload = plain[0] + "".join(map(str, moved))
        return _filled(m[0], payload + str(luhn_digit(payload)))

    def phone(self, m: re.Match) -> str | None:
        digits = re.sub("[^0-9]", "", m[0])
        code = re.match(r"\+([0-9]{1,3})", m[0])
        lead = code[1] if code else ""
        if lead.startswith("1") and len(digits) == 11:
            lead = "1"
        rest = digits[len(lead) :]
        if len(rest) == 10 and lead in ("", "1"):
            bases = [8, 10, 10, 8, 10, 10, 10, 10, 10, 10]
            low = [2, 0, 0, 2, 0, 0, 0, 0, 0, 0]
            own = [int(c) - b for c, b in zip(rest, low, strict=True)]
            if min(own) >= 0:
                moved = self._moved("phone:plan", own, bases)
                return _filled(m[0], lead + "".join(str(d + b) for d, b in zip(moved, low, strict=True)))
        if not lead or not 7 <= len(digits) <= 15 or len(rest) < 4:
            return None
        return _filled(m[0], lead + "".join(map(str, self._moved(f"phone:{lead}:{len(rest)}", [int(c) for c in rest], [10] * len(rest)))))

    def ssn(self, m: re.Match) -> str | None:
        area, group, serial = map(int, m[0].split("-"))
        if not 1 <= area <= 899 or area == 666 or not group or not serial:
            return None
        area, group, serial = self._moved("ssn", [area - 1 - (area > 666), group - 1, serial - 1], [898, 99, 9999])
        area += 1
        return f"{area + (area >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"

    def ipv4(self, m: re.Match) -> str | None:
        parts = m[0].split(".")
        if any(int(p) > 255 or str(int(p)) != p for p in parts):
            return None
        return ".".join(map(str, self._moved("ipv4", [int(p) for p in parts], [256] * 4)))

    def date(self, m: re.Match) -> str | None:
        first, last = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
        mark = m[1] or "-"
        parts = [int(p) for p in m[0].split(mark)]
        orders = ("ymd",) if m[1] is None else ("dmy", "mdy")
        for order in orders:
            year, month, day = (parts[order.index(c)] for c in "ymd")
            try:
                own = datetime.date(year, month, day).toordinal()
            except ValueError:
                continue
            if order == "mdy":  # what can't be read day first: days after the 12th
                return self._month_first(year, month, day, mark, m[0])
            new = datetime.date.fromordinal(first + self._moved("date", [own - first], [last - first + 1])[0])
            if order == "ymd":
                return new.isoformat()
            return _date_text((new.day, new.month, new.year), mark, m[0])
        return None

    def _month_first(self, year: int, month: int, day: int, mark: str, text: str) -> str:
        """Moved among the dates of 1900-2099 whose day is after the 12th, so the result is read month first again."""
        ends = _days_after_the_12th()
        at = ends[(year - 1900) * 12 + month - 1] + day - 13
        at = self._moved("date:mdy", [at], [ends[-1]])[0]
        place = bisect.bisect_right(ends, at) - 1
        return _date_text((place % 12 + 1, at - ends[place] + 13, 1900 + place // 12), mark, text)

    def replaced(self, text: str) -> tuple[str, list[tuple[int, int, str]]]:
        """The text with pseudonyms, and (start, end, kind) of the values it had."""
        found: list[tuple[int, int, str, str]] = []
        taken = bytearray(len(text))
        for kind in KINDS:
            at = 0
            while m := _PATTERNS[kind].search(text, at):
                start = m.start()
                new = self._made(kind, m)
                end = start + len(new) if new is not None and kind == "iban" else m.end()
                if new is not None and not any(taken[start:end]):
                    found.append((start, end, kind, new))
                    taken[start:end] = b"\x01" * (end - start)
                    at = end
                else:  # a value may begin inside what isn't one
                    at = start + 1
        found.sort()
        out, at = [], 0
        for start, end, _, new in found:
            out += (text[at:start], new)
            at = end
        return "".join([*out, text[at:]]), [(s, e, k) for s, e, k, _ in found]


def _shape(text: str) -> str:
    return "".join("d" if c.isdigit() else "l" if c.islower() else "u" for c in text if c in _ALPHABETS)


def _filled(pattern: str, plain: str) -> str:
    """``plain`` with the separators of ``pattern``."""
    left = iter(plain)
    return "".join(next(left) if c.isalnum() else c for c in pattern)


@functools.cache
def _days_after_the_12th() -> list[int]:
    """Days after the 12th before each month of 1900-2099, and in all."""
    return list(itertools.accumulate((_days(y, m) - 12 for y in range(1900, 2100) for m in range(1, 13)), initial=0))


def _days(year: int, month: int) -> int:
    after = datetime.date(year + month // 12, month % 12 + 1, 1)
    return (after - datetime.timedelta(days=1)).day


def _date_text(parts: tuple[int, int, int], mark: str, like: str) -> str:
    """Two digits where the value had a leading zero or both values had two digits."""
    padded = all(len(p) == 2 for p in like.split(mark)[:2])
    return mark.join([*(f"{p:02d}" if padded else str(p) for p in parts[:2]), f"{parts[2]:04d}"])


_HINT = np.zeros(256, dtype=bool)
_HINT[list(b"0123456789@")] = True

RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_values", T.LongType()), T.StructField("spans", T.StringType())])


def pseudonym_column(key: bytes):
    """A column function text -> (text, n_values, spans as start:end:kind of the original, comma-joined)."""

    @F.arrow_udf(RESULT)
    def column(text: pa.Array) -> pa.Array:
        maker = Pseudonyms(key)

        def rows() -> Iterator[tuple[str | None, int, str]]:
            for low, high, texts in blocks(text):
                hinted = np.concatenate(([0], np.cumsum(_HINT[texts.data])))
                some = hinted[texts.offsets[1:]] > hinted[texts.offsets[:-1]]
                for own, wanted in zip(text.slice(low, high - low).to_pylist(), some.tolist(), strict=True):
                    new, spans = maker.replaced(own) if wanted else (own, [])
                    yield new, len(spans), ",".join(f"{s}:{e}:{k}" for s, e, k in spans)

        found = list(rows())
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.string())],
            names=[f.name for f in RESULT],
        )

    return column


def pseudonymised(text: Column, key: bytes) -> Column:
    return pseudonym_column(key)(text)["text"]


def replace(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, text with pseudonyms, n_values, spans."""
    return docs.select(F.col(id_col), pseudonym_column(key)(F.col(text_col)).alias("made")).select(id_col, "made.*")
