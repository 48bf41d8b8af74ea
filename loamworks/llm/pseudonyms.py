"""Operator 9: format-preserving pseudonyms by a keyed Feistel permutation.

Personal numbers and dates are found by pattern and validated; each valid value
is permuted among the values of its format, so it keeps its form (length,
separators, check digits, a real calendar day) and equal values stay equal in
all documents, however they are separated.  With the key, values come back.

Kinds: card (Luhn), iban (mod 97), ssn (issued ranges), phone (national number
with an exchange code that can be dialled), ip (IPv4), date (calendar day 1900
to 2099), email (its local part's letters and digits).

A changed value is read again as the same kind and in the same way, or values
wouldn't come back: cycle walking goes on until it is.  So a date keeps its
order of day and month and how its parts are padded, and a phone number keeps
whether its area code can be assigned.

Defined results: a null text stays null with no values; an empty text stays
empty; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow import map_text

ROUNDS = 8
KINDS = ("card", "iban", "ssn", "phone", "ip", "date", "email")
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?\b",
    "phone": r"(?<![0-9A-Za-z+])(?:\+1[ .-]?)?(?:\([0-9]{3}\)[ ]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}(?P<d1>[./-])[0-9]{1,2}(?P=d1)[0-9]{1,2}|[0-9]{1,2}(?P<d2>[./-])[0-9]{1,2}(?P=d2)[0-9]{4})(?![0-9A-Za-z/-]|\.[0-9])",
    "ip": r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z-])",
}
_ANY = re.compile("|".join(f"(?P<{k}>{v})" for k, v in PATTERNS.items()), re.ASCII)
#: Every pattern needs one of these.
_MAY = re.compile(r"[@0-9]")
_GROUP = re.compile(r"[0-9]+")
CARD_DIGITS = 13


class Feistel:
    """A keyed permutation of ``range(n)``: balanced rounds on the next even power of two, walked into range."""

    def __init__(self, key: bytes) -> None:
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: str, i: int, half: int, bits: int) -> int:
        data = f"{tweak}/{bits}/{i}/{half}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=16).digest(), "little") & ((1 << bits) - 1)

    def _once(self, x: int, bits: int, tweak: str, order: range) -> int:
        left, right = x >> bits, x & ((1 << bits) - 1)
        if order.step > 0:
            for i in order:
                left, right = right, left ^ self._round(tweak, i, right, bits)
        else:
            for i in order:
                left, right = right ^ self._round(tweak, i, left, bits), left
        return left << bits | right

    def permute(self, x: int, n: int, tweak: str, back: bool = False) -> int:
        bits = max(1, -(-(n - 1).bit_length() // 2))
        order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
        while True:
            x = self._once(x, bits, tweak, order)
            if x < n:
                return x


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def shorter_cards(s: str) -> list[tuple[int, int]]:
    """Stretches of whole digit groups of ``s`` that may be a card, longest first, then by start.

    Of a stretch's groups only the last may have fewer than three digits, or
    columns of small numbers would give a valid one nearly always.
    """
    groups = [m.span() for m in _GROUP.finditer(s)]
    found = []
    for i, (a, _) in enumerate(groups):
        n = 0
        for c, b in groups[i:]:
            n += b - c
            if n >= CARD_DIGITS and b - a < len(s):
                found.append((-n, a, b))
            if b - c < 3:
                break
    return [(a, b) for _, a, b in sorted(found)]


def dialled(code: str) -> bool:
    """Whether an area or exchange code can be assigned: 2 to 9 first, and not N11."""
    return code[0] in "23456789" and code[1:] != "11"


def read_date(s: str) -> tuple[int, tuple[str, str, str]] | None:
    """Days since ``FIRST_DAY``, and the form: separator, order of the parts, padding of the first and last of day and month.

    Day comes before month unless only the other way is a calendar day.  A part
    is short (``s``: one digit), padded (``p``: 0 first) or full (two digits); a
    date with short parts only pads none, one with padded parts only pads all,
    and one with both (``sp`` or ``ps``) keeps each part as it is.
    """
    a, b, c = parts = re.split("[./-]", s)
    year_first = len(a) == 4
    kinds = "".join("s" if len(x) == 1 else "p" if x[0] == "0" else "" for x in (parts[1:] if year_first else parts[:2]))
    padding = kinds if set(kinds) == {"s", "p"} else "s" if "s" in kinds else "p"
    for order, (y, m, d) in (("ymd", parts),) if year_first else (("dmy", (c, b, a)), ("mdy", (c, a, b))):
        try:
            day = datetime.date(int(y), int(m), int(d)).toordinal()
        except ValueError:
            continue
        return (day - FIRST_DAY, (s[len(a)], order, padding)) if FIRST_DAY <= day <= LAST_DAY else None
    return None


def written_date(day: int, form: tuple[str, str, str]) -> str:
    mark, order, padding = form
    now = datetime.date.fromordinal(FIRST_DAY + day)
    parts = {"y": f"{now.year:04d}", "m": now.month, "d": now.day}
    places = iter(padding * 2 if len(padding) == 1 else padding)
    return mark.join(parts[k] if k == "y" else f"{parts[k]:02d}" if next(places) == "p" else str(parts[k]) for k in order)


def _refill(form: str, chars: str) -> str:
    """``form`` with its letters and digits replaced in turn."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in form)


def _iban_number(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s))


class Pseudonyms:
    """Replacements under one key; ``back`` undoes them."""

    def __init__(self, key: bytes, back: bool = False) -> None:
        self.feistel, self.back = Feistel(key), back
        self.known: dict[tuple[str, str], str | None] = {}

    def _number(self, digits: str, tweak: str) -> str:
        n = 10 ** len(digits)
        return str(self.feistel.permute(int(digits), n, f"{tweak}{len(digits)}", self.back)).zfill(len(digits)) if digits else ""

    def _mixed(self, chars: str, tweak: str) -> str:
        """Permute a string of letters and digits, each staying of its class."""
        sizes = [10 if c.isdigit() else 26 for c in chars]
        value, n = 0, 1
        for c, k in zip(chars, sizes, strict=True):
            value = value * k + (int(c) if k == 10 else ord(c.lower()) - 97)
            n *= k
        value = self.feistel.permute(value, n, tweak + "".join("9" if k == 10 else "a" for k in sizes), self.back)
        out = []
        for c, k in zip(reversed(chars), reversed(sizes), strict=True):
            value, r = divmod(value, k)
            out.append(str(r) if k == 10 else chr(97 + r).upper() if c.isupper() else chr(97 + r))
        return "".join(reversed(out))

    def card(self, s: str) -> str | None:
        digits = "".join(c for c in s if c.isdigit())
        if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        # Walked to a number that would take the same next check digit: digits around
        # a card then pass or fail together with it as before, and values come back.
        number = digits
        while True:
            payload = digits[0] + self._number(number[1:-1], f"card{digits[0]}")
            number = payload + luhn_digit(payload)
            if luhn_digit(number) == luhn_digit(digits):
                return _refill(s, number)

    def iban(self, s: str) -> str | None:
        plain = s.replace(" ", "")
        if not 15 <= len(plain) <= 34 or _iban_number(plain[4:] + plain[:4]) % 97 != 1:
            return None
        body = self._mixed(plain[4:], "iban" + plain[:2])
        return _refill(s, plain[:2] + f"{98 - _iban_number(body + plain[:2] + '00') % 97:02d}" + body)

    def ssn(self, s: str) -> str | None:
        area, group, serial = int(s[:3]), int(s[4:6]), int(s[7:])
        if area in (0, 666) or area > 899 or not group or not serial:
            return None
        areas = area - 1 - (area > 666)
        x = self.feistel.permute((areas * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "ssn", self.back)
        x, serial = divmod(x, 9999)
        areas, group = divmod(x, 99)
        return f"{areas + 1 + (areas >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def phone(self, s: str) -> str | None:
        at = 2 if s.startswith("+1") else 0
        digits = "".join(c for c in s[at:] if c.isdigit())
        if digits[:3] == "000" or not dialled(digits[3:6]):
            return None
        number = digits
        while True:
            number = self._number(number, "phone")
            if number[:3] != "000" and dialled(number[3:6]) and dialled(number[:3]) == dialled(digits[:3]):
                return s[:at] + _refill(s[at:], number)

    def ip(self, s: str) -> str | None:
        parts = [int(x) for x in s.split(".")]
        if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in s.split(".")):
            return None
        x = self.feistel.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip", self.back)
        return ".".join(map(str, x.to_bytes(4, "big")))

    def date(self, s: str) -> str | None:
        read = read_date(s)
        if read is None:
            return None
        day, form = read
        while True:
            day = self.feistel.permute(day, LAST_DAY - FIRST_DAY + 1, "date", self.back)
            new = written_date(day, form)
            if read_date(new) == (day, form):
                return new

    def email(self, s: str) -> str | None:
        local, _, domain = s.partition("@")
        chars = "".join(c for c in local if c.isalnum())
        return _refill(local, self._mixed(chars, "email")) + "@" + domain if chars else None

    def replace(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with pseudonyms, and how many values of each kind were replaced."""
        found = dict.fromkeys(KINDS, 0)
        if not _MAY.search(text):
            return text, found
        if len(self.known) > 100_000:
            self.known.clear()

        def known(kind: str, s: str) -> str | None:
            if (kind, s) not in self.known:
                self.known[kind, s] = getattr(self, kind)(s)
            return self.known[kind, s]

        out, done, at = [], 0, 0
        while m := _ANY.search(text, at):
            kind = m.lastgroup if m.lastgroup in PATTERNS else next(k for k in PATTERNS if m[k])
            start, end = m.span()
            new = known(kind, m[0])
            if new is None and kind == "card":
                for a, b in shorter_cards(m[0]):
                    if (new := known(kind, m[0][a:b])) is not None:
                        start, end = start + a, start + b
                        break
            if new is None:
                # What fails may hold or overlap a value; an e-mail's local part without letters can't.
                at = end if kind == "email" else start + 1
                continue
            found[kind] += 1
            out += [text[done:start], new]
            done = at = end
        return "".join(out) + text[done:], found


def pseudonymised(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """``doc_id, text, n_values`` and ``n_<kind>`` of every whole text; ``back`` restores."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        own = Pseudonyms(key, back)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            done = [(None, dict.fromkeys(KINDS, 0)) if t is None else own.replace(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([n[k] for _, n in done], pa.int64()) for k in KINDS]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([t for t, _ in done], pa.string()), pa.array([sum(n.values()) for _, n in done], pa.int64()), *columns], ["doc_id", "text", "n_values", *(f"n_{k}" for k in KINDS)])

        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_text(docs, make, f"doc_id {kind}, text string, n_values bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS))
