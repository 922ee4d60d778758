"""PII: format-preserving Feistel pseudonyms.

Validated values (payment card numbers, phone numbers, social security numbers, IBANs, IPv4 addresses, dates
and e-mail addresses) are replaced by other valid values of the same format.  A value is read as a number of
its format's domain, permuted by a keyed Feistel network on that domain (cycle walking keeps it inside), and
written back with its separators, so equal values get equal pseudonyms in every document, different values different
ones, and the mapping can be undone with the key (``undo``).  Check digits are recomputed, so a pseudonym validates as the original did; digit runs that
fail validation are left alone.  Where a value of one kind does not validate, the other kinds are tried at the same place; digits
grouped by both spaces and hyphens are no card if a phone or social security number is among them.

What is permuted: cards - all digits but the check digit and the first (the scheme); phones - the digits after the
country code (ten digits without one are a North American number, the same with +1 or without, and ten in pairs after a 0 a French
one); social security numbers - within the assignable area, group and serial ranges; IBANs - the account
digits and letters, then the check digits; IPv4 - all 32 bits; dates - the day within 1900-2099, days up to the 12th and
later ones each among themselves, so that a date reads the same way afterwards and is the same day in every notation;
e-mail - letters and digits of the local part, each within its kind (the domain is kept).
A pseudonym never equals its original: the permutation is a cyclic shift seen through the Feistel network (network,
shift by a keyed number other than 0, network backwards), which is one-to-one and moves every value.

Defined cases: NULL text stays NULL, empty text stays empty; texts of any length are searched whole; repeated rows
get equal results; other columns are returned as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import datetime
import hashlib
import hmac
import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from meterbill.llm.common import chunks, packed, unpacked

ROUNDS = 8
EPOCH = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - EPOCH
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# By kind, the first first; a value starts and ends where no letter or digit continues it.
PATTERNS = {
    "email": r"""(?<![\w.+-])(?P<email>[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24})(?![\w-])""",
    "iban": r"""(?<![\w])(?P<iban>[A-Z]{2}\d{2}(?:\ ?[A-Z0-9]{4}){2,7}(?:\ ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])""",
    "ip": r"""(?<![\w.+-])(?P<ip>(?:\d{1,3}\.){3}\d{1,3})(?![\w-]|\.\d)""",
    "date": r"""(?<![\w.-])(?P<date>(?:19|20)\d\d(?P<ds>[-/.])\d{1,2}(?P=ds)\d{1,2} | \d{1,2}(?P<es>[-/.])\d{1,2}(?P=es)(?:19|20)\d\d)(?=T\d\d:|(?![\w-]|\.\d))""",
    "ssn": r"""(?<![\w.-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])""",
    "card": r"""(?<![\w.+-])(?P<card>\d(?:[ -]?\d){12,18})(?![\w]|[.,-]\d)""",
    "phone": r"""(?<![\w.])(?P<phone>\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4} | \+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4} | \(\d{3}\)[ ]?\d{3}[ .-]\d{4} | \d{3}[.-]\d{3}[.-]\d{4} | 0[1-9](?:[ .]\d\d){4})(?![\w-])""",
}
FRENCH = re.compile(r"0[1-9](?:[ .]\d\d){4}")
FINDER = re.compile("|".join(PATTERNS.values()), re.X)
KINDS = {kind: re.compile(x, re.X) for kind, x in PATTERNS.items()}
# A text without any of these has no value of the kinds above.
HINT = re.compile(r"@|\d[\d ()./+-]{5}|[A-Z]{2}\d\d|\(\d")


def luhn_digit(digits: str) -> str:
    """The check digit that follows ``digits``."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 == 0 else 1)
        total += x - 9 if x > 9 else x
    return str(-total % 10)


def iban_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


@lru_cache(1)
def _days() -> tuple[list[int], list[int], list[int]]:
    """Numbers of the days up to the 12th of their month, of the later ones, and every day's place among its kind."""
    kinds, place = ([], []), []
    for n in range(DAYS):
        kind = kinds[datetime.date.fromordinal(EPOCH + n).day > 12]
        place.append(len(kind))
        kind.append(n)
    return *kinds, place


class Pseudonyms:
    """Keyed permutations of the formats' domains without fixed points; ``forward`` off gives the originals back."""

    def __init__(self, key: bytes, rounds: int = ROUNDS, forward: bool = True) -> None:
        self.key, self.rounds, self.forward = key, rounds, forward
        self.value = lru_cache(20_000)(self._value)

    def permute(self, x: int, size: int, tag: str, forward: bool = True) -> int:
        """A keyed bijection of range(size)."""
        if size < 2:
            return x
        left = math.isqrt(size - 1) + 1
        right = -(-size // left)
        step = self._forward if forward else self._backward
        x = step(x, left, right, tag)
        while x >= size:
            x = step(x, left, right, tag)
        return x

    def move(self, x: int, size: int, tag: str) -> int:
        """A keyed bijection of range(size) that leaves no number where it is (size 2 or more)."""
        if size < 2:
            return x
        by = 1 + self._round(0, size, tag + "|shift", size - 1)
        y = (self.permute(x, size, tag) + (by if self.forward else -by)) % size
        return self.permute(y, size, tag, False)

    def _round(self, k: int, half: int, tag: str, modulus: int) -> int:
        mac = hmac.digest(self.key, b"%d|%s|%d|%d" % (k, tag.encode(), modulus, half), hashlib.blake2b)
        return int.from_bytes(mac[:24], "big") % modulus

    def _forward(self, x: int, left: int, right: int, tag: str) -> int:
        a, b = divmod(x, right)
        for k in range(self.rounds):
            if k % 2 == 0:
                a = (a + self._round(k, b, tag, left)) % left
            else:
                b = (b + self._round(k, a, tag, right)) % right
        return a * right + b

    def _backward(self, x: int, left: int, right: int, tag: str) -> int:
        a, b = divmod(x, right)
        for k in reversed(range(self.rounds)):
            if k % 2 == 0:
                a = (a - self._round(k, b, tag, left)) % left
            else:
                b = (b - self._round(k, a, tag, right)) % right
        return a * right + b

    def symbols(self, text: str, tag: str) -> str:
        """Letters and digits of ``text`` permuted together, each place within its kind; the rest is kept."""
        kinds = [DIGITS if c in DIGITS else LOWER if c in LOWER else LOWER.upper() if c in LOWER.upper() else c for c in text]
        size, number = 1, 0
        for c, kind in zip(text, kinds):
            size *= len(kind)
            number = number * len(kind) + kind.index(c)
        shape = tag + "|" + "".join(k[0] if len(k) > 1 else "_" for k in kinds)
        y = self.move(number, size, shape)
        out = []
        for kind in reversed(kinds):
            y, at = divmod(y, len(kind))
            out.append(kind[at])
        return "".join(reversed(out))

    def _value(self, kind: str, text: str) -> str | None:
        """The pseudonym of a found value, None if it doesn't validate."""
        return getattr(self, "_" + kind)(text)

    def _email(self, text: str) -> str:
        local, at, domain = text.rpartition("@")
        return self.symbols(local, "email") + at + domain

    def _card(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        body = digits[0] + self.symbols(digits[1:-1], "card")
        return _refill(text, body + luhn_digit(body))

    def _iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or iban_check(plain[:2], plain[4:]) != plain[2:4]:
            return None
        body = self.symbols(plain[4:], "iban")
        return _refill(text, plain[:2] + iban_check(plain[:2], body) + body)

    def _ip(self, text: str) -> str | None:
        parts = [int(p) for p in text.split(".")]
        if max(parts) > 255:
            return None
        number = int.from_bytes(bytes(parts), "big")
        y = self.move(number, 1 << 32, "ip")
        return ".".join(map(str, y.to_bytes(4, "big")))

    def _ssn(self, text: str) -> str | None:
        area, group, serial = (int(x) for x in text.split("-"))
        if area in (0, 666) or area >= 900 or group == 0 or serial == 0:
            return None
        size = 898 * 99 * 9999
        number = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        y, serial = divmod(self.move(number, size, "ssn"), 9999)
        area, group = divmod(y, 99)
        area += 1
        return f"{area + (area >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"

    def _phone(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if not 9 <= len(digits) <= 15:
            return None
        if FRENCH.fullmatch(text):        # the 0 stands for the country code
            return _refill(text, "0" + self._subscriber("33", digits[1:]))
        if text[0] != "+":
            return _refill(text, self._subscriber("1", digits))
        code = re.match(r"\+(1|7|[2-9]\d{0,2}?)(?=\D|$)|\+(1|7|\d\d)", text)
        code = (code[1] or code[2]) if code else digits[:2]
        return _refill(text, code + self._subscriber(code, digits[len(code):]))

    def _subscriber(self, code: str, digits: str) -> str:
        """The digits after a country code; French ones start with no 0, before or after."""
        if code == "33" and len(digits) == 9 and digits[0] != "0":
            return str(10 ** 8 + self.move(int(digits) - 10 ** 8, 9 * 10 ** 8, "phone+33|french"))
        return self.symbols(digits, "phone+" + code)

    def _date(self, text: str) -> str | None:
        sep = re.search(r"\D", text)[0]
        a, b, c = text.split(sep)
        first = len(a) == 4
        widths = [len(x) for x in (a, b, c)]
        try:
            if first:
                order, day = "ymd", datetime.date(int(a), int(b), int(c))
            else:
                # day first, as most of the world writes it; month first where only that is a date
                order, day = ("dmy", datetime.date(int(c), int(b), int(a))) if int(b) <= 12 else ("mdy", datetime.date(int(c), int(a), int(b)))
        except ValueError:
            return None
        number = day.toordinal() - EPOCH
        *kinds, place = _days()
        kind = kinds[day.day > 12]
        y = kind[self.move(place[number], len(kind), f"date{day.day > 12:d}")]
        new = datetime.date.fromordinal(EPOCH + y)
        field = {"y": new.year, "m": new.month, "d": new.day}
        pad = 2 if any(w == 2 and x[0] == "0" for w, x in zip(widths, (a, b, c)) if w <= 2) else 1
        pad = 2 if all(w >= 2 for w in widths) else pad
        return sep.join(str(field[o]).zfill(4 if o == "y" else pad) for o in order)

    def replace(self, text: str | None) -> tuple[str | None, list[tuple[str, int, int]]]:
        """The text with its values replaced, and (kind, start, end) of each in the original."""
        if not text or not HINT.search(text):
            return text, []
        out, spans, at, look = [], [], 0, 0
        while m := FINDER.search(text, look):
            kind = m.lastgroup if m.lastgroup not in ("ds", "es") else "date"
            new = None
            for kind in list(KINDS)[list(KINDS).index(kind):]:      # no kind before it matches here
                if own := KINDS[kind].match(text, m.start()):
                    found = own.group(kind)
                    new = None if kind == "card" and _joined(text, *own.span()) else self.value(kind, found)
                    while new is None and " " in found:      # a shorter value before a space, as in a phone number before a card
                        found = found[:found.rfind(" ")]
                        joined = kind == "card" and _joined(text, m.start(), m.start() + len(found))
                        new = self.value(kind, found) if KINDS[kind].fullmatch(found) and not joined else None
                    if new is not None:
                        break
            if new is None:
                look = m.start() + 1
                continue
            out += [text[at:m.start()], new]
            at = look = m.start() + len(found)
            spans.append((kind, m.start(), at))
        return "".join(out) + text[at:], spans


def _joined(text: str, start: int, end: int) -> bool:
    """Whether digits grouped by both spaces and hyphens hold a phone or social security number, and so are no one card."""
    found = text[start:end]
    return " " in found and "-" in found and any(KINDS[k].search(text, start, end + 1) for k in ("ssn", "phone"))


def _refill(shape: str, symbols: str) -> str:
    """``symbols`` put in the places of the letters and digits of ``shape``."""
    rest = iter(symbols)
    return "".join(next(rest) if c.isalnum() else c for c in shape)


def undo(docs: DataFrame, key: bytes) -> DataFrame:
    """``pseudonymise`` backwards: every value again; a date without leading zeros may come back with them."""
    return pseudonymise(docs, key, forward=False)


def pseudonymise(docs: DataFrame, key: bytes, *, forward: bool = True) -> DataFrame:
    """All columns and rows of ``docs``, with ``text`` replaced; one pass, no shuffle."""
    rows = packed(docs)
    columns = docs.columns
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches):
        names = Pseudonyms(key, forward=forward)
        for piece in chunks(batches):
            row = piece.column(0)
            fields = [row.field(c) for c in columns]
            at = columns.index("text")
            fields[at] = pa.array([names.replace(t)[0] for t in fields[at].to_pylist()], row.type.field("text").type)
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(fields, names=columns)], names=["row"])

    return unpacked(rows.mapInArrow(run, f"row {kind}"), columns)


def findings(docs: DataFrame, key: bytes) -> DataFrame:
    """One row per document: doc_id, text (replaced), n_values, kinds (sorted, distinct), spans (kind, start, end)."""
    plain = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")

    def run_one(batch, names):
        got = [names.replace(t) for t in batch.column(1).to_pylist()]
        spans = pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for _, s in got],
                         pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([t for t, _ in got], pa.string()), pa.array([len(s) for _, s in got], pa.int32()),
             pa.array([sorted({k for k, _, _ in s}) for _, s in got], pa.list_(pa.string())), spans],
            names=["doc_id", "text", "n_values", "kinds", "spans"])

    def run(batches):
        names = Pseudonyms(key)
        for piece in chunks(batches):
            yield run_one(piece, names)

    return plain.mapInArrow(run, "doc_id long, text string, n_values int, kinds array<string>, "
                                 "spans array<struct<kind: string, start: int, end: int>>")
