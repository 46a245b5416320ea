"""PII: format-preserving Feistel pseudonyms.

Validated values (card numbers by Luhn, IBANs by mod 97, calendar dates, IPv4 addresses, social
security and phone numbers by their numbering plans, e-mail addresses) become numbers below the size of
their format, go through a keyed Feistel permutation of exactly that range, and are written back in the
same format with check digits worked out anew (dates and phone numbers digit for digit as wide as they were). The permutation depends on the key and the kind alone:
equal values get equal pseudonyms in all documents, however they are punctuated, and different values
get different ones. What fails its check is left as it is.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import ipaddress
import math
import re
import string

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusprep.llm.common import for_workers, refuse

KINDS = ("email", "iban", "ip", "date", "ssn", "card", "phone")
ROUNDS = 10
# Years that stay among themselves: dates of the last and this century keep looking like such.
_YEARS = ((1, 1899), (1900, 2099), (2100, 9999))
# Country codes of two digits. 1 and 7 have one digit, all others three.
_TWO = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
# The first two digits of codes of three digits.
_THREE = frozenset("21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 69 80 85 87 88 96 97 99".split())
_MAIL_CHARS = frozenset(string.ascii_letters + string.digits + "._%+-")
_DOMAIN = re.compile(r"@((?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})\.)+[A-Za-z]{2,24})(?![A-Za-z0-9-])")
# tried at each place in this order; every alternative starts with a bounded run
_NUMBERS = re.compile(
    r"(?<![A-Za-z0-9])(?<![0-9]\.)(?:"
    r"(?P<iban>[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
    r"|(?P<ip>[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})(?!\.?[0-9])"
    r"|(?P<date>[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9])"
    r"|(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])"
    r"|(?P<phone>\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}|[2-9][0-9]{2}[ ][2-9][0-9]{2}[ ][0-9]{4})(?![0-9])"
    r"|(?P<abroad>\+[2-9][0-9]{0,2}(?:[ .-]?\(0\))?(?:[ .-]?[0-9]{1,5}){2,6})(?![0-9])"
    r"|(?P<card>[0-9](?:[ -]?[0-9]){12,18})(?![0-9])"
    r")")


class Pseudonyms:
    """Keyed permutations of the values of each kind."""

    def __init__(self, key: bytes):
        self.key = key

    @functools.lru_cache(maxsize=100_000)  # noqa: B019 - one object a worker
    def permute(self, x: int, size: int, kind: str) -> int:
        """A permutation of range(size): Feistel rounds over two digits of a mixed radix, walked
        along its cycle until the value is in range."""
        if size < 2:
            return x
        a = math.isqrt(size - 1) + 1
        b = -(-size // a)
        wide = (max(a, b).bit_length() + 7) // 8
        more = wide + 16  # so much longer than the modulus that its remainder is even
        while True:
            left, right = divmod(x, b)
            for i in range(ROUNDS):
                half = right if i % 2 == 0 else left
                data = f"{kind}:{size}:{i}:".encode() + half.to_bytes(wide, "big")
                digest = b""
                while len(digest) < more:
                    digest += hashlib.blake2b(data, key=self.key, salt=len(digest).to_bytes(16, "big")).digest()
                mask = int.from_bytes(digest[:more], "big")
                if i % 2 == 0:
                    left = (left + mask) % a
                else:
                    right = (right + mask) % b
            x = left * b + right
            if x < size:
                return x

    def _mixed(self, text: str, kind: str, alphabets: list[str]) -> str:
        """Permute a string whose i-th character comes from alphabets[i]."""
        x = 0
        for c, abc in zip(text, alphabets, strict=True):
            x = x * len(abc) + abc.index(c)
        x = self.permute(x, math.prod(map(len, alphabets)), kind)
        out = []
        for abc in reversed(alphabets):
            x, i = divmod(x, len(abc))
            out.append(abc[i])
        return "".join(reversed(out))

    def _by_class(self, text: str, kind: str) -> str:
        """Letters stay letters and digits digits; all else stays. The case is not part of the value."""
        low = text.lower()
        at = [i for i, c in enumerate(low) if c.isascii() and c.isalnum()]
        new = self._mixed("".join(low[i] for i in at), kind, [string.digits if low[i].isdigit() else string.ascii_lowercase for i in at])
        out = list(text)
        for i, c in zip(at, new, strict=True):
            out[i] = c.upper() if text[i].isupper() else c
        return "".join(out)

    def email(self, text: str) -> str | None:
        local, _, domain = text.rpartition("@")
        if not any(c.isalnum() for c in local):
            return None
        shape = "".join("0" if c.isdigit() else "a" if c.isalpha() else c for c in local)
        return self._by_class(local, f"email:{domain.lower()}:{shape}") + "@" + domain

    def card(self, text: str) -> str | None:
        digits = [c for c in text if c.isdigit()]
        if not 13 <= len(digits) <= 19 or luhn(digits) or len(set(digits)) == 1:
            return None
        body = "".join(digits[1:-1])
        new = digits[0] + self._mixed(body, f"card:{digits[0]}", [string.digits] * len(body))
        return _refill(text, new + next(d for d in string.digits if luhn([*new, d]) == 0))

    def iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or mod97(plain[4:] + plain[:4]) != 1:
            return None
        body = plain[4:]
        shape = "".join("0" if c.isdigit() else "A" for c in body)
        new = self._by_class(body, f"iban:{plain[:2]}:{shape}")
        check = 98 - mod97(new + plain[:2] + "00")
        return _refill(text, f"{plain[:2]}{check:02d}{new}", " ")

    def ip(self, text: str) -> str | None:
        try:
            x = int(ipaddress.IPv4Address(text))
        except ValueError:
            return None
        return str(ipaddress.IPv4Address(self.permute(x, 1 << 32, "ip")))

    def date(self, text: str) -> str | None:
        """Dates stay in their range of years, and days and months keep their number of digits."""
        iso = "-" in text
        sep = "-" if iso else "." if "." in text else "/"
        parts = text.split(sep)
        # (year, month, day) by the order of the parts: after a point the day comes first, after a slash the month, if it can
        orders = [(0, 1, 2)] if iso else [(2, 1, 0), (2, 0, 1)] if sep == "." else [(2, 0, 1), (2, 1, 0)]
        for y, m, d in orders:
            try:
                datetime.date(int(parts[y]), int(parts[m]), int(parts[d]))
            except ValueError:
                continue
            year, month, day = self._moved(int(parts[y]), int(parts[m]), int(parts[d]), len(parts[m]), len(parts[d]))
            new = [""] * 3
            new[y], new[m], new[d] = f"{year:04d}", f"{month:0{len(parts[m])}d}", f"{day:0{len(parts[d])}d}"
            return sep.join(new)
        return None

    def _moved(self, year: int, month: int, day: int, month_width: int, day_width: int) -> tuple[int, int, int]:
        first, last = next(r for r in _YEARS if r[0] <= year <= r[1])
        kind = "date" if (first, month_width, day_width) == (1900, 2, 2) else f"date:{first}:{month_width}:{day_width}"
        low, high = datetime.date(first, 1, 1).toordinal(), datetime.date(last, 12, 31).toordinal()
        at = datetime.date(year, month, day).toordinal()
        while True:  # along the cycle of all dates of the range to the next one that can be written so
            at = low + self.permute(at - low, high - low + 1, kind)
            new = datetime.date.fromordinal(at)
            if (month_width == 2 or new.month < 10) and (day_width == 2 or new.day < 10):
                return new.year, new.month, new.day

    def ssn(self, text: str) -> str | None:
        area, group, serial = (int(p) for p in text.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        x = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        x, serial = divmod(self.permute(x, 898 * 99 * 9999, "ssn"), 9999)
        area, group = divmod(x, 99)
        return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def phone(self, text: str) -> str | None:
        """Numbers of the plan stay in the plan. One that is outside it counts only with its country
        code, and gets another one outside."""
        digits = "".join(c for c in text if c.isdigit())
        country, own = (digits[:1], digits[1:]) if text.startswith("+") else ("", digits)
        if own[0] in "01" or own[3] in "01":
            if not country:
                return None
            new = own
            while new == own or not (new[0] in "01" or new[3] in "01"):
                new = self._mixed(new, "phone outside", [string.digits] * 10)
                if new == own:
                    break
            return _refill(text, country + new)
        abc = ["23456789", string.digits, string.digits] * 2 + [string.digits] * 4
        return _refill(text, country + self._mixed(own, "phone", abc))

    def abroad(self, text: str) -> str | None:
        """Numbers with a country code other than 1: the code and a trunk zero stay, the first digit stays no zero."""
        digits = "".join(c for c in text.replace("(0)", "") if c.isdigit())
        size = 1 if digits[0] == "7" else 2 if digits[:2] in _TWO else 3 if digits[:2] in _THREE else 0
        own = digits[size:]
        if not size or not 8 <= len(digits) <= 15 or len(own) < 6 or own[0] == "0":
            return None
        new = self._mixed(own, f"phone:+{digits[:size]}", ["123456789", *[string.digits] * (len(own) - 1)])
        kept = iter(digits[:size] + new)
        zero = text.find("(0)")
        return "".join(c if not c.isdigit() or zero <= i < zero + 3 and zero >= 0 else next(kept) for i, c in enumerate(text))


def luhn(digits) -> int:
    """0 for a valid number."""
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10


def mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _refill(shape: str, chars: str, apart: str = "") -> str:
    """Write the characters into the places of the letters and digits of shape (apart: only these stay)."""
    it = iter(chars)
    return "".join(c if (c in apart if apart else not c.isdigit()) else next(it) for c in shape)


def _mails(text: str):
    """(start, end) of e-mail addresses, found from their @."""
    at, stop = text.find("@"), 0
    while at >= 0:
        start = at
        while start > stop and at - start < 65 and text[start - 1] in _MAIL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at)
        if m and 0 < at - start <= 64:
            stop = m.end()
            yield start, stop
        at = text.find("@", at + 1)


def _ends(m: re.Match) -> list[int]:
    """Where a candidate may end: at its end, or, for kinds written in groups, before a later group."""
    cuts = [m.start() + i for i, c in enumerate(m[0]) if c in " -"] if m.lastgroup in ("card", "iban", "abroad") else []
    return [m.end(), *reversed(cuts)]


def replacements(text: str, names: Pseudonyms) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of all values that pass their check, in order, not overlapping.

    A candidate that fails its check does not hide values inside it: the search goes on behind its
    first character."""
    out = [(a, b, "email", new) for a, b in _mails(text) if (new := names.email(text[a:b])) is not None]
    mails = [*((a, b) for a, b, _, _ in out), (len(text) + 1, len(text) + 1)]
    k, m = 0, _NUMBERS.search(text)
    while m:
        while mails[k][1] <= m.start():
            k += 1
        after = m.start() + 1
        if mails[k][0] < m.end():
            after = max(after, mails[k][1])
        else:
            for end in _ends(m):
                if (new := getattr(names, m.lastgroup)(text[m.start():end])) is not None:
                    out.append((m.start(), end, "phone" if m.lastgroup == "abroad" else m.lastgroup, new))
                    after = end
                    break
        m = _NUMBERS.search(text, after)
    return sorted(out)


def pseudonymise(text: str | None, names: Pseudonyms) -> tuple[str | None, list[dict]]:
    """The text with pseudonyms, and where they stand in it. A null text stays null."""
    if not text:
        return text, []
    out, spans, at, size = [], [], 0, 0
    for start, end, kind, new in replacements(text, names):
        out += [text[at:start], new]
        size += start - at
        spans.append({"kind": kind, "start": size, "end": size + len(new)})
        size, at = size + len(new), end
    out.append(text[at:])
    return "".join(out), spans


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


@functools.cache
def _names(key: bytes) -> Pseudonyms:
    return Pseudonyms(key)


def _batches(key: bytes, text_at: int, step: int = 512):
    def run(batches):
        names = _names(key)
        for b in batches:
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                done = [pseudonymise(t, names) for t in part.column(text_at).to_pylist()]
                columns = list(part.columns)
                columns[text_at] = pa.array([d[0] for d in done], pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.array([d[1] for d in done], _ARROW)], names=[f"c{i}" for i in range(len(columns) + 1)])

    return run


def pseudonymise_documents(docs: DataFrame, key: bytes, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """docs with pseudonyms in the text and their spans (code points of the new text, end exclusive).

    key: 16 to 64 secret bytes; the same key links values over all runs. Null texts stay null, an empty
    table gives no rows, other columns are untouched. A column named like ``spans_col`` is an error.
    """
    refuse(docs, spans_col)
    if not 16 <= len(key) <= 64:
        raise ValueError("the key must have 16 to 64 bytes")
    for_workers(docs.sparkSession)
    schema = T.StructType([*(T.StructField(f.name, f.dataType, True) for f in docs.schema.fields), T.StructField(spans_col, SPANS)])
    return docs.mapInArrow(_batches(key, docs.columns.index(text_col)), schema)
